"""A Spark-native engine for keyed analytical tables, change streams and training-text corpora."""
