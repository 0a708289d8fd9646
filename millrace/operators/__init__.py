"""Table operators: lookup joins, keyed writes, change streams, aggregates on load, load chunks, transactions."""
