"""Scalar functions: text, delimiters, encoding, types."""
