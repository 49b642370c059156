"""Encoding on streaming DataFrames (encode/decode are stateless row expressions)."""
