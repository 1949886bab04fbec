"""Operators: DataFrame in, DataFrame out, the same for tables and for micro-batches."""
