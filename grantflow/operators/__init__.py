"""Operators: DataFrames and a record spec in, DataFrames out. Lazy, no actions."""
