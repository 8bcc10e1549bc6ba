"""Operators: DataFrames in, DataFrames out, lazy unless a docstring says otherwise."""
