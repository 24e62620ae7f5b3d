"""Operators for preparing training text, each from DataFrames to DataFrames."""
