"""Operators: functions from DataFrames to a DataFrame, one module per layer."""
