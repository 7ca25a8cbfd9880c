"""Operators: functions from DataFrames to DataFrames, without actions and without I/O."""
