"""Operators: functions from DataFrames to DataFrames, thresholds as keyword parameters."""
