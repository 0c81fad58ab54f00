"""Operators: functions from DataFrames to a DataFrame, usable on their own."""
