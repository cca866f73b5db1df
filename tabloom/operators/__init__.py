"""Operators: functions from DataFrame to DataFrame, grouped by purpose."""
