"""Operators: functions from DataFrame to DataFrame, composable with ``DataFrame.transform``."""
