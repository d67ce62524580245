"""Whole analyses composed from operators. Each step is a function of DataFrames."""
