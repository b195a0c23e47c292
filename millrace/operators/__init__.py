"""Operators on DataFrames: each is a function (DataFrame, parameters) -> DataFrame."""
