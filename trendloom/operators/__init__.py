"""Operators: plain functions from DataFrames to a DataFrame, parameterised by column names."""
