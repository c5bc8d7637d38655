"""Operators from DataFrame to DataFrame, parameterised by column names."""
