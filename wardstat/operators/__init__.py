"""Operators from DataFrame to DataFrame, independent of any one table."""
