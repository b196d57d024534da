"""Operators: each takes DataFrames and returns a DataFrame, or runs one set-based job for all tenants."""
