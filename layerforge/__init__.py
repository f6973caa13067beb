"""Warehouse loads and reports as functions from DataFrames to a DataFrame."""
