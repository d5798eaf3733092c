"""Readers: files and tables to DataFrames with stated schemas."""
