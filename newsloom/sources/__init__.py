"""Readers that turn landed files into DataFrames."""
