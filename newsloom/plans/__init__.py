"""Whole runs and reports composed from the operators."""
