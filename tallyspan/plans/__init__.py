"""Warehouse models, checks and reports as configurations of the operators."""
