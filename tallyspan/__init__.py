"""Spark-native warehouse toolkit for wide, one-column-per-year statistical extracts.

Every operator is a parameterised ``DataFrame -> DataFrame`` function. The
warehouse models (long table, dimensions, facts, marts, checks, reports) are
thin configurations over those operators.
"""
