"""Parameterised DataFrame operators."""
