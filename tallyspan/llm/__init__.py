"""Operators for preparing training text: archives, rules, filters, joins, counts.

Nothing else in the package imports this subpackage.
"""
