"""Operators of a training-data pipeline on tables of texts, one module for each.

Nothing else in the package imports this subpackage.
"""
