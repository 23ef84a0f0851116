"""Operators for preparing training data at scale, one module per operator.

Nothing outside this subpackage imports it.  ``queries.py`` registers one query
per operator; the operators themselves have general interfaces.
"""
