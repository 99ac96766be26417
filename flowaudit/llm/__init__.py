"""Operators for preparing language-model training data (see README).

Nothing else in :mod:`flowaudit` imports this subpackage; it may import general
helpers of the library.  ``queries.py`` registers one query per operator.
"""
