"""Operators for preparing training data, one module per operator.

Nothing outside this package imports it.  ``registry`` holds one query per
operator and, where SQL can say the same, its SQL.
"""
