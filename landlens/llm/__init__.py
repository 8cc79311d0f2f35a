"""Operators for training-data corpora: one module an operator, see each docstring.

Nothing else in the library imports this package.  All operators share these
conventions: a null text is an empty text, rows are nodes (a repeated row or a
repeated id is judged like any other row), input columns that an operator does
not know are left alone, and an empty table gives an empty result with the same
columns.
"""
