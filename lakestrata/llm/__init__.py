"""Operators of a training-data pipeline: joins, tokens, search, cleaning.

Nothing else in the library imports this subpackage.  Registered queries are
in ``queries.py``; each operator module keeps a general interface.
"""
