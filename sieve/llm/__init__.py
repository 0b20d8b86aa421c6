"""Operators of a large-scale training-data pipeline.

Nothing outside this subpackage imports it.  Each module holds one operator
with its general interface; ``queries`` registers the thin ``opN_<name>``
queries, ``oracle`` the SQL where SQL can express one.
"""
