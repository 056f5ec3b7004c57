"""Operators of a training-data pipeline (``opN_*`` queries, corpus pipeline).

Each module holds one operator with a general DataFrame interface and the thin
query over the given tables.  Nothing else in the library imports this
subpackage.
"""
