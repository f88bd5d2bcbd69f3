"""Operators for preparing text corpora at scale.

Each module holds one operator with its own general interface, the thin
``opN_*`` query over the test tables and, where SQL can express it, the
query's SQL. Nothing else in the library imports this subpackage.
"""
