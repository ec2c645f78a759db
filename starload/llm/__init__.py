"""Operators for large training-data pipelines.

Nothing else in the package imports this folder.  Each module holds one
operator with its own general interface; ``queries.py`` registers the thin
``opN_<name>`` queries over the given tables.
"""
