"""Operators for preparing large text corpora for model training.

Nothing else in the package imports this folder.  Each module holds one
operator with its own general interface and the thin ``opN_<name>`` query that
applies it to the given tables; ``queries.py`` lists them.
"""
