"""Operators for large-scale training-data pipelines.

Nothing else in the package imports this one. Each module holds one operator
with its general interface; ``queries`` holds the thin registered queries
and their SQL.
"""
