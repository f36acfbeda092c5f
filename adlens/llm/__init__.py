"""Operators for large-scale training-data pipelines.

Nothing else in the library imports this subpackage. Each module holds one
operator and its thin ``opN_*`` query; ``catalog.py`` lists the queries and
their DuckDB statements, where there are any.
"""
