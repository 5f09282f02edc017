"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this folder. Each module holds one operator
with its own interface; ``queries.py`` holds the thin registered queries.
"""
