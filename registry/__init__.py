"""Queries over the test tables and their equivalent SQL."""
