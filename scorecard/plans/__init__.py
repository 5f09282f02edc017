"""Entities, metrics, wide tables, views and loads."""
