"""Merging a delta into a previous version of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from scorecard.operators.keys import settled


def upsert(
    target: DataFrame, delta: DataFrame, key: str = "ID", *, settle: bool = False
) -> DataFrame:
    """Delta rows replace target rows with their key; nothing is deleted.

    ``settle`` writes and counts the delta's keys first: a small delta then
    filters the target as it is read, without shuffling it.
    """
    keys = delta.select(key)
    if settle:
        keys = settled(keys, "upsert-keys")
    return target.join(keys, key, "left_anti").unionByName(delta)


def insert_new(target: DataFrame, candidates: DataFrame, key: str = "ID") -> DataFrame:
    """Candidate rows whose key the target does not hold yet."""
    return candidates.join(target.select(key), key, "left_anti")
