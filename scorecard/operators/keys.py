"""Key sets: distinct, changed, seen."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorecard.functions.values import timestamp_lit
from scorecard.operators.staging import stage

BEGINNING = datetime(1900, 1, 1)


def high_water_mark(df: DataFrame, column: str) -> datetime:
    """Newest timestamp, or 1900-01-01 for no rows. One row to the driver."""
    newest = df.agg(F.max(column).alias("m")).first()
    return newest["m"] if newest and newest["m"] is not None else BEGINNING


def newer_than(df: DataFrame, column: str, mark: datetime) -> DataFrame:
    """Rows past the mark; the mark is a literal, so it reaches the file scan."""
    return df.where(F.col(column) > timestamp_lit(mark))


def key_set(*frames: DataFrame) -> DataFrame:
    """Distinct non-null keys of one-column frames, combined before the shuffle."""
    name = frames[0].columns[0]
    renamed = [f.toDF(name) for f in frames]
    return reduce(lambda a, b: a.unionByName(b), renamed).where(F.col(name).isNotNull()).distinct()


def settled(keys: DataFrame, label: str) -> DataFrame:
    """Write a key set once, so that its readers know its real size in bytes.

    The optimiser broadcasts it below its own threshold, and the large tables are
    then filtered where they are read; else the same joins shuffle as usual.
    """
    return stage(keys, label)


def only_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` is in the one-column frame ``keys``."""
    return df.join(keys.toDF(key), key, "left_semi")


def without_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` is not in ``keys``; null keys are kept."""
    return df.join(keys.toDF(key), key, "left_anti")
