"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], ties: Sequence[str] = ()
) -> DataFrame:
    """The row with the greatest ``order`` per key; nulls sort as greatest.

    Spark keeps one row per key and input task before the shuffle
    (``WindowGroupLimit``), so a hot key sends one row per task.
    ``ties`` make the choice repeatable when ``order`` is equal.
    """
    newest = Window.partitionBy(*keys).orderBy(
        *[F.col(c).desc_nulls_first() for c in [*order, *ties]]
    )
    return df.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")
