"""Values of the neighbouring row in a per-key order, safe for hot keys."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorecard.operators.skew import (
    HotKeys,
    find_hot_keys,
    shuffle_partitions,
)
from scorecard.operators.staging import stage


def _ordering(order: Sequence[str], ahead: bool) -> list[Column]:
    """Ascending with nulls last, or its exact reverse."""
    if ahead:
        return [F.col(c).desc_nulls_first() for c in order]
    return [F.col(c).asc_nulls_last() for c in order]


def with_neighbour(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    columns: dict[str, str],
    *,
    ahead: bool = False,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Add the previous (or next) row's values: ``columns`` maps new to source."""
    if hot is None:
        hot = find_hot_keys(df, key)
    ordinary, spread = neighbour_parts(df, key, order, columns, hot, ahead=ahead)
    return ordinary if spread is None else ordinary.unionByName(spread)


def neighbour_parts(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    columns: dict[str, str],
    hot: HotKeys,
    *,
    ahead: bool = False,
) -> tuple[DataFrame, DataFrame | None]:
    """The rows of ordinary keys, and those of hot keys if there are any.

    Ordinary keys use one window: one shuffle and one sort, and the result stays
    partitioned by the key for what follows. A hot key's history is cut into
    order ranges first, so no task holds all of it.
    """
    ordinary = df if not hot.any else df.where(~hot.matches(F.col(key)))
    w = Window.partitionBy(key).orderBy(*_ordering(order, ahead))
    result = ordinary.select(
        "*", *[F.lag(src).over(w).alias(new) for new, src in columns.items()]
    )
    return result, _hot_neighbour(df, key, order, columns, ahead, hot) if hot.any else None


def _hot_neighbour(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    columns: dict[str, str],
    ahead: bool,
    hot: HotKeys,
) -> DataFrame:
    """Neighbour values for hot keys, range by range.

    Rows are range-partitioned on (key, order); a range is one piece of a key's
    history. Inside a piece the neighbour is an ordinary lag. The first row of
    a piece takes its value from the end of the piece before it. There are at
    most (ranges + hot keys) pieces, so that table is small by construction.

    The pieces are written once: range bounds come from a sample and must be
    the same for both readers.
    """
    names = df.columns
    ranges = max(2, math.ceil(hot.total_share * shuffle_partitions(df)))
    ordering = _ordering(order, ahead)
    pieces = stage(
        df.where(hot.matches(F.col(key)))
        .repartitionByRange(ranges, F.col(key), *ordering)
        .withColumn("_piece", F.spark_partition_id()),
        "hot-history",
    )
    rows = pieces.withColumnRenamed(key, "_key")
    order_cols = ["_key" if c == key else c for c in order]
    source = {new: "_key" if src == key else src for new, src in columns.items()}

    last = Window.partitionBy("_key", "_piece").orderBy(
        *[F.col(c).asc_nulls_last() if ahead else F.col(c).desc_nulls_first() for c in order_cols]
    )
    ends = (
        rows.withColumn("_rank", F.row_number().over(last))
        .where("_rank = 1")
        .select("_key", "_piece", *[F.col(src).alias(f"_end_{new}") for new, src in source.items()])
    )
    across = Window.partitionBy("_key").orderBy("_piece")
    before = ends.select(
        F.col("_key").alias("_bkey"),
        F.col("_piece").alias("_bpiece"),
        *[F.lag(f"_end_{new}").over(across).alias(f"_before_{new}") for new in source],
    )
    inside = Window.partitionBy("_key", "_piece").orderBy(*_ordering(order_cols, ahead))
    joined = rows.select(
        "*",
        F.row_number().over(inside).alias("_row"),
        *[F.lag(src).over(inside).alias(f"_lag_{new}") for new, src in source.items()],
    ).join(
        F.broadcast(before),
        F.col("_key").eqNullSafe(F.col("_bkey")) & (F.col("_piece") == F.col("_bpiece")),
        "left",
    )
    return joined.withColumnRenamed("_key", key).select(
        *names,
        *[
            F.when(F.col("_row") == 1, F.col(f"_before_{new}"))
            .otherwise(F.col(f"_lag_{new}"))
            .alias(new)
            for new in source
        ],
    )
