"""Finding hot keys and joining around them.

A hot key is one whose rows exceed a task's fair share by ``HOT_FACTOR``. They
are found with a frequent-items sketch: one pass over the key column, a fixed
size per task, one row to the driver. Being hot only changes how rows are
spread, never which rows come out, so the sketch need not be exact.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_FACTOR = 4
# Counters of the sketch per hot key that there can be, and their least number. One
# task merges the counters of all tasks. Counts are off by under 4 / counters of the
# rows, with 100 counters a hot key by under a twenty-fifth of what makes a key hot.
SKETCH_FACTOR, SKETCH_ITEMS, SKETCH_LIMIT = 100, 10_000, 1_000_000


@dataclass(frozen=True)
class HotKeys:
    """Hot values of one key column, with their estimated share of the rows."""

    shares: dict[object, float] = field(default_factory=dict)
    null_share: float = 0.0

    @property
    def any(self) -> bool:
        return bool(self.shares) or self.null_share > 0

    @property
    def total_share(self) -> float:
        return min(1.0, sum(self.shares.values()) + self.null_share)

    def matches(self, key: Column) -> Column:
        """True for rows whose key is hot; never null."""
        tests = [F.coalesce(key.isin(list(self.shares)), F.lit(False))] if self.shares else []
        if self.null_share > 0:
            tests.append(key.isNull())
        return reduce(lambda a, b: a | b, tests) if tests else F.lit(False)


NO_HOT_KEYS = HotKeys()


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def find_hot_keys(df: DataFrame, key: str, *, factor: float = HOT_FACTOR) -> HotKeys:
    """Keys of ``df`` holding more than ``factor`` fair task shares of its rows.

    With P shuffle partitions at most P / ``factor`` keys can; the sketch is asked
    for so many, so none is left out at any number of partitions.
    """
    possible = max(1, math.ceil(shuffle_partitions(df) / factor))
    items = min(SKETCH_LIMIT, max(SKETCH_ITEMS, SKETCH_FACTOR * possible))
    row = df.select(F.col(key).alias("k")).agg(
        F.expr(f"approx_top_k(k, {possible}, {items})").alias("top"),
        F.count(F.lit(1)).alias("n"),
    ).first()
    if row is None or not row["n"]:
        return NO_HOT_KEYS
    limit = factor * row["n"] / shuffle_partitions(df)
    shares: dict[object, float] = {}
    null_share = 0.0
    for item in row["top"]:
        if item["count"] <= limit:
            continue
        if item["item"] is None:
            null_share = item["count"] / row["n"]
        else:
            shares[item["item"]] = item["count"] / row["n"]
    return HotKeys(shares, null_share)


def lookup_join(
    left: DataFrame, right: DataFrame, key: str, hot: HotKeys = NO_HOT_KEYS, how: str = "left"
) -> DataFrame:
    """Left or inner join to a side with one row per key.

    Rows of hot keys meet a broadcast of one right row per hot key (a quarter of
    the shuffle partitions at most) and are not shuffled; the rest join as usual. Rows with a hot null key match
    nothing and skip the shuffle in the same way.
    """
    if not hot.any:
        return left.join(right, key, how)
    is_hot = hot.matches(F.col(key))
    usual = left.where(~is_hot).join(right, key, how)
    few = right.where(F.col(key).isin(list(hot.shares)) if hot.shares else F.lit(False))
    spread = left.where(is_hot).join(F.broadcast(few), key, how)
    return usual.unionByName(spread)
