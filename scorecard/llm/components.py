"""Connected components of a link table, by alternating star contraction.

Each round points every node at the smallest node it can see, first among its
larger neighbours, then among its smaller ones, until nothing changes. A round
is two shuffles of the links; nothing but one row of totals reaches the driver.
Rounds grow with the logarithm of the component size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorecard.operators.staging import stage


def _totals(links: DataFrame):
    row = links.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).alias("h"),
    ).first()
    return row["n"], row["h"]


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (smallest node of its component) for every linked node.

    ``links`` has two long columns a and b, in any order; loops and repeats are fine.
    """
    now = stage(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    totals = _totals(now)
    while totals[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        low = low.select("a", F.least("a", "m").alias("m"))
        # Larger neighbours move to the smallest node in sight.
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # Smaller neighbours, and the node itself, move to the smallest of them.
        small_low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(small_low, "a")
            .select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("x"))
            .select(F.col("x.b").alias("a"), F.col("x.m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        after = stage(small, "links")
        now, before, totals = after, totals, _totals(after)
        if totals == before:
            break
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
