"""Data-quality checks. Each returns failing rows; an empty result passes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorecard.functions.values import timestamp_lit

# The two kinds of change event.
EVENT_TYPES = ("ZIP_CHANGE", "AGENT_CHANGE")


class QualityError(ValueError):
    """A check that guards a write has failing rows."""


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values held by more than one row, with their count; nulls are ignored."""
    return (
        df.select(F.col(column).alias("value"))
        .where(F.col("value").isNotNull())
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("DuplicateCount"))
        .where(F.col("DuplicateCount") > 1)
    )


def allowed_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.where(~F.col(column).isin(*values))


def event_type_valid(change_events: DataFrame) -> DataFrame:
    return allowed_values(change_events, "ChangeEvent.EventType", EVENT_TYPES).select(
        F.col("ChangeEvent.EventType").alias("event_type")
    )


def no_future_timestamp(policy: DataFrame, as_of: datetime) -> DataFrame:
    """Policies whose last transaction lies past ``as_of``; bad text passes."""
    stamp = F.col("Policy.SystemIds.LastTransactionTmsp").try_cast("timestamp_ntz")
    return policy.where(stamp > timestamp_lit(as_of)).select("ID")


def unresolved_links(change_events: DataFrame) -> DataFrame:
    """Events whose policy link found no policy."""
    return not_null(change_events, "ChangeEvent.Policy.ID").select("ID")


def grain_parity(base: DataFrame, other: DataFrame, key: str = "ID") -> DataFrame:
    """Keys held by only one of the two frames; one shuffle, combined before it."""
    sides = base.select(
        F.col(key).alias("key"), F.lit(1).alias("in_base"), F.lit(0).alias("in_other")
    ).unionByName(
        other.select(
            F.col(key).alias("key"), F.lit(0).alias("in_base"), F.lit(1).alias("in_other")
        )
    )
    return (
        sides.groupBy("key")
        .agg(F.max("in_base").alias("in_base"), F.max("in_other").alias("in_other"))
        .where(F.col("in_base") + F.col("in_other") < 2)
    )


def summary(df: DataFrame, key: str, required: Sequence[str] = ()) -> DataFrame:
    """Row count, duplicated keys, null keys and null required columns in one pass."""

    def nulls(c: Column) -> Column:
        return F.sum(c.isNull().cast("bigint"))

    per_key = df.groupBy(F.col(key).alias("_key")).agg(
        F.count(F.lit(1)).alias("_n"),
        *[nulls(F.col(c)).alias(f"_null_{i}") for i, c in enumerate(required)],
    )
    repeated = F.col("_key").isNotNull() & (F.col("_n") > 1)
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(repeated.cast("bigint")), F.lit(0)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(F.col("_key").isNull(), F.col("_n"))), F.lit(0)).alias("null_keys"),
        *[
            F.coalesce(F.sum(f"_null_{i}"), F.lit(0)).alias(f"null_{c.replace('.', '_')}")
            for i, c in enumerate(required)
        ],
    )


# Declared column tests of the input tables: unique key, columns that are never null.
SOURCE_TESTS: dict[str, tuple[str | None, tuple[str, ...]]] = {
    "policy_spine": ("plcy_cntrct_num", ("plcy_cntrct_num", "plcy_incept_dt")),
    "transactions": (None, ("plcy_cntrct_num",)),
    "policy_stats": (None, ("plcy_num",)),
    "responses_agent_change": ("responseid", ("responseid",)),
    "responses_new_business": ("responseid", ("responseid",)),
    "responses_renewal": ("responseid", ("responseid",)),
    "responses_rnps": ("responseid", ("responseid",)),
    "responses_css_ces": ("responseid", ("responseid",)),
    "contacts": ("id", ("id",)),
    "phone_outcomes": ("id", ("id",)),
}
# The same for the built tables.
TABLE_TESTS: dict[str, tuple[str | None, tuple[str, ...]]] = {
    "PolicyRaw": ("ID", ("ID",)),
    "ChangeEventRaw": ("ID", ("ID",)),
    "SurveyRaw": ("ID", ("ID",)),
    "ContactRaw": ("ID", ("ID",)),
    "PolicyMetrics": ("ID", ("ID", "NumberOfZipChangeEvents", "NumberOfAgentChangeEvents")),
    "ChangeEventMetrics": ("ID", ("ID",)),
    "SurveyMetrics": ("ID", ("ID",)),
}


def column_tests(df: DataFrame, key: str | None, required: Sequence[str]) -> DataFrame:
    """One row: ``n_rows``, ``duplicate_keys``, ``null_values`` over ``required``.

    Without a key there is no shuffle of rows, only of per-task counts.
    """
    missing = [F.col(c).isNull().cast("bigint") for c in required]
    nulls = missing[0]
    for m in missing[1:]:
        nulls = nulls + m
    n, empty = F.count(F.lit(1)), F.lit(0).cast("bigint")
    if key is None:
        return df.agg(
            n.alias("n_rows"),
            empty.alias("duplicate_keys"),
            F.coalesce(F.sum(nulls), empty).alias("null_values"),
        )
    per_key = df.groupBy(F.col(key).alias("_key")).agg(n.alias("_n"), F.sum(nulls).alias("_nulls"))
    repeated = (F.col("_key").isNotNull() & (F.col("_n") > 1)).cast("bigint")
    return per_key.agg(
        F.coalesce(F.sum("_n"), empty).alias("n_rows"),
        F.coalesce(F.sum(repeated), empty).alias("duplicate_keys"),
        F.coalesce(F.sum("_nulls"), empty).alias("null_values"),
    )


def require_empty(failing: DataFrame, what: str) -> None:
    """Stop before a write when a guarding check has failing rows."""
    first = failing.limit(1).collect()
    if first:
        raise QualityError(f"{what}: for example {first[0].asDict()}")
