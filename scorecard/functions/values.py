"""Casts, dates, flags and null rules used by more than one plan."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMBER = "decimal(38,0)"
RETENTION_DAYS = 90


def null_of(dtype: str | T.DataType) -> Column:
    return F.lit(None).cast(dtype)


def try_number(c: Column) -> Column:
    """Whole number from text: null on bad text, 7.5 becomes 8."""
    return c.try_cast(NUMBER)


def safe_ratio(a: Column, b: Column) -> Column:
    """0 when the divisor is 0, null when the divisor is null."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b)


def month_start(d: Column) -> Column:
    return F.trunc(d, "MM")


def month_text(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def month_number(code: Column) -> Column:
    """``'2024-03'`` becomes 202403; null on bad text."""
    return F.replace(code, F.lit("-"), F.lit("")).try_cast("bigint")


def months_before(month: date, months: int) -> date:
    """First day of the month ``months`` before ``month``."""
    index = month.year * 12 + month.month - 1 - months
    return date(index // 12, index % 12 + 1, 1)


def date_lit(d: date) -> Column:
    return F.lit(d).cast("date")


def timestamp_lit(ts: datetime) -> Column:
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")


def flag(condition: Column) -> Column:
    """1 when true, 0 when false or unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def kept_from_start(inception: Column, cancellation: Column) -> Column:
    """Never cancelled, or cancelled more than 90 days after inception."""
    return cancellation.isNull() | (
        F.datediff(cancellation, inception) > RETENTION_DAYS
    )


def kept_after(event_date: Column, cancellation: Column) -> Column:
    """Never cancelled, or cancelled later than 90 days after the event."""
    return cancellation.isNull() | (
        cancellation > F.date_add(event_date, RETENTION_DAYS)
    )


def yes_no(answer: Column) -> Column:
    """Y is 1, N is 0, anything else null; letter case is ignored."""
    upper = F.upper(answer)
    return F.when(upper == "Y", F.lit(1)).when(upper == "N", F.lit(0)).cast("bigint")
