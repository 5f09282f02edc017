"""Child rows nested under their parent as an ordered array."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

def ordered_array(order: Sequence[Column], payload: Column) -> Column:
    """Aggregate: payloads sorted by ``order`` (nulls last), then by content."""
    parts = []
    for i, c in enumerate(order):
        parts += [c.isNull().alias(f"n{i}"), c.alias(f"o{i}")]
    pairs = F.sort_array(F.collect_list(F.struct(*parts, payload.alias("payload"))))
    # No lambda, here and in the sort: those are not compiled.
    return pairs["payload"]


def empty_if_null(array: Column, array_type: str) -> Column:
    return F.coalesce(array, F.array().cast(array_type))
