"""Stable surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats: the text of a date or timestamp is part of a key.
DATE_TEXT = "yyyy-MM-dd"
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss.SSS"
KEY_SEPARATOR = "|"


def date_text(d: Column) -> Column:
    return F.date_format(d, DATE_TEXT)


def timestamp_text(ts: Column) -> Column:
    """Fixed milliseconds; a plain cast to string would trim trailing zeros."""
    return F.date_format(ts, TIMESTAMP_TEXT)


def natural_key(*parts: Column) -> Column:
    """Parts joined by ``|``; one null part makes the whole key null."""
    spaced: list[Column] = []
    for part in parts:
        spaced += [F.lit(KEY_SEPARATOR), part] if spaced else [part]
    return F.concat(*spaced)


def hash_id(key: Column) -> Column:
    """Base64 of the SHA-256 hex text: 88 characters.

    Spark wraps base64 output at 76 characters, so the line break is removed.
    """
    encoded = F.base64(F.sha2(key.cast("string"), 256).cast("binary"))
    return F.replace(encoded, F.lit("\r\n"), F.lit(""))
