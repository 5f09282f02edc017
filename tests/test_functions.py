import base64
import hashlib
from datetime import date, datetime

from pyspark.sql import functions as F

from scorecard.functions.keys import hash_id, natural_key, timestamp_text
from scorecard.functions.values import (
    month_number,
    months_before,
    safe_ratio,
    try_number,
    yes_no,
)


def one(spark, c):
    return spark.range(1).select(c.alias("v")).first()["v"]


def test_hash_id_is_base64_of_the_hex_text(spark):
    got = one(spark, hash_id(F.lit("POL001")))
    hexed = hashlib.sha256(b"POL001").hexdigest()
    assert got == base64.b64encode(hexed.encode()).decode()
    assert len(got) == 88 and "\n" not in got and "\r" not in got


def test_a_null_part_makes_the_key_null(spark):
    assert one(spark, natural_key(F.lit("a"), F.lit("b"))) == "a|b"
    assert one(spark, natural_key(F.lit("a"), F.lit(None).cast("string"))) is None
    assert one(spark, hash_id(F.lit(None).cast("string"))) is None


def test_timestamp_text_keeps_milliseconds(spark):
    at = F.lit("2026-01-02 03:04:05").cast("timestamp_ntz")
    assert one(spark, timestamp_text(at)) == "2026-01-02 03:04:05.000"


def test_try_number_rounds_and_forgives(spark):
    rows = spark.createDataFrame([("7.5",), ("N/A",), (None,), ("10",)], "x string")
    got = [r["v"] for r in rows.select(try_number(F.col("x")).alias("v")).collect()]
    assert [None if v is None else int(v) for v in got] == [8, None, None, 10]


def test_safe_ratio(spark):
    rows = spark.createDataFrame([(3, 2), (3, 0), (3, None), (0, 5)], "a long, b long")
    got = [r["v"] for r in rows.select(safe_ratio(F.col("a"), F.col("b")).alias("v")).collect()]
    assert got == [1.5, 0.0, None, 0.0]


def test_yes_no_ignores_case(spark):
    rows = spark.createDataFrame([("Y",), ("y",), ("n",), ("maybe",), (None,)], "x string")
    got = [r["v"] for r in rows.select(yes_no(F.col("x")).alias("v")).collect()]
    assert got == [1, 1, 0, None, None]


def test_months(spark):
    assert one(spark, month_number(F.lit("2024-03"))) == 202403
    assert one(spark, month_number(F.lit("bad"))) is None
    assert months_before(date(2026, 2, 1), 3) == date(2025, 11, 1)
    assert months_before(date(2026, 12, 31), 0) == date(2026, 12, 1)
    assert datetime(2026, 1, 1).month == 1
