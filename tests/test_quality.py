from datetime import datetime

from scorecard.operators import quality as q


def test_summary_counts_in_one_pass(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 2), (None, 3), ("b", None)], "ID string, x int")
    row = q.summary(df, "ID", ["x"]).first()
    assert row.asDict() == {"rows": 5, "duplicate_keys": 1, "null_keys": 2, "null_x": 2}
    empty = q.summary(df.limit(0), "ID", ["x"]).first()
    assert empty.asDict() == {"rows": 0, "duplicate_keys": 0, "null_keys": 0, "null_x": 0}


def test_column_tests(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 2), (None, 3)], "ID string, x int")
    keyed = q.column_tests(df, "ID", ["ID", "x"]).first().asDict()
    assert keyed == {"n_rows": 4, "duplicate_keys": 1, "null_values": 3}
    plain = q.column_tests(df, None, ["x"]).first().asDict()
    assert plain == {"n_rows": 4, "duplicate_keys": 0, "null_values": 1}
    assert q.column_tests(df.limit(0), "ID", ["ID"]).first()["n_rows"] == 0


def test_column_checks(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,)], "c string")
    assert q.not_null(df, "c").count() == 2
    assert [tuple(r) for r in q.unique(df, "c").collect()] == [("a", 2)]
    assert q.allowed_values(df, "c", ["b"]).count() == 2


def test_future_timestamps(spark):
    schema = "ID string, Policy struct<SystemIds: struct<LastTransactionTmsp: string>>"
    rows = [("late", (("2030-01-01 00:00:00.000",),)), ("bad", (("x",),)), ("none", ((None,),)),
            ("fine", (("2020-01-01 00:00:00.000",),))]
    df = spark.createDataFrame(rows, schema)
    assert [r["ID"] for r in q.no_future_timestamp(df, datetime(2026, 1, 1)).collect()] == ["late"]


def test_grain_parity(spark):
    a = spark.createDataFrame([("x",), ("y",)], "ID string")
    b = spark.createDataFrame([("y",), ("z",)], "ID string")
    got = {r["key"]: (r["in_base"], r["in_other"]) for r in q.grain_parity(a, b).collect()}
    assert got == {"x": (1, 0), "z": (0, 1)}
    assert q.grain_parity(a, a).count() == 0
