from datetime import date

from pyspark.sql import functions as F

from registry.queries import Tables
from scorecard.operators.nesting import ordered_array
from scorecard.plans.metrics import policy_metrics
from scorecard.plans.policy import current_scd2, latest_transaction, monthly_history, open_history
from tests.frames import by_key, entities, frame, snap, spine, stat, txn

AS_OF = date(2026, 1, 1)


def test_in_force_boundary_is_past_90_days(spark):
    _, policy, _ = entities(
        spark,
        policy_spine=[
            spine("P90", "2025-01-01", "2025-04-01"),
            spine("P91", "2025-01-01", "2025-04-02"),
            spine("S1", "2025-01-05", "2025-03-10"),
            spine("S2", "2024-11-01", "2025-01-20"),
            spine("S3", "2024-06-01", "2025-01-10"),
            spine("OPEN", "2025-01-01"),
        ],
    )
    numbers = policy.select("ID", F.col("Policy.PolicyNumber").alias("n"))
    got = by_key(
        policy_metrics(policy, names=["InForce90Flag"]).join(numbers, "ID"), "n", "InForce90Flag"
    )
    assert got == {"P90": 0, "P91": 1, "S1": 0, "S2": 0, "S3": 1, "OPEN": 1}


def test_newest_open_history_row_wins(spark):
    stats = frame(
        spark,
        "policy_stats",
        [
            stat("P", "2025-01-01T00:00:00", src="OLDER"),
            stat("P", "2025-02-01T00:00:00", src="NEWER"),
            stat("P", "2025-03-01T00:00:00", src="CLOSED", end="2025-04-01T00:00:00"),
        ],
    )
    assert [r["src_sys"] for r in current_scd2(stats).collect()] == ["NEWER"]


def test_latest_transaction_by_date_then_time(spark):
    rows = frame(
        spark,
        "transactions",
        [
            txn("P", "2025-01-01", "11111", at="23:00:00"),
            txn("P", "2025-02-01", "22222", at="01:00:00"),
            txn("P", "2025-02-01", "33333", at="02:00:00"),
        ],
    )
    assert [r["ZipCode"] for r in latest_transaction(rows).collect()] == ["33333"]


def test_back_dated_arrival_does_not_win(spark):
    """A later timestamp with an earlier effective date is not the latest."""
    rows = [
        {**txn("P", "2025-03-01", "NEW"), "src_trans_tmsp": None},
        txn("P", "2025-02-01", "OLD"),
    ]
    assert [r["ZipCode"] for r in latest_transaction(frame(spark, "transactions", rows)).collect()] == ["NEW"]


def test_monthly_history_is_ordered_and_typed(spark):
    rows = frame(
        spark,
        "monthly_snapshots",
        [
            snap("P", "2025-02", term="Renewal"),
            snap("P", "2025-01"),
            snap("P", "2024-12", term=None),
        ],
    )
    array = monthly_history(rows).first()["MonthlySnapshots"]
    assert [s["LoadYearMonthNum"] for s in array] == [202412, 202501, 202502]
    assert [s["PriorPolicy"] for s in array] == ["PRIOR", None, "PRIOR"]
    assert array[0]["LineOfBusiness"] == "AUTO"


def test_no_snapshots_counts_zero_and_keeps_the_policy(spark):
    _, policy, events = entities(
        spark,
        policy_spine=[spine("NONE"), spine("SOME")],
        monthly_snapshots=[
            snap("SOME", "2025-01"),
            snap("SOME", "2025-02", cancelled="2024-02-01"),
            snap("SOME", "2025-03", cancelled="2025-02-01"),
        ],
    )
    rows = {r["Policy"]["PolicyNumber"]: r["Policy"] for r in policy.collect()}
    assert rows["NONE"]["MonthlySnapshots"] == []
    numbers = policy.select("ID", F.col("Policy.PolicyNumber").alias("n"))
    got = by_key(
        policy_metrics(policy, names=["NumberOfPoliciesInForce"]).join(numbers, "ID"),
        "n",
        "NumberOfPoliciesInForce",
    )
    assert got == {"NONE": 0, "SOME": 2}


def test_tenure_counts_to_as_of_or_to_cancellation(spark):
    _, policy, _ = entities(
        spark, policy_spine=[spine("P", "2025-01-01", "2025-01-11")]
    )
    plain = policy_metrics(policy, as_of=AS_OF, names=["TenureDays"])
    stopped = policy_metrics(policy, as_of=AS_OF, names=["TenureDays"], stop_at_cancellation=True)
    assert plain.first()["TenureDays"] == 365
    assert stopped.first()["TenureDays"] == 10


def test_entity_fields(spark):
    _, policy, _ = entities(
        spark,
        policy_spine=[spine("P"), spine("Q")],
        transactions=[txn("P", "2025-01-01", "90210")],
        policy_stats=[stat("P", "2025-01-05T06:07:08", prior="OLDP")],
    )
    rows = {r["Policy"]["PolicyNumber"]: r["Policy"] for r in policy.collect()}
    p, q = rows["P"], rows["Q"]
    assert p["SourceSystemCode"] == "MDM"  # the transaction has none
    assert p["PriorPolicyIndicator"] == "OLDP"
    assert p["SystemIds"]["LastTransactionTmsp"] == "2025-01-01 08:00:00.000"
    assert p["SystemIds"]["LastPolicyStatsTmsp"] == "2025-01-05 06:07:08.000"
    assert (q["ZipCode"], q["PriorPolicyIndicator"], q["SystemIds"]["FdrPlcyNum"]) == (None,) * 3
    terms = policy_metrics(policy, names=["TermType"]).collect()
    assert sorted(r["TermType"] for r in terms) == ["NB", "RB"]


def test_snapshots_are_ordered_by_compiled_code(spark):
    rows = spark.createDataFrame(
        [("P", 2, "b"), ("P", None, "z"), ("P", 1, "c"), ("P", 2, "a")], "k string, n int, v string"
    )
    nested = rows.groupBy("k").agg(ordered_array([F.col("n")], F.col("v")).alias("vs"))
    assert "lambda" not in nested._jdf.queryExecution().optimizedPlan().toString()
    assert nested.first()["vs"] == ["c", "a", "b", "z"]


def test_open_history_takes_the_place_of_history(spark):
    stats = frame(
        spark,
        "policy_stats",
        [
            stat("P", "2025-01-01T00:00:00", src="OLDER"),
            stat("P", "2025-02-01T00:00:00", src="NEWER"),
            stat("Q", "2025-03-01T00:00:00", src="CLOSED", end="2025-04-01T00:00:00"),
            stat("R", "2025-03-01T00:00:00", src="TWICE"),
            stat("R", "2025-03-01T00:00:00", src="TWICE"),
        ],
    )
    once = open_history(stats)
    assert set(once.columns) == set(stats.columns)
    got = sorted(current_scd2(once).collect())
    assert got == sorted(current_scd2(stats).collect())
    assert [r["src_sys"] for r in got] == ["NEWER", "TWICE"]


def test_policies_and_events_share_spine_and_open_history(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([(1, "C", 7, 10.0, "BUILDING")], "c_custkey long, c_name string, "
        "c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{folder}/customer.parquet")
    orders = [(n, 1, "F", 1.0, f"2000-0{n}-01 00:00:00", f"{n}-X") for n in (1, 2, 3)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, "
        "o_totalprice double, o_orderdate string, o_orderpriority string").withColumn(
        "o_orderdate", F.col("o_orderdate").cast("timestamp_ntz")).write.parquet(f"{folder}/orders.parquet")
    tables = Tables(spark, folder)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    # The window that makes the history of the test tables is run once, for both.
    assert "next_tmsp" in plan(tables.sources.policy_stats())
    for entity in (tables.new_policy(), tables.new_events()):
        assert "next_tmsp" not in plan(entity)
    assert tables.new_policy().count() == 1
    assert tables.new_events().where("ChangeEvent.EventType = 'ZIP_CHANGE'").count() == 2
