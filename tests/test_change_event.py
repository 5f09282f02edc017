from pyspark.sql import functions as F

from scorecard.operators.quality import unresolved_links
from scorecard.operators.skew import HotKeys
from scorecard.plans.change_event import (
    agent_change_events,
    all_change_events,
    change_event_entity,
    ranked_transactions,
    zip_change_events,
)
from scorecard.plans.metrics import event_metrics, policy_metrics
from tests.frames import by_key, entities, frame, snap, spine, stat, txn  # noqa: F401


def ranked(spark, *rows):
    return ranked_transactions(frame(spark, "transactions", list(rows)))


def test_an_unknown_value_breaks_the_chain(spark):
    r = ranked(
        spark,
        txn("P", "2025-01-01", "A"),
        txn("P", "2025-02-01", None),
        txn("P", "2025-03-01", "B"),
    )
    assert zip_change_events(r).count() == 0


def test_the_first_transaction_is_no_event(spark):
    assert all_change_events(ranked(spark, txn("P", "2025-01-01", "A", "X"))).count() == 0


def test_both_changes_in_one_transaction_are_two_events(spark):
    _, _, events = entities(
        spark,
        policy_spine=[spine("P")],
        transactions=[txn("P", "2025-01-01", "A", "X"), txn("P", "2025-02-01", "B", "Y")],
    )
    rows = events.collect()
    assert {r["ChangeEvent"]["EventType"] for r in rows} == {"ZIP_CHANGE", "AGENT_CHANGE"}
    assert len({r["ID"] for r in rows}) == 2
    by_kind = {r["ChangeEvent"]["EventType"]: r["ChangeEvent"] for r in rows}
    assert (by_kind["ZIP_CHANGE"]["PreviousZipCode"], by_kind["ZIP_CHANGE"]["ZipCode"]) == ("A", "B")
    assert by_kind["ZIP_CHANGE"]["AgentNumber"] is None
    assert by_kind["AGENT_CHANGE"]["ZipCode"] is None
    assert by_kind["AGENT_CHANGE"]["EventMonth"] == "2025-02"
    assert by_kind["AGENT_CHANGE"]["Rten"]["SRC_TRANS_TMSP"] == "2025-02-01 08:00:00.000"


def test_one_pass_equals_the_union(spark):
    r = ranked(
        spark,
        txn("P", "2025-01-01", "A", "X"),
        txn("P", "2025-02-01", "B", "Y"),
        txn("P", "2025-03-01", "B", "Z"),
        txn("Q", "2025-03-01", "C", "Z"),
    )
    union = zip_change_events(r).unionByName(agent_change_events(r))
    assert sorted(map(str, all_change_events(r).collect())) == sorted(map(str, union.collect()))


def test_history_rows_do_not_repeat_events(spark):
    _, _, events = entities(
        spark,
        policy_spine=[spine("P")],
        transactions=[txn("P", "2025-01-01", "A"), txn("P", "2025-02-01", "B")],
        policy_stats=[
            stat("P", "2025-01-01T00:00:00", end="2025-01-02T00:00:00"),
            stat("P", "2025-01-02T00:00:00", src="OPEN1"),
            stat("P", "2025-01-03T00:00:00", src="OPEN2"),
        ],
    )
    rows = events.collect()
    assert len(rows) == 1
    assert rows[0]["ChangeEvent"]["SourceSystemCode"] == "OPEN2"


def test_unresolved_link_counts_as_in_force_and_is_reported(spark):
    s, policy, events = entities(
        spark,
        policy_spine=[spine("OTHER")],
        transactions=[txn("P", "2025-01-01", "A"), txn("P", "2025-02-01", "B")],
    )
    flags = event_metrics(events, policy).collect()
    assert [r["InForce90DaysAfterChangeFlag"] for r in flags] == [1]
    assert unresolved_links(events).count() == 1
    # The event has no policy to roll up to.
    counts = policy_metrics(policy, events, names=["NumberOfZipChangeEvents"]).collect()
    assert [r["NumberOfZipChangeEvents"] for r in counts] == [0]


def test_retention_is_null_without_events_and_counts_zero(spark):
    _, policy, events = entities(
        spark,
        policy_spine=[spine("P", cancelled="2025-05-02"), spine("Q")],
        transactions=[
            txn("P", "2025-01-01", "A"),
            txn("P", "2025-02-01", "B"),  # cancelled exactly 90 days later
            txn("P", "2025-01-31", "C"),  # 91 days
        ],
    )
    names = [
        "NumberOfZipChangeEvents",
        "NumberOfMovedPoliciesInForce90Days",
        "MovedPolicyRetentionRate90Days",
        "NumberOfAgentChangeEvents",
        "AgentChangeRetentionRate90Days",
    ]
    numbers = policy.select("ID", F.col("Policy.PolicyNumber").alias("n"))
    rows = {
        r["n"]: [r[c] for c in names]
        for r in policy_metrics(policy, events, names=names).join(numbers, "ID").collect()
    }
    assert rows["P"] == [2, 1, 0.5, 0, None]
    assert rows["Q"] == [0, 0, None, 0, None]


def test_a_hot_policy_gives_the_same_events(spark):
    rows = [
        txn("HOT", f"2025-{1 + i // 28:02d}-{1 + i % 28:02d}", f"{i // 2 % 7}", f"A{i // 3 % 5}")
        for i in range(200)
    ] + [txn(f"P{i}", f"2025-01-{1 + j:02d}", f"{(i + j) % 3}", "A") for i in range(20) for j in range(5)]
    s, policy, plain = entities(
        spark, transactions=rows, policy_spine=[spine("HOT"), *(spine(f"P{i}") for i in range(20))]
    )
    spread = change_event_entity(
        s.transactions(), s.policy_spine(), s.policy_stats(), policy, HotKeys({"HOT": 0.66})
    )
    assert sorted(map(str, spread.collect())) == sorted(map(str, plain.collect()))
    hot_flags = event_metrics(
        plain, policy, hot=HotKeys({policy.where("Policy.PolicyNumber = 'HOT'").first()["ID"]: 0.6})
    )
    assert sorted(map(str, hot_flags.collect())) == sorted(map(str, event_metrics(plain, policy).collect()))


def test_events_are_spread_by_compiled_code(spark):
    r = ranked(spark, txn("P", "2025-01-01", "A", "X"), txn("P", "2025-02-01", "B", "Y"))
    events = all_change_events(r)
    assert "lambda" not in events._jdf.queryExecution().optimizedPlan().toString()
    assert events.count() == 2
