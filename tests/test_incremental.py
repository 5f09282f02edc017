from datetime import datetime

import pytest

from scorecard.operators.keys import only_keys, settled
from scorecard.operators.upsert import insert_new, upsert
from scorecard.plans import build as bd
from scorecard.plans import event_load as el
from scorecard.plans import incremental as inc
from scorecard.plans.survey import all_campaigns, all_responses, by_wave, survey_entity, wave_measures
from scorecard.store import TableStore
from tests.frames import answer, entities, invite, snap, sources, spine, stat, txn


def text(df):
    return sorted(map(str, df.collect()))


BEFORE = {
    "policy_spine": [spine("A"), spine("B"), spine("C")],
    "transactions": [
        txn("A", "2025-01-01", "1"),
        txn("A", "2025-02-01", "2"),
        txn("B", "2025-01-01", "1"),
        txn("C", "2025-01-01", "7", "X"),
    ],
    "policy_stats": [stat("A", "2025-01-01T00:00:00"), stat("B", "2025-01-01T00:00:00", prior="OLD")],
    "monthly_snapshots": [snap("B", "2024-01"), snap("A", "2025-02")],
}
AFTER = {
    "policy_spine": [
        spine("A"),
        spine("B", cancelled="2025-06-01"),  # changes without a new transaction
        spine("C"),
        spine("D"),
    ],
    "transactions": [
        *BEFORE["transactions"],
        txn("A", "2025-03-01", "3"),
        txn("D", "2024-01-01", "5"),  # a new policy older than the mark
        txn("D", "2024-02-01", "6"),
    ],
    "policy_stats": [
        *BEFORE["policy_stats"][:1],
        stat("B", "2025-01-01T00:00:00", prior="OLD", end="2025-03-01T00:00:00"),
        stat("B", "2025-03-01T00:00:00", prior="NEWER"),
    ],
    "monthly_snapshots": [*BEFORE["monthly_snapshots"], snap("C", "2025-03")],
}


def test_policy_load_equals_a_rebuild(spark):
    old, previous, _ = entities(spark, **BEFORE)
    new, rebuilt, _ = entities(spark, **AFTER)
    loaded = inc.load_policy(previous, new, inc.source_marks(old))
    assert text(loaded) == text(rebuilt)


def test_unchanged_policies_keep_their_enrichment(spark):
    """A load must not blank the zip, prior policy or snapshots of policies it skips."""
    old, previous, _ = entities(spark, **BEFORE)
    keys = inc.policy_changed_keys(previous, old, inc.source_marks(old))
    # Only the snapshot look-back still names a policy.
    assert [r[0] for r in keys.collect()] == ["A"]
    assert text(inc.load_policy(previous, old, inc.source_marks(old))) == text(previous)


def test_changed_keys_name_every_signal(spark):
    old, previous, _ = entities(spark, **BEFORE)
    new, _, _ = entities(spark, **AFTER)
    keys = inc.policy_changed_keys(previous, new, inc.source_marks(old))
    assert sorted(r[0] for r in keys.collect()) == ["A", "B", "C", "D"]


def test_late_back_dated_transaction_does_not_take_over(spark):
    old, previous, _ = entities(spark, **BEFORE)
    late = {**txn("A", "2024-06-01", "9"), "src_trans_tmsp": datetime(2025, 9, 1)}
    new, rebuilt, _ = entities(spark, **{**BEFORE, "transactions": [*BEFORE["transactions"], late]})
    loaded = inc.load_policy(previous, new, inc.source_marks(old))
    assert text(loaded) == text(rebuilt)
    zips = {r["Policy"]["PolicyNumber"]: r["Policy"]["ZipCode"] for r in loaded.collect()}
    assert zips["A"] == "2"


def event_store(spark, path, old, policy):
    store = TableStore(spark, str(path), buckets=4)
    bd.store_change_events(store, old, policy)
    return store


def test_event_load_equals_a_rebuild(spark, tmp_path):
    old, old_policy, _ = entities(spark, **BEFORE)
    new, policy, rebuilt = entities(spark, **{**AFTER, "policy_stats": BEFORE["policy_stats"]})
    store = event_store(spark, tmp_path, old, old_policy)
    loaded = bd.merge_change_events(store, new, policy, inc.source_marks(old))
    assert text(loaded) == text(rebuilt)
    assert loaded.count() == 3  # one stored, one for A, one for the never-seen D
    assert text(store.read("ChangeEventTails")) == text(el.history_tails(new.transactions()))


@pytest.mark.parametrize("day", ["2024-06-01", "2025-01-15", "2025-02-01", "2025-02-02", "2026-01-01"])
def test_late_rows_equal_a_rebuild(spark, tmp_path, day):
    """A late row may remove a stored event, alter one, add one, or come last."""
    old, old_policy, _ = entities(spark, **BEFORE)
    late = [
        {**txn("A", day, "2"), "src_trans_tmsp": datetime(2026, 9, 1)},
        {**txn("A", day, "1", "Y"), "src_trans_tmsp": datetime(2026, 9, 2)},
        {**txn("C", "2024-01-01", None, None), "src_trans_tmsp": datetime(2026, 9, 1)},
    ]
    new, policy, rebuilt = entities(spark, **{**BEFORE, "transactions": [*BEFORE["transactions"], *late]})
    store = event_store(spark, tmp_path, old, old_policy)
    assert text(bd.merge_change_events(store, new, policy, inc.source_marks(old))) == text(rebuilt)
    # And a later row then goes on from the new tail.
    more = [*BEFORE["transactions"], *late, {**txn("A", "2026-02-01", "9"), "src_trans_tmsp": datetime(2026, 10, 1)}]
    after, policy, rebuilt = entities(spark, **{**BEFORE, "transactions": more})
    assert text(bd.merge_change_events(store, after, policy, inc.source_marks(new))) == text(rebuilt)


def test_a_corrected_event_replaces_the_stored_one(spark, tmp_path):
    old, old_policy, events = entities(spark, **BEFORE)
    assert [e["ChangeEvent"]["PreviousZipCode"] for e in events.collect()] == ["1"]
    between = {**txn("A", "2025-01-20", "5"), "src_trans_tmsp": datetime(2025, 9, 1)}
    new, policy, _ = entities(spark, **{**BEFORE, "transactions": [*BEFORE["transactions"], between]})
    store = event_store(spark, tmp_path, old, old_policy)
    loaded = bd.merge_change_events(store, new, policy, inc.source_marks(old)).collect()
    changes = sorted((e["ChangeEvent"]["PreviousZipCode"], e["ChangeEvent"]["ZipCode"]) for e in loaded)
    assert changes == [("1", "5"), ("5", "2")]


def test_only_late_and_unseen_policies_read_old_transactions(spark):
    old, _, _ = entities(spark, **BEFORE)
    new, policy, _ = entities(spark, **AFTER)
    tails = el.history_tails(old.transactions())
    onward, whole = el.changed_history(new, tails, inc.source_marks(old).transactions)
    assert [r[0] for r in whole.collect()] == ["D"]
    assert [(r[el.KEY], str(r["EffectiveDate"])) for r in onward.collect()] == [("A", "2025-03-01")]
    load = el.event_load(new, policy, tails, inc.source_marks(old).transactions)
    assert sorted(r[el.KEY] for r in load.tails.collect()) == ["A", "D"]


def test_event_load_twice_changes_nothing(spark, tmp_path):
    new, policy, events = entities(spark, **AFTER)
    store = event_store(spark, tmp_path, new, policy)
    for marks in (inc.source_marks(new), inc.Marks(), inc.Marks()):
        assert text(bd.merge_change_events(store, new, policy, marks)) == text(events)


@pytest.mark.parametrize("done", ["ChangeEventRaw", "ChangeEventTails"])
def test_a_load_that_failed_half_way_is_repeated(spark, tmp_path, done):
    """After the events, or after the tails too, were stored and before the marks were."""
    old, old_policy, _ = entities(spark, **BEFORE)
    new, policy, rebuilt = entities(spark, **{**AFTER, "policy_stats": BEFORE["policy_stats"]})
    store, marks = event_store(spark, tmp_path, old, old_policy), inc.source_marks(old)
    if done == "ChangeEventRaw":
        load = el.event_load(new, policy, store.read("ChangeEventTails"), marks.transactions)
        store.merge("ChangeEventRaw", load.events, el.NUMBER, load.replaced, str(marks.transactions))
    else:
        bd.merge_change_events(store, new, policy, marks)
    assert text(bd.merge_change_events(store, new, policy, marks)) == text(rebuilt)


def test_survey_lookback_recomputes_recent_waves_only(spark):
    invites = [invite("P", "2025-01-05"), invite("Q", "2025-06-05"), invite("Q", "2025-08-05")]
    old = sources(
        spark,
        invites_agent_change=invites,
        responses_agent_change=[answer("R1", "P", "5"), answer("R2", "Q", "5")],
    )
    new = sources(
        spark,
        invites_agent_change=[*invites, invite("P", "2025-09-05")],
        responses_agent_change=[
            answer("R1", "P", "5"),
            answer("R2", "Q", "5"),
            answer("R3", "P", "9"),
            answer("R4", "Q", "9"),
        ],
    )
    stored, stored_responses = survey_entity(all_campaigns(old)), all_responses(old)
    survey, responses = inc.load_survey(stored, stored_responses, new)
    counts = {
        r["Survey"]["InviteWave"].month: r["Survey"]["ResponseCount"] for r in survey.collect()
    }
    # January lies before the look-back and keeps its stored count.
    assert counts == {1: 1, 6: 2, 8: 2, 9: 2}
    per_wave = {r["InviteWave"].month: r["count"] for r in by_wave(responses).groupBy("InviteWave").count().collect()}
    assert per_wave == counts
    survey2, responses2 = inc.load_survey(survey, responses, new)
    assert text(survey2) == text(survey) and text(responses2) == text(responses)


def loaded_survey(spark, old, new):
    """A load of ``new`` after ``old``, from stored totals, and what a rebuild gives."""
    stored, responses = survey_entity(all_campaigns(old)), all_responses(old)
    load = inc.survey_load(stored, responses, wave_measures(responses), new)
    _, merged = inc.load_survey(stored, responses, new)
    whole = all_responses(new)
    return load, merged, survey_entity(all_campaigns(new)), whole, wave_measures(whole)


def test_totals_follow_responses_that_move_repeat_and_go(spark):
    invites = [invite("P", "2025-06-05"), invite("Q", "2025-06-05"), invite("Q", "2025-08-05")]
    old = sources(
        spark,
        invites_agent_change=invites,
        responses_agent_change=[answer("R1", "P", "5"), answer("R2", "Q", "4"), answer("R3", "Q", "1")],
        responses_rnps=[answer("N1", "P", "3", "2025-01-10"), answer("N2", "P", "9", "2025-06-10"),
                        answer("R1", "P", "8", "2025-06-11"), answer("N3", "P", "2", "2025-06-12")],
    )
    new = sources(
        spark,
        invites_agent_change=[*invites, invite("P", "2025-07-05")],
        responses_agent_change=[
            answer("R1", "P", "7", "2026-01-20"),  # answered again
            answer("R1", "P", "5"),
            answer("R2", "P", "4"),  # another policy now; R3 is gone
            answer("R4", "Q", None, meet_needs="Y"),
        ],
        responses_rnps=[answer("N1", "P", "3", "2025-01-10"),
                        answer("N1", "P", "6", "2025-07-10"),  # from before the look-back
                        answer("N2", "P", "9", "2025-06-10"), answer("R1", "P", "8", "2025-06-11")],
    )
    load, merged, rebuilt, whole, totals = loaded_survey(spark, old, new)
    assert text(load.survey) == text(rebuilt)
    assert text(merged) == text(whole)
    kept = load.totals.where("ResponseCount > 0")
    assert text(kept) == text(totals.select(kept.columns))
    # The untouched N2 is in no delta; the other survey's R1 only keeps its row.
    assert sorted((r["SurveyType"], r["ResponseId"]) for r in load.responses.collect()) == [
        ("AGENT_CHANGE", "R1"), ("AGENT_CHANGE", "R2"), ("AGENT_CHANGE", "R4"), ("RNPS", "N1"), ("RNPS", "R1")
    ]


def test_totals_of_a_load_that_failed_half_way_are_counted_again(spark, tmp_path):
    old = sources(spark, responses_rnps=[answer("N1", "P", "3", "2025-06-10")])
    new = sources(spark, responses_rnps=[answer("N1", "P", "3", "2025-06-10"), answer("N2", "P", "9", "2025-06-11")])
    store = TableStore(spark, str(tmp_path), buckets=2)
    bd._build_survey(store, old, False)
    load = inc.survey_load(store.read("SurveyRaw"), store.read("SurveyResponses"), store.read("SurveyTotals").drop("Of"), new)
    store.merge("SurveyResponses", load.responses, "ResponseId", load.replaced)
    for _ in range(2):
        survey, _, totals = bd.merge_survey(store, new)
        assert [(r["ResponseCount"], r["ScoreSum"]) for r in totals.collect()] == [(2, 12.0)]
        assert text(survey) == text(survey_entity(all_campaigns(new)))


def test_a_load_without_changes_has_no_delta(spark):
    given = sources(
        spark, invites_agent_change=[invite("P", "2025-06-05")],
        responses_agent_change=[answer("R1", "P", "5")], responses_css_ces=[answer("C", "P", "3")],
    )
    load, merged, rebuilt, whole, _ = loaded_survey(spark, given, given)
    assert load.responses.count() == 0 and load.replaced.count() == 0
    assert text(load.survey) == text(rebuilt) and text(merged) == text(whole)


def test_upsert_and_insert(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "ID string, v int")
    delta = spark.createDataFrame([("b", 20), ("c", 30)], "ID string, v int")
    assert sorted(map(tuple, upsert(target, delta).collect())) == [("a", 1), ("b", 20), ("c", 30)]
    assert [tuple(r) for r in insert_new(target, delta).collect()] == [("c", 30)]


def test_key_sets_are_broadcast_by_their_size_in_bytes(spark):
    keys = spark.createDataFrame([("a",), ("b",)], "k string")
    rows = spark.createDataFrame([("a", 1), ("c", 2)], "k string, v int")
    try:
        for threshold, join in ((1 << 20, "BroadcastHashJoin"), (1, "SortMergeJoin")):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            kept = only_keys(rows, settled(keys, "t"), "k")
            assert join in kept._jdf.queryExecution().executedPlan().toString()
            assert [tuple(r) for r in kept.collect()] == [("a", 1)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

def test_marks_of_empty_sources(spark):
    s = sources(spark)
    assert inc.source_marks(s) == inc.Marks()
    assert inc.snapshot_lookback_start(s.monthly_snapshots()) is None
