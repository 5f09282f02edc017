from datetime import date

import pytest
from pyspark.sql import functions as F

from scorecard.operators.skew import HotKeys
from scorecard.plans.metrics import policy_metrics, survey_metric, survey_metrics
from scorecard.plans.survey import (
    all_campaigns,
    all_responses,
    by_wave,
    nest_responses,
    survey_campaign,
    survey_entity,
    survey_responses,
    invited_policies,
    typed_responses,
)
from tests.frames import answer, entities, frame, invite, sources, spine

T = "AGENT_CHANGE"


def pair(s, survey_type=T):
    invites = s.invites(survey_type)
    return (
        None if invites is None else invited_policies(invites, survey_type),
        typed_responses(s.responses(survey_type), survey_type),
    )


def campaign(spark, invites, responses):
    s = sources(spark, invites_agent_change=invites, responses_agent_change=responses)
    return campaigns(s).collect()


def campaigns(s, survey_type=T):
    invited, typed = pair(s, survey_type)
    return survey_campaign(invited, survey_responses(invited, typed))


def test_invited_twice_with_one_response(spark):
    rows = campaign(
        spark, [invite("P", "2026-01-05"), invite("P", "2026-01-20")], [answer("R", "P", "9")]
    )
    assert [(r["InvitesSent"], r["ResponseCount"], r["ResponseRate"]) for r in rows] == [(1, 1, 1.0)]


def test_invited_without_response(spark):
    rows = campaign(spark, [invite("P", "2026-01-05")], [])
    assert [(r["ResponseCount"], r["ResponseRate"]) for r in rows] == [(0, 0.0)]


def test_a_response_counts_once_in_each_inviting_wave(spark):
    rows = campaign(
        spark,
        [invite("P", "2026-01-05"), invite("P", "2026-02-05"), invite("Q", "2026-02-05")],
        [answer("R1", "P", "9"), answer("R2", "P", "5"), answer("R3", "NOT_INVITED", "1")],
    )
    got = {r["InviteWave"]: (r["InvitesSent"], r["ResponseCount"]) for r in rows}
    assert got == {date(2026, 1, 1): (1, 2), date(2026, 2, 1): (2, 2)}


def test_campaign_counts_equal_the_long_table(spark):
    s = sources(
        spark,
        invites_agent_change=[invite(f"P{i % 7}", f"2026-0{1 + i % 3}-05") for i in range(30)],
        responses_agent_change=[answer(f"R{i}", f"P{i % 9}", "5") for i in range(25)],
    )
    counts = campaigns(s).select("InviteWave", "ResponseCount")
    long = by_wave(survey_responses(*pair(s)))
    recounted = long.groupBy("InviteWave").agg(F.count("*").alias("ResponseCount"))
    assert sorted(counts.collect()) == sorted(recounted.collect())
    assert long.select("InviteWave", "ResponseId").distinct().count() == long.count()


def test_a_hot_policy_keeps_every_response(spark):
    s = sources(
        spark,
        invites_agent_change=[invite("HOT", f"2026-0{m}-05") for m in (1, 2)] + [invite("P", "2026-01-05")],
        responses_agent_change=[answer(f"R{i}", "HOT", "5") for i in range(50)]
        + [answer("S", "P", "3"), answer("N", None, "3")],
    )
    plain = survey_responses(*pair(s))
    spread = survey_responses(*pair(s), hot=HotKeys({"HOT": 0.9}))
    assert spread.count() == 51  # one row per response, not per wave
    assert by_wave(spread).count() == 101
    assert sorted(map(str, spread.collect())) == sorted(map(str, plain.collect()))


def test_types_without_invites_use_the_response_month(spark):
    s = sources(
        spark,
        responses_css_ces=[answer("R1", "P", "7", "2026-03-09"), answer("R2", "Q", "x", "2026-03-10")],
    )
    rows = campaigns(s, "CSS_CES").collect()
    assert [tuple(r) for r in rows] == [("CSS_CES", date(2026, 3, 1), None, 2, None)]
    survey, responses = survey_entity(all_campaigns(s)), all_responses(s)
    scores = survey_metric(survey, responses, "CssCesAvgScore").collect()
    assert [r["CssCesAvgScore"] for r in scores] == [7.0]


def test_scores_and_answers(spark):
    answers = [
        answer("R1", "P", "7.5", meet_needs="y", rcvd_letter="N", num_days_no_agent="10"),
        answer("R2", "P", "N/A", meet_needs="N", rcvd_letter="N", num_days_no_agent=None),
        answer("R3", "P", None, meet_needs=None, rcvd_letter="Y", num_days_no_agent="20"),
    ]
    s, policy, _ = entities(
        spark,
        policy_spine=[spine("P"), spine("SILENT")],
        invites_agent_change=[invite("P", "2026-01-05"), invite("SILENT", "2026-01-05")],
        responses_agent_change=answers,
    )
    survey, responses = survey_entity(all_campaigns(s)), all_responses(s)
    row = survey_metrics(survey, responses).first()
    assert row["AgentChangeAvgNps"] == 8.0
    assert row["AgentChangeAvgDaysWithoutAgent"] == 15.0
    # The campaign share compares with 'Y' exactly; the policy flag ignores case.
    assert row["AgentChangeMeetsNeedsRate"] == 0.0
    assert row["AgentChangeNoCommsRate"] == pytest.approx(2 / 3)
    assert row["AgentChangeResponseRate"] == 1.5
    assert row["RenewalAvgNps"] is None
    names = [
        "AgentChangeCsatScore",
        "AgentChangeDaysWithoutAgent",
        "AgentChangeMeetsNeedsFlag",
        "AgentChangeReceivedLetterFlag",
        "RenewalNpsScore",
    ]
    numbers = policy.select("ID", F.col("Policy.PolicyNumber").alias("n"))
    rows = {
        r["n"]: [r[c] for c in names]
        for r in policy_metrics(policy, responses=responses, names=names).join(numbers, "ID").collect()
    }
    assert rows == {"P": [8.0, 15.0, 1, 1, None], "SILENT": [None] * 5}


def test_nested_responses(spark):
    s = sources(
        spark,
        invites_agent_change=[invite("P", "2026-01-05"), invite("Q", "2026-02-05")],
        responses_agent_change=[
            answer("R2", "P", "1", "2026-01-20", q4_1="4"),
            answer("R1", "P", "2", "2026-01-10"),
        ],
    )
    survey, responses = survey_entity(all_campaigns(s)), all_responses(s)
    parts = nest_responses(survey, responses).orderBy("Part").collect()
    rows = {(r["Survey"]["InviteWave"].month, r["Part"]): r["Survey"]["Responses"] for r in parts}
    first, second = (1, date(2026, 1, 10)), (1, date(2026, 1, 20))
    assert set(rows) == {(2, None), first, second}
    assert [x["ResponseId"] for x in rows[first] + rows[second]] == ["R1", "R2"]
    assert rows[second][0]["ProcessRatings"]["Rating1"] == 4
    assert rows[first][0]["SystemIds"]["PolicyNumber"] == "P"
    assert rows[2, None] == []


def test_a_wave_past_any_array_bound_comes_in_parts(spark):
    survey = spark.sql("SELECT 'AGENT_CHANGE' SurveyType, DATE'2026-01-01' InviteWave, "
                       "1L InvitesSent, 120000L ResponseCount, 1D ResponseRate")
    s = sources(spark, responses_agent_change=[answer("R", "P", "1", "2026-01-20")])
    typed = typed_responses(s.responses("AGENT_CHANGE"), "AGENT_CHANGE")
    many = (
        typed.crossJoin(spark.range(120_000).withColumnRenamed("id", "n"))
        .withColumn("ResponseId", F.col("n").cast("string"))
        .withColumn("ResponseDate", F.expr("ResponseDate + make_dt_interval(cast(n % 20 as int))"))
        .drop("n")
        .withColumn("InviteWaves", F.array(F.to_date(F.lit("2026-01-01"))))
    )
    sizes = nest_responses(survey_entity(survey), many).select(F.size("Survey.Responses")).collect()
    assert sorted(r[0] for r in sizes) == [6000] * 20


def test_a_response_delivered_again_counts_once(spark):
    again = [answer("R1", "P", "2", "2026-01-10"), answer("R1", "P", "9", "2026-01-12")]
    s = sources(
        spark,
        invites_agent_change=[invite("P", "2026-01-05")],
        responses_agent_change=again + again,
        responses_rnps=again,
    )
    rows = all_responses(s).collect()
    assert [(r["ResponseId"], r["NpsScore"]) for r in rows if r["SurveyType"] == "AGENT_CHANGE"] == [("R1", 9)]
    assert len(rows) == 2
    assert {r["ResponseCount"] for r in all_campaigns(s).where("ResponseCount > 0").collect()} == {1}


def test_survey_schema_is_fixed(spark):
    shapes = {
        str(typed_responses(frame(spark, f"responses_{t.lower()}", []), t).schema)
        for t in ("AGENT_CHANGE", "RENEWAL", "CSS_CES")
    }
    assert len(shapes) == 1
