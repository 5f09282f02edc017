"""The Survey entity: one row per survey type and invite month (a wave).

A response counts in every wave that invited its policy. Responses are kept one
row each, with those waves as a short array (at most one per month), so no
response is repeated per wave. Counts and metrics come from that table. Waves
with their responses nested are built on request, where an array can hold them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, time
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorecard.functions.keys import date_text, hash_id, natural_key
from scorecard.functions.values import (
    NUMBER,
    date_lit,
    month_start,
    null_of,
    safe_ratio,
    timestamp_lit,
    try_number,
)
from scorecard.operators.latest import latest_per_key
from scorecard.operators.nesting import (
    empty_if_null,
    ordered_array,
)
from scorecard.operators.skew import HotKeys, find_hot_keys
from scorecard.sources.tables import SURVEY_TYPES, Sources


@dataclass(frozen=True)
class ResponseColumns:
    """Where one survey type keeps the common response fields."""

    policy: str = "policy_number_1"
    score: str = "q1"
    details: Mapping[str, str] = field(default_factory=dict)


# Source column of each response field, by survey type.
AGENT_CHANGE_DETAILS = {
    "VerbatimText": "q1a",
    "ProcessRating1": "q4_1",
    "ProcessRating2": "q4_2",
    "ProcessRating3": "q4_3",
    "ProcessRating4": "q4_4",
    "ProcessRating5": "q4_5",
    "ProcessRating6": "q4_6",
    "MeetsNeedsFlag": "meet_needs",
    "ReceivedLetterFlag": "rcvd_letter",
    "LetterEffectiveness": "letter_effectiveness",
    "DaysWithoutAgent": "num_days_no_agent",
    "TransferInitiatedBy": "xfer_init_by",
    "NewAgentSeries": "new_agent_series",
    "AgentId": "agent_id",
    "Ecn": "ecn",
    "HouseholdNumber": "entprs_hh_num",
    "EcmsAccountNumber": "ecms_account_number",
}
RESPONSE_COLUMNS = {
    "AGENT_CHANGE": ResponseColumns(details=AGENT_CHANGE_DETAILS),
    "NEW_BUSINESS": ResponseColumns(),
    "RENEWAL": ResponseColumns(),
    "RNPS": ResponseColumns(),
    "CSS_CES": ResponseColumns(policy="policynumber", score="q1r_ces"),
}
NUMERIC_DETAILS = {*(f"ProcessRating{i}" for i in range(1, 7)), "DaysWithoutAgent"}


def newest_responses(shaped: DataFrame) -> DataFrame:
    """A response delivered again is still one response: its newest row counts."""
    rest = [c for c in shaped.columns if c not in ("SurveyType", "ResponseId", "ResponseDate")]
    return latest_per_key(shaped, ["SurveyType", "ResponseId"], ["ResponseDate"], rest)


def typed_responses(responses: DataFrame, survey_type: str) -> DataFrame:
    """The responses of one survey type in the common shape, each id once."""
    return newest_responses(shaped_responses(responses, survey_type))


def shaped_responses(
    responses: DataFrame, survey_type: str, from_day: date | None = None
) -> DataFrame:
    """Rows in the common shape; a field the type lacks is a typed null."""
    columns = RESPONSE_COLUMNS[survey_type]

    def detail(name: str) -> Column:
        numeric = name in NUMERIC_DETAILS
        source = columns.details.get(name)
        if source is None:
            return null_of(NUMBER if numeric else "string").alias(name)
        return (try_number(F.col(source)) if numeric else F.col(source)).alias(name)

    if from_day is not None:
        start = datetime.combine(from_day, time.min)
        responses = responses.where(F.col("startdate") >= timestamp_lit(start))
    return responses.where(F.col("responseid").isNotNull()).select(
        F.lit(survey_type).alias("SurveyType"),
        F.col(columns.policy).alias("PolicyNumber"),
        F.col("responseid").alias("ResponseId"),
        F.col("startdate").cast("timestamp_ntz").alias("ResponseDate"),
        try_number(F.col(columns.score)).alias("NpsScore"),
        *[detail(name) for name in AGENT_CHANGE_DETAILS],
    )


def invited_policies(
    invites: DataFrame, survey_type: str, from_wave: date | None = None
) -> DataFrame:
    """Distinct (policy, wave): a policy invited twice in a month counts once."""
    if from_wave is not None:
        invites = invites.where(F.col("invite_pull_date") >= date_lit(from_wave))
    return invites.select(
        F.lit(survey_type).alias("SurveyType"),
        F.col("policy_number").alias("PolicyNumber"),
        month_start(F.col("invite_pull_date")).alias("InviteWave"),
    ).distinct()


def survey_id() -> Column:
    return hash_id(natural_key(F.col("SurveyType"), date_text(F.col("InviteWave"))))


def _response_month() -> Column:
    """The wave of a response to a survey without invites."""
    return month_start(F.col("ResponseDate").cast("date"))


def survey_responses(
    invited: DataFrame | None, typed: DataFrame, hot: HotKeys | None = None
) -> DataFrame:
    """One row per response that belongs to a wave, with its ``InviteWaves``.

    Without invites the wave is the month of the response. Both inputs may hold
    several survey types; they share one join. A hot policy's responses meet a
    broadcast of that policy's waves: one row per hot policy and type.
    """
    if invited is None:
        return typed.withColumn("InviteWaves", F.array(_response_month()))
    on = ["SurveyType", "PolicyNumber"]
    waves = invited.groupBy(*on).agg(
        F.array_sort(F.collect_list("InviteWave")).alias("InviteWaves")
    )
    keyed = typed.where(F.col("PolicyNumber").isNotNull())
    if hot is None:
        hot = find_hot_keys(keyed, "PolicyNumber")
    if hot.shares:
        is_hot = hot.matches(F.col("PolicyNumber"))
        few = F.broadcast(waves.where(is_hot))
        joined = keyed.where(~is_hot).join(waves, on).unionByName(
            keyed.where(is_hot).join(few, on)
        )
    else:
        joined = keyed.join(waves, on)
    return joined.select(*typed.columns, "InviteWaves")


def by_wave(responses: DataFrame) -> DataFrame:
    """One row per wave and response, keyed by the wave's ``ID``."""
    columns = [c for c in responses.columns if c != "InviteWaves"]
    return responses.select(*columns, F.explode("InviteWaves").alias("InviteWave")).select(
        survey_id().alias("ID"), "InviteWave", *columns
    )


def _sum_and_count(name: str, value: Column) -> list[Column]:
    return [F.sum(value).alias(f"{name}Sum"), F.count(value).alias(f"{name}Count")]


MEASURES = ("Score", "Days", "MeetsNeeds", "NoLetter")
TOTALS = ("ResponseCount", *(f"{m}{part}" for m in MEASURES for part in ("Sum", "Count")))


def _is(answer: str, value: str) -> Column:
    """1.0 when equal, letter case included; null when unanswered."""
    return (F.col(answer) == value).cast("double")


def wave_measures(responses: DataFrame) -> DataFrame:
    """Per type and wave: responses, and sum and count of each measure.

    Responses are combined by their set of waves before the waves are spread
    out, so a policy with many responses is one row by then.
    """
    per_set = responses.groupBy("SurveyType", "InviteWaves").agg(
        F.count(F.lit(1)).alias("ResponseCount"),
        *_sum_and_count("Score", F.col("NpsScore").cast("double")),
        *_sum_and_count("Days", F.col("DaysWithoutAgent").cast("double")),
        *_sum_and_count("MeetsNeeds", _is("MeetsNeedsFlag", "Y")),
        *_sum_and_count("NoLetter", _is("ReceivedLetterFlag", "N")),
    )
    return added_totals([per_set.withColumn("InviteWave", F.explode("InviteWaves"))])


def added_totals(parts: Sequence[DataFrame]) -> DataFrame:
    """Totals of waves from totals of parts of their responses."""
    columns = ["SurveyType", "InviteWave", *TOTALS]
    return (
        union_all([p.select(*columns) for p in parts])
        .groupBy("SurveyType", "InviteWave")
        .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in TOTALS])
        # A sum of no values is unknown.
        .withColumns({f"{m}Sum": F.when(F.col(f"{m}Count") > 0, F.col(f"{m}Sum")) for m in MEASURES})
    )


def changed_totals(totals: DataFrame, came: DataFrame, went: DataFrame) -> DataFrame:
    """Totals after responses came and went; scores are whole numbers, so sums stay exact."""
    less = wave_measures(went).select(
        "SurveyType", "InviteWave", *[(-F.col(c)).alias(c) for c in TOTALS]
    )
    return added_totals([totals, wave_measures(came), less])


def survey_campaign(invited: DataFrame | None, responses: DataFrame) -> DataFrame:
    """Per type and wave: policies invited and responses received."""
    return campaigns(None if invited is None else invites_sent(invited), wave_measures(responses))


def invites_sent(invited: DataFrame) -> DataFrame:
    return invited.groupBy("SurveyType", "InviteWave").agg(
        F.count("PolicyNumber").alias("InvitesSent")
    )


def campaigns(sent: DataFrame | None, totals: DataFrame) -> DataFrame:
    """Waves with their counts and rate; waves without invites are those of responses."""
    received = totals.select("SurveyType", "InviteWave", "ResponseCount")
    if sent is None:
        waves = received.where("ResponseCount > 0").withColumn("InvitesSent", null_of("bigint"))
    else:
        waves = sent.join(received, ["SurveyType", "InviteWave"], "left").fillna(
            0, ["ResponseCount"]
        )
    return waves.select(
        "SurveyType",
        "InviteWave",
        F.col("InvitesSent").cast("bigint").alias("InvitesSent"),
        F.col("ResponseCount").cast("bigint").alias("ResponseCount"),
        safe_ratio(F.col("ResponseCount"), F.col("InvitesSent")).alias("ResponseRate"),
    )


def survey_entity(campaigns: DataFrame) -> DataFrame:
    """``[ID, Survey]`` with counts and rate; see ``nest_responses`` for the array."""
    return campaigns.select(
        survey_id().alias("ID"),
        F.struct(
            "SurveyType", "InviteWave", "InvitesSent", "ResponseCount", "ResponseRate"
        ).alias("Survey"),
    )


def response_struct() -> Column:
    """One response as the nested object consumers know."""
    return F.struct(
        "ResponseId",
        "ResponseDate",
        "NpsScore",
        "VerbatimText",
        F.struct(
            *[F.col(f"ProcessRating{i}").alias(f"Rating{i}") for i in range(1, 7)]
        ).alias("ProcessRatings"),
        F.struct(
            "MeetsNeedsFlag",
            "ReceivedLetterFlag",
            "LetterEffectiveness",
            "DaysWithoutAgent",
            "TransferInitiatedBy",
            "NewAgentSeries",
        ).alias("AgentChangeDetails"),
        F.struct(
            "PolicyNumber", "AgentId", "Ecn", "HouseholdNumber", "EcmsAccountNumber"
        ).alias("SystemIds"),
    )


def nest_responses(survey: DataFrame, responses: DataFrame) -> DataFrame:
    """``[ID, Part, Survey]`` with ``Responses`` as an array ordered by response date.

    A wave comes in parts, one for each day of responses (``Part``), so no array
    grows with the wave; a wave without responses is one row without ``Part``.
    """
    payload = response_struct()
    columns = [c for c in responses.columns if c != "InviteWaves"]
    # Grouped by type, wave and day; the long ID is made once for each part.
    arrays = (
        responses.select(*columns, F.explode("InviteWaves").alias("InviteWave"))
        .groupBy("SurveyType", "InviteWave", F.to_date("ResponseDate").alias("Part"))
        .agg(ordered_array([F.col("ResponseDate"), F.col("ResponseId")], payload).alias("Responses"))
        .select(survey_id().alias("ID"), "Part", "Responses")
    )
    array_type = arrays.schema["Responses"].dataType.simpleString()
    return survey.join(arrays, "ID", "left").select(
        "ID",
        "Part",
        F.col("Survey").withField(
            "Responses", empty_if_null(F.col("Responses"), array_type)
        ).alias("Survey"),
    )


FromWaves = Mapping[str, date | None]


def _inputs(
    sources: Sources, from_waves: FromWaves | None
) -> tuple[tuple[DataFrame, DataFrame], tuple[None, DataFrame]]:
    """(invited, responses) of the types with invites, and of those without."""
    starts = from_waves or {}
    with_invites = [t for t in SURVEY_TYPES if sources.invites(t) is not None]
    without = [t for t in SURVEY_TYPES if t not in with_invites]
    return (
        (
            union_all([invited_policies(sources.invites(t), t, starts.get(t)) for t in with_invites]),
            newest_responses(union_all([shaped_responses(sources.responses(t), t) for t in with_invites])),
        ),
        (
            None,
            newest_responses(
                union_all([shaped_responses(sources.responses(t), t, starts.get(t)) for t in without])
            ),
        ),
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def all_responses(sources: Sources, from_waves: FromWaves | None = None) -> DataFrame:
    """Responses of every survey type with the waves they count in."""
    return union_all([survey_responses(*pair) for pair in _inputs(sources, from_waves)])


def all_campaigns(
    sources: Sources, from_waves: FromWaves | None = None, responses: DataFrame | None = None
) -> DataFrame:
    """Campaigns of every survey type; ``responses`` saves matching them again."""
    (invited, with_invites), (_, without) = _inputs(sources, from_waves)
    types = [t for t in SURVEY_TYPES if sources.invites(t) is not None]
    if responses is None:
        counted = survey_responses(invited, with_invites), survey_responses(None, without)
    else:
        has_invites = F.col("SurveyType").isin(types)
        counted = responses.where(has_invites), responses.where(~has_invites)
    return union_all([survey_campaign(invited, counted[0]), survey_campaign(None, counted[1])])
