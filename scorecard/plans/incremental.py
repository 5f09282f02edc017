"""Incremental loads of the raw entities; change events have ``event_load``.

Each load recomputes whole keys from full history, only for keys that changed,
and merges them into the previous version. With nothing new the result equals
the previous version.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorecard.functions.values import date_lit, months_before
from scorecard.operators.keys import (
    BEGINNING,
    high_water_mark,
    key_set,
    newer_than,
    only_keys,
    settled,
)
from scorecard.operators.staging import stage
from scorecard.operators.upsert import upsert
from scorecard.plans.policy import SPINE_FIELDS, policy_entity
from scorecard.plans.survey import (
    FromWaves,
    all_responses,
    campaigns,
    changed_totals,
    invited_policies,
    invites_sent,
    survey_entity,
    union_all,
    wave_measures,
)
from scorecard.sources.tables import SURVEY_TYPES, Sources

LOOKBACK_MONTHS = 3
KEY = "plcy_cntrct_num"


@dataclass(frozen=True)
class Marks:
    """Newest source timestamps a finished load has read."""

    transactions: datetime = BEGINNING
    policy_stats: datetime = BEGINNING


def source_marks(sources: Sources) -> Marks:
    """Taken from the sources, before a load reads them."""
    return Marks(
        transactions=high_water_mark(sources.transactions(), "src_trans_tmsp"),
        policy_stats=high_water_mark(sources.policy_stats(), "src_trans_tmsp"),
    )


# ---------------------------------------------------------------------- policy


def snapshot_lookback_start(monthly_snapshots: DataFrame) -> str | None:
    """Month code three months before the newest snapshot in the data."""
    code = F.when(F.col("snap_yr_mo_cd").rlike(r"^\d{4}-(0[1-9]|1[0-2])$"), F.col("snap_yr_mo_cd"))
    newest = monthly_snapshots.agg(F.max(code).alias("m")).first()
    if newest is None or newest["m"] is None:
        return None
    year, month = (int(part) for part in newest["m"].split("-"))
    return months_before(date(year, month, 1), LOOKBACK_MONTHS).strftime("%Y-%m")


def changed_spine_keys(spine: DataFrame, previous: DataFrame) -> DataFrame:
    """Policies the target lacks, or holds with other spine values."""
    number = F.col("Policy.SystemIds.RtenPlcyCntrctNum")
    stored = previous.select(
        number.alias(KEY), *[F.col(f"Policy.{name}").alias(f"_{name}") for name in SPINE_FIELDS],
        F.lit(True).alias("_stored"),
    )
    same = reduce(
        lambda a, b: a & b,
        [F.col(src).eqNullSafe(F.col(f"_{name}")) for name, src in SPINE_FIELDS.items()],
    )
    return (
        spine.join(stored, KEY, "left")
        .where(F.col("_stored").isNull() | ~same)
        .select(KEY)
    )


def policy_changed_keys(previous: DataFrame, sources: Sources, marks: Marks) -> DataFrame:
    """Policies to recompute: new transactions, new history rows, recent
    snapshots, or spine rows that are new or differ."""
    snapshots = sources.monthly_snapshots()
    start = snapshot_lookback_start(snapshots)
    signals = [
        newer_than(sources.transactions(), "src_trans_tmsp", marks.transactions).select(KEY),
        newer_than(sources.policy_stats(), "src_trans_tmsp", marks.policy_stats).select("plcy_num"),
        changed_spine_keys(sources.policy_spine(), previous),
    ]
    if start is not None:
        signals.append(
            snapshots.where(F.col("snap_yr_mo_cd") >= start).select("ext_pol_sfx_concat_cd")
        )
    return key_set(*signals)


def policy_delta(sources: Sources, keys: DataFrame) -> DataFrame:
    """The Policy entity for ``keys`` only, each from its full history."""
    return policy_entity(
        only_keys(sources.policy_spine(), keys, KEY),
        only_keys(sources.transactions(), keys, KEY),
        only_keys(sources.policy_stats(), keys, "plcy_num"),
        only_keys(sources.monthly_snapshots(), keys, "ext_pol_sfx_concat_cd"),
    )


def load_policy(previous: DataFrame, sources: Sources, marks: Marks) -> DataFrame:
    """The next version of the Policy entity."""
    keys = settled(policy_changed_keys(previous, sources, marks), "policy-keys")
    return upsert(previous, stage(policy_delta(sources, keys), "policy-delta"), settle=True)


# ---------------------------------------------------------------------- survey


def lookback_waves(previous: DataFrame) -> FromWaves:
    """First wave to recompute, by survey type: three months before the newest."""
    newest = (
        previous.groupBy(F.col("Survey.SurveyType").alias("t"))
        .agg(F.max("Survey.InviteWave").alias("w"))
        .collect()
    )
    return {r["t"]: months_before(r["w"], LOOKBACK_MONTHS) for r in newest if r["w"] is not None}


@dataclass(frozen=True)
class SurveyLoad:
    """The next version of the waves and of their totals; the responses that are new or
    differ, and the ids whose stored rows they replace."""

    survey: DataFrame
    totals: DataFrame
    responses: DataFrame
    replaced: DataFrame


def compared_responses(previous: DataFrame, fresh: DataFrame, from_waves: FromWaves, invited: list[str]) -> DataFrame:
    """Stored and next row of every response, null where there is none.

    With invites, a response keeps its waves from before the look-back and takes the
    recomputed ones after it. Without, its one wave is its month: one delivered again
    moves there. A response left without a wave is gone.
    """
    on = ["SurveyType", "ResponseId"]
    start = F.lit(None).cast("date")
    for survey_type, day in from_waves.items():
        start = F.when(F.col("SurveyType") == survey_type, date_lit(day)).otherwise(start)
    fields = [c for c in previous.columns if c not in on]
    row = lambda name: F.struct(*fields).alias(name)
    joined = previous.select(*on, row("old")).join(fresh.select(*on, row("new")), on, "full")
    joined = joined.withColumn("start", start)
    none = F.array().cast("array<date>")
    before = F.filter(F.coalesce("old.InviteWaves", none), lambda w: w < F.col("start"))
    after = F.coalesce("new.InviteWaves", none)
    moved = ~F.col("SurveyType").isin(invited) & F.col("new").isNotNull()
    waves = F.when(moved, after).otherwise(F.concat(before, after))
    kept = F.coalesce("new", "old").withField("InviteWaves", waves)
    return joined.select(*on, "old", F.when(F.size(waves) > 0, kept).alias("new"))


def survey_load(
    previous: DataFrame, previous_responses: DataFrame, totals: DataFrame, sources: Sources
) -> SurveyLoad:
    """Waves from the look-back on, by the responses that came, changed or went.

    Totals of waves are stored: only responses that differ are taken off them with
    their old values and added with their new ones. Waves before the look-back keep
    the invites they were stored with.
    """
    from_waves = lookback_waves(previous)
    invited = [t for t in SURVEY_TYPES if sources.invites(t) is not None]
    fresh = all_responses(sources, from_waves)
    compared = compared_responses(previous_responses, fresh, from_waves, invited)
    changed = stage(compared.where(~F.col("old").eqNullSafe(F.col("new"))), "survey-changes")
    rows = lambda df, name: df.where(F.col(name).isNotNull()).select(
        "SurveyType", "ResponseId", f"{name}.*"
    ).select(previous_responses.columns)
    came, went = rows(changed, "new"), rows(changed, "old")
    next_totals = stage(changed_totals(totals, came, went), "survey-totals")
    waves = previous.select("Survey.*")
    starts = F.lit(None).cast("date")
    for survey_type, day in from_waves.items():
        starts = F.when(F.col("SurveyType") == survey_type, date_lit(day)).otherwise(starts)
    stored = waves.where(F.col("SurveyType").isin(invited) & (F.col("InviteWave") < starts))
    sent = invites_sent(
        union_all([invited_policies(sources.invites(t), t, from_waves.get(t)) for t in invited])
    ).unionByName(stored.select("SurveyType", "InviteWave", "InvitesSent"))
    has_invites = F.col("SurveyType").isin(invited)
    survey = survey_entity(
        union_all(
            [
                campaigns(sent, next_totals.where(has_invites)),
                campaigns(None, next_totals.where(~has_invites)),
            ]
        )
    )
    # Ids are unique by survey type alone: rows of other types with a changed id stay.
    ids = changed.select("ResponseId").distinct()
    same = (
        previous_responses.join(ids, "ResponseId", "left_semi")
        .join(changed.select("SurveyType", "ResponseId"), ["SurveyType", "ResponseId"], "left_anti")
        .select(previous_responses.columns)
    )
    return SurveyLoad(survey, next_totals, stage(came.unionByName(same), "survey-delta"), ids)


def load_survey(
    previous: DataFrame, previous_responses: DataFrame, sources: Sources, totals: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """The next version of the Survey entity and of its responses."""
    if totals is None:
        totals = wave_measures(previous_responses)
    load = survey_load(previous, previous_responses, totals, sources)
    kept = previous_responses.join(load.replaced, "ResponseId", "left_anti").select(previous_responses.columns)
    return load.survey, kept.unionByName(load.responses)
