"""The 31 metrics.

Each metric is a named rule. Rules that read the same rows are evaluated
together: row-local ones in one projection, event roll-ups in one aggregation,
survey roll-ups in one aggregation. Asking for a single metric builds only the
roll-up it needs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorecard.functions.keys import hash_id
from scorecard.functions.values import (
    date_lit,
    flag,
    kept_after,
    kept_from_start,
    month_text,
    yes_no,
)
from scorecard.operators.skew import HotKeys, find_hot_keys, lookup_join
from scorecard.plans.change_event import AGENT_CHANGE, ZIP_CHANGE
from scorecard.plans.survey import survey_id, wave_measures

# ---------------------------------------------------------------- event grain

# Fixed values, here and below: the metric names of the output contract.
EVENT_METRICS = ("InForce90DaysAfterChangeFlag", "IsAgentChangeEvent", "IsZipChangeEvent")


def is_zip_change_event() -> Column:
    return flag(F.col("ChangeEvent.EventType") == ZIP_CHANGE)


def is_agent_change_event() -> Column:
    return flag(F.col("ChangeEvent.EventType") == AGENT_CHANGE)


def in_force_90_days_after_change(event_date: Column, cancellation: Column) -> Column:
    """Also 1 when the policy link is unresolved; the link check reports those."""
    return flag(kept_after(event_date, cancellation))


def _cancellations(policy: DataFrame) -> DataFrame:
    return policy.select(
        F.col("ID").alias("PolicyID"), F.col("Policy.CancellationDate").alias("Cancelled")
    )


def event_metrics(
    events: DataFrame,
    policy: DataFrame,
    names: Sequence[str] = EVENT_METRICS,
    hot: HotKeys | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``[ID, metric...]``, one row per event; ``keep`` names columns that stay."""
    rules = {
        "IsZipChangeEvent": is_zip_change_event(),
        "IsAgentChangeEvent": is_agent_change_event(),
        "InForce90DaysAfterChangeFlag": in_force_90_days_after_change(
            F.col("ChangeEvent.EffectiveDate"), F.col("Cancelled")
        ),
    }
    if "InForce90DaysAfterChangeFlag" in names:
        keyed = events.withColumn("PolicyID", F.col("ChangeEvent.Policy.ID"))
        if hot is None:
            hot = find_hot_keys(keyed, "PolicyID")
        events = lookup_join(keyed, _cancellations(policy), "PolicyID", hot)
    return events.select("ID", *keep, *[rules[n].alias(n) for n in names])


# ------------------------------------------------------ policy grain, row-local


def in_force_90_flag() -> Column:
    return flag(
        kept_from_start(F.col("Policy.PolicyInceptionDate"), F.col("Policy.CancellationDate"))
    )


def inception_month() -> Column:
    return month_text(F.col("Policy.PolicyInceptionDate"))


def tenure_days(as_of: date, stop_at_cancellation: bool = False) -> Column:
    """Days from inception to ``as_of``; optionally to cancellation where there is one."""
    end = date_lit(as_of)
    if stop_at_cancellation:
        end = F.coalesce(F.col("Policy.CancellationDate"), end)
    return F.datediff(end, F.col("Policy.PolicyInceptionDate")).cast("bigint")


def term_type() -> Column:
    return F.when(F.col("Policy.PriorPolicyIndicator").isNull(), F.lit("NB")).otherwise(
        F.lit("RB")
    )


def number_of_policies_in_force() -> Column:
    """Monthly snapshots still in force after 90 days; 0 for no snapshots."""
    return F.aggregate(
        F.col("Policy.MonthlySnapshots"),
        F.lit(0).cast("bigint"),
        lambda n, s: n
        + flag(kept_from_start(s["InceptionDate"], s["CancellationDate"])),
    )


LOCAL_METRICS = (
    "InForce90Flag",
    "InceptionMonth",
    "NumberOfPoliciesInForce",
    "TenureDays",
    "TermType",
)


def _local_rules(as_of: date, stop_at_cancellation: bool) -> dict[str, Column]:
    return {
        "InForce90Flag": in_force_90_flag(),
        "InceptionMonth": inception_month(),
        "NumberOfPoliciesInForce": number_of_policies_in_force(),
        "TenureDays": tenure_days(as_of, stop_at_cancellation),
        "TermType": term_type(),
    }


# -------------------------------------------------- policy grain, from events


def event_rollup(events: DataFrame, policy: DataFrame) -> DataFrame:
    """``[ID, zip_n, agent_n, zip_kept, agent_kept]`` per policy with events.

    Events are first counted per policy, kind and day. That bounds a hot policy
    by the calendar before it meets its cancellation date, and the count weighs
    in afterwards, so no event is lost.
    """
    per_day = (
        events.select(
            F.col("ChangeEvent.Policy.ID").alias("PolicyID"),
            F.col("ChangeEvent.EventType").alias("kind"),
            F.col("ChangeEvent.EffectiveDate").alias("day"),
        )
        .where(F.col("PolicyID").isNotNull())
        .groupBy("PolicyID", "kind", "day")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    kept = flag(kept_after(F.col("day"), F.col("Cancelled")))

    def total(kind: str, weight: Column) -> Column:
        return F.sum(F.when(F.col("kind") == kind, F.col("n") * weight).otherwise(F.lit(0)))

    return (
        per_day.join(_cancellations(policy), "PolicyID")
        .groupBy(F.col("PolicyID").alias("ID"))
        .agg(
            total(ZIP_CHANGE, F.lit(1)).alias("zip_n"),
            total(AGENT_CHANGE, F.lit(1)).alias("agent_n"),
            total(ZIP_CHANGE, kept).alias("zip_kept"),
            total(AGENT_CHANGE, kept).alias("agent_kept"),
        )
    )


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).cast("bigint")


def _rate(kept: str, all_events: str) -> Column:
    return F.when(F.col(all_events) > 0, F.col(kept).cast("double") / F.col(all_events))


# Rules are callables: columns can only be made while a session is active.
EVENT_ROLLUP_METRICS: dict[str, Callable[[], Column]] = {
    "AgentChangeRetentionRate90Days": lambda: _rate("agent_kept", "agent_n"),
    "MovedPolicyRetentionRate90Days": lambda: _rate("zip_kept", "zip_n"),
    "NumberOfAgentChangeEvents": lambda: _zero("agent_n"),
    "NumberOfAgentChangePoliciesInForce90Days": lambda: _zero("agent_kept"),
    "NumberOfMovedPoliciesInForce90Days": lambda: _zero("zip_kept"),
    "NumberOfZipChangeEvents": lambda: _zero("zip_n"),
}


# ------------------------------------------------- policy grain, from surveys


def _of_type(survey_type: str, value: Column) -> Column:
    return F.when(F.col("SurveyType") == survey_type, value)


def _score(survey_type: str) -> Column:
    return F.avg(_of_type(survey_type, F.col("NpsScore").cast("double")))


SURVEY_ROLLUP_METRICS: dict[str, Callable[[], Column]] = {
    "AgentChangeCsatScore": lambda: _score("AGENT_CHANGE"),
    "AgentChangeDaysWithoutAgent": lambda: F.avg(
        _of_type("AGENT_CHANGE", F.col("DaysWithoutAgent").cast("double"))
    ),
    "AgentChangeMeetsNeedsFlag": lambda: F.max(
        _of_type("AGENT_CHANGE", yes_no(F.col("MeetsNeedsFlag")))
    ),
    "AgentChangeReceivedLetterFlag": lambda: F.max(
        _of_type("AGENT_CHANGE", yes_no(F.col("ReceivedLetterFlag")))
    ),
    "CssCesScore": lambda: _score("CSS_CES"),
    "OnboardingNpsScore": lambda: _score("NEW_BUSINESS"),
    "RenewalNpsScore": lambda: _score("RENEWAL"),
    "RnpsScore": lambda: _score("RNPS"),
}


def survey_rollup(
    responses: DataFrame, names: Sequence[str] = tuple(SURVEY_ROLLUP_METRICS)
) -> DataFrame:
    """``[ID, metric...]`` per policy with responses, all types in one pass.

    Keyed by the policy's hashed number, so it joins the policy on ``ID``.
    """
    return (
        responses.where(F.col("PolicyNumber").isNotNull())
        .groupBy(hash_id(F.col("PolicyNumber")).alias("ID"))
        .agg(*[SURVEY_ROLLUP_METRICS[n]().alias(n) for n in names])
    )


POLICY_METRICS = tuple(sorted([*LOCAL_METRICS, *EVENT_ROLLUP_METRICS, *SURVEY_ROLLUP_METRICS]))


def policy_metrics(
    policy: DataFrame,
    events: DataFrame | None = None,
    responses: DataFrame | None = None,
    *,
    as_of: date | None = None,
    names: Sequence[str] = POLICY_METRICS,
    stop_at_cancellation: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``[ID, metric...]``, exactly one row per policy; ``keep`` names columns that stay.

    At most two joins on ``ID``, whatever the number of metrics.
    """
    local = [n for n in names if n in LOCAL_METRICS]
    from_events = [n for n in names if n in EVENT_ROLLUP_METRICS]
    from_surveys = [n for n in names if n in SURVEY_ROLLUP_METRICS]
    unknown = set(names) - set(POLICY_METRICS)
    if unknown:
        raise ValueError(f"unknown policy metrics: {sorted(unknown)}")
    if "TenureDays" in local and as_of is None:
        raise ValueError("TenureDays needs as_of")
    rules = _local_rules(as_of or date(1970, 1, 1), stop_at_cancellation)
    result = policy.select("ID", *keep, *[rules[n].alias(n) for n in local])
    if from_events:
        if events is None:
            raise ValueError(f"{from_events} need change events")
        result = result.join(event_rollup(events, policy), "ID", "left")
    if from_surveys:
        if responses is None:
            raise ValueError(f"{from_surveys} need survey responses")
        result = result.join(survey_rollup(responses, from_surveys), "ID", "left")
    return result.select(
        "ID",
        *keep,
        *[(EVENT_ROLLUP_METRICS[n]() if n in from_events else F.col(n)).alias(n) for n in names],
    )


# ---------------------------------------------------------------- survey grain


SURVEY_TYPE_OF = {
    "AgentChangeAvgDaysWithoutAgent": "AGENT_CHANGE",
    "AgentChangeAvgNps": "AGENT_CHANGE",
    "AgentChangeMeetsNeedsRate": "AGENT_CHANGE",
    "AgentChangeNoCommsRate": "AGENT_CHANGE",
    "AgentChangeResponseRate": "AGENT_CHANGE",
    "CssCesAvgScore": "CSS_CES",
    "NewBusinessAvgNps": "NEW_BUSINESS",
    "RenewalAvgNps": "RENEWAL",
    "RnpsAvgNps": "RNPS",
}
SURVEY_METRICS = tuple(SURVEY_TYPE_OF)

# Measure averaged by each metric; the rest average the score.
_WAVE_MEASURE = {
    "AgentChangeAvgDaysWithoutAgent": "Days",
    "AgentChangeMeetsNeedsRate": "MeetsNeeds",
    "AgentChangeNoCommsRate": "NoLetter",
}


def survey_metrics(
    survey: DataFrame,
    responses: DataFrame,
    names: Sequence[str] = SURVEY_METRICS,
    keep: Sequence[str] = (),
    totals: DataFrame | None = None,
) -> DataFrame:
    """``[ID, metric...]``, one row per wave; null where the wave is of another type.

    Only responses of the survey types that the metrics are about are read, and none
    where their ``totals`` (``wave_measures``) are at hand.
    """
    result = survey
    kinds = sorted({SURVEY_TYPE_OF[n] for n in names if n != "AgentChangeResponseRate"})
    if kinds:
        if totals is None:
            totals = wave_measures(responses.where(F.col("SurveyType").isin(kinds)))
        result = survey.join(
            totals.select(
                survey_id().alias("ID"),
                *[c for c in totals.columns if c.endswith(("Sum", "Count")) and c != "ResponseCount"],
            ),
            "ID",
            "left",
        )

    def value(name: str) -> Column:
        if name == "AgentChangeResponseRate":
            source = F.col("Survey.ResponseRate")
        else:
            measure = _WAVE_MEASURE.get(name, "Score")
            n = F.col(f"{measure}Count")
            source = F.when(n > 0, F.col(f"{measure}Sum") / n)
        return F.when(F.col("Survey.SurveyType") == SURVEY_TYPE_OF[name], source).alias(name)

    return result.select("ID", *keep, *[value(n) for n in names])


def survey_metric(survey: DataFrame, responses: DataFrame, name: str) -> DataFrame:
    """``[ID, metric]`` for the waves of the metric's own survey type only."""
    own = survey.where(F.col("Survey.SurveyType") == SURVEY_TYPE_OF[name])
    return survey_metrics(own, responses, [name])
