"""Wide tables: the entity struct plus one struct per metric.

The metrics of an entity are made from its own rows, so the entity travels with
them: a wide table is one plan over the entity, which joins what rolls up to it, and
no entity is joined to its own metrics. A metric table is a projection of the wide one.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorecard.functions.keys import date_text, hash_id, natural_key
from scorecard.plans.metrics import event_metrics, policy_metrics, survey_metrics

# Numeric measures that are counts or flags widen to bigint, fractions to double.
_WIDENED = {T.IntegerType(): "bigint", T.FloatType(): "double"}


def as_wide(measured: DataFrame, entity_name: str) -> DataFrame:
    """The entity of ``[ID, entity, metric...]`` rows, and each metric as a struct of
    one field with its own name. ``ID`` is not part of the result."""
    columns = []
    for f in measured.schema.fields:
        if f.name not in ("ID", entity_name):
            c = F.col(f.name)
            if f.dataType in _WIDENED:
                c = c.cast(_WIDENED[f.dataType])
            columns.append(F.struct(c.alias(f.name)).alias(f.name))
    return measured.select(entity_name, *columns)


def metrics_of(wide: DataFrame, key: Column) -> DataFrame:
    """``[ID, metric...]`` of a wide table; ``key`` makes the entity's ID again."""
    names = wide.columns[1:]
    return wide.select(key.alias("ID"), *[F.col(f"{n}.{n}").alias(n) for n in names])


def policy_wide(
    policy: DataFrame, events: DataFrame, responses: DataFrame, as_of: date
) -> DataFrame:
    return as_wide(policy_metrics(policy, events, responses, as_of=as_of, keep=("Policy",)), "Policy")


def policy_key() -> Column:
    return hash_id(F.col("Policy.SystemIds.RtenPlcyCntrctNum"))


def change_event_wide(events: DataFrame, policy: DataFrame) -> DataFrame:
    return as_wide(event_metrics(events, policy, keep=("ChangeEvent",)), "ChangeEvent")


def change_event_key() -> Column:
    return hash_id(
        natural_key(
            F.col("ChangeEvent.Rten.PLCY_CNTRCT_NUM"),
            F.col("ChangeEvent.EventType"),
            F.col("ChangeEvent.Rten.EFF_DT"),
            F.col("ChangeEvent.Rten.SRC_TRANS_TMSP"),
        )
    )


def survey_wide(survey: DataFrame, responses: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    return as_wide(survey_metrics(survey, responses, keep=("Survey",), totals=totals), "Survey")


def survey_key() -> Column:
    return hash_id(
        natural_key(
            F.col("Survey.SurveyType"), date_text(F.col("Survey.InviteWave"))
        )
    )


def contact_wide(contact: DataFrame) -> DataFrame:
    return as_wide(contact.select("ID", "Contact"), "Contact")
