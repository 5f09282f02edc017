"""Consumer scorecards: flat columns projected from the wide tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NEW_BUSINESS_TERM = "NB"
DEFAULT_LOAD_MONTH = "DEMO"


def _metric(name: str) -> Column:
    return F.col(f"{name}.{name}").alias(name)


def _policy(*names: str) -> list[Column]:
    return [
        F.col("Policy.SystemIds.RtenPlcyCntrctNum").alias("PolicyNumber"),
        *[F.col(f"Policy.{n}").alias(n) for n in names],
    ]


_CONTEXT = ("BusinessEntity", "LineOfBusinessCode", "PolicyStateCode", "SourceSystemCode")


def changed_address(policy_wide: DataFrame) -> DataFrame:
    """Policies that moved, and how many stayed 90 days after the move."""
    return policy_wide.where(
        F.col("NumberOfZipChangeEvents.NumberOfZipChangeEvents") > 0
    ).select(
        *_policy(*_CONTEXT, "ZipCode"),
        _metric("NumberOfZipChangeEvents"),
        _metric("NumberOfMovedPoliciesInForce90Days"),
        _metric("MovedPolicyRetentionRate90Days"),
    )


def changed_producer(policy_wide: DataFrame) -> DataFrame:
    """Policies whose agent changed, and how many stayed 90 days after it."""
    return policy_wide.where(
        F.col("NumberOfAgentChangeEvents.NumberOfAgentChangeEvents") > 0
    ).select(
        *_policy(*_CONTEXT, "AgentOfRecordNumber"),
        _metric("NumberOfAgentChangeEvents"),
        _metric("NumberOfAgentChangePoliciesInForce90Days"),
        _metric("AgentChangeRetentionRate90Days"),
    )


def onboarding_cohort(
    policy_wide: DataFrame, business_entity: str, load_month: str = DEFAULT_LOAD_MONTH
) -> DataFrame:
    """New-business policies of one business entity by inception month, in order."""
    return (
        policy_wide.where(
            (F.col("TermType.TermType") == NEW_BUSINESS_TERM)
            & (F.col("Policy.BusinessEntity") == business_entity)
        )
        .groupBy(
            F.lit(load_month).alias("LoadMonth"),
            F.col("Policy.BusinessEntity").alias("BusinessEntity"),
            F.col("InceptionMonth.InceptionMonth").alias("InceptionMonth"),
        )
        .agg(F.count(F.lit(1)).alias("NumberOfNewBusinessPolicies"))
        .orderBy(F.col("InceptionMonth").asc_nulls_last())
    )


# Survey scorecards, their survey type and their measures.
SURVEY_VIEWS: Mapping[str, tuple[str, Sequence[str]]] = {
    "AgencyChangeSurvey": (
        "AGENT_CHANGE",
        (
            "AgentChangeAvgNps",
            "AgentChangeMeetsNeedsRate",
            "AgentChangeNoCommsRate",
            "AgentChangeAvgDaysWithoutAgent",
        ),
    ),
    "OnboardingSurvey": ("NEW_BUSINESS", ("NewBusinessAvgNps",)),
    "RenewalSurvey": ("RENEWAL", ("RenewalAvgNps",)),
    "MoveSurvey": ("RNPS", ("RnpsAvgNps",)),
    "CssCesSurvey": ("CSS_CES", ("CssCesAvgScore",)),
}


def survey_view(survey_wide: DataFrame, view: str) -> DataFrame:
    """One survey scorecard by name."""
    survey_type, measures = SURVEY_VIEWS[view]
    fields = ("SurveyType", "InviteWave", "InvitesSent", "ResponseCount", "ResponseRate")
    return survey_wide.where(F.col("Survey.SurveyType") == survey_type).select(
        *[F.col(f"Survey.{n}").alias(n) for n in fields], *[_metric(m) for m in measures]
    )


def register_views(
    policy_wide: DataFrame,
    survey_wide: DataFrame,
    onboarding_entities: Mapping[str, str] | None = None,
    load_month: str = DEFAULT_LOAD_MONTH,
) -> list[str]:
    """Register every scorecard as a temporary view.

    ``onboarding_entities`` maps a view name to the business entity it counts.
    """
    views = {
        "ChangedAddress": changed_address(policy_wide),
        "ChangedProducer": changed_producer(policy_wide),
        **{
            name: onboarding_cohort(policy_wide, entity, load_month)
            for name, entity in (onboarding_entities or {}).items()
        },
        **{name: survey_view(survey_wide, name) for name in SURVEY_VIEWS},
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


def _sql(columns: Mapping[str, str], table: str, where: str) -> str:
    quoted = lambda path: ".".join(f"`{part}`" for part in path.split("."))
    named = ", ".join(f"{quoted(path)} AS `{name}`" for name, path in columns.items())
    return f"SELECT {named} FROM {table} WHERE {where}"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def view_statements(
    policy_table: str,
    survey_table: str,
    onboarding_entities: Mapping[str, str] | None = None,
    load_month: str = DEFAULT_LOAD_MONTH,
) -> dict[str, str]:
    """Every scorecard as a SELECT over the named wide tables."""
    statements = {}
    for name, place, metrics in (
        (
            "ChangedAddress",
            "ZipCode",
            ("NumberOfZipChangeEvents", "NumberOfMovedPoliciesInForce90Days", "MovedPolicyRetentionRate90Days"),
        ),
        (
            "ChangedProducer",
            "AgentOfRecordNumber",
            (
                "NumberOfAgentChangeEvents",
                "NumberOfAgentChangePoliciesInForce90Days",
                "AgentChangeRetentionRate90Days",
            ),
        ),
    ):
        columns = {"PolicyNumber": "Policy.SystemIds.RtenPlcyCntrctNum"}
        columns |= {n: f"Policy.{n}" for n in (*_CONTEXT, place)} | {m: f"{m}.{m}" for m in metrics}
        statements[name] = _sql(columns, policy_table, f"{metrics[0]}.{metrics[0]} > 0")
    for name, entity in (onboarding_entities or {}).items():
        statements[name] = f"""
            SELECT {_text(load_month)} AS LoadMonth, Policy.BusinessEntity AS BusinessEntity,
                   InceptionMonth.InceptionMonth AS InceptionMonth,
                   count(*) AS NumberOfNewBusinessPolicies
            FROM {policy_table}
            WHERE TermType.TermType = '{NEW_BUSINESS_TERM}' AND Policy.BusinessEntity = {_text(entity)}
            GROUP BY ALL ORDER BY InceptionMonth ASC NULLS LAST"""
    for name, (survey_type, measures) in SURVEY_VIEWS.items():
        fields = ("SurveyType", "InviteWave", "InvitesSent", "ResponseCount", "ResponseRate")
        columns = {n: f"Survey.{n}" for n in fields} | {m: f"{m}.{m}" for m in measures}
        statements[name] = _sql(columns, survey_table, f"Survey.SurveyType = '{survey_type}'")
    return statements


def publish_views(
    spark: SparkSession,
    database: str,
    paths: Mapping[str, str],
    onboarding_entities: Mapping[str, str] | None = None,
    load_month: str = DEFAULT_LOAD_MONTH,
) -> list[str]:
    """Put tables and scorecards into a database of the catalog, for other sessions.

    ``paths`` maps table names, PolicyWide and SurveyWide among them, to the folders of
    their newest versions. A known table is pointed to its new folder, so readers see
    the old rows or the new ones; no data is copied. A session that has read a table
    before goes on with what it read until it runs REFRESH TABLE. The database must exist.
    """
    for name, path in paths.items():
        table = f"`{database}`.`{name}`"
        if spark.catalog.tableExists(f"{database}.{name}"):
            spark.sql(f"ALTER TABLE {table} SET LOCATION {_text(path)}")
            spark.sql(f"REFRESH TABLE {table}")
        else:
            spark.sql(f"CREATE TABLE {table} USING parquet LOCATION {_text(path)}")
    statements = view_statements(
        f"`{database}`.PolicyWide", f"`{database}`.SurveyWide", onboarding_entities, load_month
    )
    for name, statement in statements.items():
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS {statement}")
    return list(statements)
