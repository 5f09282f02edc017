"""The whole build: raw entities, metrics, wide tables, views, checks."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date, datetime, time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorecard.operators import quality
from scorecard.operators.keys import settled
from scorecard.operators.staging import stage
from scorecard.operators.upsert import insert_new
from scorecard.plans import event_load, incremental, wide
from scorecard.plans.change_event import change_event_entity
from scorecard.plans.contact import (
    all_contact_events,
    contact_entity,
    contact_events_by_contact,
    shared_links,
)
from scorecard.plans.policy import policy_entity
from scorecard.plans.survey import all_campaigns, all_responses, survey_entity, wave_measures
from scorecard.plans.views import DEFAULT_LOAD_MONTH, publish_views, register_views
from scorecard.sources.tables import Sources
from scorecard.store import BUCKETS, TableStore

# Tables whose second has exactly the rows of the first.
GRAIN_PAIRS = (
    ("PolicyRaw", "PolicyMetrics"),
    ("ChangeEventRaw", "ChangeEventMetrics"),
    ("SurveyRaw", "SurveyMetrics"),
)
# Wide tables have no key of their own: they must have as many rows.
WIDE_PAIRS = (
    ("PolicyRaw", "PolicyWide"),
    ("ChangeEventRaw", "ChangeEventWide"),
    ("SurveyRaw", "SurveyWide"),
    ("ContactRaw", "ContactWide"),
)
# Tables that a build puts into a database of the catalog.
PUBLISHED = ("PolicyWide", "ChangeEventWide", "SurveyWide", "ContactWide")
MARKS_SCHEMA = "name string, mark timestamp_ntz"


@dataclass(frozen=True)
class ContactLink:
    """How contact events find their contact: a column of the event tables and
    the contact column it refers to."""

    event_column: str
    contact_column: str


def _read_marks(store: TableStore) -> incremental.Marks:
    rows = {r["name"]: r["mark"] for r in store.read("Watermarks").collect()}
    return incremental.Marks(**rows)


def _write_marks(store: TableStore, marks: incremental.Marks) -> None:
    rows = [("transactions", marks.transactions), ("policy_stats", marks.policy_stats)]
    store.replace("Watermarks", store.spark.createDataFrame(rows, MARKS_SCHEMA).coalesce(1))


def _build_policy(store: TableStore, sources: Sources, marks: incremental.Marks | None) -> DataFrame:
    snapshots = sources.monthly_snapshots()
    if marks is None:
        entity = policy_entity(
            sources.policy_spine(), sources.transactions(), sources.policy_stats(), snapshots
        )
        return store.deal("PolicyRaw", entity, "ID")
    return merge_policy(store, sources, marks)


def merge_policy(store: TableStore, sources: Sources, marks: incremental.Marks) -> DataFrame:
    """The stored Policy entity with its changed policies recomputed."""
    previous = store.read("PolicyRaw")
    keys = settled(incremental.policy_changed_keys(previous, sources, marks), "policy-keys")
    delta = stage(incremental.policy_delta(sources, keys), "policy-delta")
    return store.merge("PolicyRaw", delta, "ID")


def store_change_events(store: TableStore, sources: Sources, policy: DataFrame) -> DataFrame:
    """All change events, dealt by policy, and the last history row of each policy."""
    events = change_event_entity(
        sources.transactions(), sources.policy_spine(), sources.policy_stats(), policy
    )
    store.deal("ChangeEventTails", event_load.history_tails(sources.transactions()), incremental.KEY)
    return store.deal("ChangeEventRaw", events, event_load.NUMBER)


def merge_change_events(
    store: TableStore, sources: Sources, policy: DataFrame, marks: incremental.Marks
) -> DataFrame:
    """The stored change events with those of new transactions.

    The label of a list is the mark its load started from. If the stored one has this
    load's mark, an earlier try ended after it; what that try added is not added again.
    """
    label = str(marks.transactions)
    load = event_load.event_load(
        sources, policy, store.read("ChangeEventTails"), marks.transactions
    )
    added = load.events
    if store.label("ChangeEventRaw") == label:
        kept = event_load.not_of_policies(store.read("ChangeEventRaw"), event_load.NUMBER, load.replaced)
        added = stage(insert_new(kept, added), "event-delta")
    events = store.merge("ChangeEventRaw", added, event_load.NUMBER, load.replaced, label)
    store.merge("ChangeEventTails", load.tails, incremental.KEY, label=label)
    return events


def _build_change_events(
    store: TableStore, sources: Sources, policy: DataFrame, marks: incremental.Marks | None
) -> DataFrame:
    if marks is None:
        return store_change_events(store, sources, policy)
    return merge_change_events(store, sources, policy, marks)


def _build_survey(
    store: TableStore, sources: Sources, incremental_run: bool
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Waves, responses and totals. Responses are matched to their waves once and
    stored; their totals by wave are stored too, and loads change them."""
    if not incremental_run:
        responses = store.deal("SurveyResponses", all_responses(sources), "ResponseId")
        totals = _store_totals(store, wave_measures(responses))
        entity = survey_entity(all_campaigns(sources, None, responses))
        return store.replace("SurveyRaw", entity), responses, totals
    return merge_survey(store, sources)


def _store_totals(store: TableStore, totals: DataFrame) -> DataFrame:
    """Totals with the version of the responses that they are the totals of."""
    return store.replace("SurveyTotals", totals.withColumn("Of", F.lit(store.version("SurveyResponses"))))


def merge_survey(store: TableStore, sources: Sources) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The stored waves, responses and totals with what changed from the look-back on.

    Responses are stored before their totals. Totals of another version are left by a
    load that failed between the two, and are counted again.
    """
    responses, totals = store.read("SurveyResponses"), store.read("SurveyTotals")
    if totals.where(F.col("Of") != store.version("SurveyResponses")).isEmpty():
        totals = totals.drop("Of")
    else:
        totals = wave_measures(responses)
    load = incremental.survey_load(store.read("SurveyRaw"), responses, totals, sources)
    responses = store.merge("SurveyResponses", load.responses, "ResponseId", load.replaced)
    totals = _store_totals(store, load.totals)
    return store.replace("SurveyRaw", load.survey), responses, totals


def _build_contact(
    store: TableStore, sources: Sources, link: ContactLink | None
) -> tuple[DataFrame, DataFrame]:
    contacts = sources.contacts()
    events = contact_events_by_contact(
        contacts,
        all_contact_events(
            sources.contact_performance(),
            sources.phone_outcomes(),
            link.event_column if link else None,
        ),
        link.contact_column if link else None,
    )
    return (
        store.replace("ContactRaw", contact_entity(contacts)),
        store.replace("ContactEvents", events),
    )


def _run_column_tests(
    tests: Mapping[str, tuple[str | None, tuple[str, ...]]],
    table: Callable[[str], DataFrame],
) -> dict[str, int]:
    report: dict[str, int] = {}
    for name, (key, required) in tests.items():
        row = quality.column_tests(table(name), key, required).first()
        report[f"{name} not null"] = row["null_values"]
        if key is not None:
            report[f"{name} unique {key}"] = row["duplicate_keys"]
    return report


def source_report(sources: Sources) -> dict[str, int]:
    """Failing rows per declared column test of the input tables."""
    return _run_column_tests(quality.SOURCE_TESTS, sources.table)


def quality_report(store: TableStore, as_of: datetime) -> dict[str, int]:
    """Failing rows per check over the stored tables; 0 everywhere passes."""
    report = _run_column_tests(quality.TABLE_TESTS, store.read)
    policy, events = store.read("PolicyRaw"), store.read("ChangeEventRaw")
    failing = {
        "ChangeEventRaw event type": quality.event_type_valid(events),
        "ChangeEventRaw policy link": quality.unresolved_links(events),
        "PolicyRaw no future transaction": quality.no_future_timestamp(policy, as_of),
        **{
            f"{other} one row per {name} row": quality.grain_parity(store.read(name), store.read(other))
            for name, other in GRAIN_PAIRS
        },
    }
    report.update({name: df.count() for name, df in failing.items()})
    for name, other in WIDE_PAIRS:
        report[f"{other} as many rows as {name}"] = abs(
            store.read(name).count() - store.read(other).count()
        )
    return report


def build(
    spark: SparkSession,
    sources: Sources,
    out_dir: str,
    as_of: date,
    *,
    full_refresh: bool = False,
    contact_link: ContactLink | None = None,
    onboarding_entities: Mapping[str, str] | None = None,
    load_month: str = DEFAULT_LOAD_MONTH,
    buckets: int = BUCKETS,
    database: str | None = None,
) -> dict[str, int]:
    """Build every table under ``out_dir``, register the views, run the checks.

    The first run, and any run with ``full_refresh``, starts from nothing; other
    runs merge what changed, in the buckets that change (each dealt table has
    ``buckets`` from its first run or full refresh on). Marks are read from the
    sources first and stored last, so a failed run is simply repeated. Returns the
    quality report of the inputs and of the stored tables. With a ``database`` the wide
    tables and the views are also put into it, for other sessions.
    """
    store = TableStore(spark, out_dir, buckets)
    reuse = store.exists("Watermarks") and not full_refresh
    marks = _read_marks(store) if reuse else None
    next_marks = incremental.source_marks(sources)

    policy = _build_policy(store, sources, marks)
    events = _build_change_events(store, sources, policy, marks)
    survey, responses, totals = _build_survey(store, sources, reuse)
    contact, _ = _build_contact(store, sources, contact_link)

    wide_policy = store.replace("PolicyWide", wide.policy_wide(policy, events, responses, as_of))
    wide_event = store.replace("ChangeEventWide", wide.change_event_wide(events, policy))
    wide_survey = store.replace("SurveyWide", wide.survey_wide(survey, responses, totals))
    store.replace("ContactWide", wide.contact_wide(contact))
    for name, table, key in (
        ("PolicyMetrics", wide_policy, wide.policy_key()),
        ("ChangeEventMetrics", wide_event, wide.change_event_key()),
        ("SurveyMetrics", wide_survey, wide.survey_key()),
    ):
        store.replace(name, wide.metrics_of(table, key))

    register_views(wide_policy, wide_survey, onboarding_entities, load_month)
    if database is not None:
        paths = {name: store.path(name) for name in PUBLISHED}
        publish_views(spark, database, paths, onboarding_entities, load_month)
    _write_marks(store, next_marks)
    shared = (
        {f"contacts share {contact_link.contact_column}": shared_links(
            sources.contacts(), contact_link.contact_column
        ).count()}
        if contact_link
        else {}
    )
    return {
        **source_report(sources),
        **shared,
        **quality_report(store, datetime.combine(as_of, time.max)),
    }
