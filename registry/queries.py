"""Every operator as a query over the test tables, with flat columns."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorecard.functions.keys import timestamp_text
from scorecard.functions.values import timestamp_lit
from scorecard.operators import quality
from scorecard.operators.keys import key_set
from scorecard.operators.staging import shared_dir, stage
from scorecard.plans import build as bd
from scorecard.plans import change_event as ce
from scorecard.plans import contact as ct
from scorecard.plans import event_load as el
from scorecard.plans import incremental as inc
from scorecard.plans import metrics as mt
from scorecard.plans import policy as po
from scorecard.plans import survey as sv
from scorecard.plans import views as vw
from scorecard.plans import wide as wd
from scorecard.session import configure
from scorecard.sources.tables import INVITED_TYPES, SURVEY_TYPES, Sources
from scorecard.sources.testdata import TestdataSources
from scorecard.store import TableStore

AS_OF = date(2001, 9, 1)
EARLIER_LOAD = datetime(2001, 2, 1)
COHORT_ENTITIES = {"first": "BUILDING", "second": "MACHINERY"}
Query = Callable[[SparkSession, str], DataFrame]


class Tables:
    """Entities of one data folder. Each is written once and read back, as in a
    build, so a metric or view does not recompute the layers under it."""

    _written: dict[tuple, DataFrame] = {}
    _sources: dict[tuple, TestdataSources] = {}

    def __init__(self, spark: SparkSession, folder: str, before: datetime | None = None) -> None:
        self.spark = configure(spark)
        self.before = before
        self.folder = folder
        self.key = (spark.sparkContext.applicationId, folder, before)
        if self.key not in self._sources:
            self._sources[self.key] = TestdataSources(spark, folder, before)
        self.sources = self._sources[self.key]

    def _once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        key = (*self.key, name)
        if key not in self._written:
            self._written[key] = stage(make(), name)
        return self._written[key]

    def earlier(self) -> Tables:
        return Tables(self.spark, self.folder, EARLIER_LOAD)

    def spine(self) -> DataFrame:
        return self._once("spine", self.sources.policy_spine)

    def stats(self) -> DataFrame:
        """The open rows of the history, which policies and events both need."""
        return self._once("stats", lambda: po.open_history(self.sources.policy_stats()))

    def new_policy(self) -> DataFrame:
        s = self.sources
        return po.policy_entity(self.spine(), s.transactions(), self.stats(), s.monthly_snapshots())

    def policy(self) -> DataFrame:
        return self._once("policy", self.new_policy)

    def new_events(self) -> DataFrame:
        return ce.change_event_entity(
            self.sources.transactions(), self.spine(), self.stats(), self.policy()
        )

    def events(self) -> DataFrame:
        return self._once("events", self.new_events)

    def new_survey(self) -> DataFrame:
        return sv.survey_entity(sv.all_campaigns(self.sources, None, self.responses()))

    def survey(self) -> DataFrame:
        return self._once("survey", self.new_survey)

    def responses(self) -> DataFrame:
        return self._once("responses", lambda: sv.all_responses(self.sources))

    def totals(self) -> DataFrame:
        return self._once("totals", lambda: sv.wave_measures(self.responses()))

    def policy_metrics(self) -> DataFrame:
        return mt.policy_metrics(self.policy(), self.events(), self.responses(), as_of=AS_OF)

    def policy_wide(self) -> DataFrame:
        return self._once(
            "policy_wide",
            lambda: wd.policy_wide(self.policy(), self.events(), self.responses(), AS_OF),
        )

    def survey_wide(self) -> DataFrame:
        return self._once(
            "survey_wide",
            lambda: wd.survey_wide(self.survey(), self.responses()),
        )

    def contact_events(self) -> DataFrame:
        s = self.sources
        events = ct.all_contact_events(s.contact_performance(), s.phone_outcomes(), "email")
        return ct.contact_events_by_contact(s.contacts(), events, "email")


# ------------------------------------------------------------------- flattening


def _plain(c: Column, dtype: T.DataType) -> Column:
    """Types both engines print alike."""
    if isinstance(dtype, T.DoubleType):
        return F.round(c, 6)
    if isinstance(dtype, T.TimestampNTZType):
        return timestamp_text(c)
    if isinstance(dtype, (T.DecimalType, T.IntegerType)):
        return c.cast("bigint")
    return c


def flat(df: DataFrame, drop: tuple[str, ...] = ()) -> DataFrame:
    """Structs spread into columns named by their path; arrays left out."""

    def spread(schema: T.StructType, path: str, name: str) -> list[Column]:
        out: list[Column] = []
        for f in schema.fields:
            here, label = f"{path}`{f.name}`", f"{name}{f.name}"
            if isinstance(f.dataType, T.StructType):
                out += spread(f.dataType, here + ".", label + "_")
            elif not isinstance(f.dataType, T.ArrayType) and label not in drop:
                out.append(_plain(F.col(here), f.dataType).alias(label))
        return out

    return df.select(*spread(df.schema, "", ""))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# ----------------------------------------------------------------------- queries


def _source(name: str) -> Query:
    return lambda spark, d: flat(Tables(spark, d).sources.table(name))


def _all_invites(t: Tables) -> DataFrame:
    return _union(
        [t.sources.invites(k).withColumn("survey_type", F.lit(k)) for k in INVITED_TYPES]
    )


def _all_answers(t: Tables) -> DataFrame:
    return _union(
        [
            sv.typed_responses(t.sources.responses(k), k)
            for k in SURVEY_TYPES
        ]
    )


def _monthly_history(t: Tables) -> DataFrame:
    history = po.monthly_history(t.sources.monthly_snapshots())
    return history.select("plcy_cntrct_num", F.posexplode("MonthlySnapshots").alias("pos", "s")).select(
        "plcy_cntrct_num", F.col("pos").cast("bigint").alias("pos"), "s.*"
    )


def _nested_responses(t: Tables) -> DataFrame:
    nested = sv.nest_responses(t.survey(), t.responses())
    rows = nested.select("ID", "Part", F.posexplode("Survey.Responses").alias("pos", "r"))
    return flat(
        rows.select(
            "ID",
            F.date_format("Part", "yyyy-MM-dd").alias("Part"),
            F.col("pos").cast("bigint").alias("pos"),
            *[f"r.{c}" for c in ("ResponseId", "ResponseDate", "NpsScore", "VerbatimText")],
            "r.ProcessRatings.*",
            "r.AgentChangeDetails.*",
            "r.SystemIds.*",
        )
    )


def _nested_contact_events(t: Tables) -> DataFrame:
    nested = ct.nest_contact_events(ct.contact_entity(t.sources.contacts()), t.contact_events())
    rows = nested.select("ID", "Part", F.posexplode("Contact.ContactEvents").alias("pos", "e"))
    day = F.date_format("Part", "yyyy-MM-dd").alias("Part")
    return flat(rows.select("ID", day, F.col("pos").cast("bigint").alias("pos"), "e.*"))


def _campaign_of_repeated_ids(t: Tables) -> DataFrame:
    """Campaigns when every response is delivered twice, the older copy a day earlier."""
    s = t.sources
    frames = []
    for kind in SURVEY_TYPES:
        given = s.responses(kind)
        older = given.withColumn("startdate", F.col("startdate") - F.expr("INTERVAL 1 DAY"))
        typed = sv.typed_responses(given.unionByName(older).unionByName(given), kind)
        invites = s.invites(kind)
        invited = None if invites is None else sv.invited_policies(invites, kind)
        frames.append(sv.survey_campaign(invited, sv.survey_responses(invited, typed)))
    return flat(_union(frames))


def _shared_contact_links(t: Tables) -> DataFrame:
    """Events by contact when two contacts share every address."""
    s = t.sources
    twins = s.contacts().withColumn("id", F.concat(F.lit(" "), F.col("id")))
    events = ct.all_contact_events(s.contact_performance(), s.phone_outcomes(), "email")
    return flat(ct.contact_events_by_contact(s.contacts().unionByName(twins), events, "email"))


def _contact_entity(t: Tables) -> DataFrame:
    counts = t.contact_events().groupBy("ID").agg(F.count(F.lit(1)).alias("n"))
    entity = ct.contact_entity(t.sources.contacts()).join(counts, "ID", "left")
    return flat(
        entity.select(
            "ID", "Contact", F.coalesce("n", F.lit(0)).alias("NumberOfContactEvents")
        )
    )


def _changed_keys(t: Tables) -> DataFrame:
    """Policies whose events a load computes: from their tails, or from their history."""
    before = t.earlier()
    tails = el.history_tails(before.sources.transactions())
    mark = inc.source_marks(before.sources).transactions
    onward, whole = el.changed_history(t.sources, tails, mark)
    return key_set(onward.select(inc.KEY), whole)


def _store(t: Tables) -> TableStore:
    return TableStore(t.spark, f"{shared_dir(t.spark)}/stores/{uuid.uuid4().hex}")


def _upsert_policy(t: Tables) -> DataFrame:
    before, store = t.earlier(), _store(t)
    store.deal("PolicyRaw", before.policy(), "ID")
    return _policy_flat(bd.merge_policy(store, t.sources, inc.source_marks(before.sources)))


def _loaded_events(t: Tables, sources: Sources) -> DataFrame:
    """Events stored at the earlier load, then merged with those of ``sources``."""
    before, store = t.earlier(), _store(t)
    bd.store_change_events(store, before.sources, before.policy())
    return bd.merge_change_events(store, sources, t.policy(), inc.source_marks(before.sources))


def _upsert_events(t: Tables) -> DataFrame:
    return flat(_loaded_events(t, t.sources))


class _LateSources(TestdataSources):
    """Some transactions take effect long before the day they come."""

    def _transactions(self) -> DataFrame:
        second = F.second("src_trans_tmsp")
        late = (second % 7 == 0) & (F.col("src_trans_tmsp") >= timestamp_lit(EARLIER_LOAD))
        day = F.when(late, F.date_sub("eff_dt", 1000)).otherwise(F.col("eff_dt"))
        return super()._transactions().withColumn("eff_dt", day)


def _late_events(t: Tables) -> DataFrame:
    return flat(_loaded_events(t, _LateSources(t.spark, t.folder)))


def _survey_lookback(t: Tables) -> DataFrame:
    before = t.earlier()
    load = inc.survey_load(before.survey(), before.responses(), before.totals(), t.sources)
    return flat(load.survey)


def _survey_lookback_responses(t: Tables) -> DataFrame:
    """Totals by wave: the stored ones as the load changed them, which those of the
    merged responses must equal."""
    before = t.earlier()
    load = inc.survey_load(before.survey(), before.responses(), before.totals(), t.sources)
    store = _store(t)
    store.deal("SurveyResponses", before.responses(), "ResponseId")
    merged = store.merge("SurveyResponses", load.responses, "ResponseId", load.replaced)
    again = sv.wave_measures(merged).select(
        "SurveyType", "InviteWave", F.col("ResponseCount").alias("n"), F.col("ScoreSum").alias("s")
    )
    totals = load.totals.where("ResponseCount > 0").join(again, ["SurveyType", "InviteWave"], "full")
    both = lambda a, b: F.when(F.col(a).eqNullSafe(F.col(b)), F.col(a).cast("bigint"))
    return totals.select(
        "SurveyType",
        "InviteWave",
        both("ResponseCount", "n").alias("responses"),
        both("ScoreSum", "s").alias("score_sum"),
    )


def _responses_flat(responses: DataFrame) -> DataFrame:
    waves = F.array_join(F.transform("InviteWaves", lambda w: w.cast("string")), ",")
    return flat(responses.withColumn("InviteWaves", waves))


def _policy_flat(policy: DataFrame) -> DataFrame:
    sized = policy.withColumn(
        "NumberOfSnapshots", F.size("Policy.MonthlySnapshots").cast("bigint")
    )
    return flat(sized)


def _policy_metric(name: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        t = Tables(spark, d)
        events = t.events() if name in mt.EVENT_ROLLUP_METRICS else None
        responses = t.responses() if name in mt.SURVEY_ROLLUP_METRICS else None
        return flat(mt.policy_metrics(t.policy(), events, responses, as_of=AS_OF, names=[name]))

    return run


def _event_metric(name: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        t = Tables(spark, d)
        return flat(mt.event_metrics(t.events(), t.policy(), [name]))

    return run


def _survey_metric(name: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        t = Tables(spark, d)
        return flat(mt.survey_metric(t.survey(), t.responses(), name))

    return run


def _on(fn: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, d: fn(Tables(spark, d))


def _dq_summary(t: Tables) -> DataFrame:
    checked = {
        "policy": (t.policy(), ["Policy.ZipCode", "Policy.CancellationDate"]),
        "change_event": (t.events(), ["ChangeEvent.ZipCode", "ChangeEvent.AgentNumber"]),
    }
    rows = []
    for name, (df, required) in checked.items():
        s = quality.summary(df, "ID", required)
        rows.append(
            s.toDF("n_rows", "duplicate_keys", "null_keys", "null_first", "null_second").withColumn(
                "table_name", F.lit(name)
            )
        )
    return _union(rows)


def _dq_sources(t: Tables) -> DataFrame:
    return _union(
        [
            quality.column_tests(t.sources.table(name), key, required).withColumn(
                "table_name", F.lit(name)
            )
            for name, (key, required) in quality.SOURCE_TESTS.items()
        ]
    )


def _january_in_lower_case(t: Tables) -> DataFrame:
    """Event types that are no valid ones, when those of each January are misspelt."""
    kind, day = F.col("ChangeEvent.EventType"), F.col("ChangeEvent.EffectiveDate")
    misspelt = F.when(F.month(day) == 1, F.lower(kind)).otherwise(kind)
    events = t.events().withColumn("ChangeEvent", F.col("ChangeEvent").withField("EventType", misspelt))
    return quality.event_type_valid(events)


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {}

    # Sources.
    for name in (
        "policy_spine",
        "transactions",
        "monthly_snapshots",
        "policy_stats",
        "contacts",
        "contact_performance",
        "phone_outcomes",
    ):
        q[f"source_{name}"] = _source(name)
    q["source_invites"] = _on(lambda t: flat(_all_invites(t)))
    q["source_responses"] = _on(lambda t: flat(_all_answers(t)))

    # Policy.
    q["latest_transaction"] = _on(lambda t: flat(po.latest_transaction(t.sources.transactions())))
    q["current_scd2"] = _on(lambda t: flat(po.current_scd2(t.sources.policy_stats())))
    q["monthly_history"] = _on(_monthly_history)
    q["policy_entity_flat"] = _on(lambda t: _policy_flat(t.new_policy()))

    # Change events.
    q["ranked_transactions"] = _on(
        lambda t: flat(ce.ranked_transactions(t.sources.transactions()))
    )
    q["zip_change_events"] = _on(
        lambda t: flat(ce.zip_change_events(ce.ranked_transactions(t.sources.transactions())))
    )
    q["agent_change_events"] = _on(
        lambda t: flat(ce.agent_change_events(ce.ranked_transactions(t.sources.transactions())))
    )
    q["change_events"] = _on(
        lambda t: flat(ce.all_change_events(ce.ranked_transactions(t.sources.transactions())))
    )
    q["change_event_ids"] = _on(
        lambda t: ce.all_change_events(ce.ranked_transactions(t.sources.transactions())).select(
            ce.event_id().alias("ID"), "EventType"
        )
    )
    q["change_event_entity_flat"] = _on(lambda t: flat(t.new_events()))

    # Incremental loads.
    q["changed_keys"] = _on(_changed_keys)
    q["upsert_policy"] = _on(_upsert_policy)
    q["upsert_events"] = _on(_upsert_events)
    q["upsert_events_late"] = _on(_late_events)
    q["survey_lookback"] = _on(_survey_lookback)
    q["survey_lookback_responses"] = _on(_survey_lookback_responses)

    # Surveys.
    q["survey_responses"] = _on(lambda t: _responses_flat(sv.all_responses(t.sources)))
    q["survey_responses_by_wave"] = _on(
        lambda t: sv.wave_measures(sv.all_responses(t.sources)).select(
            "SurveyType",
            "InviteWave",
            F.col("ResponseCount").alias("responses"),
            F.col("ScoreSum").cast("bigint").alias("score_sum"),
            F.col("ScoreCount").alias("score_count"),
        )
    )
    q["survey_campaign"] = _on(
        lambda t: flat(
            sv.all_campaigns(t.sources).where(F.col("SurveyType") == "AGENT_CHANGE")
        )
    )
    q["survey_campaign_by_type"] = _on(lambda t: flat(sv.all_campaigns(t.sources)))
    q["survey_campaign_repeated_ids"] = _on(_campaign_of_repeated_ids)
    q["survey_entity_flat"] = _on(lambda t: flat(t.new_survey()))
    q["survey_nested_responses"] = _on(_nested_responses)

    # Contacts.
    q["contact_events"] = _on(
        lambda t: flat(
            ct.all_contact_events(t.sources.contact_performance(), t.sources.phone_outcomes())
        )
    )
    q["contact_events_by_contact"] = _on(lambda t: flat(t.contact_events()))
    q["contact_nested_events"] = _on(_nested_contact_events)
    q["contact_events_shared_links"] = _on(_shared_contact_links)
    q["contact_entity_flat"] = _on(_contact_entity)

    # Metrics.
    for name in mt.EVENT_METRICS:
        q[f"metric_{name}"] = _event_metric(name)
    for name in mt.POLICY_METRICS:
        q[f"metric_{name}"] = _policy_metric(name)
    for name in mt.SURVEY_METRICS:
        q[f"metric_{name}"] = _survey_metric(name)
    q["metric_TenureDays_to_cancellation"] = _on(
        lambda t: flat(
            mt.policy_metrics(
                t.policy(), as_of=AS_OF, names=["TenureDays"], stop_at_cancellation=True
            )
        )
    )
    q["policy_metrics"] = _on(lambda t: flat(t.policy_metrics()))

    # Wide tables.
    q["policy_wide_flat"] = _on(
        lambda t: flat(wd.policy_wide(t.policy(), t.events(), t.responses(), AS_OF))
    )
    q["change_event_wide_flat"] = _on(
        lambda t: flat(wd.change_event_wide(t.events(), t.policy()))
    )
    q["survey_wide_flat"] = _on(
        lambda t: flat(wd.survey_wide(t.survey(), t.responses()))
    )
    q["contact_wide_flat"] = _on(
        lambda t: flat(wd.contact_wide(ct.contact_entity(t.sources.contacts())))
    )

    # Scorecards.
    q["changed_address"] = _on(lambda t: flat(vw.changed_address(t.policy_wide())))
    q["changed_producer"] = _on(lambda t: flat(vw.changed_producer(t.policy_wide())))
    for label, entity in COHORT_ENTITIES.items():
        q[f"onboarding_cohort_{label}"] = _on(
            lambda t, entity=entity: vw.onboarding_cohort(t.policy_wide(), entity)
        )
    for view in vw.SURVEY_VIEWS:
        q[f"view_{view}"] = _on(lambda t, view=view: flat(vw.survey_view(t.survey_wide(), view)))

    # Quality checks, on columns that do have failing rows.
    q["dq_summary"] = _on(_dq_summary)
    q["dq_sources"] = _on(_dq_sources)
    q["dq_not_null"] = _on(lambda t: flat(quality.not_null(t.sources.transactions(), "src_sys_cd")))
    q["dq_unique"] = _on(lambda t: quality.unique(t.sources.transactions(), "plcy_cntrct_num"))
    q["dq_allowed_values"] = _on(
        lambda t: flat(
            quality.allowed_values(t.events(), "ChangeEvent.EventType", [ce.ZIP_CHANGE]).select("ID")
        )
    )
    q["dq_event_type_valid"] = _on(_january_in_lower_case)
    # After a second load, and counted, so that an empty table cannot pass.
    q["dq_no_duplicate_events"] = _on(
        lambda t: quality.column_tests(_upsert_events(t), "ID", ["ID"])
    )
    q["dq_no_duplicate_campaigns"] = _on(
        lambda t: quality.column_tests(_survey_lookback(t), "ID", ["ID"])
    )
    q["dq_duplicate_keys"] = _on(
        lambda t: quality.column_tests(
            t.sources.transactions(), "plcy_cntrct_num", ["plcy_cntrct_num"]
        )
    )
    q["dq_no_future_timestamp"] = _on(
        lambda t: quality.no_future_timestamp(t.policy(), EARLIER_LOAD)
    )
    q["dq_unresolved_links"] = _on(
        lambda t: quality.unresolved_links(
            ce.change_event_entity(
                t.sources.transactions(),
                t.sources.policy_spine(),
                t.sources.policy_stats(),
                t.policy().where(F.col("Policy.CancellationDate").isNull()),
            )
        )
    )
    q["grain_parity"] = _on(
        lambda t: quality.grain_parity(
            t.sources.policy_spine(),
            t.sources.monthly_snapshots()
            .select(F.col("ext_pol_sfx_concat_cd").alias("plcy_cntrct_num"))
            .distinct(),
            "plcy_cntrct_num",
        )
    )
    return q
