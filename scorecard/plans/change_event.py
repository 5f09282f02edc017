"""The ChangeEvent entity: one row per address or agent change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorecard.functions.keys import date_text, hash_id, natural_key, timestamp_text
from scorecard.functions.values import month_text, null_of
from scorecard.operators.neighbours import neighbour_parts, with_neighbour
from scorecard.operators.skew import HotKeys, find_hot_keys
from scorecard.plans.policy import current_scd2

# The two kinds of change event.
ZIP_CHANGE = "ZIP_CHANGE"
AGENT_CHANGE = "AGENT_CHANGE"

KEY = "plcy_cntrct_num"

CHANGE_EVENT_TYPE = (
    "struct<EventType: string, EffectiveDate: date, EventMonth: string, "
    "PreviousZipCode: string, ZipCode: string, PreviousAgentNumber: string, "
    "AgentNumber: string, BusinessEntity: string, LineOfBusinessCode: string, "
    "PolicyStateCode: string, SourceSystemCode: string, SourceTransactionTimestamp: string, "
    "Rten: struct<PLCY_CNTRCT_NUM: string, EFF_DT: string, SRC_TRANS_TMSP: string, "
    "SRC_SYS_CD: string, PLCY_NUM: string>, Policy: struct<ID: string>>"
)


# Rows equal in date and timestamp are ordered by content, so results repeat.
HISTORY = (
    "EffectiveDate",
    "SourceTransactionTimestamp",
    "SourceSystemCode",
    "CurrentZip",
    "CurrentAgentNumber",
)
PREVIOUS = {"PreviousZip": "CurrentZip", "PreviousAgentNumber": "CurrentAgentNumber"}


def history(transactions: DataFrame) -> DataFrame:
    return transactions.select(
        KEY,
        F.col("eff_dt").alias("EffectiveDate"),
        F.col("src_trans_tmsp").alias("SourceTransactionTimestamp"),
        F.col("src_sys_cd").alias("SourceSystemCode"),
        F.col("resdc_zip_5_cd").alias("CurrentZip"),
        F.col("agt_of_recrd_num").alias("CurrentAgentNumber"),
    )


def ranked_transactions(transactions: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Transactions with the zip and agent of the one before, per policy.

    Five-digit zip only. Both values come from one window.
    """
    return with_neighbour(history(transactions), KEY, HISTORY, PREVIOUS, hot=hot)


def _changed(current: str, previous: str) -> Column:
    """Both known and different; an unknown side is no change."""
    return F.col(previous).isNotNull() & (F.col(current) != F.col(previous))


_ZIP_CHANGED = ("CurrentZip", "PreviousZip")
_AGENT_CHANGED = ("CurrentAgentNumber", "PreviousAgentNumber")


def _zip_values() -> Column:
    return F.struct(
        F.lit(ZIP_CHANGE).alias("EventType"),
        F.col("PreviousZip").alias("PreviousZipCode"),
        F.col("CurrentZip").alias("ZipCode"),
        null_of("string").alias("PreviousAgentNumber"),
        null_of("string").alias("AgentNumber"),
    )


def _agent_values() -> Column:
    return F.struct(
        F.lit(AGENT_CHANGE).alias("EventType"),
        null_of("string").alias("PreviousZipCode"),
        null_of("string").alias("ZipCode"),
        F.col("PreviousAgentNumber"),
        F.col("CurrentAgentNumber").alias("AgentNumber"),
    )


def _events(ranked: DataFrame, condition: Column, values: Column) -> DataFrame:
    return ranked.where(condition).select(
        "plcy_cntrct_num",
        "EffectiveDate",
        "SourceTransactionTimestamp",
        "SourceSystemCode",
        values.alias("event"),
    ).where(F.col("event").isNotNull()).select(
        "plcy_cntrct_num",
        "EffectiveDate",
        "SourceTransactionTimestamp",
        "SourceSystemCode",
        "event.*",
    )


def zip_change_events(ranked: DataFrame) -> DataFrame:
    return _events(ranked, _changed(*_ZIP_CHANGED), _zip_values())


def agent_change_events(ranked: DataFrame) -> DataFrame:
    return _events(ranked, _changed(*_AGENT_CHANGED), _agent_values())


def all_change_events(ranked: DataFrame) -> DataFrame:
    """Both kinds as one union of rows, read in one pass over the window.

    A transaction that changes both gives two rows. A plain ``union`` of the two
    frames would sort the transactions twice.
    """
    zip_changed, agent_changed = _changed(*_ZIP_CHANGED), _changed(*_AGENT_CHANGED)
    kinds = F.array(F.when(zip_changed, _zip_values()), F.when(agent_changed, _agent_values()))
    # Unlike ``filter`` on the array, explode and where are compiled with the rest.
    return _events(ranked, zip_changed | agent_changed, F.explode(kinds))


def event_id() -> Column:
    """Policy, kind, effective date and timestamp, hashed."""
    return hash_id(
        natural_key(
            F.col("plcy_cntrct_num"),
            F.col("EventType"),
            date_text(F.col("EffectiveDate")),
            timestamp_text(F.col("SourceTransactionTimestamp")),
        )
    )


def policy_context(spine: DataFrame, policy_stats: DataFrame, policy: DataFrame) -> DataFrame:
    """What an event takes from its policy: one row per policy number.

    Three policy-grain tables meet on the same key before the events join, so
    the events, the larger side, are joined once.
    """
    from_spine = spine.select("plcy_cntrct_num", "bus_entity", "lob_typ_cd", "plcy_st_cd")
    stats = current_scd2(policy_stats).select(
        F.col("plcy_num").alias("plcy_cntrct_num"), F.col("plcy_num"), F.col("src_sys")
    )
    links = policy.select(
        F.col("Policy.SystemIds.RtenPlcyCntrctNum").alias("plcy_cntrct_num"),
        F.col("ID").alias("PolicyID"),
    )
    return from_spine.join(stats, "plcy_cntrct_num", "full").join(
        links, "plcy_cntrct_num", "full"
    )


def change_event_entity(
    transactions: DataFrame,
    spine: DataFrame,
    policy_stats: DataFrame,
    policy: DataFrame,
    hot: HotKeys | None = None,
) -> DataFrame:
    """``[ID, ChangeEvent]``, one row per event, with policy context.

    Ordinary policies meet their context in the partitions of the window. Hot
    policies meet a broadcast of their few context rows, one per hot policy.
    """
    if hot is None:
        hot = find_hot_keys(transactions, KEY)
    ordinary, spread = neighbour_parts(history(transactions), KEY, HISTORY, PREVIOUS, hot)
    context = policy_context(spine, policy_stats, policy)
    entity = entity_of(all_change_events(ordinary), context)
    if spread is None:
        return entity

    def of_hot(df: DataFrame, column: str) -> DataFrame:
        return df.where(F.col(column).isin(list(hot.shares)))

    few = policy_context(
        of_hot(spine, KEY),
        of_hot(policy_stats, "plcy_num"),
        of_hot(policy, "Policy.SystemIds.RtenPlcyCntrctNum"),
    )
    return entity.unionByName(
        entity_of(all_change_events(spread), F.broadcast(few))
    )


def entity_of(events: DataFrame, context: DataFrame) -> DataFrame:
    """Events with the context of their policies (``policy_context``)."""
    return events.join(context, KEY, "left").select(
        event_id().alias("ID"),
        F.struct(
            F.col("EventType"),
            F.col("EffectiveDate").cast("date").alias("EffectiveDate"),
            month_text(F.col("EffectiveDate")).alias("EventMonth"),
            F.col("PreviousZipCode"),
            F.col("ZipCode"),
            F.col("PreviousAgentNumber"),
            F.col("AgentNumber"),
            F.col("bus_entity").alias("BusinessEntity"),
            F.col("lob_typ_cd").alias("LineOfBusinessCode"),
            F.col("plcy_st_cd").alias("PolicyStateCode"),
            F.coalesce("SourceSystemCode", "src_sys").alias("SourceSystemCode"),
            timestamp_text(F.col("SourceTransactionTimestamp")).alias(
                "SourceTransactionTimestamp"
            ),
            F.struct(
                F.col("plcy_cntrct_num").alias("PLCY_CNTRCT_NUM"),
                date_text(F.col("EffectiveDate")).alias("EFF_DT"),
                timestamp_text(F.col("SourceTransactionTimestamp")).alias("SRC_TRANS_TMSP"),
                F.col("SourceSystemCode").alias("SRC_SYS_CD"),
                F.col("plcy_num").alias("PLCY_NUM"),
            ).alias("Rten"),
            F.struct(F.col("PolicyID").alias("ID")).alias("Policy"),
        )
        .cast(CHANGE_EVENT_TYPE)
        .alias("ChangeEvent"),
    )
