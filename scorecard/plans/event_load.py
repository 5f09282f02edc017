"""Incremental load of change events, from the last row of each policy's history.

A change is a difference between a row and the one before it. The table of tails
holds the last row of every policy, so rows that all come after their policy's tail
need no other history: they are put behind the tail. A policy with a row that sorts
before its tail, and one that no load has seen, is recomputed from its full history,
and its stored events are replaced. So a load equals a rebuild also when rows come
late, and reads old transactions only of the policies that need them.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorecard.operators.keys import key_set, newer_than, only_keys, settled, without_keys
from scorecard.operators.latest import latest_per_key
from scorecard.operators.neighbours import with_neighbour
from scorecard.operators.staging import stage
from scorecard.plans.change_event import (
    HISTORY,
    KEY,
    PREVIOUS,
    all_change_events,
    change_event_entity,
    entity_of,
    history,
    policy_context,
)
from scorecard.sources.tables import Sources

NUMBER = "ChangeEvent.Rten.PLCY_CNTRCT_NUM"
POLICY_NUMBER = "Policy.SystemIds.RtenPlcyCntrctNum"


@dataclass(frozen=True)
class EventLoad:
    """What a load adds: events, the policies whose stored events they replace, and the
    new tails of all policies with new rows."""

    events: DataFrame
    replaced: DataFrame
    tails: DataFrame


def history_tails(transactions: DataFrame) -> DataFrame:
    """The last row of each policy's history; one row a policy and task is shuffled."""
    return _last_rows(history(transactions))


def _last_rows(rows: DataFrame) -> DataFrame:
    return latest_per_key(rows.where(F.col(KEY).isNotNull()), [KEY], HISTORY)


def _place() -> Column:
    """Where a row stands in its policy's history; nulls come last."""
    parts = []
    for n, c in enumerate(HISTORY):
        parts += [F.col(c).isNull().alias(f"n{n}"), F.col(c).alias(f"v{n}")]
    return F.struct(*parts)


def of_policies(entity: DataFrame, number: str, keys: DataFrame) -> DataFrame:
    """Entity rows whose nested policy number is in ``keys``."""
    return only_keys(entity.withColumn(KEY, F.col(number)), keys, KEY).drop(KEY)


def not_of_policies(entity: DataFrame, number: str, keys: DataFrame) -> DataFrame:
    return without_keys(entity.withColumn(KEY, F.col(number)), keys, KEY).drop(KEY)


def transaction_keys(sources: Sources) -> DataFrame:
    return key_set(sources.transactions().select(KEY))


def _context(sources: Sources, policy: DataFrame, keys: DataFrame) -> tuple[DataFrame, ...]:
    return (
        only_keys(sources.policy_spine(), keys, KEY),
        only_keys(sources.policy_stats(), keys, "plcy_num"),
        of_policies(policy, POLICY_NUMBER, keys),
    )


def changed_history(sources: Sources, tails: DataFrame, mark: datetime) -> tuple[DataFrame, DataFrame]:
    """New rows of policies that go on from their tails, and the policies that need
    their full history."""
    new = newer_than(sources.transactions(), "src_trans_tmsp", mark)
    fresh = stage(history(new).where(F.col(KEY).isNotNull()), "new-history")
    first = fresh.groupBy(KEY).agg(F.min(_place()).alias("first"))
    known = tails.select(KEY, _place().alias("tail"))
    late = first.join(known, KEY).where("first < tail").select(KEY)
    unseen = without_keys(transaction_keys(sources), tails.select(KEY), KEY)
    whole = settled(key_set(late, unseen), "whole-histories")
    return without_keys(fresh, whole, KEY), whole


def event_load(sources: Sources, policy: DataFrame, tails: DataFrame, mark: datetime) -> EventLoad:
    """Events of the transactions past ``mark``, and of policies not seen before."""
    onward, whole = changed_history(sources, tails, mark)
    keys = settled(key_set(onward.select(KEY)), "onward-keys")
    behind = only_keys(tails, keys, KEY).select(onward.columns)
    rows = onward.withColumn("is_new", F.lit(True)).unionByName(behind.withColumn("is_new", F.lit(False)))
    ranked = with_neighbour(stage(rows, "onward-history"), KEY, HISTORY, PREVIOUS)
    further = entity_of(
        all_change_events(ranked.where("is_new")), policy_context(*_context(sources, policy, keys))
    )
    old = stage(only_keys(sources.transactions(), whole, KEY), "whole-histories")
    recomputed = change_event_entity(old, *_context(sources, policy, whole))
    return EventLoad(
        stage(further.unionByName(recomputed), "event-delta"),
        whole,
        stage(_last_rows(onward).unionByName(history_tails(old)), "tail-delta"),
    )


def with_load(previous: DataFrame, load: EventLoad) -> DataFrame:
    """The next version of the ChangeEvent entity."""
    return not_of_policies(previous, NUMBER, load.replaced).unionByName(load.events)
