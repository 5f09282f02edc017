"""Small frames in the declared input schemas."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from scorecard.plans.policy import OPEN_END
from scorecard.sources.tables import SURVEY_TYPES, INVITED_TYPES, FrameSources, schema_of


def d(text: str | None) -> date | None:
    return date.fromisoformat(text) if text else None


def ts(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text) if text else None


def frame(spark: SparkSession, table: str, rows: list[dict]) -> DataFrame:
    schema = schema_of(table)
    return spark.createDataFrame([tuple(r.get(f) for f in schema.names) for r in rows], schema)


def txn(key, day, zip_code=None, agent=None, at="08:00:00", src=None):
    return {
        "plcy_cntrct_num": key,
        "eff_dt": d(day),
        "src_trans_tmsp": ts(f"{day}T{at}"),
        "src_sys_cd": src,
        "resdc_zip_5_cd": zip_code,
        "agt_of_recrd_num": agent,
    }


def spine(key, inception="2024-01-01", cancelled=None, entity="ENTITY_A", state="CA"):
    return {
        "plcy_cntrct_num": key,
        "bus_entity": entity,
        "lob_typ_cd": "AUTO",
        "plcy_st_cd": state,
        "srvd_chnl_cd": "EA",
        "agt_of_recrd_num": "AGT1",
        "plcy_incept_dt": d(inception),
        "cncl_dt": d(cancelled),
    }


def stat(key, at, prior=None, src="MDM", end=None):
    return {
        "plcy_num": key,
        "prior_plcy": prior,
        "src_sys": src,
        "src_trans_tmsp": ts(at),
        "strt_dt_tmsp": ts(at),
        "end_dt_tmsp": ts(end) if end else OPEN_END,
    }


def snap(key, month, inception="2024-01-01", cancelled=None, term="New Business", lob="auto"):
    return {
        "ext_pol_sfx_concat_cd": key,
        "snap_yr_mo_cd": month,
        "lob_nm": lob,
        "orig_eff_dt": d(inception),
        "pol_canc_eff_dt": d(cancelled),
        "trm_typ_dscr": term,
    }


def invite(key, day):
    return {"policy_number": key, "invite_pull_date": d(day)}


def answer(rid, key, q1, day="2026-01-15", **more):
    return {
        "responseid": rid,
        "startdate": ts(f"{day}T10:00:00"),
        "policy_number_1": key,
        "policynumber": key,
        "q1": q1,
        "q1r_ces": q1,
        **more,
    }


def sources(spark: SparkSession, **rows: list[dict]) -> FrameSources:
    names = [
        "policy_spine",
        "transactions",
        "monthly_snapshots",
        "policy_stats",
        "contacts",
        "contact_performance",
        "phone_outcomes",
        *(f"invites_{t.lower()}" for t in INVITED_TYPES),
        *(f"responses_{t.lower()}" for t in SURVEY_TYPES),
    ]
    return FrameSources({n: frame(spark, n, rows.get(n, [])) for n in names})


def entities(spark: SparkSession, **rows: list[dict]):
    """Sources, Policy and ChangeEvent entity built from the given rows."""
    from scorecard.plans.change_event import change_event_entity
    from scorecard.plans.policy import policy_entity

    s = sources(spark, **rows)
    policy = policy_entity(
        s.policy_spine(), s.transactions(), s.policy_stats(), s.monthly_snapshots()
    )
    events = change_event_entity(s.transactions(), s.policy_spine(), s.policy_stats(), policy)
    return s, policy, events


def by_key(df: DataFrame, key: str, value: str) -> dict:
    return {r[key]: r[value] for r in df.collect()}
