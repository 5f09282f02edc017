"""The Policy entity: one row per policy."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorecard.functions.keys import hash_id, timestamp_text
from scorecard.functions.values import month_number, null_of, timestamp_lit
from scorecard.operators.latest import latest_per_key
from scorecard.operators.nesting import empty_if_null, ordered_array

# The end date of an open history row, and the term label that
# marks a policy's first term.
OPEN_END = datetime(2999, 12, 31)
FIRST_TERM = "New Business"
LATER_TERM = "PRIOR"

SNAPSHOT_TYPE = (
    "struct<LoadYearMonthNum: bigint, LineOfBusiness: string, InceptionDate: date, "
    "CancellationDate: date, PriorPolicy: string>"
)
POLICY_TYPE = (
    "struct<BusinessEntity: string, LineOfBusinessCode: string, PolicyStateCode: string, "
    "PolicyNumber: string, ServiceChannelCode: string, AgentOfRecordNumber: string, "
    "PolicyInceptionDate: date, CancellationDate: date, PriorPolicyIndicator: string, "
    "SourceSystemCode: string, ZipCode: string, "
    "SystemIds: struct<RtenPlcyCntrctNum: string, FdrPlcyNum: string, "
    "LastTransactionTmsp: string, LastPolicyStatsTmsp: string>, "
    f"MonthlySnapshots: array<{SNAPSHOT_TYPE}>>"
)

# Entity fields that come straight from the spine, with the spine column.
SPINE_FIELDS = {
    "BusinessEntity": "bus_entity",
    "LineOfBusinessCode": "lob_typ_cd",
    "PolicyStateCode": "plcy_st_cd",
    "PolicyNumber": "plcy_cntrct_num",
    "ServiceChannelCode": "srvd_chnl_cd",
    "AgentOfRecordNumber": "agt_of_recrd_num",
    "PolicyInceptionDate": "plcy_incept_dt",
    "CancellationDate": "cncl_dt",
}


def latest_transaction(transactions: DataFrame) -> DataFrame:
    """Newest transaction per policy, by effective date, then timestamp."""
    columns = ["plcy_cntrct_num", "eff_dt", "src_trans_tmsp", "src_sys_cd", "resdc_zip_5_cd"]
    newest = latest_per_key(
        transactions.select(*columns),
        ["plcy_cntrct_num"],
        ["eff_dt", "src_trans_tmsp"],
        ["src_sys_cd", "resdc_zip_5_cd"],
    )
    return newest.select(
        "plcy_cntrct_num",
        F.col("src_sys_cd").alias("SourceSystemCode"),
        F.col("resdc_zip_5_cd").alias("ZipCode"),
        F.col("src_trans_tmsp").alias("LatestTransactionTimestamp"),
    )


def open_history(policy_stats: DataFrame) -> DataFrame:
    """The open history row per policy, as history; the newest when several are open.

    Takes the place of ``policy_stats`` where several plans need its open rows.
    """
    return latest_per_key(
        policy_stats.where(F.col("end_dt_tmsp") == timestamp_lit(OPEN_END)).select(
            "plcy_num", "prior_plcy", "src_sys", "src_trans_tmsp", "strt_dt_tmsp", "end_dt_tmsp"
        ),
        ["plcy_num"],
        ["src_trans_tmsp", "strt_dt_tmsp"],
        ["src_sys", "prior_plcy"],
    )


def current_scd2(policy_stats: DataFrame) -> DataFrame:
    """What entities take from the open history row of each policy."""
    return open_history(policy_stats).select("plcy_num", "prior_plcy", "src_sys", "src_trans_tmsp")


def monthly_snapshot_rows(monthly_snapshots: DataFrame) -> DataFrame:
    """Snapshots in long form: one row per policy and month."""
    return monthly_snapshots.select(
        F.col("ext_pol_sfx_concat_cd").alias("plcy_cntrct_num"),
        F.col("snap_yr_mo_cd"),
        F.struct(
            month_number(F.col("snap_yr_mo_cd")).alias("LoadYearMonthNum"),
            F.upper("lob_nm").alias("LineOfBusiness"),
            F.col("orig_eff_dt").cast("date").alias("InceptionDate"),
            F.col("pol_canc_eff_dt").cast("date").alias("CancellationDate"),
            F.when(F.col("trm_typ_dscr") == FIRST_TERM, null_of("string"))
            .otherwise(F.lit(LATER_TERM))
            .alias("PriorPolicy"),
        ).alias("Snapshot"),
    )


def monthly_history(monthly_snapshots: DataFrame) -> DataFrame:
    """Snapshots nested per policy, by month.

    The input holds one row per policy and month, so an array is as long as the
    calendar. Snapshots without a policy number belong to no policy and no array.
    """
    return (
        monthly_snapshot_rows(monthly_snapshots)
        .where(F.col("plcy_cntrct_num").isNotNull())
        .groupBy("plcy_cntrct_num")
        .agg(
            ordered_array([F.col("snap_yr_mo_cd")], F.col("Snapshot")).alias("MonthlySnapshots")
        )
    )


def policy_entity(
    spine: DataFrame,
    transactions: DataFrame,
    policy_stats: DataFrame,
    monthly_snapshots: DataFrame,
) -> DataFrame:
    """``[ID, Policy]``. Every side is one row per policy before it joins."""
    stats = current_scd2(policy_stats).select(
        F.col("plcy_num").alias("plcy_cntrct_num"),
        F.col("plcy_num"),
        F.col("prior_plcy"),
        F.col("src_sys"),
        F.col("src_trans_tmsp").alias("stats_tmsp"),
    )
    latest = latest_transaction(transactions)
    history = monthly_history(monthly_snapshots)
    joined = (
        spine.join(stats, "plcy_cntrct_num", "left")
        .join(latest, "plcy_cntrct_num", "left")
        .join(history, "plcy_cntrct_num", "left")
    )
    number = F.col("plcy_cntrct_num").cast("string")
    return joined.select(
        hash_id(F.col("plcy_cntrct_num")).alias("ID"),
        F.struct(
            *[F.col(src).alias(name) for name, src in SPINE_FIELDS.items()],
            F.col("prior_plcy").alias("PriorPolicyIndicator"),
            F.coalesce("SourceSystemCode", "src_sys").alias("SourceSystemCode"),
            F.col("ZipCode"),
            F.struct(
                number.alias("RtenPlcyCntrctNum"),
                F.col("plcy_num").alias("FdrPlcyNum"),
                timestamp_text(F.col("LatestTransactionTimestamp")).alias("LastTransactionTmsp"),
                timestamp_text(F.col("stats_tmsp")).alias("LastPolicyStatsTmsp"),
            ).alias("SystemIds"),
            empty_if_null(F.col("MonthlySnapshots"), f"array<{SNAPSHOT_TYPE}>").alias(
                "MonthlySnapshots"
            ),
        )
        .cast(POLICY_TYPE)
        .alias("Policy"),
    )
