"""The input tables expressed over the order, customer and event test tables.

Gives every plan realistic rows without made-up data: orders act as policy
transactions, customers as policies and contacts, events as contact attempts.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorecard.functions.values import null_of, timestamp_lit
from scorecard.operators.neighbours import with_neighbour
from scorecard.plans.policy import FIRST_TERM, OPEN_END
from scorecard.sources.tables import SURVEY_TYPES, Sources

INVITED_PRIORITIES = ("1-URGENT", "2-HIGH")
OPEN_PRICE = 400_000
CANCELLED_BELOW = 2000


def _text(c: Column) -> Column:
    return c.cast("string")


class TestdataSources(Sources):
    """Sources derived from ``{folder}/*.parquet``."""

    __test__ = False

    def __init__(self, spark: SparkSession, folder: str, before: datetime | None = None) -> None:
        """``before`` leaves out later orders: the state at an earlier load."""
        super().__init__()
        self._files: dict[str, DataFrame] = {}
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.before = before

    def raw(self, name: str) -> DataFrame:
        if name not in self._files:
            df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            if name == "orders" and self.before is not None:
                df = df.where(F.col("o_orderdate") < timestamp_lit(self.before))
            self._files[name] = df
        return self._files[name]

    def load(self, name: str) -> DataFrame:
        for prefix, build in (("invites_", self._invites), ("responses_", self._responses)):
            if name.startswith(prefix):
                return build(name.removeprefix(prefix).upper())
        return getattr(self, f"_{name}")()

    def _orders(self) -> DataFrame:
        """Orders with the transaction timestamp: order date plus a few hours."""
        seconds = F.make_dt_interval(
            F.lit(0), F.lit(0), F.lit(0), F.col("o_orderkey") % F.lit(86400)
        )
        return self.raw("orders").withColumn("tmsp", F.col("o_orderdate") + seconds)

    def _transactions(self) -> DataFrame:
        key = F.col("o_orderkey")
        return self._orders().select(
            _text(F.col("o_custkey")).alias("plcy_cntrct_num"),
            F.col("o_orderdate").cast("date").alias("eff_dt"),
            F.col("tmsp").alias("src_trans_tmsp"),
            F.when(key % 3 == 0, null_of("string"))
            .otherwise(F.concat(F.lit("SYS"), _text(key % 4)))
            .alias("src_sys_cd"),
            F.concat(F.lit("9000"), F.substring("o_orderpriority", 1, 1)).alias("resdc_zip_5_cd"),
            F.concat(F.lit("AGT"), F.col("o_orderstatus")).alias("agt_of_recrd_num"),
        )

    def _policy_spine(self) -> DataFrame:
        span = self.raw("orders").groupBy("o_custkey").agg(
            F.min("o_orderdate").cast("date").alias("first_date"),
            F.max("o_orderdate").cast("date").alias("last_date"),
        )
        key = F.col("c_custkey")
        base = F.when(key % 3 == 0, F.col("first_date")).otherwise(F.col("last_date"))
        cancelled = F.date_add(base, (key % 180).cast("int"))
        return self.raw("customer").join(span, F.col("c_custkey") == F.col("o_custkey")).select(
            _text(key).alias("plcy_cntrct_num"),
            F.col("c_mktsegment").alias("bus_entity"),
            F.concat(F.lit("LOB"), _text(key % 3)).alias("lob_typ_cd"),
            _text(F.col("c_nationkey")).alias("plcy_st_cd"),
            F.concat(F.lit("CH"), _text(key % 4)).alias("srvd_chnl_cd"),
            F.concat(F.lit("AGT"), _text(key % 50)).alias("agt_of_recrd_num"),
            F.col("first_date").alias("plcy_incept_dt"),
            F.when(F.col("c_acctbal") < CANCELLED_BELOW, cancelled).alias("cncl_dt"),
        )

    def _policy_stats(self) -> DataFrame:
        rows = self._orders().select("o_orderkey", "o_custkey", "o_totalprice", "tmsp")
        following = with_neighbour(
            rows, "o_custkey", ["tmsp", "o_orderkey"], {"next_tmsp": "tmsp"}, ahead=True
        )
        open_row = F.col("next_tmsp").isNull() | (F.col("o_totalprice") > OPEN_PRICE)
        number = _text(F.col("o_custkey"))
        return following.select(
            number.alias("plcy_num"),
            F.when(F.col("o_custkey") % 4 == 0, F.concat(F.lit("OLD"), number)).alias("prior_plcy"),
            F.concat(F.lit("MDM"), _text(F.col("o_orderkey") % 3)).alias("src_sys"),
            F.col("tmsp").alias("src_trans_tmsp"),
            F.col("tmsp").alias("strt_dt_tmsp"),
            F.when(open_row, timestamp_lit(OPEN_END))
            .otherwise(F.col("next_tmsp"))
            .alias("end_dt_tmsp"),
        )

    def _monthly_snapshots(self) -> DataFrame:
        months = (
            self.raw("orders")
            .where(F.col("o_custkey") % 5 != 0)
            .select("o_custkey", F.trunc("o_orderdate", "MM").alias("month"))
            .distinct()
            .select(
                _text(F.col("o_custkey")).alias("plcy_cntrct_num"),
                F.date_format("month", "yyyy-MM").alias("month"),
            )
        )
        first_month = F.date_format("plcy_incept_dt", "yyyy-MM")
        return months.join(self.policy_spine(), "plcy_cntrct_num").select(
            F.col("plcy_cntrct_num").alias("ext_pol_sfx_concat_cd"),
            F.col("month").alias("snap_yr_mo_cd"),
            F.lower("bus_entity").alias("lob_nm"),
            F.col("plcy_incept_dt").alias("orig_eff_dt"),
            F.col("cncl_dt").alias("pol_canc_eff_dt"),
            F.when(F.col("month") == first_month, FIRST_TERM)
            .otherwise("Renewal")
            .alias("trm_typ_dscr"),
        )

    def _of_type(self, survey_type: str, invited: bool) -> DataFrame:
        orders = self._orders().where(
            F.col("o_orderkey") % len(SURVEY_TYPES) == SURVEY_TYPES.index(survey_type)
        )
        match = F.col("o_orderpriority").isin(*INVITED_PRIORITIES)
        return orders.where(match if invited else ~match)

    def _invites(self, survey_type: str) -> DataFrame:
        return self._of_type(survey_type, invited=True).select(
            _text(F.col("o_custkey")).alias("policy_number"),
            F.col("o_orderdate").cast("date").alias("invite_pull_date"),
        )

    def _responses(self, survey_type: str) -> DataFrame:
        key = F.col("o_orderkey")
        answers = self._of_type(survey_type, invited=False)
        policy = _text(F.col("o_custkey"))
        score = F.when(key % 17 == 0, "N/A").otherwise(_text(key % 11))
        common = [_text(key).alias("responseid"), F.col("o_orderdate").alias("startdate")]
        if survey_type == "CSS_CES":
            return answers.select(*common, policy.alias("policynumber"), score.alias("q1r_ces"))
        common += [policy.alias("policy_number_1"), score.alias("q1")]
        if survey_type != "AGENT_CHANGE":
            return answers.select(*common)
        status = F.col("o_orderstatus")
        meets = F.when(status == "F", "Y").when(status == "O", "N")
        return answers.select(
            *common,
            F.concat(F.lit("comment "), _text(key)).alias("q1a"),
            *[_text((key + i) % 11).alias(f"q4_{i}") for i in range(1, 7)],
            F.when(key % 7 == 0, F.lower(meets)).otherwise(meets).alias("meet_needs"),
            F.when(key % 3 == 0, "Y").when(key % 3 == 1, "N").alias("rcvd_letter"),
            _text(key % 5).alias("letter_effectiveness"),
            _text(key % 45).alias("num_days_no_agent"),
            F.when(key % 2 == 0, "COMPANY").otherwise("CUSTOMER").alias("xfer_init_by"),
            _text(key % 8).alias("new_agent_series"),
            F.concat(F.lit("AGT"), status).alias("agent_id"),
            F.concat(F.lit("ECN"), policy).alias("ecn"),
            F.concat(F.lit("HH"), policy).alias("entprs_hh_num"),
            F.concat(F.lit("ACC"), policy).alias("ecms_account_number"),
        )

    def _contacts(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.raw("customer").select(
            _text(key).alias("id"),
            F.concat(F.lit("001"), _text(key)).alias("accountid"),
            self._email(key).alias("email"),
            F.concat(F.lit("555-"), _text(key)).alias("preferred_phone_number_c"),
            F.when(key % 2 == 0, "MOBILE").otherwise("HOME").alias("preferred_phone_type_c"),
            F.col("c_name").alias("contact_name"),
            F.concat(_text(key), F.lit(" Main St")).alias("mailingstreet"),
            F.concat(F.lit("City"), _text(key % 100)).alias("mailingcity"),
            _text(F.col("c_nationkey")).alias("mailingstatecode"),
            F.lpad(_text(key % 100000), 5, "0").alias("mailingpostalcode"),
            null_of("timestamp_ntz").alias("lastmodifieddate"),
        )

    @staticmethod
    def _email(key: Column) -> Column:
        return F.concat(F.lit("customer"), _text(key), F.lit("@example.org"))

    def _contact_performance(self) -> DataFrame:
        key = F.col("event_id")
        kind = F.col("event_type")
        names = ("contactspace", "livevox", "drips", "sfmc", "ea_journey", "dbu_journey")
        return self.raw("events").where(kind != "click").select(
            F.concat(F.lit("Q"), _text(key)).alias("ffq_quote_id"),
            F.col("ts").alias("timestamp"),
            (key % 5).alias("contactspace_contact_attempts"),
            F.floor("value").cast("bigint").alias("contactspace_total_call_duration"),
            (F.col("value") > 20).alias("contactspace_is_qualified_contact"),
            (kind == "purchase").alias("contactspace_is_quote_discussed"),
            *[
                F.when(key % len(names) == i, "Y").otherwise("N").alias(f"contact_source_{n}")
                for i, n in enumerate(names)
            ],
            self._email(F.col("user_id")).alias("email"),
        )

    def _phone_outcomes(self) -> DataFrame:
        return self.raw("events").where(F.col("event_type") == "click").select(
            F.concat(F.lit("P"), _text(F.col("event_id"))).alias("id"),
            F.col("ts").alias("timestamp"),
            self._email(F.col("user_id")).alias("email"),
        )
