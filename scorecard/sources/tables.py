"""Declared input tables and their readers.

Only the columns the plans use are declared. A site whose column has another
name passes it in ``columns``; a site with undeclared columns it needs (for
example the contact link) lists them in ``extra``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorecard.operators.latest import latest_per_key

SURVEY_TYPES = ("AGENT_CHANGE", "NEW_BUSINESS", "RENEWAL", "RNPS", "CSS_CES")
INVITED_TYPES = ("AGENT_CHANGE", "NEW_BUSINESS", "RENEWAL")

_INVITES = "policy_number string, invite_pull_date date"
_SCORED = "responseid string, startdate timestamp_ntz, policy_number_1 string, q1 string"

# Logical table names and the columns read from each.
SCHEMAS: dict[str, str] = {
    "policy_spine": (
        "plcy_cntrct_num string, bus_entity string, lob_typ_cd string, plcy_st_cd string, "
        "srvd_chnl_cd string, agt_of_recrd_num string, plcy_incept_dt date, cncl_dt date"
    ),
    "transactions": (
        "plcy_cntrct_num string, eff_dt date, src_trans_tmsp timestamp_ntz, src_sys_cd string, "
        "resdc_zip_5_cd string, agt_of_recrd_num string"
    ),
    "monthly_snapshots": (
        "ext_pol_sfx_concat_cd string, snap_yr_mo_cd string, lob_nm string, orig_eff_dt date, "
        "pol_canc_eff_dt date, trm_typ_dscr string"
    ),
    "policy_stats": (
        "plcy_num string, prior_plcy string, src_sys string, src_trans_tmsp timestamp_ntz, "
        "strt_dt_tmsp timestamp_ntz, end_dt_tmsp timestamp_ntz"
    ),
    "invites_agent_change": _INVITES,
    "invites_new_business": _INVITES,
    "invites_renewal": _INVITES,
    "responses_agent_change": (
        _SCORED + ", q1a string, q4_1 string, q4_2 string, q4_3 string, q4_4 string, "
        "q4_5 string, q4_6 string, meet_needs string, rcvd_letter string, "
        "letter_effectiveness string, num_days_no_agent string, xfer_init_by string, "
        "new_agent_series string, agent_id string, ecn string, entprs_hh_num string, "
        "ecms_account_number string"
    ),
    "responses_new_business": _SCORED,
    "responses_renewal": _SCORED,
    "responses_rnps": _SCORED,
    "responses_css_ces": (
        "responseid string, startdate timestamp_ntz, policynumber string, q1r_ces string"
    ),
    "contacts": (
        "id string, accountid string, email string, preferred_phone_number_c string, "
        "preferred_phone_type_c string, contact_name string, mailingstreet string, "
        "mailingcity string, mailingstatecode string, mailingpostalcode string, "
        "lastmodifieddate timestamp_ntz"
    ),
    "contact_performance": (
        "ffq_quote_id string, timestamp timestamp_ntz, contactspace_contact_attempts bigint, "
        "contactspace_total_call_duration bigint, contactspace_is_qualified_contact boolean, "
        "contactspace_is_quote_discussed boolean, contact_source_contactspace string, "
        "contact_source_livevox string, contact_source_drips string, contact_source_sfmc string, "
        "contact_source_ea_journey string, contact_source_dbu_journey string"
    ),
    "phone_outcomes": "id string, timestamp timestamp_ntz",
}


def schema_of(table: str) -> T.StructType:
    return T.StructType.fromDDL(SCHEMAS[table])


def project(
    df: DataFrame,
    table: str,
    columns: Mapping[str, str] | None = None,
    extra: Iterable[str] = (),
) -> DataFrame:
    """Declared columns of ``table`` in declared types.

    A column already in its declared type is passed through, so filters on it
    still reach the file scan.
    """
    present = {f.name.lower(): f.dataType for f in df.schema.fields}
    names = dict(columns or {})
    out = []
    for field in schema_of(table).fields:
        source = names.get(field.name, field.name)
        if source.lower() not in present:
            raise ValueError(f"{table}: column {source!r} not found")
        c = F.col(f"`{source}`")
        if present[source.lower()] != field.dataType:
            c = c.cast(field.dataType)
        out.append(c.alias(field.name))
    return df.select(*out, *[F.col(f"`{c}`") for c in extra])


class Sources:
    """One method per input table. Subclasses say where the rows come from.

    A table is opened once per instance, so its files are listed once and every
    plan of a run sees the same ones.
    """

    def __init__(self) -> None:
        self._opened: dict[str, DataFrame] = {}

    def load(self, name: str) -> DataFrame:
        raise NotImplementedError

    def table(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self.load(name)
        return self._opened[name]

    def policy_spine(self) -> DataFrame:
        """One row per policy: the greatest by inception date, then the other columns.

        The source repeats some policies; ``table("policy_spine")`` has all rows.
        """
        spine = self.table("policy_spine")
        order = [c for c in ("plcy_incept_dt",) if c in spine.columns]
        rest = [c for c in spine.columns if c not in ("plcy_cntrct_num", *order)]
        return latest_per_key(spine, ["plcy_cntrct_num"], order, rest)

    def transactions(self) -> DataFrame:
        return self.table("transactions")

    def monthly_snapshots(self) -> DataFrame:
        return self.table("monthly_snapshots")

    def policy_stats(self) -> DataFrame:
        return self.table("policy_stats")

    def invites(self, survey_type: str) -> DataFrame | None:
        """Null for survey types that have no invite table."""
        if survey_type not in INVITED_TYPES:
            return None
        return self.table(f"invites_{survey_type.lower()}")

    def responses(self, survey_type: str) -> DataFrame:
        return self.table(f"responses_{survey_type.lower()}")

    def contacts(self) -> DataFrame:
        return self.table("contacts")

    def contact_performance(self) -> DataFrame:
        return self.table("contact_performance")

    def phone_outcomes(self) -> DataFrame:
        return self.table("phone_outcomes")


class FileSources(Sources):
    """Tables as folders of files: ``{root}/{table}`` unless ``paths`` says else."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        *,
        file_format: str = "parquet",
        paths: Mapping[str, str] | None = None,
        columns: Mapping[str, Mapping[str, str]] | None = None,
        extra: Mapping[str, Iterable[str]] | None = None,
    ) -> None:
        super().__init__()
        self.spark = spark
        self.root = root.rstrip("/")
        self.file_format = file_format
        self.paths = dict(paths or {})
        self.columns = dict(columns or {})
        self.extra = dict(extra or {})

    def load(self, name: str) -> DataFrame:
        path = self.paths.get(name, f"{self.root}/{name}")
        reader = self.spark.read.format(self.file_format)
        if self.file_format == "csv":
            reader = reader.option("header", True)
        return project(
            reader.load(path), name, self.columns.get(name), self.extra.get(name, ())
        )


class FrameSources(Sources):
    """Tables given as frames; used for tests and for filtered reruns."""

    def __init__(self, frames: Mapping[str, DataFrame]) -> None:
        super().__init__()
        self.frames = dict(frames)

    def load(self, name: str) -> DataFrame:
        return self.frames[name]


# The two seed files and their columns.
SEED_POLICY = (
    "plcy_cntrct_num string, bus_entity string, lob_typ_cd string, plcy_st_cd string, "
    "srvd_chnl_cd string, agt_of_recrd_num string, plcy_incept_dt date, cncl_dt date, "
    "prior_plcy string, src_sys_cd string, resdc_zip_5_cd string"
)
SEED_CHANGE_EVENT = (
    "plcy_cntrct_num string, event_type string, event_month string, before_value string, "
    "after_value string, bus_entity string"
)


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A small CSV with a header; an empty cell is null."""
    return spark.read.csv(
        path, header=True, schema=schema, enforceSchema=False, mode="FAILFAST"
    )
