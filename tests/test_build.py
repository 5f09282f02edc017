from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from scorecard.plans.build import ContactLink, build
from scorecard.sources.testdata import TestdataSources
from scorecard.sources.tables import (
    SCHEMAS,
    SEED_CHANGE_EVENT,
    SEED_POLICY,
    FileSources,
    project,
    read_seed,
)
from scorecard.store import FOLDERS, TableStore
from tests.frames import sources, spine

AS_OF = date(2001, 9, 1)
LINK = ContactLink("email", "email")
COHORTS = {"FirstOnboarding": "BUILDING", "SecondOnboarding": "MACHINERY"}


def text(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def built(spark, folder, tmp_path_factory):
    """A build at an earlier load, then an incremental one, and a fresh rebuild."""
    loaded, rebuilt = (str(tmp_path_factory.mktemp(n)) for n in ("loaded", "rebuilt"))
    earlier = TestdataSources(spark, folder, datetime(2001, 2, 1))
    now = TestdataSources(spark, folder)
    options = {"contact_link": LINK, "onboarding_entities": COHORTS}
    build(spark, earlier, loaded, AS_OF, **options)
    first = build(spark, now, loaded, AS_OF, **options)
    second = build(spark, now, rebuilt, AS_OF, **options)
    return TableStore(spark, loaded), TableStore(spark, rebuilt), first, second


def test_checks_pass(built):
    _, _, first, second = built
    assert set(first.values()) == {0} and set(second.values()) == {0}


@pytest.mark.parametrize("name", ["PolicyRaw", "ContactRaw", "ContactEvents", "ContactWide"])
def test_incremental_equals_rebuild(built, name):
    loaded, rebuilt, _, _ = built
    assert text(loaded.read(name)) == text(rebuilt.read(name))


def test_incremental_events_have_the_same_keys(built):
    loaded, rebuilt, _, _ = built
    assert text(loaded.read("ChangeEventRaw").select("ID")) == text(
        rebuilt.read("ChangeEventRaw").select("ID")
    )
    assert text(loaded.read("ChangeEventTails")) == text(rebuilt.read("ChangeEventTails"))


def test_event_metrics_of_policies_agree(built):
    loaded, rebuilt, _, _ = built
    names = ["ID", "NumberOfZipChangeEvents", "MovedPolicyRetentionRate90Days", "TenureDays"]
    assert text(loaded.read("PolicyMetrics").select(*names)) == text(
        rebuilt.read("PolicyMetrics").select(*names)
    )


def test_wide_tables_have_the_entity_and_a_struct_per_metric(built):
    _, rebuilt, _, _ = built
    wide = rebuilt.read("PolicyWide")
    assert len(wide.columns) == 20 and "ID" not in wide.columns
    assert wide.select("TermType.TermType", "Policy.SystemIds.RtenPlcyCntrctNum").count() == wide.count()
    assert wide.count() == rebuilt.read("PolicyRaw").count()
    assert len(rebuilt.read("ChangeEventWide").columns) == 4
    survey = rebuilt.read("SurveyWide")
    assert len(survey.columns) == 10
    assert survey.schema["AgentChangeResponseRate"].dataType.fields[0].dataType.simpleString() == "double"
    assert rebuilt.read("ContactWide").columns == ["Contact"]


def test_views_are_registered(built, spark):
    names = {
        "ChangedAddress": 9,
        "ChangedProducer": 9,
        "FirstOnboarding": 4,
        "SecondOnboarding": 4,
        "AgencyChangeSurvey": 9,
        "OnboardingSurvey": 6,
        "RenewalSurvey": 6,
        "MoveSurvey": 6,
        "CssCesSurvey": 6,
    }
    for name, width in names.items():
        rows = spark.sql(f"SELECT * FROM {name}")
        assert len(rows.columns) == width and "ID" not in rows.columns
        assert rows.count() > 0
    months = [r["InceptionMonth"] for r in spark.table("FirstOnboarding").collect()]
    assert months == sorted(months)


def test_a_rerun_without_changes_changes_nothing(built, spark, folder):
    loaded, _, _, _ = built
    tables = ("PolicyRaw", "ChangeEventRaw", "SurveyRaw", "SurveyResponses", "PolicyWide")
    before = {n: text(loaded.read(n)) for n in tables}
    build(spark, TestdataSources(spark, folder), loaded.root, AS_OF, contact_link=LINK)
    assert {n: text(loaded.read(n)) for n in tables} == before


def test_a_repeated_policy_is_one_row_and_reported(spark, tmp_path):
    given = sources(spark, policy_spine=[spine("A"), spine("A"), spine("B")])
    for _ in range(2):
        report = build(spark, given, str(tmp_path), AS_OF)
        assert report["policy_spine unique plcy_cntrct_num"] == 1
        assert TableStore(spark, str(tmp_path)).read("PolicyRaw").count() == 2


def test_store_versions(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2,)], "x int")
    with pytest.raises(FileNotFoundError):
        store.read("t")
    store.append("t", a)
    store.append("t", b)
    assert text(store.read("t")) == text(a.union(b))
    # A version may be built from the one it replaces.
    store.replace("t", store.read("t").where("x = 2"))
    assert text(store.read("t")) == text(b)
    # An unfinished write is not read.
    (tmp_path / "t" / "full-000009").mkdir()
    assert text(store.read("t")) == text(b)
    store.append("t", a)
    assert text(store.read("t")) == text(a.union(b))


def rows_by_bucket(store, name):
    return {r["bucket"]: r["folder"] for r in store._listed(name)}


def test_a_merge_writes_the_touched_buckets_only(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), buckets=100)
    first = spark.range(5000).selectExpr("cast(id AS string) AS ID", "0 AS v", "id % 7 AS bucket_like")
    store.deal("t", first, "ID")
    before = rows_by_bucket(store, "t")
    assert len(before) == 101  # and the row that has the schema
    delta = spark.createDataFrame([("17", 1, 0), ("new", 1, 0)], "ID string, v int, bucket_like bigint")
    merged = store.merge("t", delta, "ID")
    after = rows_by_bucket(store, "t")
    assert sum(before[b] != after[b] for b in before) <= 2
    files = [p for p in (tmp_path / "t").glob("data-*/bucket=*/*.parquet") if "data-000001" not in str(p)]
    assert 1 <= len(files) <= 2
    want = sorted([(str(i), 1 if i == 17 else 0) for i in range(5000)] + [("new", 1)])
    assert sorted((r["ID"], r["v"]) for r in merged.collect()) == want
    assert merged.columns == first.columns


def test_a_failed_merge_leaves_the_old_list(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), buckets=4)
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "ID string, v int")
    store.deal("t", rows, "ID")
    broken = rows.withColumn("v", F.expr("CAST(raise_error('lost') AS int)"))
    with pytest.raises(Exception, match="lost"):
        store.merge("t", broken, "ID")
    # Data that no list names, and a list whose write did not end.
    (tmp_path / "t" / "data-000007" / "bucket=1").mkdir(parents=True)
    (tmp_path / "t" / "list-000008").mkdir()
    assert text(store.read("t")) == text(rows)
    assert text(store.merge("t", rows.where("v = 2").withColumn("v", F.lit(3)), "ID").select("v")) == ["Row(v=1)", "Row(v=3)"]


def test_added_rows_rewrite_nothing_until_a_bucket_has_many_folders(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), buckets=1)
    rows = lambda n: spark.createDataFrame([(f"k{n}", n)], "ID string, v int")
    nothing = rows(0).select("ID").limit(0)
    store.deal("t", rows(0).limit(0), "ID")
    assert store.read("t").count() == 0 and store.read("t").columns == ["ID", "v"]
    for n in range(12):
        store.merge("t", rows(n), "ID", nothing, label=str(n))
        assert len(store._listed("t")) <= 1 + FOLDERS
    assert sorted(r["v"] for r in store.read("t").collect()) == list(range(12))
    assert store.label("t") == "11"
    gone = store.merge("t", rows(0).limit(0), "ID", rows(3).select("ID"))
    assert sorted(r["v"] for r in gone.collect()) == [n for n in range(12) if n != 3]
    # Old versions go when asked for, and what the list names stays.
    assert store.remove_old("t") and store.remove_old("t") == []
    assert store.read("t").count() == 11


def test_null_keys_are_a_bucket_too(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), buckets=3)
    rows = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "ID string, v int")
    store.deal("t", rows, "ID")
    merged = store.merge("t", rows.where("v = 3").withColumn("v", F.lit(4)), "ID")
    assert sorted(r["v"] for r in merged.collect()) == [1, 2, 4]


def test_file_sources(spark, tmp_path):
    df = sources(spark, policy_spine=[spine("A")]).table("policy_spine")
    df.withColumnRenamed("bus_entity", "entity").selectExpr("*", "1 as more").write.parquet(
        str(tmp_path / "policy_spine")
    )
    read = FileSources(
        spark,
        str(tmp_path),
        columns={"policy_spine": {"bus_entity": "entity"}},
        extra={"policy_spine": ["more"]},
    ).table("policy_spine")
    assert read.columns == [*df.columns, "more"]
    assert text(read.drop("more")) == text(df)
    plan = read.where("bus_entity = 'ENTITY_A'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(entity,ENTITY_A)" in plan  # the filter reaches the scan
    with pytest.raises(ValueError, match="not found"):
        FileSources(spark, str(tmp_path)).policy_spine()


def test_every_table_has_a_reader(spark):
    empty = sources(spark)
    for name in SCHEMAS:
        assert project(empty.table(name), name).columns == empty.table(name).columns
    assert empty.invites("RNPS") is None and empty.invites("RENEWAL") is not None


def test_seeds(spark, tmp_path):
    policy, event = tmp_path / "policy.csv", tmp_path / "event.csv"
    policy.write_text(
        "plcy_cntrct_num,bus_entity,lob_typ_cd,plcy_st_cd,srvd_chnl_cd,agt_of_recrd_num,"
        "plcy_incept_dt,cncl_dt,prior_plcy,src_sys_cd,resdc_zip_5_cd\n"
        "POL1,A,AUTO,CA,EA,AGT1,2025-01-15,,,,00210\n"
    )
    event.write_text(
        "plcy_cntrct_num,event_type,event_month,before_value,after_value,bus_entity\n"
        "POL1,ZIP_CHANGE,2025-05,1,2,A\n"
    )
    row = read_seed(spark, str(policy), SEED_POLICY).first()
    assert (row["plcy_incept_dt"], row["cncl_dt"], row["resdc_zip_5_cd"]) == (date(2025, 1, 15), None, "00210")
    assert read_seed(spark, str(event), SEED_CHANGE_EVENT).first()["event_month"] == "2025-05"


def test_tasks_write_buckets_without_a_shuffle(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), buckets=2)
    rows = spark.range(100, numPartitions=3).withColumn("text", F.col("id").cast("string"))
    stored = store.deal("T", rows.select(F.col("id").alias("ID"), "text"), "ID")
    files = [f.name for f in tmp_path.rglob("part-*.parquet") if f.parent.name.startswith("bucket=")]
    assert len(files) == 6 and all("zstd" in f for f in files)
    assert sorted(r["ID"] for r in stored.collect()) == list(range(100))
