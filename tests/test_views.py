"""Views that other sessions read, over tables in the catalog."""

from datetime import date

import pytest

from scorecard.plans import views
from scorecard.plans.survey import all_campaigns, all_responses, survey_entity
from scorecard.plans.wide import policy_wide, survey_wide
from scorecard.store import TableStore
from tests.frames import answer, entities, invite, spine, stat, txn

AS_OF = date(2026, 1, 1)
ENTITIES = {"FirstOnboarding": "ENTITY_A", "SecondOnboarding": "it's b"}
GIVEN = {
    "policy_spine": [spine("A"), spine("B", entity="it's b"), spine("C", cancelled="2025-02-10")],
    "transactions": [txn("A", "2025-01-01", "1", "X"), txn("A", "2025-02-01", "2", "Y"), txn("C", "2025-01-01", "1"),
                     txn("C", "2025-02-01", "2")],
    "policy_stats": [stat("A", "2025-01-01T00:00:00")],
    "invites_agent_change": [invite("A", "2025-06-05")],
    "responses_agent_change": [answer("R1", "A", "5")],
    "responses_rnps": [answer("N", "A", "9")],
}


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def database(spark, tmp_path):
    spark.sql(f"CREATE DATABASE shown LOCATION '{tmp_path}/shown'")
    yield "shown"
    spark.sql("DROP DATABASE shown CASCADE")


def test_a_second_session_reads_all_views(spark, tmp_path, database):
    given, policy, events = entities(spark, **GIVEN)
    responses = all_responses(given)
    survey = survey_entity(all_campaigns(given))
    store = TableStore(spark, str(tmp_path / "out"))
    wide = store.replace("PolicyWide", policy_wide(policy, events, responses, AS_OF))
    waves = store.replace("SurveyWide", survey_wide(survey, responses))
    paths = {name: store.path(name) for name in ("PolicyWide", "SurveyWide")}
    # Other rows in a later version: the catalog follows, without new views by hand.
    for version in (wide, wide.where("Policy.PolicyNumber <> 'C'")):
        paths["PolicyWide"] = store.path(store.replace("PolicyWide", version) and "PolicyWide")
        names = views.publish_views(spark, database, paths, ENTITIES)
        assert len(names) == 9
        other = spark.newSession()
        views.register_views(store.read("PolicyWide"), waves, ENTITIES)
        for name in names:
            shown = other.sql(f"SELECT * FROM {database}.{name}")
            assert shown.columns == spark.table(name).columns
            assert rows(shown) == rows(spark.table(name)), name
    assert other.table(f"{database}.ChangedAddress").count() == 1
    assert other.table(f"{database}.SecondOnboarding").first()["NumberOfNewBusinessPolicies"] == 1
