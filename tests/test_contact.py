from scorecard.plans.contact import (
    all_contact_events,
    contact_entity,
    contact_events_by_contact,
    nest_contact_events,
    shared_links,
)
from tests.frames import frame, ts


def inputs(spark, emails=("a@x", "b@x")):
    contacts = frame(
        spark, "contacts", [{"id": f"C{i}", "email": e, "mailingcity": "X"} for i, e in enumerate(emails)]
    )
    performance = spark.createDataFrame(
        [("Q1", ts("2026-01-02T00:00:00"), 3, True, "a@x"), ("Q2", None, 1, False, None)],
        "ffq_quote_id string, timestamp timestamp_ntz, contactspace_contact_attempts bigint, "
        "contactspace_is_qualified_contact boolean, email string",
    )
    for name in ("contactspace_total_call_duration",):
        performance = performance.selectExpr("*", f"cast(null as bigint) as {name}")
    performance = performance.selectExpr(
        "*",
        "true as contactspace_is_quote_discussed",
        *(
            f"'Y' as contact_source_{n}"
            for n in ("contactspace", "livevox", "drips", "sfmc", "ea_journey", "dbu_journey")
        ),
    )
    phone = spark.createDataFrame(
        [("T1", ts("2026-01-01T00:00:00"), "a@x"), ("T2", ts("2026-01-01T00:00:00"), "z@x")],
        "id string, timestamp timestamp_ntz, email string",
    )
    return contacts, all_contact_events(performance, phone, "email")


def test_channels_share_thirteen_columns(spark):
    _, events = inputs(spark)
    assert len(events.columns) == 14  # and the link
    rows = {r["ContactEventId"]: r for r in events.collect()}
    assert rows["T1"]["ContactChannel"] == "PHONE" and rows["T1"]["ContactAttempts"] is None
    assert rows["Q1"]["ContactChannel"] == "CONTACTSPACE" and rows["Q1"]["SourceDrips"] == "Y"


def test_without_a_key_every_contact_has_an_empty_array(spark):
    contacts, events = inputs(spark)
    nested = nest_contact_events(contact_entity(contacts), contact_events_by_contact(contacts, events))
    assert [r["Contact"]["ContactEvents"] for r in nested.collect()] == [[], []]


def test_events_by_key_are_ordered(spark):
    contacts, events = inputs(spark)
    linked = contact_events_by_contact(contacts, events, "email")
    parts = nest_contact_events(contact_entity(contacts), linked).orderBy("Part").collect()
    rows: dict = {}
    for r in parts:
        name = r["Contact"]["Identity"]["ApexContactId"]
        rows.setdefault(name, []).extend(r["Contact"]["ContactEvents"])
        assert r["Contact"]["MailingAddress"]["City"] == "X"
    assert [e["ContactEventId"] for e in rows["C0"]] == ["T1", "Q1"]
    assert rows["C0"][1]["ContactSources"]["EaJourney"] == "Y"
    assert rows["C1"] == []


def test_a_shared_key_has_one_owner(spark):
    contacts, events = inputs(spark, ("a@x", "a@x"))
    linked = contact_events_by_contact(contacts, events, "email")
    assert linked.count() == events.count()
    owned = linked.where("ID is not null").select("ID").distinct().collect()
    assert len(owned) == 1
    assert shared_links(contacts, "email").count() == 1


def test_unlinked_events_stay(spark):
    contacts, events = inputs(spark)
    linked = contact_events_by_contact(contacts, events, "email")
    assert linked.where("ID is null").count() == 2
    assert contact_events_by_contact(contacts, events).where("ID is null").count() == events.count()
