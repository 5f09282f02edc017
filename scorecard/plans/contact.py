"""The Contact entity: one row per contact identity.

Contact events are kept in a long table, one row per contact and event. The
nested form is built on request.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorecard.functions.keys import hash_id
from scorecard.functions.values import null_of
from scorecard.operators.nesting import (
    empty_if_null,
    ordered_array,
)
from scorecard.operators.latest import latest_per_key
from scorecard.operators.quality import unique
from scorecard.operators.skew import HotKeys, find_hot_keys, lookup_join

# Contact fields and the source column of each.
IDENTITY = {
    "ApexContactId": "id",
    "ApexAccountId": "accountid",
    "ContactName": "contact_name",
    "PreferredEmail": "email",
    "PreferredPhone": "preferred_phone_number_c",
    "PreferredPhoneType": "preferred_phone_type_c",
}
MAILING_ADDRESS = {
    "Street": "mailingstreet",
    "City": "mailingcity",
    "State": "mailingstatecode",
    "Zip": "mailingpostalcode",
}
PERFORMANCE_FIELDS = {
    "ContactAttempts": ("contactspace_contact_attempts", "bigint"),
    "TotalCallDurationSeconds": ("contactspace_total_call_duration", "bigint"),
    "IsQualifiedContact": ("contactspace_is_qualified_contact", "boolean"),
    "IsQuoteDiscussed": ("contactspace_is_quote_discussed", "boolean"),
    "SourceContactSpace": ("contact_source_contactspace", "string"),
    "SourceLivevox": ("contact_source_livevox", "string"),
    "SourceDrips": ("contact_source_drips", "string"),
    "SourceSfmc": ("contact_source_sfmc", "string"),
    "SourceEaJourney": ("contact_source_ea_journey", "string"),
    "SourceDbuJourney": ("contact_source_dbu_journey", "string"),
}
PERFORMANCE_CHANNEL = "CONTACTSPACE"
PHONE_CHANNEL = "PHONE"
SOURCE_NAMES = ("ContactSpace", "Livevox", "Drips", "Sfmc", "EaJourney", "DbuJourney")
CONTACT_EVENT_COLUMNS = ("ContactEventId", "ContactChannel", "ContactTimestamp", *PERFORMANCE_FIELDS)


def all_contact_events(
    performance: DataFrame, phone: DataFrame, link: str | None = None
) -> DataFrame:
    """Both channels in 13 common columns, plus ``ContactLink`` when ``link`` names
    the column of both inputs that leads to a contact."""
    from_performance = performance.select(
        F.col("ffq_quote_id").alias("ContactEventId"),
        F.lit(PERFORMANCE_CHANNEL).alias("ContactChannel"),
        F.col("timestamp").cast("timestamp_ntz").alias("ContactTimestamp"),
        *[F.col(src).alias(name) for name, (src, _) in PERFORMANCE_FIELDS.items()],
        *([F.col(link).alias("ContactLink")] if link else []),
    )
    from_phone = phone.select(
        F.col("id").alias("ContactEventId"),
        F.lit(PHONE_CHANNEL).alias("ContactChannel"),
        F.col("timestamp").cast("timestamp_ntz").alias("ContactTimestamp"),
        *[null_of(dtype).alias(name) for name, (_, dtype) in PERFORMANCE_FIELDS.items()],
        *([F.col(link).alias("ContactLink")] if link else []),
    )
    return from_performance.unionByName(from_phone)


def contact_events_by_contact(
    contacts: DataFrame,
    events: DataFrame,
    contact_key: str | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Long form: one row per contact and event, keyed by the contact's ``ID``.

    ``contact_key`` is the contact column that ``ContactLink`` refers to. A value
    that several contacts share belongs to the contact changed last, then to the
    greatest id, so no event is repeated. Events without a contact, all of them
    where no key is given, stay with a null ``ID``.
    """
    if contact_key is None:
        return events.select(null_of("string").alias("ID"), *CONTACT_EVENT_COLUMNS)
    owners = link_owners(contacts, contact_key)
    if hot is None:
        hot = find_hot_keys(events, "ContactLink")
    return lookup_join(events, owners, "ContactLink", hot, "left").select(
        hash_id(F.col("_contact")).alias("ID"), *CONTACT_EVENT_COLUMNS
    )


def link_owners(contacts: DataFrame, contact_key: str) -> DataFrame:
    """``[ContactLink, _contact]``: the one contact of each value of ``contact_key``."""
    changed = F.col("lastmodifieddate") if "lastmodifieddate" in contacts.columns else F.lit(None)
    rows = contacts.where(F.col(contact_key).isNotNull()).select(
        F.col(contact_key).alias("ContactLink"),
        F.col("id").alias("_contact"),
        # Nulls sort as greatest; a contact that was never changed comes last.
        F.coalesce(changed.cast("string"), F.lit("")).alias("_changed"),
    )
    return latest_per_key(rows, ["ContactLink"], ["_changed"], ["_contact"]).drop("_changed")


def shared_links(contacts: DataFrame, contact_key: str) -> DataFrame:
    """Values of ``contact_key`` that several contacts have, with their number."""
    return unique(contacts, contact_key)


def contact_entity(contacts: DataFrame) -> DataFrame:
    """``[ID, Contact]``; see ``nest_contact_events`` for the events array."""

    def fields(names: dict[str, str]) -> list:
        return [F.col(src).alias(name) for name, src in names.items()]

    return contacts.select(
        hash_id(F.col("id")).alias("ID"),
        F.struct(
            F.struct(*fields(IDENTITY)).alias("Identity"),
            F.struct(*fields(MAILING_ADDRESS)).alias("MailingAddress"),
            F.struct(
                F.col("id").alias("ApexContactId"), F.col("accountid").alias("ApexAccountId")
            ).alias("SystemIds"),
        ).alias("Contact"),
    )


def nest_contact_events(
    contact: DataFrame,
    events: DataFrame,
    order: Sequence[str] = ("ContactTimestamp", "ContactEventId"),
) -> DataFrame:
    """``[ID, Part, Contact]`` with ``ContactEvents`` by time; empty when there are none.

    A contact comes in parts, one for each day of events (``Part``), so no array
    grows with the history; a contact without events is one row without ``Part``.
    """
    plain = [c for c in CONTACT_EVENT_COLUMNS if not c.startswith("Source")]
    payload = F.struct(
        *plain,
        F.struct(*[F.col(f"Source{n}").alias(n) for n in SOURCE_NAMES]).alias("ContactSources"),
    )
    day = F.to_date("ContactTimestamp").alias("Part")
    arrays = events.where(F.col("ID").isNotNull()).groupBy("ID", day).agg(
        ordered_array([F.col(c) for c in order], payload).alias("ContactEvents")
    )
    array_type = arrays.schema["ContactEvents"].dataType.simpleString()
    return contact.join(arrays, "ID", "left").select(
        "ID",
        "Part",
        F.col("Contact")
        .withField("ContactEvents", empty_if_null(F.col("ContactEvents"), array_type))
        .alias("Contact"),
    )
