"""Resolving not-modified revisits of a web archive.

A revisit record says that a server answered "not modified": it has headers but
no payload. It is resolved to the latest earlier full response of the same
canonical URL, if their validators agree, and gets that response's headers,
updated by those of its own that such an answer may change.

The as-of join is a running "last full response" in time order. To keep a URL
with very many captures out of one task, time is cut into buckets: inside a
bucket the running value needs only the rows of that URL and bucket; across
buckets only the last response of each bucket is carried on. Payloads never
take part: the result names the response that has it.

Records: record_id, kind ("response" or "revisit"), url, at (timestamp), status,
headers (map, any case). Defined results: a record without a time or URL (null, blank,
or nothing but a scheme) never matches, and such revisits skip the as-of join; at one
time, responses come before revisits, then by record_id; headers
that are null count as none; repeated rows each get a result; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_SECONDS = 86_400

# Response fields that a not-modified answer may not replace.
KEPT_FIELDS = (
    "connection",
    "content-encoding",
    "content-length",
    "content-range",
    "content-type",
    "keep-alive",
    "proxy-authenticate",
    "proxy-authentication-info",
    "set-cookie",
    "te",
    "trailer",
    "transfer-encoding",
    "upgrade",
)
TRACKING = r"^(utm_[a-z]+|gclid|fbclid|ref)="


def canonical_url(url: Column) -> Column:
    """Scheme and leading www. away, host in lower case, no default port or fragment,
    parameters sorted and without tracking, no empty path or closing slash."""
    bare = F.regexp_replace(F.btrim(url), r"#.*$", "")
    bare = F.regexp_replace(bare, r"^(?i:https?)://", "")
    host = F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r"^www\d*\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    pairs = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    joined = F.array_join(F.array_sort(pairs), "&")
    return F.concat(host, path, F.when(joined != "", F.concat(F.lit("?"), joined)).otherwise(""))


def lower_keys(headers: Column) -> Column:
    """Header names in lower case; of names that differ only in case the last stays."""
    entries = F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>")))
    lowered = F.transform(entries, lambda e: F.struct(F.lower(e["key"]).alias("k"), e["value"].alias("v")))
    names = F.array_distinct(F.transform(lowered, lambda e: e["k"]))
    return F.map_from_entries(
        F.transform(
            names,
            lambda n: F.struct(
                n, F.element_at(F.filter(lowered, lambda e: e["k"] == n), -1)["v"]
            ),
        )
    )


def _validation(old: Column, new: Column) -> Column:
    """How the validators of a revisit (new) and a response (old) agree."""
    weak = lambda tag: F.regexp_replace(F.btrim(tag), r"^W/", "")
    tag, time = new["etag"], new["last-modified"]
    return (
        F.when(tag.isNotNull() & old["etag"].isNotNull(),
               F.when(weak(tag) == weak(old["etag"]), F.lit("etag")).otherwise(F.lit("mismatch")))
        .when(time.isNotNull() & old["last-modified"].isNotNull(),
              F.when(F.btrim(time) == F.btrim(old["last-modified"]), F.lit("last-modified"))
              .otherwise(F.lit("mismatch")))
        .otherwise(F.lit("no validator"))
    )


def merged_headers(old: Column, new: Column) -> Column:
    """The response's headers with the permitted ones of the revisit on top."""
    permitted = F.map_filter(new, lambda name, _: ~name.isin(*KEPT_FIELDS))
    rest = F.map_filter(old, lambda name, _: ~F.map_contains_key(permitted, name))
    return F.map_concat(rest, permitted)


def resolve(records: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """One row per revisit: record_id, url_key, refers_to, outcome, headers.

    ``outcome`` is etag or last-modified when resolved, else mismatch, no validator
    or no response; ``refers_to`` and ``headers`` are null unless resolved.
    """
    url_key = canonical_url(F.col("url"))
    rows = records.where(F.col("kind").isin("response", "revisit")).select(
        "record_id",
        "kind",
        F.when(url_key != "", url_key).alias("url_key"),
        "at",
        "status",
        lower_keys(F.col("headers")).alias("headers"),
    )
    matches = F.col("url_key").isNotNull() & F.col("at").isNotNull()
    alone = rows.where((F.col("kind") == "revisit") & ~matches)
    is_full = (F.col("kind") == "response") & (F.col("status") == 200)
    full = F.when(is_full, F.struct("record_id", "headers"))
    rows = rows.where(matches).withColumns(
        {
            "bucket": F.floor(F.unix_seconds(F.col("at").cast("timestamp")) / bucket_seconds),
            "late": (F.col("kind") == "revisit").cast("int"),
            "full": full,
        }
    ).where((F.col("kind") == "revisit") | is_full)
    order = ["at", "late", "record_id"]
    inside = Window.partitionBy("url_key", "bucket").orderBy(*order)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    near = rows.withColumn("found", F.last("full", ignorenulls=True).over(before)).where(
        "kind = 'revisit'"
    )
    # The last response of each bucket, then the last one of any earlier bucket.
    # The start marks buckets that hold revisits alone.
    ends = rows.groupBy("url_key", "bucket").agg(
        F.max_by("full", F.when(is_full, F.struct("at", "record_id"))).alias("last_full")
    )
    across = Window.partitionBy("url_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    earlier = ends.select(
        "url_key", "bucket", F.last("last_full", ignorenulls=True).over(across).alias("earlier")
    )
    joined = near.join(earlier, ["url_key", "bucket"], "left").select(
        "record_id",
        "url_key",
        "headers",
        F.coalesce("found", "earlier").alias("old"),
    )
    # Null in ``old`` for those that skipped the join.
    every = joined.unionByName(alone.select("record_id", "url_key", "headers"), True)
    judged = every.withColumn(
        "outcome",
        F.when(F.col("old").isNull(), F.lit("no response")).otherwise(
            _validation(F.col("old.headers"), F.col("headers"))
        ),
    )
    good = F.col("outcome").isin("etag", "last-modified")
    return judged.select(
        "record_id",
        "url_key",
        F.when(good, F.col("old.record_id")).alias("refers_to"),
        "outcome",
        F.when(good, merged_headers(F.col("old.headers"), F.col("headers"))).alias("headers"),
    )


def captures_of_pages(pages: DataFrame) -> DataFrame:
    """An archive of ``pages``: each page as a response, and a later visit of each.

    The crawl reads a page a second; it comes back to every page after a day and a
    half. The server then answers "not modified", with an entity tag for most
    pages, with a date alone for every fifth, and with another tag (the page had
    changed meanwhile) for every seventh.
    """
    at = lambda later: F.timestamp_seconds(F.lit(1_700_000_000) + F.col("page_id") + later)
    tag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"'))
    date = lambda later: F.date_format(at(later), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    response = pages.select(
        F.concat(F.lit("response-"), F.col("page_id").cast("string")).alias("record_id"),
        F.lit("response").alias("kind"),
        "url",
        at(F.lit(0)).alias("at"),
        F.lit(200).alias("status"),
        F.create_map(
            F.lit("Date"), date(F.lit(0)),
            F.lit("Last-Modified"), date(F.lit(-3600)),
            F.lit("ETag"), tag,
            F.lit("Content-Type"), F.lit("text/html; charset=utf-8"),
            F.lit("Content-Length"), F.octet_length(F.coalesce("html", F.lit(""))).cast("string"),
        ).alias("headers"),
    )
    later = F.lit(129_600)
    changed = F.when(F.col("page_id") % 7 == 0, F.lit('"changed"')).otherwise(F.concat(F.lit("W/"), tag))
    sent = F.when(F.col("page_id") % 5 == 0, F.lit(None).cast("string")).otherwise(changed)
    revisit = pages.select(
        F.concat(F.lit("revisit-"), F.col("page_id").cast("string")).alias("record_id"),
        F.lit("revisit").alias("kind"),
        "url",
        at(later).alias("at"),
        F.lit(304).alias("status"),
        F.map_filter(
            F.create_map(
                F.lit("Date"), date(later),
                F.lit("etag"), sent,
                F.lit("Last-Modified"), date(F.lit(-3600)),
                F.lit("Content-Length"), F.lit("0"),
                F.lit("Cache-Control"), F.lit("max-age=60"),
            ),
            lambda _, value: value.isNotNull(),
        ).alias("headers"),
    )
    return response.unionByName(revisit)


def listed(headers: Column) -> Column:
    """Headers as text, by name."""
    entries = F.array_sort(F.map_entries(headers))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")
