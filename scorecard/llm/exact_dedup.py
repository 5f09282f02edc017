"""Exact deduplication by composable polynomial fingerprints.

A normalised text (UTF-8 without white space) is read chunk by chunk. A chunk's
fingerprint is a polynomial of its bytes modulo three primes; two fingerprints
combine to that of the joined bytes by shifting the left one by the length of
the right one, so chunks can be hashed in any order or place. A text over
``long_chars`` is cut into parts that several tasks hash; an aggregation combines them.

Texts of equal fingerprint and length are then compared chunk by chunk: their chunks
stream through one aggregation by fingerprint, number and content. Each task keeps a
content once before anything is shuffled, so a group of copies sends at most one chunk
of each number from a task, however large it is; a further count of contents moves no
texts. Where few fingerprints are shared (``SHARED_LIMIT``), their hashes are broadcast
and other texts do not travel. A group with two contents at one chunk number is a
collision: its texts are told apart by which content they have at each number.

Defined results: a null text is empty, and empty texts are equal to each other.
Of equal texts the row with most code points in the original text stays, then the
smallest doc_id (null last). Rows repeated with the same doc_id and text all
appear; one of them has ``kept``. Very long texts are hashed and compared in chunks,
all of them. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorecard.llm.common import (
    WHITE_BYTES,
    keep_rows,
    map_rows,
    prepare,
    text_key,
    texts_of,
    without_white,
)
from scorecard.operators.skew import find_hot_keys, lookup_join
from scorecard.operators.staging import stage

CHUNK_BYTES = 1 << 16
# Texts with more code points are hashed in parts of so many, by several tasks.
LONG_CHARS = 1 << 22
# Rows of a table of keys that may be broadcast (a few MB).
SHARED_LIMIT = 200_000
# Primes below 2**31, and a base for each: arbitrary, but the same everywhere.
MODULI = (2147483647, 2147483629, 2147483587)
BASES = (1304972387, 761920437, 1883409001)


@dataclass(frozen=True)
class Fingerprint:
    """Length and residues of a byte string; ``a + b`` is that of the joined bytes."""

    length: int
    residues: tuple[int, ...]
    moduli: tuple[int, ...] = MODULI

    def __add__(self, other: Fingerprint) -> Fingerprint:
        shifted = tuple(
            (left * pow(base, other.length, p) + right) % p
            for left, right, base, p in zip(
                self.residues, other.residues, BASES, self.moduli, strict=True
            )
        )
        return Fingerprint(self.length + other.length, shifted, self.moduli)

    def key(self) -> str:
        return ":".join(map(str, self.residues))


def _weights(moduli: tuple[int, ...]) -> list[np.ndarray]:
    """Powers of each base, highest first."""
    tables = []
    for base, p in zip(BASES, moduli, strict=True):
        powers = np.empty(CHUNK_BYTES, np.uint64)
        value = 1
        for i in range(CHUNK_BYTES):
            powers[CHUNK_BYTES - 1 - i] = value
            value = value * base % p
        tables.append(powers)
    return tables


class Fingerprinter:
    """Hashes chunks with tables of powers built once per task."""

    def __init__(self, moduli: tuple[int, ...] = MODULI):
        self.moduli = moduli
        self.tables = _weights(moduli)

    def chunk(self, data: bytes) -> Fingerprint:
        # Bytes are below 2**8, powers below 2**31, terms at most 2**16.
        values = np.frombuffer(data, np.uint8).astype(np.uint64)
        residues = tuple(
            int(np.dot(values, table[CHUNK_BYTES - len(data) :])) % p
            for table, p in zip(self.tables, self.moduli, strict=True)
        )
        return Fingerprint(len(data), residues, self.moduli)

    def whole(self, data: bytes) -> Fingerprint:
        empty = Fingerprint(0, tuple(0 for _ in self.moduli), self.moduli)
        return reduce(lambda a, b: a + b, map(self.chunk, chunks_of(data)), empty)


def chunks_of(data: bytes) -> list[bytes]:
    return [data[i : i + CHUNK_BYTES] for i in range(0, len(data), CHUNK_BYTES)]


def normalised(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").translate(None, WHITE_BYTES)


_FINGERPRINTERS: dict[tuple[int, ...], Fingerprinter] = {}


def _fingerprinter(moduli: tuple[int, ...]) -> Fingerprinter:
    if moduli not in _FINGERPRINTERS:
        _FINGERPRINTERS[moduli] = Fingerprinter(moduli)
    return _FINGERPRINTERS[moduli]


def fingerprints(
    docs: DataFrame, moduli: tuple[int, ...] = MODULI, long_chars: int = LONG_CHARS
) -> DataFrame:
    """doc_id, text_key, n_chars, fp, fp_length and text_sha256 of every row.

    The table is written. Texts over ``long_chars`` are read once more, in parts.
    """

    def rows(ids, keys, texts):
        hasher = _fingerprinter(moduli)
        out = [ids, keys, list(map(len, texts)), [], [], []]
        for text in texts:
            if len(text) > long_chars:
                for column in out[3:]:
                    column.append(None)
                continue
            data = normalised(text)
            whole = hasher.whole(data)
            out[3].append(whole.key())
            out[4].append(whole.length)
            out[5].append(hashlib.sha256(data).hexdigest())
        return out

    keyed = texts_of(docs).select("doc_id", text_key().alias("text_key"), "text")
    schema = "doc_id long, text_key long, n_chars long, fp string, fp_length long, text_sha256 string"
    found = stage(map_rows(keyed, rows, schema), "fingerprints")
    short = found.where(F.col("fp").isNotNull())
    if found.where(F.col("fp").isNull()).isEmpty():
        return short
    size = F.char_length("text").cast("long")
    long = keyed.withColumn("n_chars", size).where(F.col("n_chars") > long_chars)
    return short.unionByName(stage(_in_parts(long, moduli, long_chars), "long-fingerprints"))


def _in_parts(long: DataFrame, moduli: tuple[int, ...], part_chars: int) -> DataFrame:
    """Fingerprints of long texts: hashed part by part, combined by shifting."""

    def rows(ids, keys, sizes, hashes, copies, numbers, parts):
        hasher = _fingerprinter(moduli)
        prints = [hasher.whole(normalised(part)) for part in parts]
        out = [ids, keys, sizes, hashes, copies, numbers, [f.length for f in prints]]
        for i, (base, p) in enumerate(zip(BASES, moduli, strict=True)):
            out.append([f.residues[i] for f in prints])
            out.append([pow(base, f.length, p) for f in prints])
        return out

    row = ["doc_id", "text_key", "n_chars", "text_sha256"]
    hashed = long.withColumn("text_sha256", F.sha2(without_white(F.col("text")).cast("binary"), 256))
    # Rows that agree in all of this have one text; they are hashed once.
    once = hashed.groupBy(*row).agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    starts = F.sequence(F.lit(1).cast("long"), F.col("n_chars"), F.lit(part_chars).cast("long"))
    parts = F.transform(starts, lambda at: F.substring("text", at.cast("int"), F.lit(part_chars)))
    dealt = once.select(*row, "copies", F.posexplode(parts).alias("number", "part")).repartition(
        *row, "number"
    )
    residues = [f"r{i}" for i in range(len(moduli))]
    shifts = [f"s{i}" for i in range(len(moduli))]
    fields = ", ".join(f"{r} long, {s} long" for r, s in zip(residues, shifts, strict=True))
    schema = (
        "doc_id long, text_key long, n_chars long, text_sha256 string, copies long, "
        f"number int, length long, {fields}"
    )
    hashed_parts = map_rows(dealt, rows, schema)
    # A few numbers for each part, at most 2 GB / part_chars of them for a text.
    at = F.array_sort(F.collect_list(F.struct("number", "length", *residues, *shifts)))
    grouped = hashed_parts.groupBy(*row, "copies").agg(at.alias("at"))

    def combined(i: int) -> Column:
        def step(left: Column, part: Column) -> Column:
            # Both factors are below 2**31.
            return (left * part[shifts[i]] + part[residues[i]]) % moduli[i]

        return F.aggregate("at", F.lit(0).cast("long"), step).cast("string")

    return grouped.select(
        "doc_id",
        "text_key",
        "n_chars",
        F.concat_ws(":", *[combined(i) for i in range(len(moduli))]).alias("fp"),
        F.aggregate("at", F.lit(0).cast("long"), lambda n, part: n + part["length"]).alias("fp_length"),
        "text_sha256",
        F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"),
    ).drop("copy")


def _chunk_rows(docs: DataFrame, moduli: tuple[int, ...]) -> DataFrame:
    """Every chunk of every normalised text, with the text's fingerprint."""

    def rows(ids, texts):
        hasher = _fingerprinter(moduli)
        out = [[], [], [], [], [], []]
        for doc_id, text in zip(ids, texts, strict=True):
            data = normalised(text)
            whole = hasher.whole(data)
            sha = hashlib.sha256(data).hexdigest()
            for number, chunk in enumerate(chunks_of(data)):
                for column, value in zip(
                    out, (doc_id, sha, whole.key(), whole.length, number, chunk), strict=True
                ):
                    column.append(value)
        return out

    schema = "doc_id long, sha string, fp string, fp_length long, number int, chunk binary"
    return map_rows(docs, rows, schema)


def _few(keys: DataFrame) -> DataFrame:
    """``keys``, broadcast if it has no more than ``SHARED_LIMIT`` rows."""
    return F.broadcast(keys) if keys.count() <= SHARED_LIMIT else keys


def _texts_to_compare(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Texts whose fingerprint several rows share; all of them if too many are shared.

    Texts are named by hash, so a text too many may be among them, never one too few.
    """
    key = ["fp", "fp_length"]
    usable = found.where("fp_length > 0")
    shared = usable.groupBy(*key).count().where("count > 1").select(*key)
    keys = stage(usable.join(shared, key, "left_semi").select("text_key").distinct(), "shared")
    texts = texts_of(docs)
    if keys.count() > SHARED_LIMIT:
        return texts
    keyed = texts.withColumn("text_key", text_key())
    return keyed.join(F.broadcast(keys), "text_key", "left_semi").select("doc_id", "text")


def _collisions(docs: DataFrame, found: DataFrame, moduli: tuple[int, ...]) -> DataFrame:
    """Which text has which content, for fingerprints that different texts share.

    Returns fp, fp_length, doc_id, sha and ``variant``; normally no row at all.
    """
    place = ["fp", "fp_length", "number"]
    texts = _texts_to_compare(docs, found)
    # Each task keeps a chunk once, and chunks are dealt by their content too.
    contents = _chunk_rows(texts, moduli).groupBy(*place, "chunk").agg(F.lit(1).alias("one"))
    places = contents.groupBy(*place).agg(F.count("one").alias("contents"))
    unequal = stage(
        places.where("contents > 1").select("fp", "fp_length").distinct(), "collisions"
    )
    rows = _chunk_rows(texts, moduli).join(_few(unequal), ["fp", "fp_length"], "left_semi")
    order = Window.partitionBy(*place).orderBy("chunk")
    named = (
        rows.select(*place, "chunk").distinct().withColumn("content", F.row_number().over(order))
    )
    return (
        rows.join(named, [*place, "chunk"])
        .groupBy("fp", "fp_length", "doc_id", "sha")
        .agg(F.array_sort(F.collect_set(F.struct("number", "content"))).alias("at"))
        .select(
            "fp",
            "fp_length",
            F.col("doc_id").alias("c_doc_id"),
            F.col("sha").alias("c_sha"),
            F.to_json("at").alias("variant"),
        )
    )


def exact_groups(
    docs: DataFrame, moduli: tuple[int, ...] = MODULI, long_chars: int = LONG_CHARS
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, text_key."""
    prepare(docs.sparkSession)
    found = fingerprints(docs, moduli, long_chars)
    key = ["fp", "fp_length"]
    clashes = stage(_collisions(docs, found, moduli), "clashes")
    if clashes.isEmpty():
        classed = found.withColumn("variant", F.lit(""))
    else:
        same = [found[c] == clashes[c] for c in key]
        same.append(found["doc_id"].eqNullSafe(clashes["c_doc_id"]))
        same.append(found["text_sha256"] == clashes["c_sha"])
        classed = found.join(clashes, reduce(lambda a, b: a & b, same), "left").select(
            *[found[c] for c in found.columns],
            F.coalesce(clashes["variant"], F.lit("")).alias("variant"),
        )
    classed = classed.withColumn("group", F.concat_ws("|", *key, "variant"))
    best = F.min(F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").isNull(), "doc_id"))
    groups = classed.groupBy("group").agg(
        best.alias("best"), F.count(F.lit(1)).alias("group_size")
    )
    # Rows of large groups meet a broadcast of one row per large group.
    hot = find_hot_keys(classed, "group")
    joined = lookup_join(classed, groups, "group", hot, "inner").select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("n_chars") == -F.col("best.n")))
        .alias("best_row"),
        "text_sha256",
        "n_chars",
        "text_key",
    )
    # Rows that agree in everything are interchangeable: the first of them stays.
    twins = Window.partitionBy("doc_id", "text_sha256", "n_chars").orderBy("text_key")
    return joined.withColumn("copy", F.row_number().over(twins)).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("best_row") & (F.col("copy") == 1)).alias("kept"),
        "text_sha256",
        "text_key",
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    return keep_rows(docs, stage(exact_groups(docs), "exact-groups"))
