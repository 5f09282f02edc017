"""SimHash near-duplicates found through pivot distance tables.

A fingerprint is described by its Hamming distances to reference fingerprints
(pivots). For every reference there are also pivots with one block of bits
flipped: the difference of the two distances tells how far the fingerprint is
from the reference inside that block alone. Two fingerprints that differ in at
most three bits agree in all but three blocks, hence in all these distances of
the other blocks; so candidates are the fingerprints with equal pivot distances
in some choice of all blocks but three. Candidates whose distance to any whole
reference differs by more than three are discarded (triangle inequality), and
the survivors are verified bit by bit.

Equal fingerprints are one node, so exact copies cost nothing here. Nodes of a bucket
with more than ``bucket_limit`` are not compared in pairs. Each lists the fingerprints
that differ from it in at most two of the bits free in its crowded buckets: 2,081 at
most, whatever the size of a bucket. Of two nodes within three bits, one is within one
bit and the other within two of some listed fingerprint, so all nodes that list it are
linked to the least of those within one bit of it, which is within three bits of each.
No bucket is cut or sampled, and the links lose and add no component.

Defined results: a null or empty text has fingerprint zero and links like any
other; a null doc_id takes part but is never a component's id unless alone;
repeated rows get the same verdict; very long texts count with all their shingles,
some at a time; a bit that just half of the hashes have is 0; an empty table gives no
rows; other columns, whatever their names, are ignored (``deduplicate`` returns them).
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorecard.llm.common import keep_rows, map_rows, prepare, text_key, texts_of
from scorecard.llm.components import components
from scorecard.operators.staging import stage

BITS = 64
SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 3
BUCKET_LIMIT = 128
# Blocks of bits, as even as may be.
BLOCKS = 6
# Shingles hashed at a time.
PIECE = 1 << 16
# Reference fingerprints: arbitrary, but the same everywhere.
REFERENCES = (
    0x0000000000000000,
    0x5DEECE66D1B54A33,
    0x9E3779B97F4A7C15,
    0xC2B2AE3D27D4EB4F,
    0x165667B19E3779F9,
    0x27D4EB2F165667C5,
    0x85EBCA77C2B2AE63,
    0xFF51AFD7ED558CCD,
)


def fingerprint(text: str) -> int:
    """Signed 64-bit fingerprint of the word shingles of a text."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    size = min(SHINGLE_WORDS, len(words))
    count = len(words) - size + 1
    ones = np.zeros(BITS, np.int64)
    for first in range(0, count, PIECE):
        last = min(first + PIECE, count)
        runs = map(b" ".join, zip(*[words[first + k : last + k] for k in range(size)], strict=True))
        hashes = np.fromiter(
            map(xxhash.xxh64_intdigest, runs, repeat(SEED)), np.uint64, last - first
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_key and fp (long) of every row."""

    def rows(ids, keys, texts):
        return [ids, keys, [fingerprint(t) for t in texts]]

    keyed = texts_of(docs).select("doc_id", text_key().alias("text_key"), "text")
    return map_rows(keyed, rows, "doc_id long, text_key long, fp long")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _distance(reference: int) -> Column:
    return F.bit_count(F.col("fp").bitwiseXOR(F.lit(_signed(reference)))).cast("long")


def _mask(block: int) -> int:
    first, last = block * BITS // BLOCKS, (block + 1) * BITS // BLOCKS
    return (1 << last) - (1 << first)


def pivot_table() -> Column:
    """Distances to the references, one byte each, packed into a long."""
    packed = F.lit(0).cast("long")
    for i, reference in enumerate(REFERENCES):
        packed = packed.bitwiseOR(F.shiftleft(_distance(reference), 8 * i))
    return packed


def _block_codes() -> list[Column]:
    """For each block, one value for all distances of the fingerprint inside it."""
    return [
        F.xxhash64(*[_distance(r ^ _mask(b)) - _distance(r) for r in REFERENCES])
        for b in range(BLOCKS)
    ]


def _keyed(nodes: DataFrame) -> DataFrame:
    """Rows dealt to buckets: one for each choice of the blocks that may differ."""
    coded = nodes.withColumn("_codes", F.array(*_block_codes()))
    choices = []
    for n, free in enumerate(combinations(range(BLOCKS), MAX_BITS)):
        fixed = [F.get("_codes", F.lit(b)) for b in range(BLOCKS) if b not in free]
        bits = sum(_mask(b) for b in free)
        choices.append(
            F.struct(F.xxhash64(F.lit(n), *fixed).alias("key"), F.lit(_signed(bits)).alias("free"))
        )
    return coded.select("fp", "table", F.explode(F.array(*choices)).alias("c")).select(
        "fp", "table", "c.key", "c.free"
    )


def _close(x: Column, y: Column) -> Column:
    """Pivot test, then the bits themselves."""
    spread = [
        F.abs(
            F.shiftright(x["table"], 8 * i).bitwiseAND(F.lit(255))
            - F.shiftright(y["table"], 8 * i).bitwiseAND(F.lit(255))
        )
        for i in range(len(REFERENCES))
    ]
    return (F.greatest(*spread) <= MAX_BITS) & (
        F.bit_count(x["fp"].bitwiseXOR(y["fp"])) <= MAX_BITS
    )


def _pairs(small: DataFrame) -> DataFrame:
    """Verified links of buckets of bounded size."""
    groups = small.groupBy("key").agg(F.collect_list(F.struct("fp", "table")).alias("g"))
    found = F.flatten(
        F.transform(
            "g",
            lambda x, i: F.transform(
                F.filter(F.slice("g", i + 2, F.size("g")), lambda y: _close(x, y)),
                lambda y: F.struct(x["fp"].alias("a"), y["fp"].alias("b")),
            ),
        )
    )
    return groups.select(F.explode(found).alias("l")).select("l.a", "l.b")


def _crowded_links(crowded: DataFrame) -> DataFrame:
    """Links among nodes of crowded buckets: ``fp`` and ``free``, the bits that may differ.

    A node lists what differs from it in at most two free bits. Only lists of nodes
    that fit are gathered: those within two bits of one value, 2,081 at most.
    """
    bits = F.filter(
        F.array(*[F.lit(_signed(1 << b)) for b in range(BITS)]),
        lambda bit: F.col("free").bitwiseAND(bit) != 0,
    )
    flips = F.transform(
        F.flatten(
            F.transform(
                "_bits",
                lambda x, i: F.transform(
                    F.slice("_bits", i + 2, F.size("_bits")), lambda y: x.bitwiseOR(y)
                ),
            )
        ),
        lambda flip: F.struct(flip.alias("flip"), F.lit(False).alias("near")),
    )
    single = F.transform("_bits", lambda x: F.struct(x.alias("flip"), F.lit(True).alias("near")))
    same = F.array(F.struct(F.lit(0).cast("long").alias("flip"), F.lit(True).alias("near")))
    listed = crowded.withColumn("_bits", bits).select(
        "fp", F.explode(F.concat(same, single, flips)).alias("v")
    )
    groups = (
        listed.select(F.col("fp").bitwiseXOR(F.col("v.flip")).alias("value"), "fp", "v.near")
        .groupBy("value")
        .agg(F.collect_list("fp").alias("g"), F.min(F.when(F.col("near"), F.col("fp"))).alias("b"))
        .where("size(g) > 1 AND b IS NOT NULL")
    )
    return groups.select(F.explode("g").alias("a"), "b").where("a <> b").distinct()


def links(nodes: DataFrame, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """Links (a, b) that join every two of the distinct ``fp`` within three bits,
    directly or through others within three bits of each."""
    keyed = _keyed(nodes.select("fp").withColumn("table", pivot_table()))
    # Counted in each task first, so a crowded bucket is a few rows here.
    counts = keyed.groupBy("key").count().where(F.col("count") > bucket_limit).select("key")
    crowded_keys = stage(counts, "crowded-keys")
    if crowded_keys.isEmpty():
        return _pairs(keyed).distinct()
    crowded = (
        keyed.join(crowded_keys, "key", "left_semi")
        .groupBy("fp")
        .agg(F.bit_or("free").alias("free"))
    )
    usual = _pairs(keyed.join(crowded_keys, "key", "left_anti"))
    return usual.unionByName(_crowded_links(crowded)).distinct()


def near_groups(docs: DataFrame, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """One row per input row: doc_id, text_key, fp, component_id, kept.

    ``kept`` marks the first document of each component (all rows equal to it).
    """
    prepare(docs.sparkSession)
    found = stage(fingerprints(docs), "simhash")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key"))
    nodes = stage(found.groupBy("fp").agg(first.alias("first")), "simhash-nodes")
    roots = components(links(nodes, bucket_limit))
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    heads = rooted.groupBy("root").agg(F.min("first").alias("head"))
    named = rooted.join(heads, "root").select("fp", "head")
    return found.join(named, "fp").select(
        "doc_id",
        "text_key",
        "fp",
        F.col("head.doc_id").alias("component_id"),
        (
            F.col("doc_id").eqNullSafe(F.col("head.doc_id"))
            & (F.col("text_key") == F.col("head.text_key"))
        ).alias("kept"),
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """The first document of each component, with all columns of ``docs``."""
    return keep_rows(docs, stage(near_groups(docs), "near-groups"))


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
