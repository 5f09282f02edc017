"""Substring deduplication by super-k-mer partitioning.

A window is ``k`` consecutive words. Its minimiser is the least hash among its
``m``-word runs; equal windows have equal minimisers. Consecutive windows that
share a minimiser travel as one packed string of their words (a super-k-mer) to
the bucket of the minimiser. Inside a bucket windows are sorted, so equal ones
are neighbours, and every window but the first of its kind is marked. Sorting
is by hash; neighbours of equal hash are compared word for word.

A task first keeps only the earliest of its super-k-mers with the same words and
marks the others itself, so a passage in a third of all documents sends one row
per task. The rest of a bucket is packed and compressed, in blobs of bounded size.
A minimiser shared by very many different super-k-mers (a common line in ever
new surroundings) would fill one bucket: such minimisers are found on a sample of
documents, and their windows are dealt again by a hash of the whole window. Any
set of such minimisers gives the same rows.

Marked windows come back as runs (doc_id, first word, last word), joined by document.

Defined results: a null text has no words; positions of equal windows are
ordered by (doc_id, start), a null doc_id last; rows repeated with the same
doc_id count as different documents, in the order of their text and then any.
Very long texts are compared whole. An empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorecard.llm.common import prepare, texts_of
from scorecard.operators.staging import stage

WINDOW = 20
RUN = 6
# Words in one group of texts that is worked on together.
PIECE_BYTES = 4 << 20
BLOB_BYTES = 1 << 20
# Sampled documents, and the share of sampled super-k-mers that makes a minimiser hot.
SAMPLE_DOCS = 4000
HOT_SHARE = 0.0005
MAX_HOT = 10_000
BUCKET_BYTES = 8 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers with well-spread bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A hash of each word that is the same in every task."""
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, in order."""
    count = len(words) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(count, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            total = total * _ODD + words[i : i + count]
        return _mix(total)


def least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by doubling."""
    count = len(values) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    now, have = values, 1
    while have * 2 <= width:
        now = np.minimum(now[: len(now) - have], now[have:])
        have *= 2
    rest = width - have
    return np.minimum(now[:count], now[rest : rest + count])


def super_kmers(
    hashes: np.ndarray, hot: np.ndarray, k: int, m: int
) -> list[tuple[int, int, int]]:
    """(first window, last window, bucket key) of each run with one minimiser."""
    least = least_in_windows(run_hashes(hashes, m), k - m + 1)
    if not len(least):
        return []
    keys = least
    if len(hot):
        is_hot = np.isin(least, hot)
        if is_hot.any():
            keys = np.where(is_hot, run_hashes(hashes, k), least)
    cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    starts = np.concatenate([[0], cuts])
    ends = np.concatenate([cuts, [len(keys)]]) - 1
    return list(zip(starts.tolist(), ends.tolist(), keys[starts].tolist(), strict=True))


def hot_minimisers(docs: DataFrame, rows: int, k: int, m: int) -> np.ndarray:
    """Minimisers of a large share of sampled super-k-mers; a hint for dealing only."""
    if not rows:
        return np.empty(0, np.uint64)
    sampled = docs.sample(min(1.0, SAMPLE_DOCS / rows), seed=7)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, np.uint64)
        for batch in batches:
            keys = [
                key
                for text in batch.column(0).to_pylist()
                for _, _, key in super_kmers(word_hashes(text.encode().split()), none, k, m)
            ]
            found, counts = np.unique(np.array(keys, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), pa.array(counts.astype(np.int64))], names=["key", "n"]
            )

    counts = sampled.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    counts = stage(counts, "minimiser-sample")
    total = counts.agg(F.sum("n")).first()[0] or 0
    limit = max(50.0, HOT_SHARE * total)
    hot = counts.where(F.col("n") > limit).orderBy(F.desc("n")).limit(MAX_HOT).collect()
    return np.array([r["key"] for r in hot], np.int64).view(np.uint64)


# A blob is a list of records: order of the document, first window, words.
def _blob(records: list[tuple[int, int, bytes]]) -> bytes:
    head = np.array([(d, s, len(w)) for d, s, w in records], np.int64).tobytes()
    data = len(records).to_bytes(4, "little") + head + b"".join(w for _, _, w in records)
    return zstandard.ZstdCompressor(level=1).compress(data)


def _records(blob: bytes) -> Iterator[tuple[int, int, bytes]]:
    data = zstandard.ZstdDecompressor().decompress(blob, max_output_size=1 << 31)
    count = int.from_bytes(data[:4], "little")
    head = np.frombuffer(data, np.int64, count * 3, 4).reshape(-1, 3)
    at = 4 + 24 * count
    for order, start, length in head.tolist():
        yield order, start, data[at : at + length]
        at += length


MARKS = "pos long, first long, last long"


def _dealt(docs: DataFrame, hot: np.ndarray, buckets: int, k: int, m: int) -> DataFrame:
    """Blobs by bucket, and marks (blob null, dealt evenly) of what a task finds itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, dict[bytes, tuple[int, int]]] = defaultdict(dict)
        held = 0

        def flush(marks: list) -> pa.RecordBatch:
            numbers, blobs = [], []
            for bucket, found in kept.items():
                some, size = [], 0
                for words, (order, start) in found.items():
                    some.append((order, start, words))
                    size += len(words)
                    if size > BLOB_BYTES:
                        numbers.append(bucket)
                        blobs.append(_blob(some))
                        some, size = [], 0
                if some:
                    numbers.append(bucket)
                    blobs.append(_blob(some))
            none = [None] * len(numbers)
            columns = list(zip(*marks, strict=True)) or [(), (), ()]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(numbers + [pos % buckets for pos, _, _ in marks], pa.int32()),
                    pa.array(blobs + [None] * len(marks), pa.binary()),
                    *[pa.array(none + list(c), pa.int64()) for c in columns],
                ],
                names=["bucket", "blob", "pos", "first", "last"],
            )

        marks: list[tuple[int, int, int]] = []
        for batch in batches:
            for order, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                words = text.encode().split()
                for start, end, key in super_kmers(word_hashes(words), hot, k, m):
                    packed = b" ".join(words[start : end + k])
                    found = kept[key % buckets]
                    first = found.get(packed)
                    if first is None:
                        found[packed] = (order, start)
                        held += len(packed) + 150
                        continue
                    if (order, start) < first:
                        found[packed] = (order, start)
                        first, (order_, start_) = (order, start), first
                    else:
                        order_, start_ = order, start
                    marks.append((order_, start_, start_ + end - start))
            if held > PIECE_BYTES * 8 or len(marks) > 50_000:
                yield flush(marks)
                kept.clear()
                marks, held = [], 0
        yield flush(marks)

    schema = f"bucket int, blob binary, {MARKS}"
    return docs.select("pos", "text").mapInArrow(run, schema)


def _bucket_marks(dealt: DataFrame, k: int) -> DataFrame:
    """Runs of windows that an earlier window equals, found by sorting each bucket."""

    def sort_bucket(group: pa.Table) -> pa.Table:
        positions, starts, lengths, words = [], [], [], []
        own = group.filter(pc.is_null(group.column("blob"))).select(["pos", "first", "last"])
        for blob in group.column("blob").drop_null().to_pylist():
            for order, start, packed in _records(blob):
                mine = packed.split(b" ")
                positions.append(order)
                starts.append(start)
                lengths.append(len(mine))
                words += mine
        lengths = np.array(lengths, np.int64)
        begins = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        hashes = word_hashes(words)
        all_runs = run_hashes(hashes, k)
        counts = lengths - k + 1
        # Where each window begins among the words, and where in its document.
        inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        at = (np.repeat(begins, counts) + inner).astype(np.int64)
        order = np.repeat(np.array(positions, np.int64), counts)
        start = np.repeat(np.array(starts, np.int64), counts) + inner
        ranked = np.lexsort((start, order, all_runs[at]))
        sorted_hash = all_runs[at][ranked]
        same = np.flatnonzero(sorted_hash[1:] == sorted_hash[:-1]) + 1
        marked = np.zeros(len(ranked), bool)
        heads: list[int] = []
        previous = -2
        for place in same.tolist():
            if place != previous + 1 or not heads:
                heads = [place - 1]
            window = int(at[ranked[place]])
            mine = words[window : window + k]
            for head in heads:
                first = int(at[ranked[head]])
                if words[first : first + k] == mine:
                    marked[place] = True
                    break
            else:
                heads.append(place)
            previous = place
        chosen = ranked[marked]
        o, s = order[chosen], start[chosen]
        by_place = np.lexsort((s, o))
        o, s = o[by_place], s[by_place]
        if len(o):
            cut = np.flatnonzero((o[1:] != o[:-1]) | (s[1:] != s[:-1] + 1)) + 1
            first = np.concatenate([[0], cut])
            last = np.concatenate([cut, [len(o)]]) - 1
            o, s, e = o[first], s[first], s[last]
        else:
            e = s
        found = pa.table({"pos": pa.array(o), "first": pa.array(s), "last": pa.array(e)})
        return pa.concat_tables([own, found])

    return dealt.groupBy("bucket").applyInArrow(sort_bucket, MARKS)


def numbered(docs: DataFrame) -> DataFrame:
    """pos, doc_id and text: ``pos`` orders documents by doc_id, whatever repeats."""
    texts = texts_of(docs)
    stats = texts.agg(
        F.count("doc_id").alias("ids"), F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("low")
    ).first()
    repeated = stats["rows"] - stats["ids"] > 0 or not (
        texts.groupBy("doc_id").count().where("count > 1").isEmpty()
    )
    if not repeated:
        return texts.withColumn("pos", F.col("doc_id").cast("long"))
    # Null or repeated ids: rank the rows once, in ranges, and write the ranks.
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), F.col("text")]
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = texts.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    return stage(placed.withColumn("pos", F.monotonically_increasing_id()), "ranked-texts")


def repeated_runs(docs: DataFrame, k: int = WINDOW, m: int = RUN) -> DataFrame:
    """pos, first, last: runs of windows of ``numbered`` documents to be removed."""
    size = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("c")).first()
    hot = hot_minimisers(docs, size["n"], k, m)
    # About three bytes travel for each byte of text.
    buckets = max(16, -(-3 * (size["c"] or 0) // BUCKET_BYTES))
    return _bucket_marks(_dealt(docs, hot, int(buckets), k, m), k)


def remove_repeats(docs: DataFrame, k: int = WINDOW, m: int = RUN) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words that stay, joined by one space)."""
    prepare(docs.sparkSession)
    placed = numbered(docs)
    runs = stage(
        repeated_runs(placed, k, m)
        .groupBy("pos")
        .agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("runs")),
        "repeated-runs",
    )
    joined = placed.join(runs, "pos", "left").select(
        "doc_id",
        "text",
        F.col("runs.first").alias("first"),
        F.col("runs.last").alias("last"),
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, kept = [], [], []
            for text, first, last in zip(*[c.to_pylist() for c in batch.columns[1:]], strict=True):
                words = text.encode().split()
                counts.append(len(words))
                at, parts, gone = 0, [], 0
                for a, b in zip(first or (), last or (), strict=True):
                    parts += words[at:a] if a > at else []
                    end = b + k
                    gone += max(0, end - max(a, at))
                    at = max(at, end)
                removed.append(gone)
                kept.append(b" ".join(parts + words[at:]).decode())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )

    return joined.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept string")
