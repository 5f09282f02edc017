"""Packing by the length histogram, shortest pack first.

Documents are tokenised once. Every ``capacity`` tokens of a document fill a
sequence of their own; what is left of it (its rest) is packed. Packing needs
only the number of rests of each length. Lengths are taken longest first; each is
put into the packs that are shortest so far, all equal packs at once, so what is
kept is a count for each pattern of lengths, and the work does not grow with the
number of documents. A pattern then says which ranks of a length go where, and
the rests, ranked within their length, find their place by rank.

Patterns that would leave more than ``slack`` places empty are not used as they
are: their packs are laid end to end, and that stream is cut every ``capacity``
tokens, at most one cut of a rest for each sequence. What remains at its end is cut
to powers of two, which need no padding. So padding is at most ``slack`` tokens a
sequence.

Nothing but the histogram reaches the driver (fewer rows than ``capacity``). Ranks
are counted in the tasks that tokenise; a table of counts by length and partition,
added up along the partitions, makes them ranks over all rows, so a length that a
third of all documents have is in no single task. The table of places is broadcast.
It has a row for each slot of each pattern; with L lengths there are at most 2 L
patterns, as a length leaves at most one pattern split and one new, whatever the
number of documents.

Defined results: a null or empty text is a document of the end id alone; texts of
any length are packed whole; repeated rows are packed each for itself; ties of
length are broken by the order of reading; other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorecard.llm.bpe import encoder
from scorecard.llm.common import prepare, texts_of
from scorecard.operators.staging import stage

CAPACITY = 2048
# Empty places that a pattern may leave.
SLACK = 8
# Sequence numbers: of patterns from 0, of the stream, of its end, of full pieces.
STREAM, STREAM_END, FULL = 1 << 60, 1 << 61, 1 << 62
# Full pieces of one partition have numbers of their own.
PARTITION_BITS = 36

TOKENS = (
    "doc_id long, n_tokens long, rest int, local_rank long, first_full long, ids binary"
)
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in order of placing) and how many packs have each."""
    by_space: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(capacity + 1)]
    for length in sorted(histogram, reverse=True):
        left, space = histogram[length], capacity
        while left:
            # The shortest pack has the most space; a pack only loses space.
            while space >= length and not by_space[space]:
                space -= 1
            if space < length:
                by_space[capacity - length].append(((length,), left))
                break
            pattern, count = by_space[space].pop()
            used = min(count, left)
            if count > used:
                by_space[space].append((pattern, count - used))
            by_space[space - length].append(((*pattern, length), used))
            left -= used
    counts: Counter[tuple[int, ...]] = Counter()
    for packs in by_space:
        for pattern, count in packs:
            counts[pattern] += count
    return sorted(counts.items(), reverse=True)


def powers(length: int) -> list[int]:
    """Powers of two that add up to ``length``, largest first."""
    return [1 << b for b in range(length.bit_length() - 1, -1, -1) if length >> b & 1]


@dataclass(frozen=True)
class Places:
    """Where the rank of a rest among those of its length puts it.

    For each length: first ranks of its slots, and for each slot whether it is in
    the stream, the number (or stream position) of its first pack, the step to the
    next pack, and the offset in the pack.
    """

    capacity: int
    slots: dict[int, tuple[np.ndarray, np.ndarray]]
    stream: int

    @classmethod
    def of(cls, patterns: list[tuple[tuple[int, ...], int]], capacity: int, slack: int) -> Places:
        found: dict[int, list[tuple[int, int, int, int]]] = {}
        ranks: Counter[int] = Counter()
        sequences = stream = 0
        for pattern, count in patterns:
            size, offset = sum(pattern), 0
            loose = capacity - size > slack
            base, step = (stream, size) if loose else (sequences, 1)
            for length in pattern:
                found.setdefault(length, []).append((ranks[length], loose, base, step, offset))
                ranks[length] += count
                offset += length
            if loose:
                stream += size * count
            else:
                sequences += count
        slots = {}
        for length, rows in found.items():
            table = np.array(sorted(rows), np.int64)
            slots[length] = (table[:, 0].copy(), table[:, 1:].copy())
        return cls(capacity, slots, stream)

    def parts(self, length: int, rank: int) -> Iterator[tuple[int, int, int]]:
        """sequence_id, offset and length of the pieces of a rest."""
        firsts, rows = self.slots[length]
        at = int(np.searchsorted(firsts, rank, "right")) - 1
        loose, base, step, offset = (int(v) for v in rows[at])
        place = rank - int(firsts[at])
        if not loose:
            yield base + place, offset, length
            return
        position = base + place * step + offset
        whole = self.stream // self.capacity * self.capacity
        while length:
            if position < whole:
                number, inside = divmod(position, self.capacity)
                taken = min(length, self.capacity - inside)
                yield STREAM + number, inside, taken
            else:
                first = whole
                for number, size in enumerate(powers(self.stream - whole)):
                    if position < first + size:
                        break
                    first += size
                inside = position - first
                taken = min(length, size - inside)
                yield STREAM_END + number, inside, taken
            position += taken
            length -= taken


def tokens(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int) -> DataFrame:
    """Ids of every document, the length of its rest and ranks within the partition."""
    end = array("I", [end_id]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(tokenizer_path)
        wide = max(tool.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1) > 1 << 16
        seen: Counter[int] = Counter()
        full = 0
        for batch in batches:
            doc_ids, texts = (c.to_pylist() for c in batch.columns)
            rows = []
            for doc_id, data in zip(doc_ids, tool.encode_batch(texts), strict=True):
                ids = np.frombuffer(data + end, np.uint32)
                whole, rest = divmod(len(ids), capacity)
                stored = ids if wide else ids.astype(np.uint16)
                rows.append((doc_id, len(ids), rest, seen[rest], full, stored.tobytes()))
                seen[rest] += 1
                full += whole
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            names = [field.split()[0] for field in TOKENS.split(", ")]
            columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
            )

    read = texts_of(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return read.mapInArrow(run, TOKENS).withColumn("part", F.spark_partition_id())


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 1,
    capacity: int = CAPACITY,
    slack: int = SLACK,
) -> DataFrame:
    """Every piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = prepare(docs.sparkSession)
    rows = stage(tokens(docs, tokenizer_path, end_id, capacity), "tokens")
    counts = stage(
        rows.where("rest > 0").groupBy("rest", "part").agg(F.count(F.lit(1)).alias("n")), "lengths"
    )
    # At most capacity - 1 rows.
    histogram = {r["rest"]: r["n"] for r in counts.groupBy("rest").agg(F.sum("n").alias("n")).collect()}
    places = Places.of(shortest_pack_first(histogram, capacity), capacity, slack)
    shared = spark.sparkContext.broadcast(places)  # bounded by patterns, not by documents
    # A length has a row for each partition that holds it.
    before = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = counts.select(
        "rest", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier")
    )
    ranked = rows.join(earlier, ["rest", "part"], "left").select(
        "doc_id",
        "rest",
        (F.col("local_rank") + F.coalesce("earlier", F.lit(0))).alias("rank"),
        (F.lit(FULL) + F.shiftleft(F.col("part").cast("long"), PARTITION_BITS) + F.col("first_full")).alias("full"),
        "n_tokens",
        "ids",
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = shared.value
        kinds = [pa.int64()] * 7
        names = [field.split()[0] for field in PIECES.split(", ")]
        for batch in batches:
            out: list[list] = [[] for _ in kinds]
            for doc_id, rest, rank, full, count, data in zip(
                *[c.to_pylist() for c in batch.columns], strict=True
            ):
                stored = np.uint16 if len(data) == 2 * count else np.uint32
                ids = memoryview(np.frombuffer(data, stored).astype("<u4").tobytes())
                pieces = [(full + n, 0, capacity) for n in range(count // capacity)]
                if rest:
                    pieces += places.parts(rest, rank)
                start = 0
                for sequence, offset, length in pieces:
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    values = (doc_id, start, length, crc, count, sequence, offset)
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
                    start += length
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names
            )

    return ranked.mapInArrow(place, PIECES)
