"""Packing token pieces into sequences by a grouping genetic algorithm.

Documents are tokenised once into pieces of at most ``capacity`` tokens. Pieces
that fill a sequence have their own. The others are dealt evenly into shards of
bounded size, and each shard is packed by several islands. An island keeps a few
packings; a child takes whole well-filled bins of one parent, the bins of the
other that hold none of their pieces, and best-fits the displaced pieces. After
each epoch the best packing of an island migrates to the next one. Islands that
reach the least possible number of bins stop. What the shards leave in bins that
are not full is packed again across shards.

Defined results: a null text is an empty document of one token; the pieces of
repeated rows are packed each for itself; a text of over ``capacity`` tokens is cut
into full pieces and a rest; of bins that leave equal space the newest is taken; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import random
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorecard.llm.bpe import encoder
from scorecard.llm.common import map_rows, prepare, texts_of
from scorecard.operators.staging import stage

CAPACITY = 4096
SHARD_PIECES = 20_000
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 6
POPULATION = 4
WELL_FILLED = 0.995
# Sequence numbers of pieces that fill a sequence, and of the second round.
FULL, AGAIN = 1 << 61, 1 << 60


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece of every document."""
    end = array("I", [end_id]).tobytes()

    def rows(ids, texts):
        tool = encoder(tokenizer_path)
        out = [[], [], [], [], []]
        for doc_id, data in zip(ids, tool.encode_batch(texts), strict=True):
            data += end
            for number, at in enumerate(range(0, len(data), 4 * capacity)):
                part = data[at : at + 4 * capacity]
                values = (doc_id, number, at // 4, len(part) // 4, zlib.crc32(part))
                for column, value in zip(out, values, strict=True):
                    column.append(value)
        return out

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return map_rows(texts_of(docs), rows, schema)


class Bins:
    """A packing under construction: bins by free space, for best fit."""

    def __init__(self, lengths: list[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.members: list[list[int]] = []
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.seen = 0  # bit f is set where a bin has f free

    def add(self, members: list[int], free: int) -> None:
        self.by_free[free].append(len(self.members))
        self.seen |= 1 << free
        self.members.append(members)

    def fit(self, item: int) -> None:
        """Put an item where it leaves least space, else in a new bin."""
        length = self.lengths[item]
        above = self.seen >> length
        if not above:
            self.add([item], self.capacity - length)
            return
        free = length + (above & -above).bit_length() - 1
        slot = self.by_free[free]
        number = slot.pop()
        if not slot:
            self.seen &= ~(1 << free)
        self.members[number].append(item)
        left = free - length
        self.by_free[left].append(number)
        self.seen |= 1 << left


def best_fit(lengths: list[int], order: list[int], capacity: int) -> list[list[int]]:
    bins = Bins(lengths, capacity)
    for item in order:
        bins.fit(item)
    return bins.members


def crossover(
    giver: list[list[int]], taker: list[list[int]], lengths: list[int], capacity: int, rng
) -> list[list[int]]:
    """Whole well-filled bins of ``giver`` go into ``taker``; displaced items best-fit."""
    fill = lambda members: sum(lengths[i] for i in members)
    bins = Bins(lengths, capacity)
    injected: set[int] = set()
    good = [b for b in giver if fill(b) >= WELL_FILLED * capacity]
    for members in rng.sample(good, max(1, len(good) // 2)) if good else []:
        injected.update(members)
        bins.add(list(members), capacity - fill(members))
    displaced = []
    for members in taker:
        used = fill(members)
        # Bins with an injected item go; so do some poor ones, which mutates.
        if injected.isdisjoint(members) and (used >= WELL_FILLED * capacity or rng.random() < 0.5):
            bins.add(list(members), capacity - used)
        else:
            displaced += [i for i in members if i not in injected]
    displaced.sort(key=lengths.__getitem__, reverse=True)
    for item in displaced:
        bins.fit(item)
    return bins.members


def fitness(packing: list[list[int]], lengths: list[int]) -> tuple[int, int]:
    """Fewer bins first, then fuller ones."""
    return len(packing), -sum(sum(lengths[i] for i in b) ** 2 for b in packing)


def least_bins(lengths: list[int], capacity: int) -> int:
    return -(-sum(lengths) // capacity)


def evolve(
    lengths: list[int], population: list[list[list[int]]], capacity: int, generations: int, rng
) -> list[list[list[int]]]:
    """The island's packings after some generations, best first."""
    order = sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True)
    if not population:
        population = [best_fit(lengths, order, capacity)]
    target = least_bins(lengths, capacity)
    ranked = sorted(population, key=lambda p: fitness(p, lengths))
    if len(ranked[0]) > target:
        while len(ranked) < POPULATION:
            noisy = sorted(order, key=lambda i: lengths[i] * rng.uniform(0.8, 1.0), reverse=True)
            ranked.append(best_fit(lengths, noisy, capacity))
    for _ in range(generations):
        ranked = sorted(ranked, key=lambda p: fitness(p, lengths))[:POPULATION]
        if len(ranked[0]) <= target:
            break
        giver, taker = rng.sample(ranked, 2)
        ranked.append(crossover(giver, taker, lengths, capacity, rng))
    return sorted(ranked, key=lambda p: fitness(p, lengths))[:POPULATION]


def _write(packing: list[list[int]], count: int) -> bytes:
    numbers = np.empty(count, np.int32)
    for number, members in enumerate(packing):
        numbers[members] = number
    return numbers.tobytes()


def _read(data: bytes) -> list[list[int]]:
    numbers = np.frombuffer(data, np.int32)
    packing: list[list[int]] = [[] for _ in range(int(numbers.max()) + 1)]
    for item, number in enumerate(numbers.tolist()):
        packing[number].append(item)
    return packing


STATE = "shard long, island int, ids binary, lengths binary, packings array<binary>, bins long"


def _first_epoch(items: DataFrame, islands: int, capacity: int) -> DataFrame:
    def start(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("row_id")
        shard, island = int(group["shard"].iloc[0]), int(group["island"].iloc[0])
        lengths = group["length"].tolist()
        found = evolve(lengths, [], capacity, GENERATIONS, random.Random(f"{shard}/{island}/0"))
        return pd.DataFrame(
            {
                "shard": [shard],
                "island": [island],
                "ids": [group["row_id"].to_numpy(np.int64).tobytes()],
                "lengths": [np.array(lengths, np.int32).tobytes()],
                "packings": [[_write(p, len(lengths)) for p in found]],
                "bins": [len(found[0])],
            }
        )

    copies = items.withColumn("island", F.explode(F.array(*[F.lit(i) for i in range(islands)])))
    return copies.groupBy("shard", "island").applyInPandas(start, STATE)


def _next_epoch(state: DataFrame, islands: int, epoch: int, capacity: int) -> DataFrame:
    """Each island goes on with its packings and the best of its neighbour."""

    def go_on(group: pd.DataFrame) -> pd.DataFrame:
        own = group[group["own"]].iloc[0]
        lengths = np.frombuffer(own["lengths"], np.int32).tolist()
        known = [_read(p) for packings in group["packings"] for p in packings]
        rng = random.Random(f"{own['shard']}/{own['island']}/{epoch}")
        found = evolve(lengths, known, capacity, GENERATIONS, rng)
        return pd.DataFrame(
            {
                "shard": [own["shard"]],
                "island": [own["island"]],
                "ids": [own["ids"]],
                "lengths": [own["lengths"]],
                "packings": [[_write(p, len(lengths)) for p in found]],
                "bins": [len(found[0])],
            }
        )

    elite = state.withColumns(
        {
            "island": ((F.col("island") + 1) % islands).cast("int"),
            "packings": F.slice("packings", 1, 1),
            "own": F.lit(False),
        }
    )
    both = state.withColumn("own", F.lit(True)).unionByName(elite)
    return both.groupBy("shard", "island").applyInPandas(go_on, STATE)


def _placed(state: DataFrame, capacity: int) -> DataFrame:
    """row_id, length, shard, bin, fill and offset by each shard's best island."""
    best = state.groupBy("shard").agg(F.min_by(F.struct("*"), F.struct("bins", "island")).alias("s"))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for one in batch.itertuples():
                lengths = np.frombuffer(one.lengths, np.int32).astype(np.int64)
                bins = np.frombuffer(one.packing, np.int32).astype(np.int64)
                order = np.argsort(bins, kind="stable")
                fills = np.bincount(bins, weights=lengths).astype(np.int64)
                ends = np.cumsum(lengths[order])
                before = np.concatenate([[0], np.cumsum(fills)])[bins[order]]
                yield pd.DataFrame(
                    {
                        "row_id": np.frombuffer(one.ids, np.int64)[order],
                        "length": lengths[order],
                        "shard": one.shard,
                        "bin": bins[order],
                        "fill": fills[bins[order]],
                        "offset": ends - lengths[order] - before,
                    }
                )

    narrow = best.select("shard", "s.ids", "s.lengths", F.get("s.packings", F.lit(0)).alias("packing"))
    schema = "row_id long, length long, shard long, bin long, fill long, offset long"
    return narrow.mapInPandas(rows, schema)


def _pack(items: DataFrame, count: int, capacity: int, shard_pieces: int, label: str) -> DataFrame:
    """Pack (row_id, length) in shards of about ``shard_pieces`` by islands."""
    shards = max(1, -(-count // shard_pieces))
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("row_id"), F.lit(shards)))
    state = stage(_first_epoch(dealt, ISLANDS, capacity), f"{label}-epoch")
    for epoch in range(1, EPOCHS):
        state = stage(_next_epoch(state, ISLANDS, epoch, capacity), f"{label}-epoch")
    return stage(_placed(state, capacity), f"{label}-placed")


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 1,
    capacity: int = CAPACITY,
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """Every piece with its sequence_id and offset."""
    prepare(docs.sparkSession)
    all_pieces = stage(
        pieces(docs, tokenizer_path, end_id, capacity).withColumn(
            "row_id", F.monotonically_increasing_id()
        ),
        "pieces",
    )
    full = all_pieces.where(F.col("length") == capacity).select(
        "row_id", (F.lit(FULL) + F.col("row_id")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    items = all_pieces.where(F.col("length") < capacity).select("row_id", "length")
    number = lambda base: F.lit(base) + F.shiftleft("shard", 24) + F.col("bin")
    placed = _pack(items, items.count(), capacity, shard_pieces, "packing")
    first = placed.select("row_id", number(0).alias("sequence_id"), "offset")
    if not placed.where("shard > 0").isEmpty():
        # Bins that are not full, of all shards, once more together.
        poor = placed.where(F.col("fill") < WELL_FILLED * capacity).select("row_id", "length")
        again = _pack(poor, poor.count(), capacity, shard_pieces, "packing-again")
        first = placed.where(F.col("fill") >= WELL_FILLED * capacity).select(
            "row_id", number(0).alias("sequence_id"), "offset"
        ).unionByName(again.select("row_id", number(AGAIN).alias("sequence_id"), "offset"))
    return all_pieces.join(first.unionByName(full), "row_id").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
