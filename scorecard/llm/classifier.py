"""A quality classifier on random-indexing word vectors.

Each word slot has a fixed sparse random index vector. A slot's word vector is
the sum of the index vectors of its neighbours over the whole corpus, so every
document contributes and partial sums just add up. Words share ``SLOTS`` slots
by hash, which bounds the table whatever the vocabulary. Word shapes (case,
digits, signs, repetition) have slots and vectors of their own, made alike.

A document is the mean of its words' vectors and the mean of its shapes'
vectors. A two-layer network, trained in numpy on a bounded sample of labelled
documents, gives a logit; a temperature fitted on documents it was not trained
on calibrates the probability.

Defined results: a null or empty text has the zero vector and gets a score like
any other; repeated rows get equal scores; of several labels of a document the
mean decides, null labels are ignored; without labels of both kinds the score is
the share of label 1 (0.5 without labels); an empty table gives no rows. Long texts
count whole, some words at a time. A score of just 0.3 predicts 1. Of several texts
with one labelled doc_id the one of the least hash is learned from. Labels, lang,
source and doc_id are never inputs of a score; other columns are ignored. Neither
batches nor partitions change a score, beyond the rounding of a matrix product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorecard.llm.common import prepare, texts_of
from scorecard.operators.staging import stage

SLOTS = 1 << 14
SHAPES = 1 << 10
DIM = 32
NONZERO = 4
REACH = 2
# Slots of one row of a partial sum.
BLOCK = 256
# Words worked on at a time.
PIECE = 1 << 18
# At most so many labelled documents are learned from.
TRAIN_ROWS = 20_000
HIDDEN = 32
EPOCHS = 60
THRESHOLD = 0.3
# Length, as a share of the mean one, that every vector's length is increased by.
DAMPING = 0.1
FOLDS = 5


@dataclass(frozen=True)
class Indexing:
    """Positions and signs of the index vector of every slot."""

    positions: np.ndarray
    signs: np.ndarray

    @classmethod
    def make(cls, seed: int = 17) -> Indexing:
        rng = np.random.default_rng(seed)
        rows = SLOTS + SHAPES
        positions = np.argsort(rng.random((rows, DIM)), axis=1)[:, :NONZERO]
        signs = rng.choice([-1.0, 1.0], (rows, NONZERO))
        # The neutral slot, which stands between texts, adds nothing to neighbours.
        return cls(
            np.vstack([positions, np.zeros((1, NONZERO))]).astype(np.int64),
            np.vstack([signs, np.zeros((1, NONZERO))]),
        )


def shape_of(word: str) -> str:
    """Character classes of a word, runs collapsed; signs stand for themselves."""
    out = []
    for c in word:
        kind = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out)


def _code(word: bytes) -> int:
    slot = xxhash.xxh3_64_intdigest(word) % SLOTS
    shape = xxhash.xxh3_64_intdigest(shape_of(word.decode("utf-8", "replace"))) % (SHAPES // 4)
    return slot * SHAPES + shape * 4


class Codes(dict):
    """Codes by word, of two generations: the older goes when the newer is full."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.old = limit, {}

    def __missing__(self, word: bytes) -> int:
        code = self.old.get(word)
        if code is None:
            code = _code(word)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[word] = code
        return code


_CODES = Codes(200_000)


def slots_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Word slots and shape slots of a text, in order."""
    words = text.encode("utf-8", "surrogatepass").split()
    codes = np.fromiter(map(_CODES.__getitem__, words), np.int64, len(words))
    slots, shapes = codes // SHAPES, codes % SHAPES
    if len(codes) > 1:
        shapes[1:] += codes[1:] == codes[:-1]
    if len(codes) > 3:
        triples = (codes[:-2] * 1_000_003 + codes[1:-1]) * 1_000_003 + codes[2:]
        _, first = np.unique(triples, return_index=True)
        again = np.ones(len(triples), np.int64)
        again[first] = 0
        shapes[2:] += 2 * again
    return slots, SLOTS + shapes


def add_contexts(total: np.ndarray, slots: np.ndarray, indexing: Indexing) -> None:
    """Add to each slot the index vectors of its neighbours within ``REACH``."""
    size = total.size
    for start in range(0, len(slots), PIECE):
        part = slots[start : start + PIECE + REACH]
        for by in range(1, REACH + 1):
            left, right = part[: min(PIECE, len(part) - by)], part[by : by + PIECE]
            left = left[: len(right)]
            if not len(left):
                continue
            for a, b in ((left, right), (right, left)):
                for j in range(NONZERO):
                    at = a * DIM + indexing.positions[b, j]
                    total += np.bincount(at, indexing.signs[b, j], size)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Vectors of all slots, from every document; a table of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexing = Indexing.make()
        rows = SLOTS + SHAPES
        total = np.zeros((rows + 1) * DIM)
        gap = np.full(REACH, rows)
        for batch in batches:
            words, shapes = [], []
            for text in batch.column(0).to_pylist():
                w, s = slots_of(text)
                # No context reaches across the gap to another text.
                words += [w, gap]
                shapes += [s, gap]
            for part in (words, shapes):
                if part:
                    add_contexts(total, np.concatenate(part), indexing)
        values = total[: rows * DIM].astype(np.int64).reshape(-1, BLOCK * DIM)
        used = np.flatnonzero(values.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(used.astype(np.int32)),
                pa.array([values[i].tobytes() for i in used], pa.binary()),
            ],
            names=["block", "sums"],
        )

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v, np.int64) for v in group.column("sums").to_pylist())
        return pa.table({"block": group.column("block")[:1], "sums": pa.array([total.tobytes()])})

    schema = "block int, sums binary"
    partial = texts_of(docs).select("text").mapInArrow(run, schema)
    summed = partial.groupBy("block").applyInArrow(add, schema)
    vectors = np.zeros((SLOTS + SHAPES, DIM))
    for row in summed.collect():  # (SLOTS + SHAPES) / BLOCK rows
        at = row["block"] * BLOCK
        vectors[at : at + BLOCK] = np.frombuffer(row["sums"], np.int64).reshape(BLOCK, DIM)
    for part in (slice(0, SLOTS), slice(SLOTS, None)):
        vectors[part] -= vectors[part].mean(axis=0)
        # Long vectors to length one; slots seen rarely for this corpus stay near zero.
        norms = np.linalg.norm(vectors[part], axis=1, keepdims=True)
        vectors[part] /= norms + max(DAMPING * float(norms.mean()), 1e-9)
    return vectors.astype(np.float32)


def document_vector(text: str, vectors: np.ndarray) -> np.ndarray:
    """Mean vector of the words and of the shapes of a text."""
    out = np.zeros(2 * DIM)
    slots, shapes = slots_of(text)
    for number, part in enumerate((slots, shapes)):
        for start in range(0, len(part), PIECE):
            out[number * DIM : (number + 1) * DIM] += vectors[part[start : start + PIECE]].sum(axis=0)
    return out / max(1, len(slots))


@dataclass
class Network:
    """Two layers, with the standardisation of inputs and the temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1)
        return hidden @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x) / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -50, 50)))


def train(x: np.ndarray, y: np.ndarray, seed: int = 5) -> Network:
    """Train on four fifths of the rows, fit the temperature on the rest."""
    rng = np.random.default_rng(seed)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    order = rng.permutation(len(x))
    held, used = order[: len(x) // 5], order[len(x) // 5 :]
    share = float(np.clip(y[used].mean() if len(used) else 0.5, 1e-3, 1 - 1e-3))
    net = Network(
        mean,
        scale,
        rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)),
        np.zeros(HIDDEN),
        np.zeros(HIDDEN),
        float(np.log(share / (1 - share))),
    )
    if len(np.unique(y)) < 2 or not len(held):
        return net
    inputs = (x - mean) / scale
    weights = [net.w1, net.b1, net.w2, np.array([net.b2])]
    first = [np.zeros_like(w) for w in weights]
    second = [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(EPOCHS):
        for rows in np.array_split(rng.permutation(used), max(1, len(used) // 128)):
            a, t = inputs[rows], y[rows]
            hidden = np.tanh(a @ weights[0] + weights[1])
            error = (_sigmoid(hidden @ weights[2] + weights[3]) - t) / len(rows)
            back = np.outer(error, weights[2]) * (1 - hidden**2)
            slopes = [
                a.T @ back + 1e-4 * weights[0],
                back.sum(axis=0),
                hidden.T @ error + 1e-4 * weights[2],
                np.array([error.sum()]),
            ]
            step += 1
            for i, slope in enumerate(slopes):
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope**2
                rate = 0.003 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                weights[i] = weights[i] - rate * first[i] / (np.sqrt(second[i]) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = *weights[:3], float(weights[3][0])
    z, t = net.logits(x[held]), y[held]
    losses = {}
    for temperature in np.geomspace(0.25, 8.0, 61):
        p = np.clip(_sigmoid(z / temperature), 1e-9, 1 - 1e-9)
        losses[float(temperature)] = -float(np.mean(t * np.log(p) + (1 - t) * np.log(1 - p)))
    net.temperature = min(losses, key=losses.get)
    return net


def held_out() -> Column:
    """Whether a document is never learned from, by the checksum of its number."""
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(number.cast("binary")) % FOLDS == 0


def classify(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    spark = prepare(docs.sparkSession)
    vectors = word_vectors(docs)
    shared = spark.sparkContext.broadcast(vectors)  # 2 MB, whatever the corpus
    known = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
        .where(~held_out())
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(train_rows)
    )
    known = stage(known, "labels")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [document_vector(t, shared.value).tobytes() for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(rows, pa.binary())], names=["doc_id", "key", "label", "x"]
            )

    # One text of each labelled document: at most ``train_rows`` rows come back.
    learned = (
        texts_of(docs)
        .join(F.broadcast(known), "doc_id")  # at most train_rows rows
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), "label", "text")
        .mapInArrow(features, "doc_id long, key long, label int, x binary")
        .groupBy("doc_id")
        .agg(F.min(F.struct("key", "x", "label")).alias("best"))
        .select("doc_id", "best.label", "best.x")
        .toPandas()
        .sort_values("doc_id")
    )
    if len(learned):
        x = np.stack([np.frombuffer(v) for v in learned["x"]])
        net = train(x, learned["label"].to_numpy(float))
    else:
        net = train(np.zeros((1, 2 * DIM)), np.array([0.5]))
    shared_net = spark.sparkContext.broadcast(net)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            x = np.array([document_vector(t, shared.value) for t in texts]).reshape(-1, 2 * DIM)
            p = shared_net.value.scores(x)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(p, pa.float64()),
                    pa.array((p >= THRESHOLD).astype(np.int32)),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = texts_of(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text"
    )
    return rows.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")
