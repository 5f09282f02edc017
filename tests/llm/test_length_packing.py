"""Packing by the length histogram."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from scorecard.llm import length_packing
from scorecard.llm.queries import WORD_TOKENIZER
from tests.llm import brute


def one_by_one(lengths, capacity):
    """Shortest pack first, longest first, one length at a time: multiset of packs."""
    packs = []
    for length in sorted(set(lengths), reverse=True):
        new = []
        for _ in range(lengths.count(length)):
            open_packs = [p for p in packs if sum(p) + length <= capacity]
            if open_packs:
                min(open_packs, key=sum).append(length)
            else:
                new.append([length])
        packs += new
    return Counter(sum(p) for p in packs)


@pytest.mark.parametrize("seed", range(6))
def test_patterns_are_those_of_single_packing(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([1, 2, 3, 5, 8, 13, 14, 20, 31, rng.randint(1, 31)]) for _ in range(150)]
    patterns = length_packing.shortest_pack_first(Counter(lengths), 32)
    placed = Counter()
    for pattern, count in patterns:
        assert sum(pattern) <= 32
        placed.update({length: pattern.count(length) * count for length in set(pattern)})
    assert placed == Counter(lengths)
    assert Counter({s: 0 for s in ()}) + sum(
        (Counter({sum(p): c}) for p, c in patterns), Counter()
    ) == one_by_one(lengths, 32)
    assert len(patterns) <= 2 * len(set(lengths))


def test_work_does_not_grow_with_documents():
    few = {n: 3 for n in range(1, 2048)}
    many = {n: 3 * 10**9 for n in few}
    a, b = (length_packing.shortest_pack_first(h, 2048) for h in (few, many))
    assert [p for p, _ in a] == [p for p, _ in b]
    assert len(a) <= 2 * 2047


def check(rows, texts, capacity, end_id=1, slack=length_packing.SLACK):
    library = Tokenizer.from_file(WORD_TOKENIZER)
    want = Counter()
    for doc_id, text in texts:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, end_id], "<u4")
        want[doc_id, ids.tobytes()] += 1
    found = rows.copy()
    assert found["length"].sum() == sum(len(data) // 4 for _, data in want.elements())
    # Pieces of each document follow one another and have its ids.
    kinds = Counter()
    for doc_id, text_ids in want:
        kinds[doc_id] += 1
    for (doc_id, data), times in want.items():
        own = found[found["doc_id"].isna() if doc_id is None else found["doc_id"] == doc_id]
        own = own[own["doc_tokens"] == len(data) // 4]
        for piece in own.itertuples():
            part = data[4 * piece.start : 4 * (piece.start + piece.length)]
            if kinds[doc_id] == 1:
                assert piece.ids_crc32 == zlib.crc32(part)
        if kinds[doc_id] == 1:
            assert own["length"].sum() == times * len(data) // 4
            starts = Counter()
            for piece in own.itertuples():
                starts.update(range(piece.start, piece.start + piece.length))
            assert set(starts.values()) == {times} and len(starts) == len(data) // 4
    placed = found.sort_values(["sequence_id", "offset"])
    ends = placed.groupby("sequence_id")["length"].cumsum()
    assert (ends - placed["length"] == placed["offset"]).all()
    used = placed.groupby("sequence_id")["length"].sum()
    assert used.max() <= capacity
    padding = sum(0 if n & (n - 1) == 0 else capacity - n for n in used.tolist())
    assert padding <= slack * len(used)


@pytest.mark.parametrize("parts", [1, 5])
def test_packed_documents(spark, parts):
    rng = random.Random(parts)
    words = "cat dog bird house over".split()
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 90))) for _ in range(120)]
    texts += [None, "", "cat " * 95, "cat " * 31, *brute.EDGE_TEXTS]
    ids = [*range(len(texts) - 1), None]
    docs = brute.frame(spark, [*texts, texts[3]], [*ids, 3]).repartition(parts)
    rows = length_packing.pack(docs, WORD_TOKENIZER, 1, 32, 2).toPandas()
    check(rows, [*zip(ids, texts, strict=True), (3, texts[3])], 32, slack=2)


def test_one_length_alone_is_cut_to_fit(spark):
    docs = brute.frame(spark, ["cat " * 19] * 40)
    rows = length_packing.pack(docs, WORD_TOKENIZER, 1, 32, 2).toPandas()
    check(rows, [(i, "cat " * 19) for i in range(40)], 32, slack=2)
    assert rows["sequence_id"].nunique() == 25


def test_empty_table_and_whole_table(spark, folder):
    assert length_packing.pack(brute.frame(spark, []), WORD_TOKENIZER).count() == 0
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = length_packing.pack(docs, WORD_TOKENIZER).toPandas()
    check(rows, [(r.doc_id, r.text) for r in docs.collect()], 2048)
