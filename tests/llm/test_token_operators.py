"""Encoding, token files, packing, the classifier, revisits, and the pipeline."""

import random
import zlib
from datetime import datetime

import numpy as np
import pyarrow as pa
import pytest
from pyarrow import ipc
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from scorecard.llm import bpe, classifier, packing, revisits, token_files, trie_bpe
from scorecard.llm.queries import BYTE_TOKENIZER, WORD_TOKENIZER
from tests.llm import brute

ODD = [
    "  a  b ", "a\n b\n\n c \n", "x<|endoftext|> y <|startoftext|>z <|endoftext|>",
    "\x1ca\x1c b", "İstanbul ΣΑΣ ς 中文 a b　c Å ʼn ½ ①", "tab\t\tx\r\ny",
    "don't I'LL we'Re '' 's", "a\x85b", "😀😀 x", "1234 5 6a7", "=-=" * 33, ".\n" * 40,
]
TEXTS = brute.EDGE_TEXTS + ODD


@pytest.mark.parametrize("path", [BYTE_TOKENIZER, WORD_TOKENIZER])
def test_word_encoder_equals_the_library(path, folder, spark):
    library, ours = Tokenizer.from_file(path), bpe.WordEncoder(path, 5000)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("text").collect()
    for text in [*filter(None, TEXTS), *(r.text for r in docs[:60])]:
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ours.encode(text), np.uint32).tolist() == want


@pytest.mark.parametrize("portion", [1, 9, 1 << 21])
def test_word_batches_equal_the_library(portion, monkeypatch):
    monkeypatch.setattr(bpe, "PORTION", portion)
    library, ours = Tokenizer.from_file(WORD_TOKENIZER), bpe.WordEncoder(WORD_TOKENIZER, 3000)
    rng = random.Random(portion)
    signs = [*"''''stmdrevlSTL  \n\t\x0b\x1c\x00\x85\xa0azA9.<|>\u2028　ÀÞßÿ×÷ªÅ²İΣſ中é\u0301😀", "<|endoftext|>", "<|ENDOFTEXT|>", "'ll"]
    for _ in range(60):
        some = signs if rng.random() < 0.5 else rng.sample(signs, 6)
        texts = ["".join(rng.choices(some, k=rng.randint(0, 50))) for _ in range(rng.randint(0, 8))]
        want = [library.encode(text, add_special_tokens=False).ids for text in texts]
        assert [np.frombuffer(ids, np.uint32).tolist() for ids in ours.encode_batch(texts)] == want


def test_word_pieces_are_merged_once(monkeypatch):
    ours, merged = bpe.WordEncoder(WORD_TOKENIZER), []
    tokenize = ours.model.tokenize

    class Model:
        def tokenize(self, piece):
            merged.append(piece)
            return tokenize(piece)

    monkeypatch.setattr(ours, "model", Model())
    list(ours.encode_batch(["zebra, lion.", "Zebra! (lion)"]))
    list(ours.encode_batch(["LION's zebra. lion,"]))
    assert sorted(merged) == sorted({*merged})
    assert {"zebra", "lion", "'s"} <= {*merged}


def test_white_space_of_any_kind_parts_words():
    ours = bpe.WordEncoder(WORD_TOKENIZER)
    spaces = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u200a\u2028\u2029\u202f\u205f　"
    text = "".join(f"Cat{space}字" for space in spaces)
    want = Tokenizer.from_file(WORD_TOKENIZER).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ours.encode(text), np.uint32).tolist() == want
    assert {*ours.later.now} == {b"cat", " 字Cat".encode(), " 字".encode()}


def test_long_texts_are_encoded_in_parts(monkeypatch):
    monkeypatch.setattr(bpe, "PORTION", 100)
    ours, sizes = bpe.WordEncoder(WORD_TOKENIZER), []
    split = ours._split
    monkeypatch.setattr(ours, "_split", lambda texts: sizes.append(sum(map(len, texts))) or split(texts))
    text = "Some words, and\nmore. " * 100
    want = Tokenizer.from_file(WORD_TOKENIZER).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ours.encode(text), np.uint32).tolist() == want
    assert max(sizes) < 110 and sum(sizes) == len(text)


def test_trie_encoder_equals_the_library(folder, spark):
    library, ours = Tokenizer.from_file(BYTE_TOKENIZER), trie_bpe.TrieEncoder(BYTE_TOKENIZER)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("text").collect()
    texts = [*filter(None, TEXTS), *(r.text for r in docs[:60])]
    for text, ids in zip(texts, ours.encode_batch(texts), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want
        assert ours.decode(ids) == library.decode(want, skip_special_tokens=False)
    # Cut inside a character, ids decode to replacement characters alike.
    ids = ours.encode_batch(["😀字"])[0][1:]
    assert ours.decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False)


def test_trie_round_trip(spark):
    docs = brute.frame(spark, TEXTS)
    encoded = trie_bpe.encode(docs, BYTE_TOKENIZER)
    back = {r.doc_id: r.text for r in trie_bpe.decode(encoded, BYTE_TOKENIZER).collect()}
    assert back == {i: t or "" for i, t in enumerate(TEXTS)}


@pytest.mark.parametrize(("length", "chars"), [(2048, 1 << 25), (7, 40)])
def test_token_files(spark, length, chars):
    library = Tokenizer.from_file(BYTE_TOKENIZER)
    ids = [*range(len(TEXTS) - 2, 0, -1), None, 5]
    docs = brute.frame(spark, TEXTS, ids)
    files = token_files.write_files(docs, token_files.new_folder(docs), BYTE_TOKENIZER, 0, length, chars)
    got = sorted(token_files.read_files(files).collect(), key=lambda r: r.start)
    start, counts = 0, []
    for r in got:
        assert r.start == start
        start += r.n_tokens
        counts.append((r.doc_id, r.n_tokens, r.ids_crc32))
    want = []
    for doc_id, text in zip(ids, TEXTS, strict=True):
        tokens = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want.append((doc_id, len(tokens), zlib.crc32(tokens.tobytes())))
    assert sorted(counts, key=str) == sorted(want, key=str)
    order = [r.doc_id for r in got]
    assert order[-1] is None and order[:-1] == sorted(order[:-1])


def test_token_file_is_read_without_copying(tmp_path):
    path = str(tmp_path / "tokens.arrows")
    with pa.OSFile(path, "wb") as sink:
        writer = token_files.SequenceWriter(sink, 8)
        writer.add(1, np.arange(600, dtype=np.uint32))
        writer.close()
    before = pa.total_allocated_bytes()
    with pa.memory_map(path) as source:
        batches = list(ipc.open_stream(source))
        assert [b.num_rows for b in batches] == [64, 11]
        assert batches[1].column(0)[3].as_py() == list(range(536, 544))
        assert batches[1].column(1)[10].as_py() == [True] * 8
        assert pa.total_allocated_bytes() - before < 1024


@pytest.mark.parametrize("tokens", [0, 5, 600, 64 * 8, 64 * 8 * 300 + 1])
def test_sequences_by_number(tmp_path, tokens):
    path = str(tmp_path / "tokens.arrows")
    with pa.OSFile(path, "wb") as sink:
        writer = token_files.SequenceWriter(sink, 8, True)
        writer.add(1, np.arange(tokens, dtype=np.uint32))
        writer.close()
    before = pa.total_allocated_bytes()
    with pa.memory_map(path) as source:
        file = token_files.SequenceFile(source)
        assert len(file) == -(-tokens // 8)
        for n in {0, len(file) // 2, len(file) - 1} if tokens else ():
            ids, mask = file[n]
            left = min(8, tokens - 8 * n)
            assert ids.to_pylist() == [*range(8 * n, 8 * n + left), *[0] * (8 - left)]
            assert mask.to_pylist() == [True] * left + [False] * (8 - left)
        assert pa.total_allocated_bytes() - before < 1024
        for n in (-1, len(file)):
            with pytest.raises(IndexError):
                file[n]
        assert file.index().to_pylist() == [{"doc_id": 1, "n_tokens": tokens}]
        [(doc_id, ids)] = token_files.read_documents(source)
        assert doc_id == 1 and np.array_equal(ids, np.arange(tokens))


def test_packing(spark):
    rng = random.Random(2)
    texts = [" ".join("cat dog bird".split()[rng.randrange(3)] for _ in range(rng.randint(0, 60))) for _ in range(150)]
    docs = brute.frame(spark, [*texts, None, "cat " * 95], [*range(150), 7, None])
    for shard_pieces in (20_000, 40):
        rows = packing.pack(docs, WORD_TOKENIZER, 1, 32, shard_pieces).toPandas()
        assert rows.groupby(["doc_id", "piece"], dropna=False).size().max() <= 2
        library = Tokenizer.from_file(WORD_TOKENIZER)
        total = sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for t in [*texts, "", "cat " * 95])
        assert rows["length"].sum() == total
        placed = rows.sort_values(["sequence_id", "offset"])
        ends = placed.groupby("sequence_id")["length"].cumsum()
        assert (ends - placed["length"] == placed["offset"]).all()
        used = placed.groupby("sequence_id")["length"].sum()
        assert used.max() <= 32
        assert len(used) <= 1.05 * total / 32 + 1


def test_pieces_have_the_ids_of_the_library(spark):
    library = Tokenizer.from_file(WORD_TOKENIZER)
    got = sorted(tuple(r) for r in packing.pieces(brute.frame(spark, TEXTS), WORD_TOKENIZER, 1, 16).collect())
    want = []
    for doc_id, text in enumerate(TEXTS):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want += [
            (doc_id, n, at, len(ids[at : at + 16]), zlib.crc32(ids[at : at + 16].tobytes()))
            for n, at in enumerate(range(0, len(ids), 16))
        ]
    assert got == want


def test_the_search_keeps_what_best_fit_found_or_betters_it():
    """Where best fit misses the least number of bins, crossover goes on from it."""
    rng = random.Random(5)
    lengths = [n for _ in range(60) for n in (rng.randint(34, 40), rng.randint(25, 33))]
    lengths += [100 - a - b for a, b in zip(lengths[::2], lengths[1::2], strict=True)]
    order = sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True)
    plain = len(packing.best_fit(lengths, order, 100))
    assert packing.least_bins(lengths, 100) == 60 < plain
    found = packing.evolve(lengths, [], 100, 200, rng)
    assert len(found[0]) <= plain
    for one in found:
        assert sorted(i for members in one for i in members) == list(range(len(lengths)))
        assert max(sum(lengths[i] for i in members) for members in one) <= 100


def test_crossover_keeps_every_item_once():
    rng = random.Random(1)
    lengths = [rng.randint(1, 100) for _ in range(400)]
    order = list(range(400))
    a = packing.best_fit(lengths, order, 128)
    b = packing.best_fit(lengths, order[::-1], 128)
    child = packing.crossover(a, b, lengths, 128, rng)
    assert sorted(i for bin_ in child for i in bin_) == order
    assert max(sum(lengths[i] for i in bin_) for bin_ in child) <= 128


def test_classifier_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = classifier.classify(docs, labels).toPandas()
    assert len(found) == 1000 and found["score"].between(0, 1).all()
    held = found[found["held_out"]].merge(labels.toPandas(), on="doc_id")
    assert brute.auc(held["quality"].to_numpy(), held["score"].to_numpy()) > 0.9
    assert (held["predicted"] == held["quality"]).mean() > 0.9
    assert (found["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in found["doc_id"]]).all()


def test_classifier_scores_do_not_depend_on_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    again = docs.unionByName(docs.where("doc_id % 3 = 0").withColumn("text", F.lit("other text")))
    scores = []
    for parts in (1, 7):
        found = classifier.classify(again.repartition(parts, "text"), labels).toPandas()
        scores.append(found.sort_values(["doc_id", "score"])["score"].to_numpy())
    assert np.abs(scores[0] - scores[1]).max() < 1e-9


def test_no_context_reaches_another_text(spark):
    apart = classifier.word_vectors(brute.frame(spark, ["one two", "three four", "", None]).coalesce(1))
    indexing, total = classifier.Indexing.make(), np.zeros((classifier.SLOTS + classifier.SHAPES + 1) * classifier.DIM)
    for text in ("one two", "three four"):
        for part in classifier.slots_of(text):
            classifier.add_contexts(total, part, indexing)
    used = total.reshape(-1, classifier.DIM)[: classifier.SLOTS].any(axis=1)
    unseen = apart[: classifier.SLOTS][~used][0]
    far = np.abs(apart[: classifier.SLOTS] - unseen).max(axis=1) > 1e-6
    assert np.array_equal(used, far)


def test_classifier_odd_inputs(spark):
    docs = brute.frame(spark, TEXTS, [*range(len(TEXTS) - 1), None])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert classifier.classify(docs, none).count() == len(TEXTS)
    same = spark.createDataFrame([(1, 1), (1, None), (2, 1), (None, 0)], "doc_id long, quality int")
    assert classifier.classify(docs, same).where("score > 0.5").count() == len(TEXTS)
    assert classifier.classify(brute.frame(spark, []), none).count() == 0


def test_revisits(spark):
    at = lambda s: datetime(2024, 1, 1 + s // 100, 0, 0, s % 60)
    url = "HTTP://WWW.Example.com:80/a/?b=2&a=1&utm_x=9#f"
    rows = [
        ("r1", "response", "https://example.com/a?a=1&b=2", at(1), 200, {"ETag": '"x"', "Content-Length": "9", "Date": "d1"}),
        ("r2", "response", url, at(5), 404, {"ETag": '"y"'}),
        ("v1", "revisit", url, at(8), 304, {"etag": 'W/"x"', "content-length": "0", "Date": "d2"}),
        ("v2", "revisit", url, at(800), 304, {"ETag": '"z"'}),
        ("v3", "revisit", url, at(0), 304, {"ETag": '"x"'}),
        ("v4", "revisit", None, at(9), 304, None),
        ("v5", "revisit", url, None, 304, {"ETag": '"x"'}),
        ("v6", "revisit", url, at(900), 304, {}),
        ("n1", "response", None, at(8), 200, {"ETag": '"x"'}),
        ("n2", "response", " http:// ", at(8), 200, {"ETag": '"x"'}),
        ("n3", "revisit", None, at(9), 304, {"ETag": '"x"'}),
        ("n4", "revisit", "", at(9), 304, {"ETag": '"x"'}),
        ("v7", "revisit", url, at(901), 304, {"ETag": '"x"'}),
        ("v7", "revisit", url, at(901), 304, {"ETag": '"x"'}),
    ]
    schema = "record_id string, kind string, url string, at timestamp, status int, headers map<string,string>"
    for seconds in (revisits.BUCKET_SECONDS, 1, 10**9):
        got = revisits.resolve(spark.createDataFrame(rows, schema), seconds).collect()
        assert len(got) == 10
        shown = {r.record_id: (r.refers_to, r.outcome) for r in got}
        assert shown["v1"] == ("r1", "etag") == shown["v7"]
        assert shown["v2"] == (None, "mismatch")
        assert {shown[v] for v in ("v3", "v4", "v5", "n3", "n4")} == {(None, "no response")}
        assert shown["v6"] == (None, "no validator")
        merged = next(r.headers for r in got if r.record_id == "v1")
        assert merged == {"etag": 'W/"x"', "content-length": "9", "date": "d2"}
    assert revisits.resolve(spark.createDataFrame([], schema)).count() == 0


def test_pipeline(spark, folder):
    assert len(corpus_pipeline.STAGES) == 5
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    rows = corpus_pipeline.run(spark, folder).collect()
    kept = {r.doc_id for r in rows}
    assert kept < {r.doc_id for r in documents.select("doc_id").collect()}
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert all(not brute.rule_counts(texts[i])[0] < 20 for i in kept)
    assert len({"".join(brute.words(texts[i])) for i in kept}) == len(kept)
    prints = [brute.simhash(texts[i]) for i in kept]
    assert len(set(brute.groups_within(prints, 3).values())) == len(kept)


def test_pipeline_stages_on_odd_rows(spark):
    prose = "The cat of the house is in the garden and it was not seen by a man of the town. More was said of it."
    rows = [prose, prose, prose + " token = 0123456789abcdef0123", None, ""]
    docs = brute.frame(spark, rows, [1, 1, None, 4, None])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, "")
        assert after.columns == docs.columns
        docs = spark.createDataFrame(after.collect(), docs.schema)
    assert 1 <= docs.count() <= 2
    assert not docs.where("text like '%0123456789abcdef%'").count()
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0


def test_decimals_of_ids_come_with_them():
    tool = trie_bpe.TrieEncoder(BYTE_TOKENIZER)
    texts = ["", "one two  three", "one", "\u3000x <|endoftext|> one", " "]
    for (ids, listed), again in zip(
        tool.encode_listed(texts), tool.encode_batch(texts), strict=True
    ):
        assert listed.decode() == ",".join(map(str, again.tolist()))
        assert ids.tolist() == again.tolist()


def test_trie_asks_only_for_last_tokens_a_word_needs():
    tool = trie_bpe.TrieEncoder(BYTE_TOKENIZER)
    whole = max((t for t, n in tool.ids.items() if t.isalpha() and tool._is_own(n)), key=len)
    assert len(whole) > 5
    assert list(tool.encode_words({whole})[whole]) == [tool.ids[whole]]
    assert not tool.follows  # before, every prefix asked whether tokens may follow each other
    # Words that share a prefix, and a prefix that is a word itself.
    words = {whole, whole + b"zq", whole + b"zqzq", whole[:4], b"\0", b"\0\0", b"a\0b" * 40}
    for word, ids in tool.encode_words(words).items():
        assert list(ids) == tool.merged([tool.ids[bytes([b])] for b in word])


def test_trie_chunks_of_random_texts_equal_the_library():
    library, ours = Tokenizer.from_file(BYTE_TOKENIZER), trie_bpe.TrieEncoder(BYTE_TOKENIZER)
    random = np.random.default_rng(7)
    parts = [" ", " ", " ", "\n", "\t", "a", "the", "ing", "'s", "'", "é", "12", "\0", "-", "中", " ", "\x1c", "<|endoftext|>"]
    texts = ["".join(random.choice(parts, random.integers(0, 40))) for _ in range(1500)]
    for some in (texts[:1000], texts[900:]):  # some texts again, their chunks are known then
        for text, ids in zip(some, ours.encode_batch(some), strict=True):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
