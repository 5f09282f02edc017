"""Rules, secrets, exact and near copies, repeated passages."""

import hashlib
import random
import re
import string

import pytest

from scorecard.llm import exact_dedup, quality_rules, secret_scan, simhash, superkmers
from scorecard.llm.components import components
from scorecard.llm.queries import BYTE_RANKS
from tests.llm import brute


def by_text(rows):
    return sorted(rows, key=str)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    made = [" ".join(rng.choice("ab") for _ in range(rng.randint(5, 200))) for _ in range(20)]
    lines = ["\n".join(" ".join(rng.choice(["foo", "bar", "#x"]) for _ in range(rng.randint(0, 6))) for _ in range(20)) for _ in range(20)]
    return brute.EDGE_TEXTS + made + lines


def test_fingerprints_compose():
    tool = exact_dedup.Fingerprinter()
    data = random.Random(1).randbytes(200_000)
    whole = tool.whole(data)
    for cut in (0, 1, 65_536, 100_001):
        assert tool.whole(data[:cut]) + tool.whole(data[cut:]) == whole
    assert tool.whole(data[1:] + data[:1]) != whole


@pytest.mark.parametrize("moduli", [exact_dedup.MODULI, (2, 3, 2)])
def test_exact_groups(spark, texts, moduli):
    ids = [*range(len(texts)), 3, 3, None, None]
    rows = list(zip(ids, [*texts, "a", "a", "ab ", None], strict=True))
    docs = brute.frame(spark, [t for _, t in rows], ids)
    got = exact_dedup.exact_groups(docs, moduli).collect()
    found = [(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got]
    assert by_text(found) == by_text(brute.exact(rows))
    assert sum(r.kept for r in got) == len({r.text_sha256 for r in got})


@pytest.mark.parametrize("moduli", [exact_dedup.MODULI, (2, 3, 2)])
def test_exact_groups_of_long_texts_hashed_in_parts(spark, moduli, monkeypatch):
    base = "é ab\n" * 40_000
    texts = [base, base + " ", base[:-2] + "X\n", base, base[::-1], "short", " sho rt", "", None]
    ids = [4, 2, 3, 4, 5, 6, 7, 8, None]
    docs = brute.frame(spark, texts, ids)
    want = by_text(brute.exact(list(zip(ids, texts, strict=True))))
    for limit in (exact_dedup.SHARED_LIMIT, 0):
        monkeypatch.setattr(exact_dedup, "SHARED_LIMIT", limit)
        got = exact_dedup.exact_groups(docs, moduli, long_chars=999).collect()
        assert by_text([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got]) == want
    parts = exact_dedup.fingerprints(docs, moduli, long_chars=999).collect()
    whole = exact_dedup.fingerprints(docs, moduli).collect()
    assert by_text(parts) == by_text(whole)


def test_exact_groups_deal_chunks_by_content(spark, texts):
    docs = brute.frame(spark, texts)
    found = exact_dedup.fingerprints(docs)
    plan = exact_dedup._chunk_rows(exact_dedup._texts_to_compare(docs, found), exact_dedup.MODULI)
    plan = plan.groupBy("fp", "fp_length", "number", "chunk").count()
    text = plan._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    dealt = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert len(dealt) == 1 and "chunk" in dealt[0]
    assert "BroadcastHashJoin" in text or "BroadcastExchange" in text


def test_exact_keeps_columns_and_one_of_repeated_rows(spark):
    docs = brute.frame(spark, ["a b", "a b", "ab", None, ""], [1, 1, 2, 3, 4])
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, "a b"), (3, None)]


@pytest.mark.parametrize("apply", [exact_dedup.deduplicate, simhash.deduplicate])
def test_columns_of_any_name_stay(spark, apply):
    names = ["_id", "_key", "_text_key", "row", "id", "key", "a.b"]
    rows = [(1, "a b c", *names), (1, "a b c", *names), (2, "a b c", *names), (3, "q", *names)]
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names)
    docs = spark.createDataFrame(rows, schema)
    kept = apply(docs)
    assert kept.schema == docs.schema
    assert sorted(map(tuple, kept.collect())) == [rows[0], rows[3]]


def test_rules_against_brute_force(spark, texts):
    got = {r.doc_id: r for r in quality_rules.judge(brute.frame(spark, texts)).collect()}
    for i, text in enumerate(texts):
        r = got[i]
        want = brute.rule_counts(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)


def test_rules_run_no_python(spark):
    plan = quality_rules.judge(brute.frame(spark, ["a"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rules_filter_keeps_columns(spark):
    prose = "The cat of the house is in the garden and it was not seen by a man of the town."
    docs = brute.frame(spark, [prose + " More was said of it.", None, "THE!! " * 40, "of " * 50])
    kept = quality_rules.filter_documents(docs)
    assert kept.columns == docs.columns
    assert [r.doc_id for r in kept.collect()] == [0]


def test_secrets(spark):
    hexa, rand = "0123456789abcdef01", "q7ZxP0vK2mB9tR4wYc8N"
    texts = [
        None,
        "",
        f"token = {hexa} and é PassWord:'abcdefghijkl' x",
        "AKIA" + "Q" * 14 + " AKIA" + "Q" * 13,
        f"see {rand} now; sha256-{rand}{rand}; 123e4567-e89b-12d3-a456-426614174000",
        "incomprehensibilities_of_internationalization 12345678901234567890123",
        "secret=short token=" + "z" * 30000,
    ]
    got = {r.doc_id: r for r in secret_scan.scan(brute.frame(spark, texts), BYTE_RANKS).collect()}
    start = texts[2].index(hexa)
    word = texts[2].index("PassWord")
    base = f"assign:0:{start + 18},hex:{start}:{start + 18},assign:{word}:{word + 22}"
    assert got[2].spans == base
    assert got[2].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    assert (got[3].n_access, got[3].spans) == (1, "access:0:18")
    assert got[4].spans == f"random:4:{4 + len(rand)}"
    assert got[5].spans == "hex:46:69" and got[0].spans == ""
    assert got[6].n_assign == 1
    clean = secret_scan.redact(brute.frame(spark, texts), BYTE_RANKS)
    assert clean.columns == list(brute.frame(spark, []).columns)
    shown = {r.doc_id: r.text for r in clean.collect()}
    assert shown[0] is None and shown[5].endswith("zation [SECRET]")
    assert hexa not in shown[2] and shown[2].startswith("[SECRET] and é [SECRET]")


def test_secrets_of_any_letters_and_digits(spark):
    rng = random.Random(6)
    letters, upper = string.ascii_letters, string.ascii_uppercase
    kinds = [letters, string.ascii_lowercase, upper, letters + string.digits, upper + "234567"]
    made = ["".join(rng.choices(k, k=n)) for k in kinds for n in (20, 24, 32, 64)]
    rand, uuid = "q7ZxP0vK2mB9tR4wYc8N", "123e4567-e89b-12d3-a456-426614174000"
    parts = [f"{rand}_{uuid}", f"{uuid}/{rand}", f"0123456789abcdef01_{rand}", f"AKIA{'Q' * 14}/{rand}"]
    numbers = ["2024-01-01/2024-12-31", "=-" * 20, "A0B1C2D3" * 5, f"x-{uuid}"]
    texts = [f"see {t} now" for t in [*made, *parts, *numbers]]
    clean = secret_scan.redact(brute.frame(spark, texts), BYTE_RANKS)
    shown = [r.text for r in clean.orderBy("doc_id").collect()]
    assert shown[: len(made)] == ["see [SECRET] now"] * len(made)
    for got, text in zip(shown[len(made) :], parts, strict=False):
        assert rand not in got and "[SECRET]" in got and (uuid in got) == (uuid in text)
    assert shown[len(made) + len(parts) :] == texts[len(made) + len(parts) :]


def test_simhash_fingerprints(spark, texts):
    got = {r.doc_id: r.fp for r in simhash.fingerprints(brute.frame(spark, texts)).collect()}
    assert all(got[i] % (1 << 64) == brute.simhash(t) for i, t in enumerate(texts))


@pytest.mark.parametrize("limit", [128, 4])
def test_simhash_links_lose_no_component(spark, limit):
    rng = random.Random(3)
    fps = {rng.getrandbits(63) for _ in range(60)}
    for base in rng.sample(sorted(fps), 4):
        weak = rng.sample(range(63), 12)
        fps |= {base ^ sum(1 << k for k in rng.sample(weak, rng.randint(1, 4))) for _ in range(25)}
    nodes = spark.createDataFrame([(f,) for f in fps], "fp long")
    roots = {r.node: r.root for r in components(simhash.links(nodes, limit)).collect()}
    assert {f: roots.get(f, f) for f in fps} == brute.groups_within(fps, 3)


@pytest.mark.parametrize("limit", [1, 128])
def test_simhash_links_only_what_is_close(spark, limit):
    # The bits of block 1 differ, but not their distances to the references.
    rest = random.Random(5).getrandbits(63) & ~(((1 << 21) - 1) ^ ((1 << 10) - 1))
    fps = {rest | 0x7DC00, rest | 0x1D3C00, rest | 0x1D3C00 ^ 0x7 << 40}
    nodes = spark.createDataFrame([(f,) for f in fps], "fp long")
    roots = {r.node: r.root for r in components(simhash.links(nodes, limit)).collect()}
    assert {f: roots.get(f, f) for f in fps} == brute.groups_within(fps, 3)


def test_simhash_crowded_bucket_gives_bounded_links(spark):
    rng = random.Random(6)
    base, weak = rng.getrandbits(64), rng.sample(range(64), 16)
    fps = {base ^ sum(1 << k for k in rng.sample(weak, rng.randint(0, 6))) for _ in range(900)}
    fps |= {base ^ (0b1111 << at) ^ 0xF for at in range(16, 48, 4)}
    signed = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = simhash.links(nodes, 8)
    rows = found.collect()
    assert len(rows) <= 2081 * len(fps)
    assert all(bin((r.a ^ r.b) % (1 << 64)).count("1") <= 3 for r in rows)
    roots = {r.node: r.root for r in components(found).collect()}
    assert {f: roots.get(f, f) for f in signed} == brute.groups_within(signed, 3)


def test_near_groups(spark):
    texts = ["a b c d", "A b  c d", None, "", "x y z w v", "q"]
    got = simhash.near_groups(brute.frame(spark, texts, [5, 4, 3, None, 1, 1])).collect()
    shown = sorted((r.doc_id if r.doc_id is not None else -1, r.component_id) for r in got)
    assert shown == [(-1, 3), (1, 1), (1, 1), (3, 3), (4, 4), (5, 4)]
    kept = simhash.deduplicate(brute.frame(spark, texts, [5, 4, 3, None, 1, 1]))
    assert len(kept.collect()) == 4


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(1000, 2000 + i) for i in range(40)]
    links = spark.createDataFrame([*chain, *star, (7, 7), (1, 0)], "a long, b long")
    roots = {r.node: r.root for r in components(links).collect()}
    assert set(roots.values()) == {0, 1000} and len(roots) == 82


@pytest.mark.parametrize("hot_share", [superkmers.HOT_SHARE, 0.0])
def test_repeats_removed(spark, texts, hot_share, monkeypatch):
    monkeypatch.setattr(superkmers, "HOT_SHARE", hot_share)
    rows = list(enumerate([*texts, texts[-1]]))
    docs = brute.frame(spark, [t for _, t in rows])
    got = [tuple(r) for r in superkmers.remove_repeats(docs, 6, 2).collect()]
    assert by_text(got) == by_text(brute.without_repeats(rows, 6))


def test_repeats_with_null_and_repeated_ids(spark):
    passage = " ".join(f"w{i}" for i in range(25))
    docs = brute.frame(spark, [passage, passage, passage, "a"], [2, 2, None, 1])
    got = sorted((r.n_words, r.n_removed) for r in superkmers.remove_repeats(docs).collect())
    assert got == [(1, 0), (25, 0), (25, 25), (25, 25)]


@pytest.mark.parametrize(
    "apply",
    [
        exact_dedup.exact_groups,
        exact_dedup.deduplicate,
        quality_rules.judge,
        simhash.near_groups,
        superkmers.remove_repeats,
        lambda d: secret_scan.scan(d, BYTE_RANKS),
    ],
)
def test_empty_table(spark, apply):
    assert apply(brute.frame(spark, [])).count() == 0


# The contract's patterns, written plainly.
ASSIGN = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
PLAIN = (
    ("assign", re.compile(ASSIGN, re.I | re.A), 2, 12),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile("[0-9a-f]+"), 0, 16),
)


def plain_spans(text):
    found = []
    for order, (kind, pattern, group, least) in enumerate(PLAIN):
        spans = [m.span() for m in pattern.finditer(text or "") if len(m[group]) >= least]
        found += [(start, order, f"{kind}:{start}:{end}") for start, end in spans]
    return [text for _, _, text in sorted(found)]


def test_base_spans_are_those_of_the_plain_patterns(spark, folder):
    rng = random.Random(12)
    parts = ["token", "API_KEY", "apikey:", "=", " ", "'", "secret", "PassWord", "\n", "\x1c", "é", "ſecret=",
             "AKIA" + "A1B2" * 5, "AKIA1", "0123456789abcdef", "deadbeef", "x/+_.=-" * 3, "a" * 12, "long " * 40]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(400)]
    texts += [*brute.EDGE_TEXTS, *(r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect())]
    got = {r.doc_id: r for r in secret_scan.scan(brute.frame(spark, texts), BYTE_RANKS).collect()}
    for number, text in enumerate(texts):
        spans, r = plain_spans(text), got[number]
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        counts = [sum(s.startswith(kind) for s in spans) for kind, *_ in PLAIN]
        assert [r.n_assign, r.n_access, r.n_hex] == counts
        assert set(spans) <= set(r.spans.split(","))
