"""Radix trees and the conversation trie against plain dictionaries."""

import hashlib
import random
import zlib

import pytest

from scorecard.llm import radix, turn_trie
from scorecard.llm.queries import op11_conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string, page string, key string, x1 int"
COLUMNS = (
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
)


def sequences(rows, rebuild):
    """Turns (role, text) of every conversation, rebuilt by groups of five or not."""
    digest = lambda r, t: hashlib.sha256(f"{len(r)}:{r}{t}".encode()).hexdigest()[:32]
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn, role or "", text or ""))
    for turns in own.values():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, digest(*r[1:])))
    own = {c: [t[1:] for t in turns] for c, turns in own.items()}
    if not rebuild:
        return own
    found = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = int(c / 5) * 5
        found[c] = own.get(base, [])[:h] + turns[h:]
    return found


def by_hand(rows, rebuild):
    convs = sequences(rows, rebuild)
    members, ends = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), set()).add(c)
        ends.setdefault(tuple(turns), []).append(c)
    kids, leaves, saved = {}, {}, {}
    for node in sorted(members, key=len, reverse=True):
        kids.setdefault(node, 0)
        leaves[node] = leaves.get(node, 0) + (kids[node] == 0)
        size = len(node[-1][1].encode()) if node else 0
        saved[node] = saved.get(node, 0) + (len(members[node]) - 1) * size
        if node:
            up = node[:-1]
            kids[up] = kids.get(up, 0) + 1
            leaves[up] = leaves.get(up, 0) + leaves[node]
            saved[up] = saved.get(up, 0) + saved[node]
    return sorted(
        (
            (
                min(m), len(node), min(members[node[:-1]]) if node else None, len(m), kids[node], leaves[node],
                saved[node], hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest(),
            )
            for node, m in members.items()
        ),
        key=str,
    )


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def test_layouts_grow_and_keep_order():
    for count in (3, 4, 5, 16, 17, 48, 49, 256):
        tree, rng = radix.Tree(), random.Random(count)
        firsts = rng.sample(range(256), count)
        for byte in firsts:
            assert tree.insert(bytes([byte, 1])) is tree.insert(bytes([byte, 1]))
        kids = tree.root.kids
        assert [b for b, _ in kids.items()] == sorted(firsts)
        assert all((kids.get(b) is not None) == (b in firsts) for b in range(256))
        kind = radix.Sorted if count <= 16 else radix.Indexed if count <= 48 else radix.Full
        assert type(kids) is kind


def test_paths_are_compressed_and_split():
    tree = radix.Tree()
    for key in (b"abcdefgh", b"abcd", b"abxy", b""):
        assert tree.insert(key).held is None
    (_, upper), = tree.root.kids.items()
    assert upper.path == b"ab"
    assert sorted(n.path for _, n in upper.kids.items()) == [b"cd", b"xy"]


def test_only_whole_ids_give_turns():
    tree = radix.Tree()
    keys = [b"aaaa", b"aaab", b"aaaacccc", b"aaaadddd", b"b" * 12]
    for number, key in enumerate(keys):
        node = tree.insert(key)
        node.held = radix.Held()
        node.held.add(number, True, (0, 0))
    sizes = {k[i : i + 4]: 10 for k in keys for i in range(0, len(k), 4)}
    found = {(t.depth, t.least): t for t in radix.turns(tree, 4, sizes, [])}
    assert {d: sum(k[0] == d for k in found) for d in range(4)} == {0: 1, 1: 3, 2: 3, 3: 1}
    root, shared = found[0, 0], found[1, 0]
    assert (root.members, root.children, root.leaves, root.saved) == (5, 3, 4, 20)
    assert (shared.members, shared.children, shared.leaves, shared.parent) == (3, 2, 2, 0)


def random_rows(seed, convs=40):
    rng = random.Random(seed)
    texts = [None, "", "a", "é", "long " * 5000]
    rows = []
    for conv in rng.sample(range(-20, 60), convs):
        for turn in range(rng.choice([1, 1, 3, 12, 30])):
            role = rng.choice(["user", "user", None, "assistant"])
            rows.append((conv, rng.choice([turn, turn, turn, None]), role, rng.choices(texts, [1, 1, 9, 1, 1])[0]))
    rows += [(c, t, "user", "a") for c in range(100, 160) for t in range(7)]
    rows += rows[:9] + [(None, 0, "user", "a"), (None, None, None, None)]
    return rows


@pytest.mark.parametrize("rebuild", [False, True])
@pytest.mark.parametrize(("page_turns", "tree_rows"), [(64, 20_000), (64, 3), (4, 7), (1, 1)])
def test_trie_of_random_conversations(spark, rebuild, page_turns, tree_rows):
    rows = random_rows(page_turns)
    given = spark.createDataFrame([(*r, "p", "k", 1) for r in rows], SCHEMA)
    make = turn_trie.rebuilt_trie if rebuild else turn_trie.prefix_trie
    assert rows_of(make(given, page_turns, tree_rows)) == by_hand(rows, rebuild)


def test_one_very_long_conversation_in_many_ranges(spark):
    rows = [(5, t, "user", f"t{t % 11}") for t in range(2000)] + [(6, t, "user", f"t{t % 11}") for t in range(1500)]
    rows += [(c, 0, "user", "t0") for c in range(7, 20)] + [(7, None, "user", "same")] * 900
    given = spark.createDataFrame([(*r, "p", "k", 1) for r in rows], SCHEMA)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert rows_of(turn_trie.prefix_trie(given)) == by_hand(rows, False)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_conversations_of_the_tables(spark, folder):
    given = spark.read.parquet(f"{folder}/conversations.parquet").collect()
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in given]
    assert rows_of(op11_conversation_trie(spark, folder)) == by_hand(rows, True)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert turn_trie.prefix_trie(none).count() == 0
    assert turn_trie.rebuilt_trie(none).count() == 0
    # Conversation 9 takes nothing of the absent 5 and may lose its own turns.
    one = [(c, 0, "user", "x") for c in (6, 7, 8, 9)]
    given = spark.createDataFrame([(*r, None, None, None) for r in one], SCHEMA)
    assert rows_of(turn_trie.rebuilt_trie(given)) == by_hand(one, True)
