"""Repair of role sequences against plain searches."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from scorecard.llm import lr_repair, role_repair
from scorecard.llm.queries import op13_role_repair

WHITE = " \t\n\x0b\x0c\r"
# States of the role initials that may have come out: start, s, u, a.
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def least_edits(rows):
    """Least (cost, audit) by best-first search over (rows used, state)."""
    waiting, done = [(0, "", 0, "")], set()
    while waiting:
        cost, audit, used, state = heapq.heappop(waiting)
        if used == len(rows) and state in ("", "a"):
            return cost, audit
        if (used, state) in done:
            continue
        done.add((used, state))
        for role in "ua":
            if (state, role) in NEXT:
                heapq.heappush(waiting, (cost + 2, audit + "I", used, NEXT[state, role]))
        if used < len(rows):
            role, fault = rows[used]
            heapq.heappush(waiting, (cost + 3, audit + "D", used + 1, state))
            if fault != lr_repair.DOOMED:
                more = fault == lr_repair.TRUNCATED
                if (state, role) in NEXT:
                    heapq.heappush(waiting, (cost + more, audit + "K", used + 1, NEXT[state, role]))
                for role in "ua":
                    if (state, role) in NEXT:
                        heapq.heappush(waiting, (cost + 2 + more, audit + "R", used + 1, NEXT[state, role]))


def by_hand(conversations, damage=True):
    """The report of every conversation, one at a time."""
    after, reports = {}, []
    for conv, turn, role, text in conversations:
        rows = after.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20 if damage else -1
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for conv, rows in after.items():
        digest = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r)))
        seen, faults, counts = set(), [], [0, 0, 0]
        for _, role, text in rows:
            body = text.rstrip(WHITE)
            n = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else 3
            faults.append([lr_repair.DOOMED, lr_repair.DOOMED, lr_repair.TRUNCATED, lr_repair.SOUND][n])
            if n < 3:
                counts[n] += 1
            seen.add((role, text))
        initials = [role[:1] for _, role, _ in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        turns = {t for t, _, _ in rows if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, audit = least_edits(list(zip(initials, faults, strict=True)))
        lines, state, at = [], "", 0
        for edit in audit:
            role, text = (None, "") if edit == "I" else rows[at][1:]
            at += edit != "I"
            if edit in "IR":
                role = {"u": "user", "a": "assistant"}["u" if (state, "u") in NEXT else "a"]
            if edit != "D":
                state = NEXT[state, role[:1]]
                lines.append(f"{role}:{text}")
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        reports.append((conv, gaps, *counts, illegal, cost, audit, sha))
    return sorted(reports, key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("size", [0, 1, 2, 3, 5, 9, 40])
def test_parse_in_blocks_is_the_least(size):
    rng = random.Random(size)
    for _ in range(40):
        rows = [(rng.choice(["s", "u", "a", "t", ""]), rng.choice([0, 0, 0, 1, 2])) for _ in range(size)]
        want = least_edits(rows)
        for cuts in ([], sorted(rng.choices(range(size + 1), k=3))):
            chain = lr_repair.Chain()
            for a, b in zip([0, *cuts], [*cuts, size], strict=True):
                chain.add({top: lr_repair.parse_block(top, rows[a:b]) for top in lr_repair.TOPS})
            cost, audits = chain.end()
            assert (cost, "".join(audits)) == want


def test_a_grammar_that_is_not_lr():
    with pytest.raises(ValueError):
        lr_repair.Table((("x", ("y",)), ("x", ("z",)), ("y", ("u",)), ("z", ("u",))))


def test_conversations_of_the_tables(spark, folder):
    given = spark.read.parquet(f"{folder}/conversations.parquet")
    assert rows_of(op13_role_repair(spark, folder)) == by_hand([tuple(r) for r in given.collect()])


SCHEMA = "conv_id long, turn long, role string, text string, part string, kind int, digest string"


def odd_rows():
    rng = random.Random(8)
    texts = [None, "", " \t\n", "ok.", "no", "Yes!  \n", "é?", "x " * 20_000 + "."]
    rows = []
    for conv in [None, -7, 0, 5, 11]:
        for _ in range(rng.randint(1, 30)):
            role = rng.choice([None, "", "user", "assistant", "system", "tool", "User"])
            rows.append((conv, rng.choice([None, 0, 1, 2, 9]), role, rng.choice(texts)))
    return rows + rows[:5]


@pytest.mark.parametrize("block_rows", [role_repair.BLOCK_ROWS, 3])
def test_odd_rows(spark, block_rows):
    rows = odd_rows()
    given = spark.createDataFrame([(*r, "p", 1, "d") for r in rows], SCHEMA)
    got = rows_of(role_repair.repair_report(given, None, block_rows))
    assert got == by_hand(rows, damage=False)
    got = rows_of(role_repair.repair_report(role_repair.damaged(given), given, block_rows))
    assert got == by_hand(rows)


def test_one_very_long_conversation_in_many_ranges(spark):
    rng = random.Random(9)
    rows = [(1, t // 2, rng.choice(["user", "assistant"]), rng.choice(["a.", "b.", "c", f"{t}."])) for t in range(3000)]
    rows += [(c, 0, "user", "hi.") for c in range(2, 40)] + [(1, 5, "user", "same.")] * 4000
    given = spark.createDataFrame([(*r, "p", 1, "d") for r in rows], SCHEMA)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = role_repair._flagged(given)
        assert turns.where("conv_id = 1").select("part").distinct().count() > 2
        got = rows_of(role_repair.repair_report(given, None, 100))
        turned = role_repair.repaired_turns(given, 100).where("conv_id = 1").orderBy("number").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    want = by_hand(rows, damage=False)
    assert got == want
    text = "\n".join(f"{r.role}:{r.text}" for r in turned)
    assert hashlib.sha256(text.encode()).hexdigest() == next(r[-1] for r in want if r[0] == 1)
    assert re.fullmatch("s?(ua)+", "".join(r.role[0] for r in turned))


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert role_repair.repair_report(role_repair.damaged(none), none).count() == 0
    one = spark.createDataFrame([(3, 0, "user", "x.", None, None, None)], SCHEMA)
    assert rows_of(role_repair.repair_report(none, one)) == [
        (3, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    ]
