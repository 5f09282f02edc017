"""Repair of conversation structure by a generalised LR parse (``lr_repair``).

Rows of a conversation are taken by turn (nulls first; ties by role, then by a
digest of role and text). The first fault of a row counts: blank text, a role and
text seen earlier in the conversation, or an end without a closing sign. The least
edits make its role initials a sentence of the grammar.

A conversation may be very long. Rows are range-partitioned by conversation and turn
and written once; a conversation's rows in one range are parsed in blocks of bounded
length, from every top state of the stack, so ranges of one conversation are
parsed in different tasks. Blocks, a few short rows each, are then chained in order.
Repeats are found within a range by the task that parses it, and across ranges by
the first range that has them. Last, texts stream through in order, next to the
edits that were chosen, and come out repaired; no text waits in memory. A digest
of a whole conversation is of one stream by its nature, so that last pass has one
task for each conversation; what a task holds is the audit of one conversation.

Defined results: null roles and texts are one space; rows with a null conv_id are a
conversation; a role of other initials can be reroled or deleted, not kept; turns
that are all null have no gaps; repeated rows are duplicates; very long texts are
read whole; conversations listed without rows have zeros, an empty audit and the
digest of the empty string; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorecard.llm.common import WHITE, prepare
from scorecard.llm.lr_repair import DOOMED, INSERT, SOUND, TOPS, TRUNCATED, Chain, Repair, edits_of, parse_block
from scorecard.operators.staging import stage

BLOCK_ROWS = 1 << 14
CLOSING = ".!?"
# Adjacent initials that may be.
LEGAL = ("su", "ua", "au")
LAST_PART = (1 << 31) - 1
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
BATCH_OUT = 512

BLOCKS = (
    "conv_id long, part int, block int, blank long, duplicate long, truncated long, illegal long, "
    "least long, greatest long, turns long, first string, last string, "
    "parses array<struct<top: int, state: int, cost: long, audit: string>>"
)
AUDITS = "conv_id long, part int, block int, audit string, " + ", ".join(f"{c} long" for c in COUNTS)
REPORT = "conv_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"
TURNS = "conv_id long, number long, role string, text string, edit string"


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows as a faulty export would leave them, by a checksum of conversation and turn."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    read = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        kind.alias("kind"),
    ).where("kind <> 0")
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return read.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit(""))
        .when(F.col("kind") == 2, F.translate("text", CLOSING, ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def _flagged(rows: DataFrame) -> DataFrame:
    """Rows in ranges, with what their fault depends on, written once."""
    body = F.rtrim(F.col("text"), F.lit(WHITE))
    bounded = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    read = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )
    flagged = read.select(
        "*",
        F.unhex(F.sha2(bounded.cast("binary"), 256)).alias("digest"),
        (body == "").alias("is_blank"),
        (~F.right(body, F.lit(1)).isin(*CLOSING)).alias("is_truncated"),
    )
    # Bounds come from a sample, so what they make is written before it is read twice.
    # Equal rows are as good as each other; numbers let them be in several ranges.
    numbered = flagged.withColumn("tie", F.monotonically_increasing_id())
    ranged = numbered.repartitionByRange("conv_id", "turn", "role", "digest", "tie").drop("tie")
    return stage(ranged.withColumn("part", F.spark_partition_id()), "turns")


def _order(*before: str) -> list[Column]:
    return [*map(F.col, before), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]


class _Block:
    """Rows of one conversation and range, up to a number."""

    def __init__(self, conv_id: int | None, part: int, number: int, before: _Block | None):
        self.key, self.number = (conv_id, part), number
        # Repeats go on from the block before; neighbours across blocks are counted later.
        self.seen: set[bytes] = before.seen if before else set()
        self.first = self.last = None
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.least = self.greatest = None
        self.rows: list[tuple[str, int]] = []

    def add(self, turn, role: str, digest: bytes, is_blank: bool, is_truncated: bool, is_later: bool) -> None:
        fault = SOUND
        if is_blank:
            fault, self.blank = DOOMED, self.blank + 1
        elif is_later or digest in self.seen:
            fault, self.duplicate = DOOMED, self.duplicate + 1
        elif is_truncated:
            fault, self.truncated = TRUNCATED, self.truncated + 1
        self.seen.add(digest)
        initial = role[:1]
        if self.first is None:
            self.first = initial
        elif self.last + initial not in LEGAL:
            self.illegal += 1
        self.last = initial
        if turn is not None:
            if turn != self.greatest:
                self.turns += 1
            self.least = turn if self.least is None else self.least
            self.greatest = turn
        self.rows.append((initial, fault))

    def row(self) -> tuple:
        parses = [
            {"top": top, "state": state, "cost": cost, "audit": audit}
            for top in TOPS
            for state, (cost, audit) in parse_block(top, self.rows).items()
        ]
        return (
            *self.key, self.number, self.blank, self.duplicate, self.truncated, self.illegal,
            self.least, self.greatest, self.turns, self.first, self.last, parses,
        )


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    waiting: list[tuple] = []
    size = 0
    for row in rows:
        waiting.append(row)
        size += sum(len(v) for v in row if isinstance(v, str))
        if len(waiting) >= BATCH_OUT or size > 16 << 20:
            yield _batch(waiting, schema)
            waiting, size = [], 0
    if waiting:
        yield _batch(waiting, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def _tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def _blocks(turns: DataFrame, block_rows: int) -> DataFrame:
    """Every block with its counts and its least parses from each top."""
    # Contents of a conversation that are in more than one range, and the first of these.
    first = turns.groupBy("conv_id", "digest").agg(F.min("part").alias("first_part"), F.max("part").alias("last_part"))
    first = first.where("first_part < last_part").select(
        F.col("conv_id").alias("c"), F.col("digest").alias("d"), "first_part"
    )
    narrow = turns.drop("text").join(
        first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")), "left"
    )
    ordered = (
        narrow.select(
            "conv_id", "part", "turn", "role", "digest", "is_blank", "is_truncated",
            F.coalesce(F.col("part") > F.col("first_part"), F.lit(False)).alias("is_later"),
        )
        .repartition("conv_id", "part")
        .sortWithinPartitions(*_order("conv_id", "part"))
    )
    schema = _arrow(BLOCKS)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        block = None
        for conv_id, part, *row in _tuples(batches):
            same = block is not None and block.key == (conv_id, part)
            if not same or len(block.rows) >= block_rows:
                if block is not None:
                    yield block.row()
                block = _next_block(block if same else None, conv_id, part)
            block.add(*row)
        if block is not None:
            yield block.row()

    return ordered.mapInArrow(lambda batches: _batches(rows(batches), schema), BLOCKS)


def _next_block(before: _Block | None, conv_id: int | None, part: int) -> _Block:
    return _Block(conv_id, part, before.number + 1 if before else 0, before)


def _chained(blocks: DataFrame) -> DataFrame:
    """The chosen audit of every block; counts stand in a last row of each conversation."""
    schema = _arrow(AUDITS)
    ordered = blocks.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")

    def ended(conv_id, places, chain, counts, turns, least, greatest) -> Iterator[tuple]:
        cost, audits = chain.end()
        for (part, block), audit in zip(places, audits, strict=False):
            yield (conv_id, part, block, audit, *[None] * len(COUNTS))
        gaps = 0 if least is None else greatest - least + 1 - turns
        yield (conv_id, LAST_PART, 0, audits[-1], gaps, *counts, cost)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        state = None
        for conv_id, part, block, *counts, least, greatest, turns, first, last, parses in _tuples(batches):
            if state is None or state[0] != conv_id:
                if state is not None:
                    yield from ended(*state)
                state, last_role = [conv_id, [], Chain(), [0] * 4, 0, None, None], None
            if last_role is not None and last_role + first not in LEGAL:
                state[3][3] += 1
            state[1].append((part, block))
            state[2].add(_by_top(parses))
            state[3] = [a + b for a, b in zip(state[3], counts, strict=True)]
            if least is not None:
                # A turn that two blocks share counts once.
                state[4] += turns - (state[6] is not None and state[6] == least)
                state[5] = least if state[5] is None else state[5]
                state[6] = greatest
            last_role = last
        if state is not None:
            yield from ended(*state)

    return ordered.mapInArrow(lambda batches: _batches(rows(batches), schema), AUDITS)


def _by_top(parses: list[dict]) -> dict[int, dict[int, tuple[int, str]]]:
    found: dict[int, dict[int, tuple[int, str]]] = {}
    for p in parses:
        found.setdefault(p["top"], {})[p["state"]] = (p["cost"], p["audit"])
    return found


class _Writer:
    """Repairs one conversation as its audits and turns come by."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.repair, self.edits = Repair(), iter(())
        self.audits: list[str] = []
        self.counts = [0] * len(COUNTS)
        self.hash, self.number = hashlib.sha256(), 0

    def audit(self, audit: str, counts: list) -> Iterator[tuple]:
        """Edits of the rows that follow; those of the last row end the conversation."""
        waiting = "".join(edit for n, edit in self.edits for edit in [INSERT * n + edit])
        self.audits.append(audit)
        self.edits = edits_of(waiting + audit)
        if counts[0] is not None:
            self.counts = counts
            for inserts, _ in self.edits:
                for _ in range(inserts):
                    yield self._turn(self.repair.turn(INSERT), "", INSERT)

    def row(self, role: str, text: str) -> Iterator[tuple]:
        inserts, edit = next(self.edits)
        for _ in range(inserts):
            yield self._turn(self.repair.turn(INSERT), "", INSERT)
        out = self.repair.turn(edit, role)
        if out is not None:
            yield self._turn(out, text, edit)

    def _turn(self, role: str, text: str, edit: str) -> tuple:
        line = f"{role}:{text}".encode("utf-8", "surrogatepass")
        self.hash.update(b"\n" + line if self.number else line)
        self.number += 1
        return (self.conv_id, self.number - 1, role, text, edit)

    def report(self) -> tuple:
        return (self.conv_id, *self.counts, "".join(self.audits), self.hash.hexdigest())


def _applied(turns: DataFrame, audits: DataFrame, listed: DataFrame, report: bool) -> DataFrame:
    """Turns next to their audits, in order: a report, or the repaired turns."""
    columns = [
        "conv_id", "part", "kind", "block", "turn", "role", "digest", "text", "audit", *COUNTS,
    ]
    marks = listed.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    frames = [
        marks.select("conv_id", F.lit(-1).alias("part"), F.lit(0).alias("kind")),
        audits.withColumn("kind", F.lit(1)),
        turns.select("conv_id", "part", F.lit(2).alias("kind"), "turn", "role", "digest", "text"),
    ]
    both = frames[0].unionByName(frames[1], True).unionByName(frames[2], True).select(columns)
    ordered = both.repartition("conv_id").sortWithinPartitions(
        F.col("conv_id"), F.col("part"), F.col("kind"), F.col("block"), *_order()
    )
    ordered = ordered.drop("part", "block", "turn", "digest")
    out = REPORT if report else TURNS
    schema = _arrow(out)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        writer = None
        for conv_id, kind, role, text, audit, *counts in _tuples(batches):
            if writer is None or writer.conv_id != conv_id:
                if writer is not None and report:
                    yield writer.report()
                writer = _Writer(conv_id)
            made = ()
            if kind == 1:
                made = writer.audit(audit, counts)
            elif kind == 2:
                made = writer.row(role, text)
            for row in made:
                if not report:
                    yield row
        if writer is not None and report:
            yield writer.report()

    return ordered.mapInArrow(lambda batches: _batches(rows(batches), schema), out)


def _repair(rows: DataFrame, listed: DataFrame | None, block_rows: int, report: bool) -> DataFrame:
    prepare(rows.sparkSession)
    turns = _flagged(rows)
    audits = stage(_chained(_blocks(turns, block_rows)), "audits")
    return _applied(turns, audits, turns if listed is None else listed, report)


def repair_report(rows: DataFrame, listed: DataFrame | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Faults, least cost, audit and digest of each conversation of ``rows``.

    ``listed`` names the conversations that get a row even without any of theirs.
    """
    return _repair(rows, listed, block_rows, True)


def repaired_turns(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The repaired conversations: conv_id, number, role, text and edit of each turn."""
    return _repair(rows, None, block_rows, False)
