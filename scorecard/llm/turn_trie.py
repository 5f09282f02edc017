"""The prefix trie of conversations, through adaptive radix trees.

A turn (role and text) becomes a fixed-width id, the first 16 bytes of a SHA-256
digest, and a conversation the ids of its turns put end to end. Keys are cut into
pages of ``page_turns`` turns; a page is named by a checksum of all pages before it,
so pages of equal beginnings meet. Pages are range-partitioned by their keys, and a
task builds radix trees (``radix``) over some of its rows at a time.

Most turn nodes are wholly inside one such tree and come out finished. A node on the
path of the first or last key of a tree may go on in the tree before or after: it
comes out in part, and the parts are added up by its key. There are at most two such
paths a tree, so this table is small, and a beginning that a third of all
conversations share costs a row for each tree. Pages after the first are added to
the nodes above them by running sums along conversations, not level by level.

Positions within a conversation are counted within ranges of it and added up, so a
very long conversation is in many tasks. The digest of the conversations that end
with a node is of one stream by its nature: a node that has more than one tree can
hold gets it from joined lists of ids, sorted, one after the other.

Defined results: null roles and texts are empty; rows without conv_id belong to no
conversation; turns are in order, nulls first, ties by their ids, and rows that agree
are turns each; a conversation without turns is a member of the root; long texts
count with all their bytes; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorecard.llm.common import prepare
from scorecard.llm.radix import Held, Tree, digest_of, turns
from scorecard.operators.staging import stage

ID_BYTES = 16
PAGE_TURNS = 64
# Rows, and bytes of keys, of one radix tree.
TREE_ROWS = 20_000
TREE_BYTES = 16 << 20
# Copies of the small side of a join on keys that very many nodes share.
SALTS = 16
HEAD_TURNS = 9
GROUP = 5

NODES = pa.schema(
    [
        ("page", pa.int64()), ("x1", pa.int64()), ("x2", pa.int64()), ("key", pa.binary()),
        ("is_open", pa.bool_()), ("level", pa.int64()), ("turn_id", pa.string()), ("size", pa.int64()),
        ("n_convs", pa.int64()), ("conv_id", pa.int64()), ("n_children", pa.int64()),
        ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("parent_conv_id", pa.int64()),
        ("parent_key", pa.binary()), ("ends_sha256", pa.string()), ("first_end", pa.int64()),
        ("ends", pa.string()), ("next1", pa.int64()), ("next2", pa.int64()),
    ]
)
NODES_DDL = (
    "page long, x1 long, x2 long, key binary, is_open boolean, level long, turn_id string, size long, "
    "n_convs long, conv_id long, n_children long, n_leaves long, saved_tokens long, parent_conv_id long, "
    "parent_key binary, ends_sha256 string, first_end long, ends string, next1 long, next2 long"
)
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def coded(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), id (hexadecimal) and size (bytes of text) of every turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    bounded = F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    narrow = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.substring(F.sha2(bounded, 256), 1, 2 * ID_BYTES).alias("id"),
        F.octet_length(text).cast("long").alias("size"),
    )
    # Equal turns are as good as each other; numbers let them be in several ranges.
    ranged = narrow.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(
        "conv_id", "turn", "id", "tie"
    )
    rows = stage(ranged.drop("tie").withColumn("part", F.spark_partition_id()), "coded-turns")
    inside = Window.partitionBy("conv_id", "part").orderBy(F.col("turn").asc_nulls_first(), "id")
    # One row for each conversation and range.
    along = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    later = counts.select("conv_id", "part", F.sum("n").over(along).alias("before")).where("before > 0")
    placed = rows.withColumn("at", F.row_number().over(inside)).join(later, ["conv_id", "part"], "left")
    return placed.select("conv_id", (F.col("at") + F.coalesce("before", F.lit(0))).alias("pos"), "id", "size")


def listed(conversations: DataFrame) -> DataFrame:
    return (
        conversations.where(F.col("conv_id").isNotNull())
        .select(F.col("conv_id").cast("long").alias("conv_id"))
        .distinct()
    )


def rebuilt(turns_of: DataFrame, conv_ids: DataFrame) -> DataFrame:
    """Coded turns of conversations that begin like the first one of their group of five.

    Conversation c takes the first h turns of conversation c - c % 5, then its own
    after its first h; h is a checksum of c. At most eight turns are ever taken.
    """
    conv = F.col("conv_id")
    plan = conv_ids.select(
        "conv_id",
        (F.crc32(conv.cast("string").cast("binary")) % HEAD_TURNS).cast("int").alias("h"),
        (conv - conv % GROUP).alias("base"),
    )
    heads = (
        turns_of.where((conv % GROUP == 0) & (F.col("pos") < HEAD_TURNS))
        .groupBy(conv.alias("base"))
        .agg(F.array_sort(F.collect_list(F.struct("pos", "id", "size"))).alias("head"))
    )
    none = F.array().cast("array<struct<pos: long, id: string, size: long>>")
    planned = plan.join(heads, "base", "left").select(
        "conv_id", "h", F.when(F.col("h") > 0, F.slice(F.coalesce("head", none), 1, F.col("h"))).otherwise(none).alias("head")
    )
    taken = planned.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.*")
    own = turns_of.join(planned.select("conv_id", "h", F.size("head").alias("m")), "conv_id").where("pos > h")
    return taken.unionByName(own.select("conv_id", (F.col("pos") - F.col("h") + F.col("m")).alias("pos"), "id", "size"))


def _pages(turns_of: DataFrame, conv_ids: DataFrame, page_turns: int) -> DataFrame:
    """Every page of every conversation: its key, and checksums of what is before it."""
    marks = conv_ids.select("conv_id", F.lit(0).cast("long").alias("page"))
    rows = turns_of.withColumn("page", F.floor((F.col("pos") - 1) / page_turns).cast("long"))
    turn = F.when(F.col("pos").isNotNull(), F.struct("pos", "id", "size"))
    pages = (
        rows.unionByName(marks, True)
        .groupBy("conv_id", "page")
        .agg(F.array_sort(F.collect_list(turn)).alias("turns"))  # at most page_turns
    )
    named = pages.select(
        "conv_id", "page", F.array_join("turns.id", "").alias("hexadecimal"), F.col("turns.size").alias("sizes")
    ).withColumn("sum", F.sha2(F.concat(F.col("page").cast("string"), F.lit(":"), F.col("hexadecimal")).cast("binary"), 256))
    number = lambda first: F.conv(F.substring("sum", first, 16), 16, -10).cast("long")
    along = Window.partitionBy("conv_id").orderBy("page")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    summed = named.withColumns({"s1": number(1), "s2": number(17)}).withColumns(
        {
            "x1": F.coalesce(F.bit_xor("s1").over(before), F.lit(0)),
            "x2": F.coalesce(F.bit_xor("s2").over(before), F.lit(0)),
            "ends": F.lead("page").over(along).isNull(),
        }
    )
    return summed.select(
        "page", "x1", "x2", F.unhex("hexadecimal").alias("key"), "conv_id", "sizes", "ends",
        F.col("x1").bitwiseXOR(F.col("s1")).alias("next1"), F.col("x2").bitwiseXOR(F.col("s2")).alias("next2"),
    )


def _tree_rows(rows: list[tuple]) -> Iterator[tuple]:
    """Turn nodes of the rows of one tree each for all their pages; rows are sorted."""
    start = 0
    while start < len(rows):
        page = rows[start][:3]
        end = start
        tree, sizes, last = Tree(), {}, None
        while end < len(rows) and rows[end][:3] == page:
            key, conv_id, lengths, ends, next1, next2 = rows[end][3:]
            if last is None or key != last:
                node, last = tree.insert(key), key
                for n, length in enumerate(lengths):
                    sizes[key[n * ID_BYTES : (n + 1) * ID_BYTES]] = length
            if node.held is None:
                node.held = Held()
            node.held.add(conv_id, ends, (next1, next2))
            end += 1
        open_keys = [rows[start][3]] * (start == 0) + [rows[end - 1][3]] * (end == len(rows))
        for t in turns(tree, ID_BYTES, sizes, open_keys):
            ends = t.held.ends if t.held else []
            onward = t.held.onward if t.held and t.held.onward else (None, None)
            yield (
                *page, t.key, t.is_open, t.depth, t.turn_id.hex(), t.size, t.members, t.least, t.children,
                t.leaves, t.saved, t.parent, t.parent_key,
                None if t.is_open else digest_of(ends), ends[0] if t.is_open and ends else None,
                ",".join(map(str, ends)) if t.is_open and ends else None, *onward,
            )
        start = end


def _nodes(pages: DataFrame, tree_rows: int) -> DataFrame:
    order = ["page", "x1", "x2", "key", "conv_id"]
    ordered = pages.repartitionByRange(*order).sortWithinPartitions(*order)

    def out(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        for row in _tree_rows(rows):
            made.append(row)
            if len(made) == tree_rows:
                yield _batch(made)
                made = []
        if made:
            yield _batch(made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                rows.append(row)
                held += len(row[3])
                if len(rows) >= tree_rows or held > TREE_BYTES:
                    yield from out(rows)
                    rows, held = [], 0
        yield from out(rows)

    columns = ["page", "x1", "x2", "key", "conv_id", "sizes", "ends", "next1", "next2"]
    return stage(ordered.select(columns).mapInArrow(run, NODES_DDL), "trie-nodes")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), NODES, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=NODES)


PLACE = ["page", "x1", "x2"]


def _ends_of_open(parts: DataFrame) -> DataFrame:
    """Digests of open nodes: their lists of ids, sorted, in one stream a node."""
    lists = parts.where(F.col("ends").isNotNull()).select(*PLACE, "key", "first_end", "ends")
    ordered = lists.repartition(*PLACE, "key").sortWithinPartitions(*PLACE, "key", "first_end")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None

        def done() -> pa.RecordBatch:
            columns = [*[[v] for v in node], [digest.hexdigest()]]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[*PLACE, "key", "open_sha"]
            )

        for batch in batches:
            for *place, _, ends in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if place != node:
                    if node is not None:
                        yield done()
                    node, digest = place, hashlib.sha256(ends.encode())
                else:
                    digest.update(b"," + ends.encode())
        if node is not None:
            yield done()

    return ordered.mapInArrow(run, "page long, x1 long, x2 long, key binary, open_sha string")


def _beginnings(key: str = "key") -> Column:
    """A key's own beginnings at whole ids, itself included."""
    steps = F.sequence(F.lit(0), (F.octet_length(key) / ID_BYTES).cast("int"))
    return F.transform(steps, lambda n: F.substring(F.col(key), F.lit(1), n * ID_BYTES))


def _merged(nodes: DataFrame) -> DataFrame:
    """Open nodes from their parts, with the sums of the open nodes below them."""
    parts = nodes.where("is_open")
    whole = parts.groupBy(*PLACE, "key").agg(
        F.first("level").alias("level"),
        F.first("turn_id").alias("turn_id"),
        F.first("size").alias("size"),
        F.sum("n_convs").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.sum("n_children").alias("closed_children"),
        F.sum("n_leaves").alias("leaves"),
        F.sum("saved_tokens").alias("saved"),
        F.max("next1").alias("next1"),
        F.max("next2").alias("next2"),
    )
    whole = stage(whole, "open-nodes").join(_ends_of_open(parts), [*PLACE, "key"], "left")
    above = F.substring(F.col("key"), F.lit(1), F.octet_length("key") - ID_BYTES)
    below = whole.where("level > 0").groupBy(*PLACE, above.alias("key")).agg(F.count(F.lit(1)).alias("open_children"))
    counted = whole.join(below, [*PLACE, "key"], "left").withColumn(
        "n_children", F.col("closed_children") + F.coalesce("open_children", F.lit(0))
    )
    is_leaf = (F.col("n_children") == 0) & F.col("next1").isNull()
    own = counted.withColumns(
        {
            "leaves": F.col("leaves") + is_leaf.cast("long"),
            "saved": F.col("saved") + (F.col("n_convs") - 1) * F.col("size"),
        }
    )
    own = stage(own, "open-nodes")
    sums = (
        own.select(*PLACE, F.explode(_beginnings()).alias("key"), "leaves", "saved")
        .groupBy(*PLACE, "key")
        .agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    )
    parents = own.select(*PLACE, F.col("key").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    named = own.withColumn("above", F.when(F.col("level") > 0, above))
    return (
        named.join(sums, [*PLACE, "key"])
        .join(parents, [*PLACE, "above"], "left")
        .select(
            *PLACE, "key", "level", "turn_id", "n_convs", "conv_id", "n_children", "n_leaves", "saved_tokens",
            "parent_conv_id", F.coalesce("open_sha", F.lit(EMPTY_SHA)).alias("ends_sha256"), "next1", "next2",
        )
    )


def _with_later_pages(nodes: DataFrame, pages: DataFrame) -> DataFrame:
    """Adds what later pages hold to the nodes before them."""
    roots = nodes.where("page > 0 AND level = 0")
    # A page belongs to its least conversation; sums run up that one's pages, and a
    # page has those of all conversations that pass through it.
    owned = roots.select(*PLACE, "conv_id", F.col("n_leaves").alias("l"), F.col("saved_tokens").alias("s"))
    passing = pages.where("page > 0").select(*PLACE, "conv_id").join(owned, [*PLACE, "conv_id"], "left")
    up = Window.partitionBy("conv_id").orderBy(F.desc("page")).rowsBetween(Window.unboundedPreceding, 0)
    run = lambda c: F.sum(F.coalesce(c, F.lit(0))).over(up)
    below = (
        passing.withColumns({"l": run("l"), "s": run("s")})
        .groupBy(*PLACE)
        .agg(F.sum("l").alias("l"), F.sum("s").alias("s"))
    )
    first = roots.select(*PLACE, "n_children").join(below, PLACE)
    first = first.select(
        (F.col("page") - 1).alias("page"), F.col("x1").alias("next1"), F.col("x2").alias("next2"),
        F.col("n_children").alias("c"), "l", "s",
    )
    boundary = nodes.where(F.col("next1").isNotNull()).select(*PLACE, "key", "next1", "next2")
    met = stage(boundary.join(first, ["page", "next1", "next2"]), "later-pages")
    more = (
        met.withColumn("whole", F.col("key"))
        .select(*PLACE, "whole", "c", "l", "s", F.explode(_beginnings()).alias("key"))
        .groupBy(*PLACE, "key")
        .agg(
            F.sum(F.when(F.col("whole") == F.col("key"), F.col("c")).otherwise(0)).alias("c"),
            F.sum("l").alias("l"),
            F.sum("s").alias("s"),
        )
    )
    zero = lambda c: F.coalesce(c, F.lit(0))
    joined = nodes.where(F.col("key").isNotNull()).join(more, [*PLACE, "key"], "left")
    added = joined.drop("next1", "next2").withColumns(
        {
            "n_children": F.col("n_children") + zero("c"),
            "n_leaves": F.col("n_leaves") + zero("l"),
            "saved_tokens": F.col("saved_tokens") + zero("s"),
        }
    )
    every = added.drop("c", "l", "s").unionByName(nodes.where(F.col("key").isNull()).drop("next1", "next2"))
    # The node above a later page has members that end there, which the page has not.
    top = (F.col("page") > 0) & (F.col("level") == 1)
    parents = nodes.where(F.col("next1").isNotNull()).select(
        (F.col("page") + 1).alias("page"), F.col("next1").alias("x1"), F.col("next2").alias("x2"),
        F.col("conv_id").alias("above"),
    )
    tops = every.where(top).join(parents, PLACE).withColumn("parent_conv_id", F.col("above")).drop("above")
    return every.where(~top).unionByName(tops)


def trie(
    turns_of: DataFrame, conv_ids: DataFrame, page_turns: int = PAGE_TURNS, tree_rows: int = TREE_ROWS
) -> DataFrame:
    """One row for each node: conv_id (least member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256, turn_id (of its last turn)."""
    pages = stage(_pages(turns_of, conv_ids, page_turns), "pages")
    nodes = _nodes(pages, tree_rows)
    whole = stage(_merged(nodes), "open-nodes")
    closed = nodes.where("NOT is_open").select(*whole.columns, "parent_key", "ends")
    # A node that closes under an open one has its parent there; very many may share one.
    parent = whole.select(
        *PLACE, F.col("key").alias("parent_key"), F.col("conv_id").alias("open_parent"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
    )
    salted = closed.where(F.col("parent_key").isNotNull()).withColumn(
        "salt", F.pmod(F.xxhash64("conv_id", "level"), F.lit(SALTS)).cast("int")
    )
    found = salted.join(parent, [*PLACE, "parent_key", "salt"]).withColumn("parent_conv_id", F.col("open_parent"))
    every = whole.unionByName(found.select(whole.columns)).unionByName(
        closed.where(F.col("parent_key").isNull()).select(whole.columns)
    )
    if not pages.where("page > 0").isEmpty():
        every = _with_later_pages(stage(every, "nodes"), pages)
    return every.where("page = 0 OR level > 0").select(
        "conv_id",
        (F.col("page") * page_turns + F.col("level")).alias("depth"),
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        "ends_sha256",
        "turn_id",
    )


def prefix_trie(conversations: DataFrame, page_turns: int = PAGE_TURNS, tree_rows: int = TREE_ROWS) -> DataFrame:
    """The trie of a table of conversations as they are."""
    prepare(conversations.sparkSession)
    return trie(coded(conversations), listed(conversations), page_turns, tree_rows)


def rebuilt_trie(conversations: DataFrame, page_turns: int = PAGE_TURNS, tree_rows: int = TREE_ROWS) -> DataFrame:
    """The trie of conversations rebuilt by groups of five (``rebuilt``)."""
    prepare(conversations.sparkSession)
    conv_ids = listed(conversations)
    rows = stage(coded(conversations), "turn-positions")
    return trie(rebuilt(rows, conv_ids), conv_ids, page_turns, tree_rows)
