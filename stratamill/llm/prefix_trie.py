"""Prefix trie of conversations, by ROLLUP over positional turn-id columns.

1. *Numbering*: turns are sorted by conversation and turn over range partitions, and a
   turn's place is its row number less its conversation's first. A conversation of any
   length is spread over tasks.
2. *Rebuilding*: the first h turns are those of the family's first conversation, then
   come the conversation's own turns after its first h.
3. *Blocks*: ``WIDTH`` turns at a time become the columns t0, t1, ... of a row, keyed by
   the node in which the block before ends. A turn's id is 128 bits of its place, role
   and text; the exclusive or of the ids on the way names a node. So the blocks of all
   conversations are keyed at once, by a running exclusive or.
4. *Counts*: equal rows are folded, then one ``ROLLUP`` over the columns gives all
   prefixes of all blocks; ``grouping_id`` tells their depth.
5. *Subtrees*: the same ``ROLLUP`` over the nodes sums leaves and saved tokens within a
   block. The sums of blocks that go on from a block's end are passed up beforehand by
   pointer doubling, in rounds that grow with the logarithm of the longest conversation.

What is shuffled are turn ids, never texts. A node that a third of all conversations
share is folded before each exchange. The ids of members that end in a node are joined
in runs, in parallel; its digest reads the runs as a stream, because SHA-256 has no
parallel form. Per task of the sort, one row count passes through the driver.

Defined cases: null roles and texts are empty. Null turns come first; turns of equal
number, or none, follow each other by the 64-bit hash of their role and text. Repeated
rows are turns of their own. Rows without a conv_id belong to no conversation. Very long
texts are hashed and counted whole. An empty table has no root and gives an empty
result. Extra columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratamill.llm.text import single_spaced, word_count
from stratamill.sinks.written import written_once

WIDTH = 8
FAMILY = 20
HEAD = 3
# Blocks of a conversation whose running names are computed by one task.
STRETCH = 4096
# Conversation ids that share all but so many bits are joined before they are sent on.
RUN_BITS = 9


def _node(a: Column, b: Column) -> Column:
    return F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))


def _xor(*values: Column) -> Column:
    return reduce(lambda x, y: x.bitwiseXOR(y), values)


def head_turns(conv: Column) -> Column:
    """How many turns a conversation takes from the first of its family."""
    return F.pmod(F.crc32(conv.cast("string")), F.lit(HEAD + 1)).cast("int")


def numbered_turns(df: DataFrame) -> DataFrame:
    """conv, place (from 0), a and b (128 bits of role and text), words."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = df.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        F.xxhash64(F.lit(3), role, text).alias("a"),
        F.xxhash64(F.lit(4), role, text).alias("b"),
        word_count(single_spaced(text)).alias("words"),
    )
    order = ["conv", F.col("turn").asc_nulls_first(), "a", "b"]
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    dealt = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = written_once(dealt.select("conv", "a", "b", "words", F.spark_partition_id().alias("task"), within.alias("at")))
    before, firsts = 0, []
    for task, n in sorted((r["task"], r["n"]) for r in dealt.groupBy("task").agg(F.count("*").alias("n")).collect()):
        firsts.append((task, before))
        before += n
    firsts = df.sparkSession.createDataFrame(firsts, "task int, before long")
    rows = dealt.join(F.broadcast(firsts), "task").withColumn("row", F.col("before") + F.col("at"))
    starts = rows.groupBy("conv").agg(F.min("row").alias("start"))
    return rows.join(starts, "conv").select("conv", (F.col("row") - F.col("start")).alias("place"), "a", "b", "words")


def rebuilt_turns(turns: DataFrame) -> DataFrame:
    """The turns of rebuilt conversations, as ``numbered_turns``; one without any has a row of nulls."""
    fields = ("place", "a", "b", "words")
    taken = turns.where((F.col("place") < HEAD) & (F.col("conv") % FAMILY == 0))
    heads = taken.groupBy(F.col("conv").alias("base")).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("head"))
    convs = turns.groupBy("conv").agg(F.count("*").alias("own"))
    convs = convs.withColumn("base", F.col("conv") - F.col("conv") % FAMILY).join(heads, "base", "left")
    h = head_turns(F.col("conv"))
    none = F.array().cast(heads.schema["head"].dataType)
    convs = written_once(convs.select("conv", "own", h.alias("h"), F.slice(F.coalesce("head", none), 1, h).alias("head")))
    first = convs.select("conv", F.explode_outer("head").alias("x"), (F.col("own") > F.col("h")).alias("goes_on"))
    first = first.where("x is not null or not goes_on").select("conv", *[F.col(f"x.{f}").alias(f) for f in fields])
    # Where the family's first conversation is shorter than that, the own turns move up.
    less = F.col("h") - F.size("head")
    moved = convs.select("conv", less.alias("less")).where("less > 0")
    rest = turns.where(F.col("place") >= h).join(moved, "conv", "left")
    place = F.col("place") - F.coalesce("less", F.lit(0))
    return first.unionByName(rest.select("conv", place.alias("place"), "a", "b", "words"))


def _running(df: DataFrame, group: list[str], order: str) -> DataFrame:
    """With before_a and before_b: the exclusive or of a and b over the group's earlier rows."""
    earlier = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumns({f"before_{x}": F.coalesce(F.bit_xor(x).over(earlier), F.lit(0)) for x in "ab"})


def turn_blocks(turns: DataFrame, width: int, stretch: int = STRETCH) -> DataFrame:
    """conv, at (the block, and the node before it), t0, t1, ..., end (the node behind it), last (no block follows)."""
    ids = [F.when(F.col("place").isNotNull(), F.xxhash64(F.lit(i), "place", "a", "b")) for i in (1, 2)]
    rows = turns.select("conv", "place", ids[0].alias("a"), ids[1].alias("b"), "words")
    rows = rows.withColumn("block", F.floor(F.coalesce("place", F.lit(0)) / width).cast("long"))
    parts = [
        F.max(F.when(F.col("place") == F.col("block") * width + i, F.col(x))).alias(f"{x}{i}")
        for i in range(width)
        for x in ("a", "b", "words")
    ]
    whole = [F.coalesce(F.bit_xor(x), F.lit(0)).alias(x) for x in "ab"]
    rows = rows.groupBy("conv", "block").agg(*parts, *whole)
    rows = rows.withColumn("stretch", F.floor(F.col("block") / stretch).cast("long"))
    turn = [F.when(F.col(f"a{i}").isNotNull(), F.struct(*[F.col(f"{x}{i}").alias(x) for x in ("a", "b", "words")])) for i in range(width)]
    rows = written_once(rows.select("conv", "block", "stretch", "a", "b", *[t.alias(f"t{i}") for i, t in enumerate(turn)]))
    # Running names within stretches of a conversation, then over its stretches.
    totals = rows.groupBy("conv", "stretch").agg(*[F.bit_xor(x).alias(x) for x in "ab"], F.max("block").alias("final"))
    totals = _running(totals, ["conv"], "stretch").withColumn("final", F.max("final").over(Window.partitionBy("conv")))
    totals = totals.select("conv", "stretch", "final", *[F.col(f"before_{x}").alias(f"stretch_{x}") for x in "ab"])
    named = _running(rows, ["conv", "stretch"], "block").join(totals, ["conv", "stretch"])
    before = {x: _xor(F.col(f"before_{x}"), F.col(f"stretch_{x}")) for x in "ab"}
    return named.select(
        "conv",
        F.struct("block", _node(before["a"], before["b"]).alias("node")).alias("at"),
        *[f"t{i}" for i in range(width)],
        _node(*[_xor(before[x], F.col(x)) for x in "ab"]).alias("end"),
        (F.col("block") == F.col("final")).alias("last"),
    )


def _rolled(df: DataFrame, width: int, **sums: Column) -> DataFrame:
    """``sums`` of all prefixes: at, t0, t1, ..., level (turns in it), node, and the sums.

    A group is a prefix only if its last column holds a turn: rows that end before it
    give groups of their own there. Without any turn, only the root is returned: other
    nodes in which a block begins are the last ones of the block before.
    """
    places = [F.col(f"t{i}") for i in range(width)]
    rolled = df.rollup("at", *[f"t{i}" for i in range(width)]).agg(
        F.grouping_id().alias("gid"), *[value.alias(name) for name, value in sums.items()]
    )
    level = F.lit(width) - F.bit_count("gid").cast("int")
    turns = sum((p.isNotNull().cast("int") for p in places), F.lit(0))
    rolled = rolled.withColumn("level", level).where((F.col("level") >= 0) & (F.col("level") == turns))
    rolled = rolled.where("level > 0 or at.block = 0")
    reached = [_xor(F.col(f"at.node.{x}"), *[F.coalesce(p[x], F.lit(0)) for p in places]) for x in "ab"]
    return rolled.withColumn("node", _node(*reached)).drop("gid")


def trie_nodes(blocks: DataFrame, width: int) -> DataFrame:
    """node, parent, at, t0, t1, ..., level, depth, conv (smallest member), n_convs, saving (its own)."""
    columns = [f"t{i}" for i in range(width)]
    folded = blocks.groupBy("at", *columns).agg(F.min("conv").alias("conv"), F.count("*").alias("copies"))
    nodes = _rolled(folded, width, conv=F.min("conv"), n_convs=F.sum("copies"))
    last = F.coalesce(*[F.col(c) for c in reversed(columns)])
    parent = F.when(F.col("level") > 0, _node(*[_xor(F.col(f"node.{x}"), last[x]) for x in "ab"]))
    saving = (F.col("n_convs") - 1) * F.coalesce(last["words"], F.lit(0))
    depth = F.col("at.block") * width + F.col("level")
    return nodes.withColumns({"parent": parent, "saving": saving, "depth": depth})


def _passed_up(nodes: DataFrame, measures: list[str], width: int) -> DataFrame:
    """node and, for nodes in which a block begins, the measures of all nodes behind it.

    Pointer doubling: after k rounds a row holds the sums of its next 2 ** k blocks.
    """
    sums = nodes.where("at.block > 0").groupBy("at.node").agg(*[F.sum(m).alias(m) for m in measures])
    above = nodes.where(f"level = {width}").select("node", F.when(F.col("at.block") > 0, F.col("at.node")).alias("up"))
    sums = written_once(sums.join(above, "node"))
    while not sums.where("up is not null").isEmpty():
        below = sums.where("up is not null")
        more = below.groupBy(F.col("up").alias("node")).agg(*[F.sum(m).alias(f"more_{m}") for m in measures])
        further = sums.select(F.col("node").alias("up"), F.col("up").alias("further"))
        jumped = below.select("node", "up").join(further.where("further is not null"), "up").select("node", "further")
        total = [(F.col(m) + F.coalesce(f"more_{m}", F.lit(0))).alias(m) for m in measures]
        sums = sums.join(more, "node", "left").join(jumped, "node", "left")
        sums = written_once(sums.select("node", *total, F.col("further").alias("up")))
    return sums.drop("up")


def end_digests(blocks: DataFrame, run_bits: int = RUN_BITS) -> DataFrame:
    """node, digest: SHA-256 of the ids of the conversations that end there, ascending, comma-joined."""
    ended = blocks.where("last").select(F.col("end").alias("node"), "conv")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    runs = ended.groupBy("node", F.shiftright("conv", run_bits).alias("run")).agg(joined.alias("ids"))
    runs = runs.repartition("node").sortWithinPartitions("node", "run").select("node.a", "node.b", "ids")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for a, b, ids in zip(*(batch.column(i) for i in range(3)), strict=True):
                key = (a.as_py(), b.as_py())
                if key != node:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.as_py().encode())
            yield _digests(done)
        if node is not None:
            yield _digests([(*node, state.hexdigest())])

    found = runs.mapInArrow(digest, "a long, b long, digest string")
    return found.select(_node(F.col("a"), F.col("b")).alias("node"), "digest")


def _digests(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string())
    columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, names=["a", "b", "digest"])


def prefix_trie(df: DataFrame, width: int = WIDTH, stretch: int = STRETCH, run_bits: int = RUN_BITS) -> DataFrame:
    """A row per node of the trie over rebuilt conversations.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. ``df`` has conv_id, turn, role and text.
    """
    turns = written_once(numbered_turns(df))
    blocks = written_once(turn_blocks(rebuilt_turns(turns), width, stretch))
    nodes = trie_nodes(blocks, width)
    nodes = written_once(nodes)
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = written_once(nodes.withColumn("leaf", F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.lit(0)).cast("long")))
    measures = ["leaf", "saving"]
    behind = _passed_up(nodes, measures, width).withColumnsRenamed({m: f"behind_{m}" for m in measures})
    summed = nodes.join(behind, "node", "left")
    summed = summed.withColumns({m: F.col(m) + F.coalesce(f"behind_{m}", F.lit(0)) for m in measures})
    subtrees = _rolled(summed, width, n_leaves=F.sum("leaf"), saved=F.sum("saving")).select("node", "n_leaves", "saved")
    ends = end_digests(blocks, run_bits)
    found = nodes.join(subtrees, "node").join(ends, "node", "left")
    found = found.select("node", "parent", "conv", "depth", "n_convs", "n_children", "n_leaves", "saved", "digest")
    found = written_once(found)
    # The root may have a third of all nodes below it; they need no join.
    root = nodes.where("depth = 0").select("conv").first()
    top = F.when(F.col("depth") == 1, F.lit(root["conv"] if root else None).cast("long"))
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv"))
    deep = found.where("depth > 1").join(parents, "parent")
    every = deep.unionByName(found.where("depth <= 1").withColumn("parent_conv", top))
    return every.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent_conv").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.coalesce("digest", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
