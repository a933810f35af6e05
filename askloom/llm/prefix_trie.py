"""Trie of conversation prefixes by ROLLUP over positional turn columns.

A turn is told by the SHA-256 of its role and text.  A conversation is cut into blocks of ``WIDTH``
turns, one row per block with the turns in columns t1, t2, ...  ``GROUP BY ROLLUP (t1, t2, ...)``
aggregates all prefixes that end in a block at once, and ``grouping_id`` tells how long each
is.  A long conversation goes on in further blocks, which are grouped by the node that the block
before ends in, so that no row is wider and no group larger for it.

That node is named by the sums, over the turns up to it, of two hashes of turn and depth.  Sums run
in parallel: the blocks of a very long conversation need not wait for each other.

Sums over a subtree are rollups as well.  Each node counts with its smallest member, and with
no other; so what lies below a node is what its members count at its depth and deeper, a sum from
the end of each conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from askloom.llm.frames import written
from askloom.llm.mixing import word_count
from askloom.operators.windows import GROUP, running_sums

WIDTH = 8
#: A conversation takes the first turns of the one whose id is the next lower multiple of ``STRIDE``.
STRIDE, MOST_SHARED = 20, 4
#: Bytes of ids that are hashed in one piece.
PIECE = 1 << 20


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by conversation: each row's place in its conversation, counted from the start of the task."""
    last, held = None, 0
    for batch in batches:
        conv = batch.column(0).to_numpy()
        if not len(conv):
            continue
        new = np.ones(len(conv), bool)
        new[1:] = conv[1:] != conv[:-1]
        first = np.flatnonzero(new)
        place = np.arange(len(conv)) - np.repeat(first, np.diff(np.append(first, len(conv)))) + 1
        if conv[0] == last:
            run = first[1] if len(first) > 1 else len(conv)
            place[:run] += held
        last, held = conv[-1], int(place[-1])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(place, pa.int64()), *batch.columns[1:]], ["conv_id", "place", *batch.schema.names[1:]])


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place from 1, turn_key, words) of ``conversations``, by turn, null first; ties by role and text.

    Rows are sorted over tasks, so a very long conversation lies in several; a conversation's rows in
    the tasks before are added to its places.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"), text.alias("text"))
    ordered = rows.orderBy("conv_id", F.col("turn").asc_nulls_first(), "role", "text").select(
        "conv_id", F.spark_partition_id().alias("task"),
        F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("turn_key"),
        word_count(F.col("text")).alias("words"))
    placed = written(ordered.mapInArrow(_places, "conv_id long, place long, task int, turn_key binary, words long"), "turns")
    # One row per conversation and task; a conversation lies in several only if it crosses a border.
    held = placed.groupBy("conv_id", "task").agg(F.max("place").alias("n"))
    crossing = held.groupBy("conv_id").agg(F.count(F.lit(1)).alias("tasks")).where("tasks > 1").select("conv_id")
    before = Window.partitionBy("conv_id").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    carried = held.join(crossing, "conv_id").select("conv_id", "task", F.sum("n").over(before).alias("carried")).where("carried > 0")
    # At most one conversation goes on from one task to the next.
    return placed.join(F.broadcast(carried), ["conv_id", "task"], "left").select(
        "conv_id", (F.col("place") + F.coalesce("carried", F.lit(0))).alias("place"), "turn_key", "words")


def _shared(conv: Column) -> Column:
    return F.crc32(conv.cast("string")) % MOST_SHARED


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, n turns) and their rebuilt turns (conv_id, depth from 1, turn_key, words).

    A conversation c begins with the first h turns of c - c % ``STRIDE`` and goes on with its own turns
    after its first h, where h = crc32(c) % ``MOST_SHARED``.  The remainder of a negative id is
    negative, as in SQL.
    """
    base = F.col("conv_id") - F.col("conv_id") % STRIDE
    convs = written(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own")).withColumn("base", base).withColumn(
        "h", F.when(F.col("base") == F.col("conv_id"), 0).otherwise(_shared(F.col("conv_id")))), "conversations")
    lengths = convs.select(F.col("conv_id").alias("base"), F.col("own").alias("base_n"))
    convs = written(convs.join(lengths, "base", "left").withColumn(
        "taken", F.least("h", F.coalesce("base_n", F.lit(0)))).select("conv_id", "own", "base", "h", "taken"), "shares")
    heads = turns.where(F.col("place") < MOST_SHARED).select(F.col("conv_id").alias("base"), "place", "turn_key", "words")
    borrowed = convs.where("taken > 0").select("conv_id", "base", "taken").join(heads, "base").where("place <= taken").select(
        "conv_id", F.col("place").alias("depth"), "turn_key", "words")
    # What a conversation finds less than h turns for moves up; few do.
    moved = convs.where("taken < h").select("conv_id", (F.col("h") - F.col("taken")).alias("up"))
    h = F.when(base == F.col("conv_id"), 0).otherwise(_shared(F.col("conv_id")))
    own = turns.where(F.col("place") > h).join(moved, "conv_id", "left").select(
        "conv_id", (F.col("place") - F.coalesce("up", F.lit(0))).alias("depth"), "turn_key", "words")
    return convs.select("conv_id", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n")), \
        borrowed.unionByName(own)


def _columns(name: str) -> list[str]:
    return [f"{name}{i}" for i in range(1, WIDTH + 1)]


def _hashed(key: Column, depth: Column, seed: int) -> Column:
    return F.xxhash64(key, depth.cast("long"), F.lit(seed)).cast("decimal(20,0)")


def conversation_blocks(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per conversation and block: conv_id, b, p1, p2 (the node before), t1.., w1.. (turn, words).

    A conversation without turns has a row without any.
    """
    at = F.col("depth") - 1
    sums = [F.sum(_hashed(F.col("turn_key"), F.col("depth"), k)).cast("decimal(38,0)").alias(f"x{k}") for k in (1, 2)]

    def cell(name: str, i: int) -> Column:
        return F.max(F.when(at % WIDTH == i, F.col(name)))

    blocks = turns.withColumn("b", F.floor(at / WIDTH)).groupBy("conv_id", "b").agg(
        *sums, *[cell("turn_key", i).alias(c) for i, c in enumerate(_columns("t"))],
        *[cell("words", i).alias(c) for i, c in enumerate(_columns("w"))])
    zero = F.lit(0).cast("decimal(38,0)")
    empty = convs.where("n = 0").select("conv_id", F.lit(0).cast("long").alias("b"), zero.alias("x1"), zero.alias("x2"))
    blocks = written(blocks.unionByName(empty, allowMissingColumns=True), "blocks")
    summed = running_sums(blocks, ["conv_id"], "b", {"s1": F.col("x1"), "s2": F.col("x2")}, GROUP)
    return written(summed.select("conv_id", "b", (F.col("s1") - F.col("x1")).cast("decimal(38,0)").alias("p1"),
                                 (F.col("s2") - F.col("x2")).cast("decimal(38,0)").alias("p2"),
                                 *_columns("t"), *_columns("w")), "placed_blocks")


def _rollup(rows: DataFrame, aggregates: str) -> DataFrame:
    """Aggregates of all prefixes, with ``level``: how many turns of the block the prefix has."""
    t = ", ".join(_columns("t"))
    level = f"CAST({WIDTH} - bit_count(grouping_id()) AS INT)"
    rolled = rows.sparkSession.sql(
        f"SELECT b, p1, p2, {t}, {level} AS level, {aggregates} FROM {{rows}} GROUP BY b, p1, p2, ROLLUP({t})", rows=rows)
    # A conversation that ends before a level has no turn there; the prefix without any is the root.
    last = F.coalesce(*[F.when(F.col("level") == i, F.col(c).isNotNull()) for i, c in enumerate(_columns("t"), 1)],
                      F.col("b") == 0)
    return rolled.where(last)


def _at_level(name: str) -> Column:
    return F.coalesce(*[F.when(F.col("level") == i, F.col(c)) for i, c in enumerate(_columns(name), 1)], F.lit(0)).cast("long")


def prefix_nodes(blocks: DataFrame) -> DataFrame:
    """One row per node: depth, conv_id (smallest member), n_convs, words, d1, d2 (its name), e1, e2 (its parent's)."""
    most = ", ".join(f"max({c}) AS {c}" for c in _columns("w"))
    rolled = _rollup(blocks, f"min(conv_id) AS conv_id, count(*) AS n_convs, {most}")
    first = F.col("b") * WIDTH

    def name(k: int, upto: Column) -> Column:
        parts = [F.when(F.lit(i) <= upto, _hashed(F.col(c), first + i, k)).otherwise(F.lit(0).cast("decimal(20,0)"))
                 for i, c in enumerate(_columns("t"), 1)]
        total = F.col(f"p{k}")
        for p in parts:
            total = (total + p).cast("decimal(38,0)")
        return total

    level = F.col("level")
    return written(rolled.select(
        (first + level).cast("long").alias("depth"), "conv_id", "n_convs", _at_level("w").alias("words"),
        name(1, level).alias("d1"), name(2, level).alias("d2"), name(1, level - 1).alias("e1"), name(2, level - 1).alias("e2")), "nodes")


def _subtree_sums(blocks: DataFrame, nodes: DataFrame) -> DataFrame:
    """(conv_id, depth, saved_tokens, n_leaves) of every node, from its own ``saved`` and ``leaf``."""
    at = F.col("depth") - 1

    def cell(name: str, i: int) -> Column:
        return F.sum(F.when(at % WIDTH == i, F.col(name)))

    # The root has no turn; it is added at the end.
    own = nodes.where("depth > 0").groupBy("conv_id", F.floor(at / WIDTH).alias("b")).agg(
        *[cell("saved", i).alias(c) for i, c in enumerate(_columns("s"))],
        *[cell("leaf", i).alias(c) for i, c in enumerate(_columns("l"))])
    rows = blocks.select("conv_id", "b", "p1", "p2", *_columns("t")).join(own, ["conv_id", "b"], "left").fillna(
        0, [*_columns("s"), *_columns("l")])

    def block_sum(name: str) -> Column:
        total = F.lit(0).cast("long")
        for c in _columns(name):
            total = total + F.col(c)
        return total

    rows = rows.withColumn("from_end", -F.col("b"))
    rows = running_sums(rows, ["conv_id"], "from_end", {"s_on": block_sum("s"), "l_on": block_sum("l")}, GROUP)
    sums = ", ".join(f"sum({c}) AS {c}" for c in [*_columns("s"), *_columns("l")])
    rolled = _rollup(rows, f"min(conv_id) AS conv_id, {sums}, sum(s_on) AS s_on, sum(l_on) AS l_on")

    def below(name: str) -> Column:
        """What the members have from the level on: all of the block and after, less the levels before."""
        total = F.col(f"{name}_on")
        for i, c in enumerate(_columns(name), 1):
            total = total - F.when(F.col("level") > i, F.col(c)).otherwise(0)
        return total.cast("long")

    return rolled.select("conv_id", (F.col("b") * WIDTH + F.col("level")).cast("long").alias("depth"),
                         below("s").alias("saved_tokens"), below("l").alias("n_leaves"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (d1, d2, depth, conv_id) in order: ids of a node joined by commas, in pieces."""

    def piece(key: tuple, ids: list[int]) -> tuple:
        return *key, ids[0], ",".join(map(str, ids))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.decimal128(38, 0), pa.decimal128(38, 0), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["d1", "d2", "depth", "conv_id", "ids"])

    key, ids, room = None, [], 0
    for batch in batches:
        rows = []
        for d1, d2, depth, conv in zip(*(c.to_pylist() for c in batch.columns)):
            if ids and ((d1, d2, depth) != key or room > PIECE):
                rows.append(piece(key, ids))
                ids, room = [], 0
            key = (d1, d2, depth)
            ids.append(conv)
            room += 20
        if rows:
            yield batch_of(rows)
    if ids:
        yield batch_of([piece(key, ids)])


def _hashed_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From pieces in order: (d1, d2, depth, SHA-256 of all ids of the node)."""
    key, state = None, None
    for batch in batches:
        done = []
        for d1, d2, depth, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2, 4))):
            if (d1, d2, depth) == key:
                state.update(b",")
            else:
                if key:
                    done.append((*key, state.hexdigest()))
                key, state = (d1, d2, depth), hashlib.sha256()
            state.update(ids.encode())
        yield _ends_batch(done)
    if key:
        yield _ends_batch([(*key, state.hexdigest())])


def _ends_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.decimal128(38, 0), pa.decimal128(38, 0), pa.int64(), pa.string()]
    columns = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["d1", "d2", "depth", "ends_sha256"])


def conversation_ends(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """(d1, d2, depth, ends_sha256): hash of the ids of the conversations that end in a node, ascending.

    Ids are sorted over all tasks and joined into long pieces there; only the pieces of a node
    meet, one after another, in the one task that hashes them.
    """
    zero = F.lit(0).cast("decimal(38,0)")
    named = turns.groupBy("conv_id").agg(
        *[F.sum(_hashed(F.col("turn_key"), F.col("depth"), k)).cast("decimal(38,0)").alias(f"d{k}") for k in (1, 2)],
        F.count(F.lit(1)).alias("depth"))
    ends = named.select("d1", "d2", "depth", "conv_id").unionByName(
        convs.where("n = 0").select(zero.alias("d1"), zero.alias("d2"), F.lit(0).cast("long").alias("depth"), "conv_id"))
    kind = "d1 decimal(38,0), d2 decimal(38,0), depth long"
    # The pieces are written: another run of the sort could cut them elsewhere.
    pieces = written(ends.orderBy("d1", "d2", "depth", "conv_id").mapInArrow(_pieces, f"{kind}, conv_id long, ids string"), "pieces")
    return pieces.repartition("d1", "d2", "depth").sortWithinPartitions("d1", "d2", "depth", "conv_id").mapInArrow(
        _hashed_pieces, f"{kind}, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of rebuilt conversations of ``conversations`` (conv_id, turn, role, text).

    Returns one row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256; see ``rebuilt`` for the conversations.  Turns come in order of
    ``turn``, null first, ties by role and text; a null role or text is empty.  Repeated rows are
    turns of their own.  Rows with a null conv_id belong to no conversation and are not read.  A
    conversation that is left without turns is a member of the root.  An empty table has no
    conversations and gives no rows, not even the root.  Other columns are not read.  Turns are told
    apart by SHA-256 and prefixes by two 64-bit hashes a turn.
    """
    convs, turns = rebuilt(numbered_turns(conversations))
    turns = written(turns, "rebuilt")
    blocks = conversation_blocks(convs, turns)
    nodes = prefix_nodes(blocks)
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("e1").alias("d1"), F.col("e2").alias("d2")).agg(
        F.count(F.lit(1)).alias("n_children"))
    name = ["depth", "d1", "d2"]
    judged = written(
        nodes.join(children, name, "left").join(conversation_ends(convs, turns), name, "left").withColumns({
            "n_children": F.coalesce("n_children", F.lit(0)).cast("long"),
            "saved": (F.col("n_convs") - 1) * F.col("words"),
            "ends_sha256": F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest()))}).withColumn(
            "leaf", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")), "judged")
    sums = _subtree_sums(blocks, judged)
    whole = judged.join(sums, ["conv_id", "depth"])
    # A root without children is the one leaf there is.
    alone = (F.col("depth") == 0) & (F.col("n_children") == 0)
    parents = judged.select((F.col("depth") + 1).alias("depth"), F.col("d1").alias("e1"), F.col("d2").alias("e2"),
                            F.col("conv_id").alias("parent_conv_id"))
    return whole.withColumn("n_leaves", F.when(alone, 1).otherwise(F.col("n_leaves")).cast("long")).join(
        parents, ["depth", "e1", "e2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
