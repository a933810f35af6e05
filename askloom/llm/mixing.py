"""Mixing sources to target weights by pivotal dependent rounding, in built-in functions only.

Every document of a source is wanted the same number of times, its source's target over
its source's size.  The whole part of that number is taken outright.  The fractional parts
are rounded together: of two documents with fractions p and q one gives mass to the other
until one of them is 0 or 1, by a draw that keeps the expectation of both, and the other
goes on to meet the next.  Their sum never changes, so what a source takes stays near its
target instead of scattering like independent draws.

The pairing runs as a reduction tree.  Documents of one source and about one size are dealt
into blocks of about ``BLOCK``; a block leaves at most one document with a fraction, which
moves to the block above, until a source has one left, which is drawn.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from askloom.llm.frames import WORD, numbered, written

BLOCK = 64
#: Fractions are whole numbers of this unit, so moving mass is exact.
ONE = 1 << 40
STEPS_PER_OCTAVE = 4


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """Targets of the sources in ``sizes`` (source, source_size), one row per source.

    Sources by code point, null last, take the weights in turn.  All sizes are shared by
    weight; a target stops at ``most`` times its source's size and the rest is shared again
    by weight among the others.  With sources in the order of ``most * size / weight``, those
    that stop are the first ones, so running sums find the level.  The windows see one row per source.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(turn, F.lit(len(weights))) + 1)
    placed = sizes.withColumn("weight", weight.cast("double")).withColumn("cap", most * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    levelled = placed.withColumn("level", level).withColumn("stops", F.col("level") * F.col("weight") >= F.col("cap"))
    # The first that does not stop has the highest level of those that do not.
    final = F.max(F.when(~F.col("stops"), F.col("level"))).over(every)
    target = F.when(F.col("stops"), F.col("cap")).otherwise(final * F.col("weight"))
    return levelled.withColumn("target", target).select("source", "source_size", "target")


def _draw(seed: int, *keys: str) -> str:
    return f"(pmod(xxhash64({seed}L, {', '.join(keys)}), {ONE}L) / {float(ONE)}D)"


def _pivot(items: str, seed: int) -> Column:
    """One block: an array of (size, id, again, p) to (act, done), done holding (id, again, take)."""
    item = "struct<size:bigint,id:bigint,again:int,p:bigint>"
    done = "array<struct<id:bigint,again:int,take:int>>"

    def decided(who: str, take: int) -> str:
        return f"struct({who}.id AS id, {who}.again AS again, {take} AS take)"

    def left(who: str, p: str) -> str:
        return f"named_struct('size', {who}.size, 'id', {who}.id, 'again', {who}.again, 'p', {p})"

    both, u = "(a.act.p + x.p)", _draw(seed, "a.act.id", "a.act.again", "x.id", "x.again")
    gone = f"CAST(NULL AS {item})"

    def step(stays: str, goes: str, p: str, take: int) -> str:
        return f"named_struct('act', {left(stays, p)}, 'done', array_append(a.done, {decided(goes, take)}))"

    ends = (f"named_struct('act', {gone}, 'done', concat(a.done, array("
            f"{decided('a.act', 1)}, {decided('x', 0)})))",
            f"named_struct('act', {gone}, 'done', concat(a.done, array("
            f"{decided('a.act', 0)}, {decided('x', 1)})))")
    return F.expr(f"""
        aggregate({items}, named_struct('act', {gone}, 'done', CAST(array() AS {done})), (a, x) -> CASE
            WHEN a.act IS NULL THEN named_struct('act', {left('x', 'x.p')}, 'done', a.done)
            WHEN {both} < {ONE}L THEN CASE WHEN {u} * {both} < x.p
                THEN {step('x', 'a.act', both, 0)} ELSE {step('a.act', 'x', both, 0)} END
            WHEN {both} = {ONE}L THEN CASE WHEN {u} * {ONE}L < a.act.p THEN {ends[0]} ELSE {ends[1]} END
            ELSE CASE WHEN {u} * ({2 * ONE}L - {both}) < {ONE}L - x.p
                THEN {step('x', 'a.act', f'{both} - {ONE}L', 1)} ELSE {step('a.act', 'x', f'{both} - {ONE}L', 1)} END
        END)""")


def dependent_rounding(items: DataFrame, seed: int = 0) -> DataFrame:
    """Round ``items`` (source, size, id, again, p in units of ``ONE``, 0 < p < ONE): id, again, take.

    The number of levels is the logarithm of the largest cell to the base ``BLOCK``.
    """
    step = F.floor(F.log2(F.greatest("size", F.lit(1))) * STEPS_PER_OCTAVE).cast("int")
    cells = items.withColumn("cell", step)
    counts = cells.groupBy("source", "cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    most = counts.agg(F.max("blocks").alias("b")).head()["b"] or 1
    same = F.col("l.source").eqNullSafe(F.col("r.source")) & (F.col("l.cell") == F.col("r.cell"))
    rows = cells.alias("l").join(counts.alias("r"), same).select(
        "l.source", "l.cell", "l.size", "l.id", "l.again", "l.p",
        F.pmod(F.xxhash64(F.lit(seed), "l.id", "l.again"), F.col("r.blocks")).alias("block"))
    decided: list[DataFrame] = []
    level, keys = 0, ["source", "cell", "block"]
    while True:
        # With the size first in the struct a block pairs neighbours in size.
        packed = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("size", "id", "again", "p"))).alias("items"))
        done = written(packed.select(*keys, _pivot("items", seed + level).alias("r")).select(*keys, "r.act", "r.done"), "pivot")
        decided.append(done.select(F.explode("done").alias("d")).select("d.*"))
        rest = done.where("act IS NOT NULL").select(*keys, "act.*")
        level += 1
        if keys == ["source"]:
            break
        if most > 1:
            most = -(-most // BLOCK)
            rows = rest.withColumn("block", F.floor(F.col("block") / BLOCK))
        else:  # one fraction per size class: they meet in one block of their source
            keys, rows = ["source"], rest
    last = F.expr(f"CASE WHEN {_draw(seed, 'id', 'again')} * {ONE}L < p THEN 1 ELSE 0 END")
    out = rest.select("id", "again", last.cast("int").alias("take"))
    for part in decided:
        out = out.unionByName(part)
    return out


def mix_sources(documents: DataFrame, weights: Sequence[float] = (5, 2, 1), most: float = 3.0,
                seed: int = 20) -> DataFrame:
    """How often the mix takes each document of ``documents`` (doc_id, source, text).

    Returns one row per input row: doc_id, size, source_size, target, copies, taken.  A null
    or empty text has size 0 and is never taken.  A null source is a source of its own, last in
    order.  Repeated rows are documents of their own, told apart by a number; rows with a null
    doc_id likewise.  No rows give no rows; a table of empty texts takes nothing.  The draws are hashes of ids and of
    ``seed``, so a rerun takes the same.  Other columns are not read.
    """
    sized = documents.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    sized = written(sized, "sizes")
    rows = numbered(sized, "doc_id", out="again")
    sources = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    sources = written(sources, "targets")
    same = F.col("d.source").eqNullSafe(F.col("s.source"))
    wanted = rows.alias("d").join(sources.alias("s"), same).select(
        "d.*", "s.source_size", "s.target",
        F.when(F.col("s.source_size") > 0, F.col("s.target") / F.col("s.source_size")).otherwise(0.0).alias("times"))
    whole = F.floor("times")
    part = F.round((F.col("times") - whole) * ONE).cast("long")
    wanted = written(wanted.withColumn("whole", whole + F.when(part >= ONE, 1).otherwise(0)).withColumn(
        "p", F.when(part >= ONE, F.lit(0).cast("long")).otherwise(part)).drop("times"), "wanted")
    rounded = dependent_rounding(
        wanted.where("p > 0 AND size > 0").select("source", "size", F.col("doc_id").alias("id"), "again", "p"), seed)
    same = F.col("w.doc_id").eqNullSafe(F.col("r.id")) & (F.col("w.again") == F.col("r.again"))
    copies = F.when(F.col("size") > 0, F.col("whole") + F.coalesce("take", F.lit(0))).otherwise(0).cast("long")
    return wanted.alias("w").join(rounded.alias("r"), same, "left").withColumn("copies", copies).select(
        "w.doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
