"""Audit of how filters interact, by constrained least squares over all coalitions.

Every text fails some of the filters; the failed ones are the bits of its pattern.  The rows of a
part are tabulated by pattern, and from that by coalition: how many rows the filters of a coalition
remove together.  With five filters that are 32 numbers a part, whatever its size.

What a filter removes in a step is the coalition with it less the coalition without it.  Its Shapley
value is the weight of the filter in the additive model that fits the 32 numbers best under the
Shapley kernel and meets the one of all filters exactly.  The normal equations of this fit, with a
multiplier for the condition, do not depend on the data: they are solved once in rationals, for a
right-hand side of 32 unknown numbers, and the solution is a whole-number combination of them over
one denominator.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction
from itertools import permutations
from math import comb, factorial, lcm

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askloom.llm.frames import WORD, written

COUNTS = ("rows", "good", "toxic")
#: The name of the filter that a row fails if a row with a smaller id has the same text.
DUPLICATE = "E"


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions of one text, by name."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 2 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def shapley_weights(n: int) -> tuple[list[list[int]], int]:
    """Whole numbers ``c`` and a denominator: the value of player i is sum(c[i][S] * v(S)) / denominator.

    Least squares over the coalitions S (bit sets) that are neither empty nor whole, weighted by
    (n - 1) / (C(n, |S|) |S| (n - |S|)), under the condition that the values add up to v(all) - v(none).
    """
    inner = range(1, 2**n - 1)
    whole = 2**n - 1

    def weight(s: int) -> Fraction:
        k = s.bit_count()
        return Fraction(n - 1, comb(n, k) * k * (n - k))

    def has(s: int, i: int) -> int:
        return s >> i & 1

    # Unknowns: the n values and the multiplier; right-hand sides: one column per coalition.
    rows: list[list[Fraction]] = []
    for i in range(n):
        left = [sum((weight(s) for s in inner if has(s, i) and has(s, j)), Fraction(0)) for j in range(n)] + [Fraction(1)]
        right = [weight(s) * has(s, i) if s in inner else Fraction(0) for s in range(whole + 1)]
        right[0] -= sum(right)  # v(S) - v(none)
        rows.append(left + right)
    last = [Fraction(0)] * (whole + 1)
    last[0], last[whole] = Fraction(-1), Fraction(1)
    rows.append([Fraction(1)] * n + [Fraction(0)] + last)
    for k in range(n + 1):
        at = next(r for r in range(k, n + 1) if rows[r][k])
        rows[k], rows[at] = rows[at], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for r in range(n + 1):
            if r != k and rows[r][k]:
                rows[r] = [x - rows[r][k] * y for x, y in zip(rows[r], rows[k])]
    solved = [row[n + 1:] for row in rows[:n]]
    below = lcm(*(x.denominator for row in solved for x in row))
    return [[int(x * below) for x in row] for row in solved], below


def failed_filters(documents: DataFrame, filters: Mapping[str, Column], part: Column) -> DataFrame:
    """doc_id, part, copy (hash of the text) and pattern of every row: bit i is set if filter i fails."""
    text = F.coalesce(F.col("text"), F.lit(""))
    pattern = sum((F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(filters.values())), F.lit(0))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(part, F.lit("")).alias("part"),
                            F.unhex(F.sha2(text, 256)).alias("copy"), pattern.cast("int").alias("pattern"))


def _any_label(labels: DataFrame, name: str) -> Column:
    return F.coalesce(F.max(F.col(name) == 1), F.lit(False)).alias(f"is_{name}")


def pattern_counts(rows: DataFrame, labels: DataFrame, duplicate: int) -> DataFrame:
    """(part, pattern, rows, good, toxic) of ``rows`` (as of ``failed_filters``), the bit ``duplicate`` set for later copies.

    Rows are merged by id and text before their labels are joined, and by text and part before
    the smallest id of a text is looked up, so a text that a third of the rows hold arrives as a
    few rows a task.
    """
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        _any_label(labels, "quality"), _any_label(labels, "toxic"))
    kinds = ["part", "copy", "pattern", "is_quality", "is_toxic"]
    placed = rows.where("doc_id IS NOT NULL").join(known, "doc_id", "left").fillna(False, ["is_quality", "is_toxic"])
    same_id = placed.groupBy("doc_id", *kinds).agg(F.count(F.lit(1)).alias("n"))
    held = written(same_id.groupBy(*kinds).agg(F.sum("n").alias("n"), F.min(F.struct("doc_id", "n")).alias("first")), "copies")
    several = held.groupBy("copy").agg(F.min("first.doc_id").alias("least"), F.sum("n").alias("all")).where("all > 1")
    judged = held.join(several.select("copy", "least"), "copy", "left")
    # Rows that repeat the smallest id have no smaller one before them.
    leads = F.col("least").isNull() | (F.col("first.doc_id") == F.col("least"))
    stays = F.when(F.col("least").isNull(), F.col("n")).when(leads, F.col("first.n")).otherwise(0)
    split = judged.select("part", "is_quality", "is_toxic", F.explode(F.array(
        F.struct(F.col("pattern").alias("pattern"), stays.cast("long").alias("n")),
        F.struct(F.col("pattern").bitwiseOR(F.lit(1 << duplicate)).alias("pattern"), (F.col("n") - stays).cast("long").alias("n")),
    )).alias("s")).select("part", "is_quality", "is_toxic", "s.*")
    # A row without an id comes before or after no other one, and has no labels.
    loose = rows.where("doc_id IS NULL").groupBy("part", "pattern").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.lit(False).alias("is_quality"), F.lit(False).alias("is_toxic"), "pattern", "n")
    return split.unionByName(loose).groupBy("part", "pattern").agg(
        F.sum("n").alias("rows"), F.sum(F.when(F.col("is_quality"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("is_toxic"), F.col("n")).otherwise(0)).alias("toxic"))


def coalition_table(counts: DataFrame, n: int) -> DataFrame:
    """One row per part: arrays ``pattern`` (rows by pattern) and ``gone`` (removed by coalition), each of rows, good and toxic.

    Entry S of ``gone`` counts the rows that the filters of S remove together.
    """
    sets = F.sequence(F.lit(0), F.lit(2**n - 1))
    spread = counts.withColumn("s", F.explode(sets))

    def if_hit(name: str, hit: Column) -> Column:
        return F.sum(F.when(hit, F.col(name)).otherwise(0)).alias(name)

    hit = F.col("pattern").bitwiseAND(F.col("s")) != 0
    gone = spread.groupBy("part", "s").agg(
        *[if_hit(c, hit) for c in COUNTS], F.sum(F.when(F.col("pattern") == F.col("s"), F.col("rows")).otherwise(0)).alias("exact"),
        F.sum("rows").alias("all"))
    # Always 2**n entries a part.
    return gone.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("s", *COUNTS, "exact", "all"))).alias("t")).select(
        "part", F.col("t.exact").alias("exact"), F.col("t")[0]["all"].alias("total"), *[F.col(f"t.{c}").alias(f"gone_{c}") for c in COUNTS])


def audit_filters(documents: DataFrame, labels: DataFrame, filters: Mapping[str, Column] | None = None,
                  part: Column | None = None) -> DataFrame:
    """What every order of the filters keeps and removes in ``documents`` (doc_id, text, source), step by step.

    ``filters`` names failure conditions, columns over ``text`` (a null text is empty); to them
    comes ``DUPLICATE``: the text equals that of a row with a smaller id, in any part.  ``labels``
    (doc_id, quality, toxic) may cover some rows; a row is good or toxic if any of its labels is 1.

    Returns one row per part, order and step: part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley (the value of the step's filter times the number
    of orders, which is what it removes in all orders together).  A null part is the empty one.
    Rows without an id have no labels and are no copies of another; rows that repeat an id count
    each, and none of them is before the other.  Texts are told apart by SHA-256.  An empty
    table has no parts and gives no rows.  Other columns are not read.
    """
    source = documents.withColumn("text", F.coalesce(F.col("text"), F.lit("")))
    filters = dict(filters or text_filters(F.col("text")))
    names = [*filters, DUPLICATE]
    n = len(names)
    rows = written(failed_filters(source, filters, F.col("source") if part is None else part), "patterns")
    table = coalition_table(pattern_counts(rows, labels, n - 1), n)
    valued = table.withColumn("share", _shapley(F.col("gone_rows"), n))
    return valued.withColumn("step", F.explode(_steps(names))).select("part", *_step_counts(names))


def _shapley(gone: Column, n: int) -> Column:
    """Array of the filters' values times the number of orders, from the table of coalitions."""
    weights, below = shapley_weights(n)
    times = factorial(n) // below  # the denominator divides the number of orders
    return F.array(*[
        F.aggregate(F.zip_with(gone, F.array(*[F.lit(c * times).cast("long") for c in row]), lambda v, c: v * c),
                    F.lit(0).cast("long"), lambda a, x: a + x) for row in weights])


def _steps(names: Sequence[str]) -> Column:
    """All steps of all orders: order, number, filter, and the coalition before."""
    orders = [(o, "".join(names[i] for i in o)) for o in permutations(range(len(names)))]
    steps = [f"struct('{text}' AS filter_order, {k + 1} AS step, {o[k]} AS filter, {sum(1 << i for i in o[:k])} AS before)"
             for o, text in orders for k in range(len(names))]
    return F.expr(f"array({', '.join(steps)})")


def _step_counts(names: Sequence[str]) -> list[Column]:
    def at(array: str, place: Column) -> Column:
        return F.get(F.col(array), place)

    before, bit = F.col("step.before"), F.element_at(F.array(*[F.lit(1 << i) for i in range(len(names))]), F.col("step.filter") + 1)
    after = before.bitwiseOR(bit)

    def gone(name: str) -> Column:
        return at(f"gone_{name}", after) - at(f"gone_{name}", before)

    return [
        F.col("step.filter_order").alias("filter_order"), F.col("step.step").alias("step"),
        (F.col("total") - at("gone_rows", after)).alias("kept"), gone("rows").alias("removed"),
        (at("gone_rows", bit) - gone("rows")).alias("redundant"), at("exact", bit).alias("unique_fails"),
        gone("good").alias("good_lost"), gone("toxic").alias("toxic_lost"),
        F.element_at("share", F.col("step.filter") + 1).alias("shapley"),
    ]
