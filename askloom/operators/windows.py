"""Ordered calculations within a key that stay parallel when one key is very large.

A plain window sends all rows of a key to one task.  Here a key is cut into groups of
``GROUP`` consecutive order values; the window runs inside the groups, and a table with
one narrow row per group carries what crosses their borders.  A caller who knows that no key
exceeds one group (``group_width`` asks the table) passes ``width=None`` for a plain window.

``order`` must be a whole number that is unique within a key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from askloom.session import cut_lineage

GROUP = 4096


def group_width(df: DataFrame, order: str) -> int | None:
    """None when all order values lie in ``[0, GROUP)``, so that no key has more rows.

    One small job on one column; on a stored table the column statistics answer it.
    """
    outside = (F.col(order) < 0) | (F.col(order) >= GROUP)
    return None if df.where(outside).select(order).isEmpty() else GROUP


def with_group(df: DataFrame, order: str, width: int | None = GROUP) -> DataFrame:
    """Add ``_group`` unless it is there; a single group for ``width=None``.

    Functions that are given the column keep it: windows that share it share the shuffle.
    """
    if "_group" in df.columns:
        return df
    return df.withColumn("_group", F.floor(F.col(order) / width) if width else F.lit(0).cast("bigint"))


def _tidy(df: DataFrame, given: DataFrame) -> DataFrame:
    return df if "_group" in given.columns else df.drop("_group")


def running_sums(
    df: DataFrame, keys: Sequence[str], order: str, values: Mapping[str, Column], width: int | None = GROUP
) -> DataFrame:
    """Add, under each name, the sum of the value up to and including the row."""
    grouped = with_group(df, order, width).withColumns({f"_v_{n}": v for n, v in values.items()})
    parts = [*keys, "_group"]
    inside = Window.partitionBy(*parts).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    summed = grouped.withColumns({n: F.sum(f"_v_{n}").over(inside) for n in values})
    if width:
        across = Window.partitionBy(*keys).orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
        totals = grouped.groupBy(*parts).agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in values])
        # Only keys with several groups carry anything over a border.
        carried = totals.select(
            *parts, *[F.sum(f"_t_{n}").over(across).alias(f"_c_{n}") for n in values]
        ).where(F.coalesce(*[F.col(f"_c_{n}") for n in values]).isNotNull())
        summed = summed.join(carried, parts, "left").withColumns(
            {n: F.col(n) + F.coalesce(f"_c_{n}", F.lit(0)) for n in values})
    return _tidy(summed.drop(*[f"_{k}_{n}" for n in values for k in "vc"]), df)


def running_sum(
    df: DataFrame, keys: Sequence[str], order: str, value: Column, out: str, width: int | None = GROUP
) -> DataFrame:
    return running_sums(df, keys, order, {out: value}, width)


def neighbor(
    df: DataFrame, keys: Sequence[str], order: str, value: Column, out: str, step: int,
    width: int | None = GROUP,
) -> DataFrame:
    """Add ``value`` of the next (``step=1``) or the previous (``step=-1``) row."""
    shift, edge = (F.lead, F.min_by) if step > 0 else (F.lag, F.max_by)
    grouped = with_group(df, order, width).withColumn("_value", value)
    parts = [*keys, "_group"]
    inside = Window.partitionBy(*parts).orderBy(order)
    shifted = grouped.withColumn(out, shift("_value").over(inside))
    if width:
        across = Window.partitionBy(*keys).orderBy("_group")
        edges = grouped.groupBy(*parts).agg(edge("_value", order).alias("_edge"))
        carried = edges.select(*parts, shift("_edge").over(across).alias("_carried")).where(
            F.col("_carried").isNotNull())
        shifted = shifted.join(carried, parts, "left").withColumn(out, F.coalesce(out, "_carried"))
    return _tidy(shifted.drop("_value", "_carried"), df)


def running_number(df: DataFrame, *order: Column | str, out: str = "row_no") -> DataFrame:
    """Number all rows from 1 in the given order, without a single-task window.

    The rows are range-partitioned and sorted and numbered as they lie then.
    """
    return numbered_as_they_lie(df.orderBy(*order), out)


def numbered_as_they_lie(df: DataFrame, out: str) -> DataFrame:
    """Number all rows from 1, partition by partition, without a shuffle.

    A row's number is its place in its partition plus the sizes of the partitions before.  The
    rows are written out first: a second run could deal them otherwise.
    """
    placed = cut_lineage(df.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    place = F.col("_at").bitwiseAND(2**33 - 1)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the sort, so this window and the broadcast are as large
    # as the number of tasks.
    starts = (
        placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    return (
        placed.withColumn("_part", part).withColumn("_place", place)
        .join(F.broadcast(starts), "_part")
        .withColumn(out, F.col("_start") + F.col("_place") + 1)
        .drop("_part", "_place", "_start", "_at")
    )
