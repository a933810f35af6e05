"""Embedding near-dedup by an epsilon grid order join.

Unit vectors whose cosine reaches ``least`` are at most ``eps = sqrt(2 - 2 * least)`` apart, and a
projection on orthonormal directions brings no two closer than that lets them.  Vectors of
one label are sorted by the cells of width ``eps`` that their leading principal coordinates
fall into, and the sequence is cut into intervals.  Two intervals are joined only if their
boxes come within ``eps``; a join halves its sequences and goes on with the halves that come
near, down to ``LEAF`` vectors, whose cosines are computed in double precision.

Equal vectors are one node with a count, so copies are not expanded into pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askloom.llm.components import components
from askloom.llm.frames import written

#: Vectors of an interval, of a leaf, of the sample that finds the directions, and directions.
INTERVAL, LEAF, SAMPLE, LEADING = 2048, 128, 4096, 4
NODE = "label long, dims int, node long, copies long, embedding"


def directions(sample: np.ndarray, leading: int = LEADING) -> np.ndarray:
    """Leading principal directions of unit vectors, one a column."""
    if not len(sample):
        return np.zeros((0, leading))
    values, vectors = np.linalg.eigh(np.cov(sample.T, bias=True).reshape(sample.shape[1], -1))
    return vectors[:, np.argsort(-values)[:leading]]


def _unit(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    v = v / np.abs(v).max(1, keepdims=True)  # no overflow or underflow in the squares
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def _vectors(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _kind(vectors: DataFrame) -> str:
    """Floats stay floats; any other numbers are doubles, and none is rounded."""
    return "array<float>" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label, dims and embedding of the vectors that can link."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(
        fine & F.exists("embedding", lambda x: x != 0)).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.size("embedding").alias("dims"), F.col("embedding").cast(_kind(vectors)).alias("embedding"))


def _placed(axes: dict[int, np.ndarray], eps: float):
    """Add the principal coordinates and their cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spot = np.zeros((batch.num_rows, LEADING))
            dims = batch.column(1).to_numpy()
            for d in np.unique(dims):
                rows = np.flatnonzero(dims == d)
                if d in axes:
                    basis = axes[d]
                    spot[rows, :basis.shape[1]] = _unit(_vectors(batch.column(4).take(pa.array(rows)))) @ basis
            cell = np.floor(spot / eps).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, _lists(spot, pa.float64()), *(pa.array(np.ascontiguousarray(cell[:, k])) for k in range(LEADING))],
                [*batch.schema.names, "spot", *(f"c{k}" for k in range(LEADING))])

    return run


def _lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(np.ascontiguousarray(rows).ravel(), kind), rows.shape[1]).cast(pa.list_(kind))


def _intervals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the intervals of a sorted partition; an interval has one label and one dimension."""
    part, number, filled, last = TaskContext.get().partitionId(), 0, 0, None
    for batch in batches:
        label, dims = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        out = np.empty(batch.num_rows, np.int64)
        for k in range(batch.num_rows):
            if filled == INTERVAL or last not in (None, (label[k], dims[k])):
                number, filled = number + 1, 0
            last, filled = (label[k], dims[k]), filled + 1
            out[k] = (part << 32) | number
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], [*batch.schema.names, "interval"])


def near_pairs(a: np.ndarray, b: np.ndarray, spot_a: np.ndarray, spot_b: np.ndarray, least: float, same: bool) -> np.ndarray:
    """Places (i, j) in two grid-ordered sequences whose cosine reaches ``least``; i < j if they are the ``same``."""
    eps = math.sqrt(max(0.0, 2 - 2 * least)) + 1e-9
    found = []

    def join(i: int, j: int, k: int, m: int) -> None:
        if same and m <= i + 1:
            return
        low = np.maximum(spot_a[i:j].min(0) - spot_b[k:m].max(0), spot_b[k:m].min(0) - spot_a[i:j].max(0))
        if (np.maximum(low, 0) ** 2).sum() > eps * eps:
            return
        if j - i <= LEAF and m - k <= LEAF:
            x, y = np.nonzero(a[i:j] @ b[k:m].T >= least)
            pairs = np.stack([x + i, y + k], 1)
            found.append(pairs[pairs[:, 0] < pairs[:, 1]] if same else pairs)
            return
        if j - i >= m - k:
            half = (i + j) // 2
            join(i, half, k, m)
            join(half, j, k, m)
        else:
            half = (k + m) // 2
            join(i, j, k, half)
            join(i, j, half, m)

    if len(a) and len(b):
        join(0, len(a), 0, len(b))
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


def _joined(least: float):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        same = key[0].as_py() == key[1].as_py()
        order = np.lexsort([table.column(c).to_numpy() for c in ("node", *(f"c{k}" for k in reversed(range(LEADING))), "side")])
        table = table.take(pa.array(order))
        side, node, copies = (table.column(c).to_numpy() for c in ("side", "node", "copies"))
        v, spot = _unit(_vectors(table.column("embedding"))), _vectors(table.column("spot"))
        cut = len(side) if same else int(np.searchsorted(side, 1))
        rest = slice(None) if same else slice(cut, None)
        pairs = near_pairs(v[:cut], v[rest], spot[:cut], spot[rest], least, same)
        x, y = pairs[:, 0], pairs[:, 1] + (0 if same else cut)
        links = np.zeros(len(node), np.int64)
        np.add.at(links, x, copies[y])
        np.add.at(links, y, copies[x])
        # A forest keeps what is connected with one row per node.
        root = np.arange(len(node))
        while True:
            least_root = root.copy()
            np.minimum.at(least_root, x, root[y])
            np.minimum.at(least_root, y, root[x])
            least_root = least_root[least_root]
            if (least_root == root).all():
                break
            root = least_root
        held = np.flatnonzero(links)
        return pa.table({"node": node[held], "links": links[held], "root": node[root[held]]})

    return run


def link_vectors(vectors: DataFrame, least: float = 0.98) -> DataFrame:
    """Links and components of ``vectors`` (vec_id, label, embedding: array of float or double).

    Returns one row per input row: vec_id, n_links (other rows linked directly), component_id
    (smallest vec_id reachable, itself included), kept.  Vectors link if labels are equal, not
    null, their dimensions are equal and their cosine is at least ``least``.  Null or empty
    vectors, zero ones and those with a null or non-finite component link with nothing, and so do
    rows with a null vec_id, whose component and kept are null.  Repeated rows are vectors of their own
    that link with each other.  Other columns are not read; an empty table gives no rows.
    """
    eps = math.sqrt(max(0.0, 2 - 2 * least)) + 1e-9
    fine = written(usable(vectors), "vectors")
    nodes = fine.groupBy("label", "dims", "embedding").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"))
    nodes = written(nodes.select("label", "dims", "node", "copies", "embedding"), "nodes")
    axes = {}
    for row in nodes.select("dims").distinct().collect():  # one row per dimension of vectors
        sample = nodes.where(F.col("dims") == row["dims"]).orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("embedding").toArrow()
        axes[row["dims"]] = directions(_unit(_vectors(sample.column(0))))
    cells = ", ".join(f"c{k} int" for k in range(LEADING))
    node = f"{NODE} {_kind(vectors)}, spot array<double>, {cells}"
    placed = nodes.mapInArrow(_placed(axes, eps), node)
    order = ["label", "dims", *(f"c{k}" for k in range(LEADING)), "node"]
    ordered = written(placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _intervals, f"{node}, interval long"), "ordered")

    def bounds(which, name: str):
        return F.array(*(which(F.col("spot")[k]) for k in range(LEADING))).alias(name)

    boxes = written(ordered.groupBy("interval", "label", "dims").agg(
        bounds(F.min, "low"), bounds(F.max, "high"), F.min("c0").alias("first"), F.max("c0").alias("last")), "boxes")
    left = boxes.select(F.col("interval").alias("a"), "label", "dims", F.col("low").alias("low_a"), F.col("high").alias("high_a"),
                        F.explode(F.sequence("first", "last")).alias("cell"))
    right = boxes.select(F.col("interval").alias("b"), "label", "dims", "low", "high",
                         F.explode(F.sequence(F.col("first") - 1, F.col("last") + 1)).alias("cell"))
    gap = sum((F.pow(F.greatest(F.col("low_a")[k] - F.col("high")[k], F.col("low")[k] - F.col("high_a")[k], F.lit(0.0)), 2)
               for k in range(LEADING)), F.lit(0.0))
    pairs = left.join(right, ["label", "dims", "cell"]).where((F.col("a") <= F.col("b")) & (gap <= eps * eps)).select("a", "b").distinct()
    sides = pairs.select("a", "b", F.col("a").alias("interval"), F.lit(0).alias("side")).unionByName(
        pairs.where("a <> b").select("a", "b", F.col("b").alias("interval"), F.lit(1).alias("side")))
    joined = sides.join(ordered.drop("label", "dims"), "interval").groupBy("a", "b").applyInArrow(
        _joined(least), "node long, links long, root long")
    joined = written(joined, "joined")
    links = joined.groupBy("node").agg(F.sum("links").alias("links"))
    found = components(joined.select(F.col("node").alias("x"), F.col("root").alias("y")))
    described = nodes.join(links, "node", "left").join(found, "node", "left").select(
        "label", "dims", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("component_id"))
    own = fine.join(described, ["label", "dims", "embedding"]).select("vec_id", "n_links", "component_id")
    rest = vectors.select(F.col("vec_id").cast("long").alias("vec_id")).exceptAll(own.select("vec_id"))
    rest = rest.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return own.unionByName(rest).withColumn("kept", F.col("vec_id") == F.col("component_id"))
