"""Exact top-k similarity search and what follows from its hits.

The questions are written once with their vectors and taken in portions of bounded size.  A
portion's matrices are broadcast, every index task keeps a running top-k, and the index is
never moved: a portion costs one scan of it and a shuffle of at most k rows per question and
task.  Portions run one after another: a portion's hits are stored and its matrices are
given up before the next is read, so neither driver nor executors hold more than one.
A question row is what hits belong to: rows that repeat an id have k hits each.

Scores are cosines rounded to six decimals; ties go to the smaller key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from askloom.config import MIN_HIT_CHARS, TOP_K
from askloom.functions.text import strip_space
from askloom.functions.vectors import SCORE_UNITS, cosine, round_score
from askloom.operators.windows import numbered_as_they_lie
from askloom.session import cut_lineage, scratch_path
from askloom.sources.index import STORED_KEY

CHUNK_KEY = ("source", "page", "chunk_no")
MAX_BROADCAST_BYTES = 64 * 2**20
MAX_BROADCAST_HITS = 250_000
QUESTIONS_PER_BLOCK = 8_192
CELLS_AT_ONCE = 2_000_000
# A cell scored by itself takes about as long as so many in a product of matrices.
CELLS_A_ROW = 32


def index_key(index: DataFrame) -> tuple[str, ...]:
    """The columns that tell index rows apart: those of a stored index if they are there."""
    return STORED_KEY if {"load_id", "row_id"} <= {*index.columns} else CHUNK_KEY


def top_k(
    questions: DataFrame,
    index: DataFrame,
    k: int = TOP_K,
    question: str = "question_id",
    key: Sequence[str] | None = None,
    vector: str = "embedding",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    questions_per_block: int = QUESTIONS_PER_BLOCK,
) -> DataFrame:
    """``(question, key…, score, rank)`` of the k best index rows of every question row.

    A scan serves as many questions as ``max_broadcast_bytes`` of matrix hold, and multiplies
    ``questions_per_block`` at a time.  For more questions give a stored ``index``: every portion
    scans it.
    """
    return _search(questions, index, k, question, list(key or index_key(index)), vector, max_broadcast_bytes,
                   questions_per_block).hits


class Found(NamedTuple):
    hits: DataFrame
    most: int  # no more hits than this


def _search(
    questions: DataFrame, index: DataFrame, k: int, question: str, key: list[str], vector: str,
    max_bytes: int, block_rows: int,
) -> Found:
    stored = numbered_as_they_lie(questions.select(question, vector), out="_no")
    n, width = stored.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size(vector)), F.lit(1))).head()
    rows = max(1, max_bytes // (8 * max(1, width)))
    if n <= rows:
        portion = _Portion(stored, question, vector, block_rows)
        return Found(portion.hits(index, k, question, key, vector), n * k)
    path = scratch_path(index.sparkSession, "hits")
    for at in range(0, n, rows):
        portion = _Portion(stored.where(F.col("_no").between(at + 1, at + rows)), question, vector, block_rows)
        hits = portion.hits(index, k, question, key, vector)
        hits.write.mode("append").parquet(path)
        portion.shared.destroy()
    return Found(index.sparkSession.read.schema(hits.schema).parquet(path), n * k)


class _Portion:
    """Questions whose matrices all tasks hold at once, in blocks of at most ``block_rows``."""

    def __init__(self, stored: DataFrame, question: str, vector: str, block_rows: int) -> None:
        asked = _usable(stored.select(question, vector).toArrow(), vector)
        self.spark, self.names = stored.sparkSession, asked.column(question)
        self.shared = self.spark.sparkContext.broadcast(
            [_matrix(asked.slice(at, block_rows), vector) for at in range(0, max(1, len(asked)), block_rows)])

    def hits(self, index: DataFrame, k: int, question: str, key: list[str], vector: str) -> DataFrame:
        shared = self.shared
        narrow = index.select(*key, vector)
        schema = T.StructType([T.StructField("_q", T.IntegerType()), *narrow.schema[: len(key)],
                               T.StructField("score", T.DoubleType())])

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best, first = [], 0
            for matrix in shared.value:
                best.append(RunningTopK(matrix, key, vector, k, first))
                first += len(matrix)
            for batch in batches:
                rows = pa.Table.from_batches([batch])
                for block in best:
                    block.add(rows)
            for block in best:
                yield from block.result(to_arrow_schema(schema)).to_batches()

        hits = rank_hits(narrow.mapInArrow(scan, schema), k, "_q", key)
        # Positions become ids again; this table has as many rows as the portion.
        names = self.spark.createDataFrame(
            pa.table({"_q": pa.array(range(len(self.names)), pa.int32()), question: self.names}))
        return hits.join(F.broadcast(names), "_q").select(question, *key, "score", "rank")


def rank_hits(hits: DataFrame, k: int, question: str, key: Sequence[str]) -> DataFrame:
    """Best first within a question, at most k.  The rank filter becomes a group limit
    before the shuffle."""
    order = Window.partitionBy(question).orderBy(F.desc("score"), *[F.asc(c) for c in key])
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _usable(rows: pa.Table, vector: str) -> pa.Table:
    """Rows with a vector.  Done here and not with ``where``: a filter on a vector that is
    still to be embedded would be pushed down with a second run of the model."""
    return rows.filter(pc.is_valid(rows.column(vector)))


def _matrix(table: pa.Table, vector: str) -> np.ndarray:
    """Unit rows in double precision; zero vectors stay zero."""
    column = table.column(vector).combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    matrix = values.reshape(len(column), -1) if len(column) else np.zeros((0, 1))
    norms = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
    return matrix / np.where(norms > 0, norms, 1.0)[:, None]


def _units(scores: np.ndarray) -> np.ndarray:
    return np.floor(scores * SCORE_UNITS + 0.5).astype(np.int64)


class RunningTopK:
    """Best k index rows per question over any number of batches.

    ``units`` holds scores in millionths and ``slots`` points into ``pool``, the key
    columns of the rows still in play; free places hold ``EMPTY`` and -1.

    Once a question has k hits, products in single precision tell which cells may change them: their error has a
    bound.  Only those cells are scored, in double precision; every result is one of a score in double precision.
    """

    EMPTY = -(2**62)
    # Below any score.
    LOW = -2 * SCORE_UNITS

    def __init__(self, matrix: np.ndarray, key: list[str], vector: str, k: int, first: int = 0) -> None:
        self.matrix, self.key, self.vector, self.k, self.first = matrix, key, vector, k, first
        self.units = np.full((len(matrix), k), self.EMPTY, dtype=np.int64)
        self.slots = np.full((len(matrix), k), -1, dtype=np.int64)
        self.pool: pa.Table | None = None
        self.rough = matrix.astype(np.float32)
        # Of unit rows: rounding of the components and of a sum in any order, of the score and of the bound itself.
        self.slack = (matrix.shape[1] + 4) * 2.0**-24 + 2 / SCORE_UNITS
        self.full = False

    def add(self, rows: pa.Table) -> None:
        rows = _usable(rows, self.vector)
        if not len(self.matrix) or not rows.num_rows:
            return
        step = max(1, CELLS_AT_ONCE // len(self.matrix))
        for at in range(0, rows.num_rows, step):
            self._add(rows.slice(at, step))

    def _add(self, rows: pa.Table) -> None:
        rows = rows.take(_order(rows, self.key))
        vectors = _matrix(rows, self.vector)
        width = len(vectors)
        # Only questions that this batch can change are looked at further.
        if self.full:
            touched, units = self._close(vectors)
        else:
            units = _units(self.matrix @ vectors.T)
            touched = np.flatnonzero(units.max(axis=1) >= self.units[:, -1])
            units = units[touched]
        if not len(touched):
            return
        # Rows are in key order, so score and position together give distinct numbers
        # whose order is the order of the result.
        ranked = units * width + (width - 1 - np.arange(width))
        if width > self.k:
            ranked = -np.partition(-ranked, self.k - 1, axis=1)[:, : self.k]
        position = width - 1 - ranked % width
        self._merge(rows.select(self.key), touched, ranked // width, position)
        self.full = self.full or bool((self.slots[:, -1] >= 0).all())

    def _close(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The questions that ``vectors`` may change, and their units; cells that can't change them may hold ``LOW``."""
        least = (self.units[:, -1] / SCORE_UNITS - self.slack).astype(np.float32)
        close = self.rough @ vectors.astype(np.float32).T >= least[:, None]
        touched = np.flatnonzero(close.any(axis=1))
        row, column = np.nonzero(close[touched])
        if len(row) * CELLS_A_ROW > len(touched) * len(vectors):
            return touched, _units(self.matrix[touched] @ vectors.T)
        units = np.full((len(touched), len(vectors)), self.LOW, dtype=np.int64)
        step = max(1, CELLS_AT_ONCE // vectors.shape[1])
        for at in range(0, len(row), step):
            q, c = row[at:at + step], column[at:at + step]
            units[q, c] = _units(np.einsum("ij,ij->i", self.matrix[touched[q]], vectors[c]))
        return touched, units

    def _merge(
        self, keys: pa.Table, touched: np.ndarray, units: np.ndarray, position: np.ndarray
    ) -> None:
        used, local = np.unique(position, return_inverse=True)
        fresh = keys.take(pa.array(used))
        offset = self.pool.num_rows if self.pool is not None else 0
        pool = pa.concat_tables([self.pool, fresh]) if offset else fresh
        place = np.empty(pool.num_rows, dtype=np.int64)
        place[np.asarray(_order(pool, self.key))] = np.arange(pool.num_rows)

        all_units = np.hstack([self.units[touched], units])
        all_slots = np.hstack([self.slots[touched], local.reshape(position.shape) + offset])
        key_rank = np.where(all_slots >= 0, place[all_slots], pool.num_rows)
        best = np.lexsort((key_rank, -all_units), axis=-1)[:, : self.k]
        self.units[touched] = np.take_along_axis(all_units, best, axis=1)
        self.slots[touched] = np.take_along_axis(all_slots, best, axis=1)

        # Forget rows that no question holds any more.
        kept, again = np.unique(self.slots, return_inverse=True)
        again = again.reshape(self.slots.shape)
        if kept[0] == -1:
            kept, again = kept[1:], again - 1
        self.pool, self.slots = pool.take(pa.array(kept)), again

    def result(self, schema: pa.Schema) -> pa.Table:
        """Rows ``(_q, key…, score)``; ``_q`` is the row of the question matrix after the ``first``."""
        if self.pool is None:
            return schema.empty_table()
        row, column = np.nonzero(self.slots >= 0)
        found = self.pool.take(pa.array(self.slots[row, column]))
        found = found.add_column(0, "_q", pa.array(row + self.first, pa.int32()))
        found = found.append_column("score", pa.array(self.units[row, column] / SCORE_UNITS))
        return found.cast(schema)


def _order(rows: pa.Table, key: Sequence[str]) -> pa.Array:
    return pc.sort_indices(rows, sort_keys=[(c, "ascending") for c in key], null_placement="at_start")


def score_pairs(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Add the rounded cosine of two vector columns of the same row."""
    return pairs.withColumn("score", round_score(cosine(left, right)))


def best_hit(hits: DataFrame) -> DataFrame:
    return hits.where(F.col("rank") == 1).drop("rank")


def hydrate(
    hits: DataFrame, chunks: DataFrame, key: Sequence[str] | None = None, few: bool = False
) -> DataFrame:
    """Give hits the text and metadata of their chunks.

    The join comes after the search, so text never takes part in the scoring shuffle.
    ``few`` says that the number of hits is known to be bounded; then they are broadcast
    and the chunk table is scanned in place.
    """
    key = key or index_key(chunks)
    h, c = (F.broadcast(hits) if few else hits).alias("h"), chunks.alias("c")
    same = [F.col(f"h.{name}").eqNullSafe(F.col(f"c.{name}")) for name in key]
    taken = {*hits.columns, "embedding"}
    return h.join(c, same).select("h.*", *[F.col(f"c.{n}") for n in chunks.columns if n not in taken])


def retrieve(
    questions: DataFrame,
    index: DataFrame,
    k: int = TOP_K,
    question: str = "question_id",
    key: Sequence[str] | None = None,
    vector: str = "embedding",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    questions_per_block: int = QUESTIONS_PER_BLOCK,
) -> DataFrame:
    """Hits of every question row with the text and metadata of their chunks.

    The hits of all portions are joined to the chunks once; few enough of them are broadcast.
    """
    key = list(key or index_key(index))
    found = _search(questions, index, k, question, key, vector, max_broadcast_bytes, questions_per_block)
    return hydrate(found.hits, index.drop(vector), key, few=found.most <= MAX_BROADCAST_HITS)


def off_topic_gate(
    questions: DataFrame, hits: DataFrame, question: str = "question_id", text: str = "text"
) -> DataFrame:
    """Flag questions without a hit or whose best hit is shorter than 50 characters.

    The length is that of the stripped text; similarity plays no part.
    """
    best = hits.where(F.col("rank") == 1).select(question, F.char_length(strip_space(text)).alias("_chars"))
    flag = F.col("_chars").isNull() | (F.col("_chars") < MIN_HIT_CHARS)
    return questions.join(best, question, "left").withColumn("off_topic", flag).drop("_chars")
