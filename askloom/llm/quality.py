"""Text quality by Bradley-Terry pairwise ranking.

Labels say which of two documents is better, so the model learns from pairs: a document of
label 1 is preferred to one of label 0 with the logistic of the difference of their scores,
and a score is linear in features of the text's form.  All labelled documents take part: their
features are dealt to blocks, every document meets ``PAIRS_EACH`` of the other label in its block
at least, and each Newton step is one pass that leaves one row of sums a task.  The score at the quantile that leaves
the labelled share of good documents above it becomes the cut, and scores are turned into
0 to 1 so that the cut stands at ``CUT``; it is the exact one of all labelled documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askloom.llm.frames import written
from askloom.llm.tokens import distinct, mixed, prefix_hashes, shingles, slices, span_hashes, words
from askloom.operators.windows import running_number

CUT = 0.7
#: Pairs of each labelled document at least, and Newton steps at most.
PAIRS_EACH, RIDGE, STEPS = 24, 1.0, 25
#: Labelled documents in a block, and how many of either label one has on average at least.
BLOCK, LEAST_EACH = 4096, 64
#: Labels that may be sent to all tasks (about 16 bytes each); more are joined.
BROADCAST_LABELS = 1 << 20
FEATURES = ("log_words", "word_bytes", "word_spread", "upper", "digits", "symbols", "marks", "wide", "repeated_shingles",
            "repeated_lines", "line_words", "distinct_words", "bare_words", "runs", "stops", "capitals", "long_words")


def _kinds() -> dict[str, np.ndarray]:
    table = {k: np.zeros(256, bool) for k in ("upper", "lower", "digit", "stop", "symbol", "wide", "line")}
    table["upper"][65:91] = table["lower"][97:123] = table["digit"][48:58] = True
    for c in b".?,;:'\"-":
        table["stop"][c] = True
    table["symbol"][33:127] = True
    for k in ("upper", "lower", "digit", "stop"):
        table["symbol"] &= ~table[k]
    table["wide"][128:] = True
    table["line"][10] = True
    return table


KINDS = _kinds()


def text_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row per document; an empty text has the row of zeros."""
    docs, size = len(offsets) - 1, np.maximum(np.diff(offsets), 1)

    def per_doc(mask: np.ndarray, places: np.ndarray = offsets) -> np.ndarray:
        sums = np.zeros(len(mask) + 1, np.float64)
        np.cumsum(mask, out=sums[1:])
        return sums[places[1:]] - sums[places[:-1]]

    w = words(data, offsets)
    n = np.maximum(np.diff(w.first), 1)
    length = (w.end - w.start).astype(np.float64)
    mean = per_doc(length, w.first) / n
    value, doc, _ = shingles(w)
    held, first = distinct(value, doc, docs)
    total = np.bincount(doc, minlength=docs)
    types = np.diff(distinct(w.hash, w.doc, docs)[1])
    letters = {k: per_doc(KINDS[k][data]) for k in KINDS}
    alphabetic = np.maximum(letters["upper"] + letters["lower"] + letters["wide"], 1)
    # Lines with anything in them.
    cuts = np.union1d(np.flatnonzero(KINDS["line"][data]) + 1, offsets[offsets < len(data)])
    ends = np.append(cuts[1:], len(data)) if len(cuts) else cuts
    line_doc = np.searchsorted(offsets, cuts, "right") - 1
    full = ends - cuts > 1
    lines = np.bincount(line_doc[full], minlength=docs)
    hashes = span_hashes(prefix_hashes(data), cuts[full], ends[full]) if len(data) else np.zeros(0, np.uint64)
    kinds = np.unique(mixed(hashes ^ (line_doc[full].astype(np.uint64) << np.uint64(20))))
    own = np.unique(np.stack([line_doc[full].astype(np.uint64), hashes], 1), axis=0)[:, 0] if len(kinds) else np.zeros(0)
    line_types = np.bincount(own.astype(np.int64), minlength=docs)
    run = np.zeros(len(data), bool)
    run[2:] = (data[2:] == data[1:-1]) & (data[2:] == data[:-2]) & (KINDS["symbol"][data[2:]] | KINDS["stop"][data[2:]])
    plain = KINDS["upper"][data] | KINDS["lower"][data] | KINDS["wide"][data]
    sums = np.zeros(len(data) + 1, np.int64)
    np.cumsum(plain, out=sums[1:])
    bare = (sums[w.end] == sums[w.start]).astype(np.float64)
    capital = KINDS["upper"][data[w.start]].astype(np.float64) if len(w.start) else np.zeros(0)
    columns = [
        np.log1p(np.diff(w.first)), mean, np.sqrt(np.maximum(per_doc(length ** 2, w.first) / n - mean ** 2, 0)),
        letters["upper"] / alphabetic, letters["digit"] / size, letters["symbol"] / size, letters["stop"] / n,
        letters["wide"] / size, 1 - np.diff(first) / np.maximum(total, 1), 1 - line_types / np.maximum(lines, 1),
        np.log1p(np.diff(w.first) / np.maximum(lines, 1)), types / n * np.log1p(n),
        per_doc(bare, w.first) / n, per_doc(run) / n, np.log1p(letters["stop"]), per_doc(capital, w.first) / n,
        per_doc((length > 12).astype(np.float64), w.first) / n]
    out = np.stack(columns, 1)
    out[np.diff(w.first) == 0] = 0
    return out


@dataclass
class Ranking:
    middle: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    cut: float
    scale: float

    def raw(self, features: np.ndarray) -> np.ndarray:
        return _expanded((features - self.middle) / self.spread) @ self.weights

    def score(self, features: np.ndarray) -> np.ndarray:
        shift = np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip((self.raw(features) - self.cut) * self.scale + shift, -30, 30)))


def _expanded(z: np.ndarray) -> np.ndarray:
    z = np.clip(z, -6, 6)
    return np.concatenate([z, z * z], 1)


def _slope_and_curve(x: np.ndarray, labels: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Of the logistic loss of differences (label 1 less label 0) in a block: the slope, then the rows of the second derivative.

    Every row is in ``PAIRS_EACH`` pairs or more: the two labels meet at as many evenly spread distances.
    """
    out = np.zeros(len(w) + len(w) ** 2)
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    if not len(good) or not len(bad):
        return out
    few, many = (good, bad) if len(good) < len(bad) else (bad, good)
    for shift in np.arange(PAIRS_EACH) * len(few) // PAIRS_EACH:
        other = few[(np.arange(len(many)) + shift) % len(few)]
        apart = x[other] - x[many] if few is good else x[many] - x[other]
        p = 1 / (1 + np.exp(np.clip(apart @ w, -30, 30)))
        out += np.append(apart.T @ p, ((apart * (p * (1 - p))[:, None]).T @ apart).ravel())
    return out


def _newton(sums: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The weights, from the sums of ``_slope_and_curve`` over all pairs."""
    w = np.zeros(2 * len(FEATURES))
    for _ in range(STEPS):
        found = sums(w)
        slope, curve = found[:len(w)] - RIDGE * w, found[len(w):].reshape(len(w), len(w)) + RIDGE * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _cut_place(n: int, bad: int) -> int:
    """How many of ``n`` ordered scores lie below the cut: as many as have label 0, none and all excepted."""
    return min(max(bad, 1), n - 1)


def fit_ranking(features: np.ndarray, labels: np.ndarray) -> Ranking:
    """Fit on the features and labels (0 or 1) of one block.  With one label only every score is the cut's."""
    middle, spread = (features.mean(0), features.std(0) + 1e-9) if len(features) else (np.zeros(len(FEATURES)), np.ones(len(FEATURES)))
    x = _expanded((features - middle) / spread)
    if not (labels == 1).any() or not (labels == 0).any():
        return Ranking(middle, spread, np.zeros(2 * len(FEATURES)), 0.0, 1.0)
    w = _newton(lambda at: _slope_and_curve(x, labels, at))
    ordered = np.sort(x @ w)
    at = _cut_place(len(labels), int((labels == 0).sum()))
    # Between the worst of the good share and the best of the rest.
    return Ranking(middle, spread, w, float((ordered[at - 1] + ordered[at]) / 2), 1.0)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))


def _summed(rows: DataFrame, of_batches: Callable[[Iterator[pa.RecordBatch]], np.ndarray]) -> np.ndarray:
    """The sums over all tasks of what ``of_batches`` gives for one; a task leaves one row.

    The rows are added in the order of their values, so the result does not depend on that of the tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([of_batches(batches)], pa.list_(pa.float64()))], ["sums"])

    parts = rows.mapInArrow(run, "sums array<double>").toArrow().column(0).combine_chunks()
    each = parts.flatten().to_numpy(zero_copy_only=False).reshape(len(parts), -1)
    return each[np.lexsort(each.T)].sum(0)


def _moments(middle: np.ndarray | None) -> Callable[[Iterator[pa.RecordBatch]], np.ndarray]:
    """Sums of the features of rows (doc_id, label, features), or of the squares of their distances from ``middle``."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        out = np.zeros(len(FEATURES))
        for batch in batches:
            x = _matrix(batch.column(2))
            out += x.sum(0) if middle is None else ((x - middle) ** 2).sum(0)
        return out

    return of_batches


def _block_sums(middle: np.ndarray, spread: np.ndarray, w: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], np.ndarray]:
    """``_slope_and_curve`` over the blocks of a task, from rows (block, label, features) sorted by block."""

    def of_block(x: np.ndarray, labels: np.ndarray) -> np.ndarray:
        return _slope_and_curve(_expanded((x - middle) / spread), labels, w)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        out = np.zeros(len(w) + len(w) ** 2)
        held: list[np.ndarray] = []
        for batch in batches:
            cols = [batch.column(0).to_numpy(), batch.column(1).to_numpy(), _matrix(batch.column(2))]
            held = [np.concatenate(c) for c in zip(held, cols)] if held else cols
            ends = np.flatnonzero(held[0][1:] != held[0][:-1]) + 1
            for i, j in zip(np.append(0, ends[:-1]), ends):
                out += of_block(held[2][i:j], held[1][i:j])
            held = [c[ends[-1]:] for c in held] if len(ends) else held
        return out + of_block(held[2], held[1]) if held and len(held[0]) else out

    return of_batches


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [text_features(data, offsets) for _, _, data, offsets in slices(batch.column(2))]
        flat = np.concatenate(rows).ravel() if rows else np.zeros(0)
        column = pa.FixedSizeListArray.from_arrays(pa.array(flat), len(FEATURES)).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), column], ["doc_id", "label", "features"])


def train_quality(documents: DataFrame, labels: DataFrame) -> Ranking:
    """Learn from all rows of ``labels`` (doc_id, label) and the texts of ``documents`` (doc_id, text).

    Labels other than 0 and 1 and null ids are left out.  The features are computed once and
    kept in the shared folder.  Blocks are dealt by hash; if one label is so scarce that a block
    could miss it, its rows go to several blocks.
    """
    chosen = labels.where("doc_id IS NOT NULL AND label IN (0, 1)").select("doc_id", F.col("label").cast("long").alias("label"))
    few = chosen.count() <= BROADCAST_LABELS
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if few:
        texts = texts.join(F.broadcast(chosen), "doc_id")
    else:  # Features are narrower than texts: these are what is joined.
        texts = texts.where("doc_id IS NOT NULL").withColumn("label", F.lit(0).cast("long"))
    rows = texts.select("doc_id", "label", "text").mapInArrow(_features, "doc_id long, label long, features array<double>")
    rows = written(rows if few else rows.drop("label").join(chosen, "doc_id").select("doc_id", "label", "features"), "features")
    count = dict(map(tuple, rows.groupBy("label").count().collect()))
    n, scarce = sum(count.values()), min(count.get(0, 0), count.get(1, 0))
    middle = _summed(rows, _moments(None)) / n if n else np.zeros(len(FEATURES))
    spread = np.sqrt(_summed(rows, _moments(middle)) / n) + 1e-9 if n else np.ones(len(FEATURES))
    if not scarce:
        return Ranking(middle, spread, np.zeros(2 * len(FEATURES)), 0.0, 1.0)
    blocks = -(-n // BLOCK)
    copies = min(blocks, -(-LEAST_EACH * blocks // scarce))
    first = F.pmod(F.xxhash64("doc_id"), F.lit(blocks))
    every = F.sequence(F.lit(0), F.when(F.col("label") == (0 if count[0] == scarce else 1), copies - 1).otherwise(0))
    dealt = rows.withColumn("copy", F.explode(every)).select(
        ((first + F.col("copy")) % blocks).alias("block"), "label", "features")
    # A file has whole blocks and, far below the size of a row group, goes to one task.
    files = max(-(-blocks // 32), min(blocks, documents.sparkSession.sparkContext.defaultParallelism))
    dealt = written(dealt.repartition(files, "block").sortWithinPartitions("block", "label", F.xxhash64("features")), "blocks")
    w = _newton(lambda at: _summed(dealt, _block_sums(middle, spread, at)))
    model = Ranking(middle, spread, w, 0.0, 1.0)

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.raw(_matrix(batch.column(1))))], ["doc_id", "raw"])

    at = _cut_place(n, count[0])
    placed = running_number(
        rows.select("doc_id", "features").mapInArrow(raw, "doc_id long, raw double"), "raw", "doc_id", out="place")
    # Between the worst of the good share and the best of the rest.
    low, high = sorted(r[0] for r in placed.where(F.col("place").isin(at, at + 1)).select("raw").collect())
    return Ranking(middle, spread, w, (low + high) / 2, 1.0)


def score_quality(documents: DataFrame, model: Ranking) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (score of ``CUT`` or more) of every row of ``documents`` (doc_id, text).

    A null text is scored like the empty one, by a row of zeros.  Repeated rows and null ids
    are scored each; other columns are not read; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [model.score(text_features(data, offsets)) for _, _, data, offsets in slices(batch.column(1))]
            score = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array((score >= CUT).astype(np.int32))], ["doc_id", "score", "predicted"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, score double, predicted int")
