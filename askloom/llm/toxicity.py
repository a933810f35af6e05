"""Toxicity by multiple-instance learning.

Labels are of documents, toxicity is of sentences.  A sentence's score is the logistic of
the weights of the words and word beginnings and endings it holds; a document's is the
noisy-or of its sentences: it is toxic unless every sentence is clean.  Trained from
document labels alone, the model so finds the sentences that offend.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askloom.llm.tokens import LOWER, mixed, prefix_hashes, slices, span_hashes, words

CUT = 0.7
#: Labelled documents that the fit takes at most (the bounded sample), and features kept.
TRAIN_DOCS, KEPT, LEAST_DOCS = 20_000, 4096, 4
AFFIX = range(3, 8)
#: Bytes of text taken at once: every word has about eleven features.
BYTES = 1 << 18
ROUNDS, RATE, RIDGE = 600, 0.15, 1e-4
#: Features of labelled documents that a round of the fit looks at together: what the driver holds besides the features.
AT_ONCE = 1 << 16
ENDS = np.zeros(256, bool)
ENDS[[10, 33, 46, 63]] = True
CORE = np.zeros(256, bool)
CORE[48:58] = CORE[65:91] = CORE[97:123] = CORE[128:] = True


def instances(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features of the words of each sentence.

    Returns the hash and the sentence of each feature, and for each sentence its document and
    its first and last byte (in the slice).  Words lose marks at both ends; their
    features are the whole, and beginnings and endings of 3 to 7 bytes.
    """
    data = LOWER[data]
    w = words(data, offsets)
    n = len(data)
    if not len(w.start):
        e = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), e, e, e, e, e
    # A sentence goes to the first end mark; it begins at the first word after that.
    marks = np.zeros(n + 1, np.int64)
    np.cumsum(ENDS[data], out=marks[1:])
    turn = marks[w.start]
    new = np.ones(len(turn), bool)
    new[1:] = (turn[1:] != turn[:-1]) | (w.doc[1:] != w.doc[:-1])
    sentence = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(turn)) - 1
    core, place = CORE[data], np.arange(n)
    after = np.minimum.accumulate(np.where(core, place, n)[::-1])[::-1]
    before = np.maximum.accumulate(np.where(core, place, -1))
    start, end = after[w.start], before[w.end - 1] + 1
    ok = np.flatnonzero((start < w.end) & (end > w.start))
    start, end, of = start[ok], end[ok], sentence[ok]
    sums = prefix_hashes(data)
    hashes, holders = [span_hashes(sums, start, end)], [of]
    for k in AFFIX:
        long = np.flatnonzero(end - start > k)
        hashes.append(mixed(span_hashes(sums, start[long], start[long] + k) + np.uint64(1)))
        hashes.append(mixed(span_hashes(sums, end[long] - k, end[long]) + np.uint64(2)))
        holders += [of[long], of[long]]
    return np.concatenate(hashes), np.concatenate(holders), w.doc[first], first, w.start[first], w.end[last]


@dataclass
class Model:
    """Sorted feature hashes with weights, the weight of every sentence, and the cut on document scores."""

    known: np.ndarray
    weights: np.ndarray
    base: float
    cut: float

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each known feature, -1 for the others."""
        if not len(self.known):
            return np.full(len(hashes), -1)
        bits = np.zeros(1 << 16, bool)
        bits[(self.known >> np.uint64(48)).astype(np.int64)] = True
        out = np.full(len(hashes), -1)
        likely = np.flatnonzero(bits[(hashes >> np.uint64(48)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.known, hashes[likely]), len(self.known) - 1)
        out[likely] = np.where(self.known[at] == hashes[likely], at, -1)
        return out

    def calibrated(self, clean: np.ndarray) -> np.ndarray:
        """Score from the log probability that all sentences are clean; the cut stands at ``CUT``."""
        toxic = np.clip(-np.expm1(clean), 1e-12, 1 - 1e-12)
        logit = np.log(toxic / (1 - toxic)) - np.log(self.cut / (1 - self.cut)) + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _held(known: Model, data: np.ndarray, offsets: np.ndarray):
    """Distinct (sentence, feature) places, and the sentences' documents, starts and ends."""
    hashes, of, doc, _, start, end = instances(data, offsets)
    at = known.places(hashes)
    ok = at >= 0
    pairs = np.unique(np.stack([of[ok], at[ok]], 1), axis=0)
    return pairs, doc, start, end


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


@dataclass
class Bags:
    """Labelled documents: label, number of sentences, and of each document the sentences with features, one after another.

    ``held`` is the number of features of each such sentence; ``first`` and ``first_feature`` are the n + 1
    places of the documents in ``held`` and in ``feature``.
    """

    label: np.ndarray
    number: np.ndarray
    first: np.ndarray
    held: np.ndarray
    first_feature: np.ndarray
    feature: np.ndarray

    def parts(self) -> Iterator[tuple[slice, slice, np.ndarray, np.ndarray, np.ndarray]]:
        """Whole documents of about ``AT_ONCE`` features together.

        Places of the documents and of their sentences, then the document of each sentence, and the sentence
        and the feature of each feature; documents and sentences are counted from the part's first.
        """
        a = 0
        while a < len(self.label):
            b = max(a + 1, int(np.searchsorted(self.first_feature, self.first_feature[a] + AT_ONCE, "right")) - 1)
            at = slice(self.first[a], self.first[b])
            doc = np.repeat(np.arange(b - a), np.diff(self.first[a:b + 1]))
            yield (slice(a, b), at, doc, np.repeat(np.arange(len(doc)), self.held[at]),
                   self.feature[self.first_feature[a]:self.first_feature[b]])
            a = b


def fit(known: np.ndarray, bags: Bags | None) -> Model:
    """Fit weights on labelled documents; with one label only no document is toxic."""
    k = len(known)
    empty = Model(known, np.zeros(k), -8.0, 0.5)
    if bags is None or not len(bags.label) or bags.label.min() == bags.label.max():
        return empty
    label, docs = bags.label.astype(np.float64), len(bags.label)
    plain = bags.number - np.diff(bags.first).astype(np.float64)
    w = np.append(np.zeros(k), -6.0)
    m, v = np.zeros(k + 1), np.zeros(k + 1)
    pull, each = np.empty(docs), np.empty(len(bags.held))

    def judged(doc: np.ndarray, sentence: np.ndarray, feature: np.ndarray, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weight of each sentence, and how likely each document is toxic."""
        z = np.bincount(sentence, weights=w[feature], minlength=len(doc)) + w[k]
        return z, -np.expm1(np.bincount(doc, weights=-_softplus(z), minlength=len(plain)) - plain * _softplus(w[k]))

    for step in range(1, ROUNDS + 1):  # Adam on the log likelihood of noisy-or
        slope = np.zeros(k + 1)
        for of, at, doc, sentence, feature in bags.parts():
            z, toxic = judged(doc, sentence, feature, plain[of])
            toxic = np.maximum(toxic, 1e-9)
            pull[of] = np.where(label[of] == 1, -(1 - toxic) / toxic, 1.0)
            each[at] = pull[of][doc] / (1 + np.exp(-z))
            np.add.at(slope, feature, each[at][sentence])
        slope[k] = each.sum() + (pull * plain).sum() / (1 + np.exp(-w[k]))
        slope /= docs
        slope[:k] += RIDGE * w[:k]
        m, v = .9 * m + .1 * slope, .999 * v + .001 * slope ** 2
        w = w - RATE * (m / (1 - .9 ** step)) / (np.sqrt(v / (1 - .999 ** step)) + 1e-8)
    toxic = np.concatenate([judged(doc, sentence, feature, plain[of])[1] for of, _, doc, sentence, feature in bags.parts()])
    # The cut with the best F1 on the training rows, in the middle of its gap.
    order = np.argsort(-toxic, kind="stable")
    hits = np.cumsum(label[order])
    best = 2 * hits / (np.arange(1, len(order) + 1) + label.sum())
    at = int(np.argmax(best))
    low = toxic[order[at + 1]] if at + 1 < len(order) else 0.0
    cut = float(np.clip(np.sqrt(max(low, 1e-9) * max(toxic[order[at]], 1e-9)), 1e-6, 0.999))
    return Model(known, w[:k], float(w[k]), cut)


def train_toxicity(documents: DataFrame, labels: DataFrame, sample: int = TRAIN_DOCS) -> Model:
    """Learn from ``labels`` (doc_id, label) and the texts of ``documents`` (doc_id, text).

    At most ``sample`` labelled rows are taken, the first ones by a hash of their id.  The
    ``KEPT`` features that tell the labels apart best (by the likelihood ratio of document
    counts) are fitted.  Labels other than 0 and 1 and null ids are left out.
    """
    chosen = labels.where("doc_id IS NOT NULL AND label IN (0, 1)").select("doc_id", "label").orderBy(
        F.xxhash64("doc_id"), "doc_id", "label").limit(sample)
    # At most ``sample`` rows of two numbers are sent to all tasks.
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(F.col("label").cast("long").alias("label"), "text")
    counts = texts.mapInArrow(_document_features, "label long, feature long").groupBy("feature").agg(
        F.sum("label").cast("double").alias("a"), F.sum(1 - F.col("label")).cast("double").alias("b"))
    total = chosen.agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b")).head()
    yes, no = float(total["a"] or 0), float(total["b"] or 0)
    if not yes or not no:
        return fit(np.zeros(0, np.uint64), None)
    part = F.lit(yes / (yes + no))
    n = F.col("a") + F.col("b")

    def term(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    ratio = term(F.col("a"), n * part) + term(F.col("b"), n * (1 - part))
    best = counts.where(n >= LEAST_DOCS).orderBy(ratio.desc(), "feature").limit(KEPT).select("feature").toPandas()
    known = np.sort(best["feature"].to_numpy(np.int64).view(np.uint64))
    bare = Model(known, np.zeros(len(known)), 0.0, 0.5)

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(0)
            for i, j, data, offsets in slices(batch.column(1), BYTES):
                pairs, doc, _, _ = _held(bare, data, offsets)
                new = np.flatnonzero(np.diff(pairs[:, 0], prepend=-1))  # the first feature of each sentence that has one
                places, holders = np.arange(j - i + 1), doc[pairs[:, 0]]
                yield pa.RecordBatch.from_arrays(
                    [label.slice(i, j - i), pa.array(np.bincount(doc, minlength=j - i).astype(np.int32)),
                     _lists(np.searchsorted(holders[new], places), np.diff(np.append(new, len(pairs)))),
                     _lists(np.searchsorted(holders, places), pairs[:, 1])],
                    ["label", "n", "held", "feature"])

    # Sorted, so that the fit depends on the order of rows as little as can be.
    rows = texts.mapInArrow(bags, "label long, n int, held array<int>, feature array<int>")
    rows = rows.withColumn("key", F.xxhash64("feature")).toArrow()
    rows = rows.take(pc.sort_indices(rows, [(c, "ascending") for c in ("label", "n", "key")]))
    (first, held), (first_feature, feature) = _flat(rows.column("held")), _flat(rows.column("feature"))
    return fit(known, Bags(rows.column("label").to_numpy(), rows.column("n").to_numpy(), first, held, first_feature, feature))


def _lists(bounds: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.astype(np.int32)))


def _flat(lists: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The n + 1 places of the lists in their values, and the values."""
    first = np.zeros(len(lists) + 1, np.int64)
    np.cumsum(pc.list_value_length(lists).to_numpy(), out=first[1:])
    return first, pc.list_flatten(lists).to_numpy()


def _document_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        label = batch.column(0).to_numpy()
        for i, j, data, offsets in slices(batch.column(1), BYTES):
            hashes, of, doc, *_ = instances(data, offsets)
            owner = doc[of]
            order = np.lexsort((hashes, owner))
            hashes, owner = hashes[order], owner[order]
            new = np.ones(len(hashes), bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(label[i:j][owner[new]]), pa.array(hashes[new].view(np.int64))], ["label", "feature"])


def _clean(model: Model, data: np.ndarray, offsets: np.ndarray, docs: int):
    """Log probability that all sentences of each document are clean, with the scores and places of sentences."""
    pairs, doc, start, end = _held(model, data, offsets)
    z = np.bincount(pairs[:, 0], weights=model.weights[pairs[:, 1]], minlength=len(doc)) + model.base
    return np.bincount(doc, weights=-_softplus(z), minlength=docs), z, doc, start, end


def drop_toxic(documents: DataFrame, model: Model) -> DataFrame:
    """The rows of ``documents`` (any columns, with text) that ``model`` does not reject, unchanged and in place.

    Null and empty texts stay; repeated rows and null ids are judged each.
    """
    text = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in slices(batch.column(text), BYTES):
                keep = model.calibrated(_clean(model, data, offsets, j - i)[0]) < CUT
                yield batch.slice(i, j - i).filter(pa.array(keep))

    return documents.mapInArrow(run, documents.schema)


def score_toxicity(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted, n_sentences and the worst sentence of every row of ``documents`` (doc_id, text).

    ``worst_start`` and ``worst_end`` are bytes of the UTF-8 text (end exclusive) and
    ``worst_score`` is that sentence's own score; null without a sentence.  Null and empty
    texts hold no sentence and are not toxic (the lowest score).  Repeated rows and null
    ids are scored each; of equally bad sentences the first is given; other columns are not
    read; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, j, data, offsets in slices(batch.column(1), BYTES):
                clean, z, doc, start, end = _clean(model, data, offsets, j - i)
                number, score = np.bincount(doc, minlength=j - i), model.calibrated(clean)
                first = np.zeros(j - i + 1, np.int64)
                np.cumsum(number, out=first[1:])
                for d in range(j - i):
                    if number[d]:
                        s = first[d] + int(np.argmax(z[first[d]:first[d + 1]]))
                        out.append((float(score[d]), int(number[d]), int(start[s] - offsets[d]), int(end[s] - offsets[d]),
                                    float(1 / (1 + np.exp(-z[s])))))
                    else:
                        out.append((float(score[d]), 0, None, None, None))
            columns = list(zip(*out)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(columns[0], pa.float64()), pa.array([int(s >= CUT) for s in columns[0]], pa.int32()),
                 pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64()),
                 pa.array(columns[4], pa.float64())],
                ["doc_id", "score", "predicted", "n_sentences", "worst_start", "worst_end", "worst_score"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, score double, predicted int, n_sentences long, worst_start long, worst_end long, worst_score double")
