"""Language-model scores by a probabilistic suffix tree.

The symbols are pairs of bytes of lower-cased words: a word's bytes two by two, the last pair
filled up with the space after it, and one symbol for the end of a text.  Texts and symbol
sequences so correspond one to one, and unseen words have a probability too.

A context is the up to ``DEPTH`` symbols before.  It becomes a state of the tree if it is
frequent enough and its next-symbol counts diverge from those of its parent (the context
without its oldest symbol) by more than chance and its size allow.  Next-symbol distributions
are discounted, and what is left goes to the parent's distribution.  A symbol is scored from
the longest suffix of what came before that is a state.

Counts are gathered from all training texts.  Which states and symbols are kept goes by the
divergence and by fixed least counts, whatever the size of the corpus, so the tree grows with
it.  It is sent to the tasks in blocks of about ``TREE_BLOCK`` next symbols, the vocabulary for
the base score in blocks of ``VOCABULARY_BLOCK`` words, and each pass over the texts takes one
block of both.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askloom.llm.frames import written
from askloom.llm.tokens import LOWER, Words, slices, words

DEPTH = 3
BITS = np.uint64(16)
END = 0x0A00
END_TOKEN = -0x5DEECE66D0A00B
DISCOUNT = 0.7
#: A state occurs so many times at least, a kept next symbol so many times.
LEAST_STATE, LEAST_NEXT = 8, 2
#: Gain in nats over the parent for each different next symbol.
GAIN_EACH = 1.0
HELD = 4 << 20
VOCABULARY_BLOCK = 8 << 20
#: Next symbols after two and three symbols that go to the tasks at once (about 12 bytes each).
TREE_BLOCK = 3 << 19


def symbols(data: np.ndarray, w: Words, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the documents one after another, and the n + 1 places where they start."""
    data = LOWER[data]
    pairs = (w.end - w.start) // 2 + 1
    place = np.cumsum(pairs) - pairs + w.doc  # one end symbol for every document before
    counts = np.bincount(w.doc, weights=pairs, minlength=docs).astype(np.int64) + 1
    first = np.zeros(docs + 1, np.int64)
    np.cumsum(counts, out=first[1:])
    out = np.full(first[-1], END, np.uint64)
    of = np.repeat(np.arange(len(pairs)), pairs)
    within = np.arange(len(of)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
    at, end = w.start[of] + 2 * within, w.end[of]
    padded = np.append(data, [0, 0]).astype(np.uint64)
    high = np.where(at < end, padded[np.minimum(at, len(data))], np.uint64(32))
    low = np.where(at + 1 < end, padded[np.minimum(at + 1, len(data))], np.where(at + 1 == end, np.uint64(32), np.uint64(0)))
    out[place[of] + within] = (high << np.uint64(8)) | low
    return out, first


def grams(symbol: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each symbol with the ``DEPTH`` symbols before it, the oldest in the highest bits; texts begin after ends."""
    within = np.arange(len(symbol)) - np.repeat(first[:-1], np.diff(first))
    key = symbol.copy()
    for k in range(1, DEPTH + 1):
        before = np.full(len(symbol), END, np.uint64)
        before[k:] = symbol[:-k] if k < len(symbol) else symbol[:0]
        before[within < k] = END
        key |= before << (BITS * np.uint64(k))
    return key


def _counted(values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate(values), return_counts=True) if values else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts (kind, key, n) of grams (kind 0) and words (kind 1) of training texts."""

    def rows(kind: int, values: list[np.ndarray]) -> pa.RecordBatch:
        key, n = _counted(values)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(key), kind, np.int32)), pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))], ["kind", "key", "n"])

    found, tokens, held, ends = [], [], 0, 0
    for batch in batches:
        for i, j, data, offsets in slices(batch.column(0)):
            w = words(data, offsets)
            found.append(grams(*symbols(data, w, j - i)))
            tokens.append(w.hash)
            held += len(found[-1])
            ends += j - i
            if held >= HELD:
                yield rows(0, found)
                yield rows(1, tokens)
                found, tokens, held = [], [], 0
    yield rows(0, found)
    yield rows(1, tokens)
    if ends:
        yield pa.RecordBatch.from_arrays(
            [pa.array([1], pa.int32()), pa.array([END_TOKEN], pa.int64()), pa.array([ends], pa.int64())], ["kind", "key", "n"])


@dataclass
class Tree:
    """For each depth the sorted states with the log10 of what they leave to the parent, and the kept
    next symbols with the log10 of their probabilities."""

    states: list[np.ndarray]
    left: list[np.ndarray]
    nexts: list[np.ndarray]
    chances: list[np.ndarray]

    def log10(self, key: np.ndarray) -> np.ndarray:
        """Log probability of each gram from its longest state."""
        out = np.zeros(len(key))
        open_ = np.arange(len(key))
        for d in range(DEPTH, -1, -1):
            own = _below(key[open_], d + 1)
            at, hit = _find(self.nexts[d], own)
            out[open_[hit]] += self.chances[d][at[hit]]
            open_ = open_[~hit]
            if d:
                at, hit = _find(self.states[d], _below(key[open_], d + 1) >> BITS)
                out[open_[hit]] += self.left[d][at[hit]]
            else:
                out[open_] += self.left[0][0] - 16 * np.log10(2)
        return out

    def blocks(self) -> int:
        return 1

    def block(self, b: int) -> Tree:
        return self


@dataclass
class StoredTree:
    """A tree too large for one block: for each depth the kept (key, n, total), read again for every block.

    A block has what follows some of all pairs of symbols, and what follows less than a pair,
    at most the grams of four bytes.  A gram is scored by the block of the pair before it.
    """

    levels: list[DataFrame]
    number: int

    def blocks(self) -> int:
        return self.number

    def block(self, b: int) -> Tree:
        pair = F.shiftrightunsigned("key", 16).bitwiseAND(_mask(2))
        own = F.shiftright(pair * PAIR_FACTOR, 16) % self.number == b
        return build_tree(_arrays(level.where(own) if d > 1 else level) for d, level in enumerate(self.levels))


#: Deals the pairs of symbols (32 bits) to blocks; the product stays below 2 to the 63.
PAIR_FACTOR = 1640531527


def _in_block(key: np.ndarray, b: int, blocks: int) -> np.ndarray:
    pair = (key >> BITS) & np.uint64(_mask(2))
    return ((pair * np.uint64(PAIR_FACTOR)) >> np.uint64(16)) % np.uint64(blocks) == np.uint64(b)


def _arrays(level: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    # Counts of 32 bits are half as wide on the driver, which holds one level of a block.
    narrow = level.agg(F.max("total")).head()[0] or 0
    kind = "int" if narrow < 1 << 31 else "long"
    key, n, total = _columns(level.select("key", F.col("n").cast(kind).alias("n"), F.col("total").cast(kind).alias("total")))
    return key.view(np.uint64), n, total


def _columns(frame: DataFrame) -> list[np.ndarray]:
    """The columns of ``frame`` as arrays of their own; what Arrow held is given back to the system."""
    table = frame.toArrow()
    columns = [np.concatenate([np.zeros(0, c.type.to_pandas_dtype()), *(x.to_numpy() for x in c.chunks)]) for c in table.columns]
    del table
    pa.default_memory_pool().release_unused()
    return columns


def _below(key: np.ndarray, count: int) -> np.ndarray:
    return key if count * 16 >= 64 else key & np.uint64((1 << (16 * count)) - 1)


def _find(table: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(key), np.int64), np.zeros(len(key), bool)
    at = np.minimum(np.searchsorted(table, key), len(table) - 1)
    return at, table[at] == key


def build_tree(levels: Iterable[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Tree:
    """From the kept (gram, count, count of its context) of every depth to chances.

    A gram's chance is its discounted share plus what the context leaves, by the parent.
    """
    tree, chances = Tree([], [], [], []), np.zeros(0)
    for d, (key, n, total) in enumerate(levels):
        order = np.argsort(key)
        key, share, total = key[order], n[order] - DISCOUNT, total[order]
        del order, n
        first = key >> BITS
        first = np.flatnonzero(np.append(True, first[1:] != first[:-1])) if len(key) else np.zeros(0, np.int64)
        states = key[first] >> BITS
        left = 1 - np.add.reduceat(share, first) / total[first] if len(first) else np.ones(0)
        share /= total
        del total
        rest = np.repeat(left, np.diff(np.append(first, len(key))))
        if d == 0:
            states, left = np.zeros(1, np.uint64), left if len(left) else np.ones(1)
            rest *= 2.0 ** -16
        else:
            at, hit = _find(tree.nexts[d - 1], _below(key, d))
            rest *= chances[at] if len(chances) else 0.0
            rest[~hit] = 0.0
            del at, hit
        share += rest
        chances = share
        tree.states.append(states)
        tree.left.append(np.log10(np.maximum(left, 1e-12)).astype(np.float32))
        tree.nexts.append(key)
        tree.chances.append(np.log10(chances).astype(np.float32))
    return tree


def _mask(count: int) -> int:
    return (1 << (16 * count)) - 1


def _context(key: Column) -> Column:
    return F.shiftrightunsigned(key, 16)


def learn_tree(counts: DataFrame) -> Tree | StoredTree:
    """Choose states from gram counts (key, n) and build the tree."""
    levels = {DEPTH: counts}
    for d in range(DEPTH - 1, -1, -1):
        own = levels[d + 1].groupBy(F.col("key").bitwiseAND(_mask(d + 1)).alias("key")).agg(F.sum("n").alias("n"))
        levels[d] = written(own, f"level{d}")
    total = levels[0].agg(F.sum("n")).head()[0] or 0
    chosen: dict[int, DataFrame] = {}
    sizes = {0: levels[0].agg(F.sum("n").alias("total")).select(F.lit(0).cast("long").alias("context"), "total")}
    for d in range(1, DEPTH + 1):
        sizes[d] = levels[d].groupBy(_context(F.col("key")).alias("context")).agg(F.sum("n").alias("total"), F.count("*").alias("types"))
        frequent = written(sizes[d].where(F.col("total") >= LEAST_STATE), f"frequent{d}")
        own = levels[d].withColumn("context", _context(F.col("key"))).join(frequent, "context")
        up = levels[d - 1].select(F.col("key").alias("up"), F.col("n").alias("n_up"), _context(F.col("key")).alias("context_up")).join(
            sizes[d - 1].select(F.col("context").alias("context_up"), F.col("total").alias("total_up")), "context_up")
        paired = own.withColumn("up", F.col("key").bitwiseAND(_mask(d))).join(up, "up")
        gain = F.sum(F.col("n") * F.log(F.col("n") / F.col("total") * F.col("total_up") / F.col("n_up")))
        chosen[d] = written(paired.groupBy("context").agg(gain.alias("gain"), F.first("total").alias("total"), F.first("types").alias("types")).where(
            F.col("gain") >= GAIN_EACH * F.col("types")).select("context", "total"), f"states{d}")
        sizes[d] = frequent
    for d in range(DEPTH, 1, -1):  # the suffixes of a state are states
        suffixes = chosen[d].select(F.col("context").bitwiseAND(_mask(d - 1)).alias("context")).distinct()
        chosen[d - 1] = sizes[d - 1].join(
            suffixes.unionByName(chosen[d - 1].select("context")).distinct(), "context").select("context", "total")
    kept = [(levels[0].where(F.col("n") >= LEAST_NEXT).withColumn("total", F.lit(total).cast("long")))]
    for d in range(1, DEPTH + 1):
        kept.append(levels[d].where(F.col("n") >= LEAST_NEXT).withColumn("context", _context(F.col("key"))).join(chosen[d], "context"))
    kept = [written(frame.select("key", "n", "total"), f"kept{d}") for d, frame in enumerate(kept)]
    blocks = max(1, -(-sum(level.count() for level in kept[2:]) // TREE_BLOCK))
    stored = StoredTree(kept, blocks)
    return stored.block(0) if blocks == 1 else stored


@dataclass
class Vocabulary:
    """Counts of training words in blocks by hash, number of training tokens and of distinct ones."""

    counts: DataFrame
    tokens: int
    distinct: int

    def blocks(self) -> int:
        return max(1, -(-self.distinct // VOCABULARY_BLOCK))

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        own = self.counts.where(F.pmod(F.xxhash64("key"), F.lit(self.blocks())) == b)
        key, n = _columns(own.select("key", F.col("n").cast("int" if self.tokens < 1 << 31 else "long").alias("n")))
        order = np.argsort(key.view(np.uint64))
        return key.view(np.uint64)[order], n[order]


def learn(training: DataFrame) -> tuple[Tree | StoredTree, Vocabulary]:
    """Count ``training`` (text: null is empty) once and build both models."""
    counts = written(training.select("text").mapInArrow(_gather, "kind int, key long, n long").groupBy("kind", "key").agg(
        F.sum("n").alias("n")), "counts")
    vocabulary = counts.where("kind = 1").select("key", "n")
    row = vocabulary.agg(F.sum("n"), F.count("*")).head()
    return learn_tree(counts.where("kind = 0").select("key", "n")), Vocabulary(vocabulary, row[0] or 0, row[1])


def score_texts(documents: DataFrame, tree: Tree | StoredTree, vocabulary: Vocabulary) -> DataFrame:
    """Scores of every row of ``documents`` (doc_id, text).

    Returns doc_id, n_tokens, n_known, train_tokens, base_score and score.  Null and empty texts are one
    end token.  Repeated rows and null ids are scored each; other columns are not read; an
    empty table gives no rows.  Without any training text nothing is known and the tree is
    uniform over all pairs of bytes.  With several blocks, equal rows have equal sums, so id and
    a hash of the text bring the sums of a row together.
    """
    whole = vocabulary.tokens + 0.1 * (vocabulary.distinct + 1)
    frame = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"), "text")
    passes = max(vocabulary.blocks(), tree.blocks())

    def sums(b: int) -> DataFrame:
        words_of = vocabulary.block(b) if b < vocabulary.blocks() else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        tree_of = tree.block(b) if b < tree.blocks() else None
        return frame.mapInArrow(_sums(*words_of, whole, tree_of, b, tree.blocks()),
                                "doc_id long, hash long, n_tokens long, n_known long, known double, score double")

    if passes == 1:
        out = sums(0)
    else:
        each = written(sums(0), "sums")
        for b in range(1, passes):
            each = each.unionByName(written(sums(b), "sums"))
        copies = F.count(F.lit(1)) / passes
        out = each.groupBy("doc_id", "hash").agg(
            F.max("n_tokens").alias("n_tokens"), F.round(F.sum("n_known") / copies).cast("long").alias("n_known"),
            (F.sum("known") / copies).alias("known"), (F.sum("score") / copies).alias("score"), copies.cast("int").alias("copies")
        ).withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    unknown = (F.col("n_tokens") - F.col("n_known")) * F.lit(float(np.log10(0.1 / whole)))
    return out.select("doc_id", "n_tokens", "n_known", (F.col("known") + unknown).alias("base_score"), "score",
                      F.lit(vocabulary.tokens).cast("long").alias("train_tokens"))


def _sums(keys: np.ndarray, counts: np.ndarray, whole: float, tree: Tree | None, b: int, blocks: int):
    """Of rows (doc_id, hash, text): the known words of one block of the vocabulary and the grams of block ``b`` of the tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([END_TOKEN]).view(np.uint64)
        at_end, knows_end = _find(keys, end)
        end_share = float(np.log10((counts[at_end[0]] + 0.1) / whole)) if knows_end[0] else 0.0
        for batch in batches:
            known, tokens, share, score = [], [], [], []
            for i, j, data, offsets in slices(batch.column(2)):
                docs = j - i
                w = words(data, offsets)
                tokens.append(np.diff(w.first) + 1)
                if len(keys):
                    kinds, of = np.unique(w.hash, return_inverse=True)
                    at, hit = _find(keys, kinds)
                    value = np.where(hit, np.log10((counts[at] + 0.1) / whole), 0.0)
                    known.append(np.bincount(w.doc, weights=hit[of], minlength=docs).astype(np.int64) + int(knows_end[0]))
                    share.append(np.bincount(w.doc, weights=value[of], minlength=docs) + end_share)
                else:
                    known.append(np.zeros(docs, np.int64))
                    share.append(np.zeros(docs))
                if tree is not None:
                    symbol, first = symbols(data, w, docs)
                    key = grams(symbol, first)
                    doc = np.repeat(np.arange(docs), np.diff(first))
                    if blocks > 1:
                        own = _in_block(key, b, blocks)
                        key, doc = key[own], doc[own]
                    each, of = np.unique(key, return_inverse=True)
                    score.append(np.bincount(doc, weights=tree.log10(each)[of], minlength=docs).astype(np.float64))
                else:
                    score.append(np.zeros(docs))
            if not known:
                continue
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)] + [pa.array(np.concatenate(x)) for x in (tokens, known, share, score)],
                ["doc_id", "hash", "n_tokens", "n_known", "known", "score"])

    return run
