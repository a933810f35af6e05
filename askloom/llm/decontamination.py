"""Benchmark decontamination: short test items found inside long documents.

Items and documents are sets of five-word shingles; a document is contaminated by an item
if it contains at least three quarters of the item's shingles.  MinHash sees little of a
short item in a long document, so both are partitioned by size: items go to classes of
powers of two, and for each class a document is cut into overlapping windows of about
twice the class.  Window and item then have comparable sizes, and ``DRAWS`` min-hashes of
one row each find an item with a chance of missing it below 1e-5.  Items of fewer than
``SMALL`` shingles have windows of one shingle, which misses nothing.  Every candidate is
verified by exact containment in the whole document, so no wrong pair comes out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askloom.llm.tokens import distinct, mixed, shingles, slices, words

DRAWS = 64
SMALL = 8
BLOCK_BYTES = 32 << 20
OUT = "doc_id long, item_id long, n_shared long, n_item long, containment double"
MULTIPLIERS = mixed(np.arange(1, DRAWS + 1, dtype=np.uint64)) | np.uint64(1)
BITS = 16


@dataclass
class SizeClass:
    """Items of one class: for each draw its sorted min-hashes and their items."""

    size: int
    values: list[np.ndarray]
    owners: list[np.ndarray]

    @cached_property
    def bits(self) -> list[np.ndarray]:
        """Made where they are used, not sent."""
        return [_bits(v) for v in self.values]


@dataclass
class Items:
    ids: list
    sets: list[np.ndarray]
    classes: list[SizeClass]
    small_values: np.ndarray
    small_owners: np.ndarray
    small_bits: np.ndarray


def _bits(values: np.ndarray) -> np.ndarray:
    found = np.zeros(1 << BITS, bool)
    found[(values >> np.uint64(64 - BITS)).astype(np.int64)] = True
    return found


def _lookup(values: np.ndarray, bits: np.ndarray, known: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``values`` that are ``known`` and the owner of each match."""
    at = np.flatnonzero(bits[(values >> np.uint64(64 - BITS)).astype(np.int64)])
    low, high = np.searchsorted(known, values[at], "left"), np.searchsorted(known, values[at], "right")
    n = high - low
    hit = np.repeat(at, n)
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return hit, owners[np.repeat(low, n) + within]


def index_items(rows: list[tuple]) -> Items:
    """Index of (item_id, text) rows; texts without words are left out."""
    texts = pa.array([t for _, t in rows], pa.string())
    ids, sets = [], []
    for i, j, data, offsets in slices(texts):
        value, doc, _ = shingles(words(data, offsets))
        sets_of, first = distinct(value, doc, j - i)
        for d in range(j - i):
            if first[d + 1] > first[d]:
                ids.append(rows[i + d][0])
                sets.append(sets_of[first[d]:first[d + 1]])
    classes: dict[int, list[int]] = {}
    for k, s in enumerate(sets):
        classes.setdefault(0 if len(s) < SMALL else 1 << (len(s) - 1).bit_length(), []).append(k)
    small = classes.pop(0, [])
    values = np.concatenate([sets[k] for k in small]) if small else np.zeros(0, np.uint64)
    owners = np.repeat(small, [len(sets[k]) for k in small]).astype(np.int64)
    order = np.argsort(values, kind="stable")
    built = []
    for size, members in sorted(classes.items()):
        of = np.array(members, np.int64)
        vals, own = [], []
        for m in MULTIPLIERS:
            v = np.array([(sets[k] * m).min() for k in members], np.uint64)
            o = np.argsort(v, kind="stable")
            vals.append(v[o])
            own.append(of[o])
        built.append(SizeClass(size, vals, own))
    return Items(ids, sets, built, values[order], owners[order], _bits(values))


def candidates(value: np.ndarray, first: np.ndarray, items: Items) -> np.ndarray:
    """Distinct (document, item) pairs one of whose windows shares a min-hash; two columns."""
    found = []
    docs = len(first) - 1
    doc = np.repeat(np.arange(docs), np.diff(first))
    if len(items.small_values) and len(value):
        at, owner = _lookup(value, items.small_bits, items.small_values, items.small_owners)
        found.append(np.stack([doc[at], owner], 1))
    if items.classes and len(value):
        step = items.classes[0].size
        # Blocks of the smallest class, from the start of each document.
        counts = -(-np.diff(first) // step)
        block_first = np.zeros(docs + 1, np.int64)
        np.cumsum(counts, out=block_first[1:])
        block_doc = np.repeat(np.arange(docs), counts)
        starts = first[block_doc] + (np.arange(len(block_doc)) - block_first[block_doc]) * step
        for draw, m in enumerate(MULTIPLIERS):
            level, size = np.minimum.reduceat(value * m, starts), step
            for c in items.classes:
                while size < c.size:  # twice the block: with the next block of the same document
                    level = _with_later(level, block_doc, size // step)
                    size *= 2
                window = _with_later(level, block_doc, size // step)
                at, owner = _lookup(window, c.bits[draw], c.values[draw], c.owners[draw])
                if len(at):
                    found.append(np.stack([block_doc[at], owner], 1))
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)


def _with_later(level: np.ndarray, doc: np.ndarray, shift: int) -> np.ndarray:
    """Minimum of each window and the one ``shift`` blocks later in the same document."""
    out = level.copy()
    if shift < len(level):
        same = doc[shift:] == doc[:-shift]
        np.minimum(out[:-shift], level[shift:], out=out[:-shift], where=same)
    return out


def _found(items: Items, need: np.ndarray, texts: pa.Array) -> Iterator[tuple[int, int, int]]:
    """(row, item, shared shingles) of the texts that contain enough of an item."""
    for i, j, data, offsets in slices(texts):
        value, doc, _ = shingles(words(data, offsets))
        first = np.searchsorted(doc, np.arange(j - i + 1))
        last, own = -1, None
        for d, k in candidates(value, first, items):
            if d != last:
                last, own = d, np.unique(value[first[d]:first[d + 1]])
            want = items.sets[k]
            at = np.minimum(np.searchsorted(own, want), len(own) - 1)
            shared = int((own[at] == want).sum())
            if shared >= need[k]:
                yield i + int(d), int(k), shared


def _needed(items: Items, least: float) -> np.ndarray:
    return np.array([-(-round(len(s) * least * 1e9) // 10**9) for s in items.sets], np.int64)


def _search(items: Items, least: float):
    need = _needed(items, least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_shared", pa.int64()),
                            ("n_item", pa.int64()), ("containment", pa.float64())])
        for batch in batches:
            ids = batch.column(0)
            rows = [(ids[i].as_py(), items.ids[k], shared, len(items.sets[k]), shared / len(items.sets[k]))
                    for i, k, shared in _found(items, need, batch.column(1))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def _blocks(benchmark: DataFrame) -> Iterator[Items]:
    """Indexes of the distinct items, each of at most about ``BLOCK_BYTES`` of text."""
    queries = benchmark.select("item_id", "text").where("text IS NOT NULL").distinct()
    size = queries.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    blocks = int(-(-size // BLOCK_BYTES))
    for b in range(blocks):
        part = queries.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b) if blocks > 1 else queries
        items = index_items([(r["item_id"], r["text"]) for r in part.collect()])
        if items.ids:
            yield items


def contaminated(documents: DataFrame, benchmark: DataFrame, least: float = 0.75) -> DataFrame:
    """Pairs of ``documents`` (doc_id, text) and ``benchmark`` (item_id, text) rows, by whole texts.

    Returns doc_id, item_id, n_shared, n_item, containment, one row per document row and item
    that it contains to at least ``least``.  A text of one to four words has its whole
    sequence as its only shingle; null and empty texts contain nothing and are contained in
    nothing.  Repeated items count once, repeated document rows give a row each, ids may be
    null.  Other columns are not read; an empty table on either side gives no rows.

    The items are the stated queries.  They are read in blocks of at most ``BLOCK_BYTES`` of
    text, each sent to all tasks; the documents are scanned once per block and never shuffled.
    """
    scan = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = None
    for items in _blocks(benchmark):
        pairs = scan.mapInArrow(_search(items, least), OUT)
        found = pairs if found is None else found.unionByName(pairs)
    empty = scan.limit(0).select("doc_id", *(F.lit(None).cast(t).alias(n) for n, t in (f.split() for f in OUT.split(", ")[1:])))
    return empty if found is None else found


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, least: float = 0.75) -> DataFrame:
    """The rows of ``documents`` (any columns, with text) that contain no item, unchanged and in place.

    What contains an item is told as by ``contaminated``; repeated rows and null ids are judged each.
    """
    text = documents.columns.index("text")

    def without(items: Items):
        need = _needed(items, least)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[i for i, _, _ in _found(items, need, batch.column(text))]] = False
                yield batch.filter(pa.array(keep))

        return run

    kept = documents
    for items in _blocks(benchmark):
        kept = kept.mapInArrow(without(items), documents.schema)
    return kept
