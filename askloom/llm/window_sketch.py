"""Exact substring dedup by words, behind a count-min prefilter.

A word goes if a window of ``WIDTH`` words that covers it also starts earlier: in a document
with a smaller id, or earlier in its own.  Most windows occur once; the prefilter finds these
without grouping them.

A window is counted under its least gram: of its grams of ``GRAM`` words the one with the smallest
hash, the first of equal ones.  Equal windows have it at the same place, so a gram is the least one
of some window at as many places as any of these windows has, or more.  Windows next to each
other mostly share a least gram; such a run is a segment and is counted once.

1. Every task keeps count-min sketches of the grams it reads.  A gram that is repeated in its
   sketch needs no other task.  The rest meet in slices of the hashes, where the sketches of the
   tasks are merged: one cell for a gram seen once, two for one repeated there.  A cell can only be
   too large, so no repeated window is lost; what is left out occurs once.
2. What the sketches call repeated is grouped exactly.  Of equal segments only the first stays; the
   others go whole.  Different first segments of one gram are opened, and their windows are grouped:
   all but the first window of each group go.
3. The starts of windows that go are joined to their documents.

A hot gram arrives in a slice as a few rows a task, equal segments are merged in the task that
reads them, and groups are only ever counted and their first place taken, never collected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askloom.llm.frames import written
from askloom.llm.tokens import _Powers, Words, buffers, mixed, slices, words
from askloom.operators.windows import running_number

WIDTH, GRAM = 20, 6
#: Bytes of text whose segments share a slice, on average: about 100,000 segments.
SLICE_BYTES = 8 << 20
#: Cells of one of the two rows of a sketch: a slice fills about a tenth.
CELLS = 1 << 20
#: Segments that a task holds before it counts them.
HELD = 1 << 19
LOW = np.uint64(0xFFFFFFFF)
#: What becomes of a segment: its slice decides, only its gram is counted, repeated, a later copy.
OPEN, SEEN, REPEATED, COPY = range(4)
DEALT = "slice int, state int, gram long, segment long, doc long, place long"
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95))
_UP = tuple(_Powers(b) for b in _BASES)
_DOWN = tuple(_Powers(np.uint64(pow(int(b), -1, 1 << 64))) for b in _BASES)


class _Spans:
    """Hashes of runs of words."""

    def __init__(self, hashes: np.ndarray, k: int = 0):
        self.k, self.n = k, len(hashes)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(mixed(hashes + np.uint64(k)) * _DOWN[k].upto(self.n), out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * _UP[self.k].upto(self.n + 1)[start] + (end - start).astype(np.uint64))


def segments(w: Words) -> tuple[np.ndarray, ...]:
    """Segments: gram and segment hash, document, first window (from the document's first word), number of windows."""
    n, reach = len(w.hash), WIDTH - GRAM + 1
    none = np.zeros(0, np.int64)
    if n < WIDTH:
        return none, none, none, none, none
    spans, at = _Spans(w.hash), np.arange(n - GRAM + 1)
    gram = spans.of(at, at + GRAM)
    # The smallest hash of each window; a tie goes to the first place.
    least = (gram & ~LOW) | at.astype(np.uint64)
    span = 1
    while span * 2 <= reach:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    m = n - WIDTH + 1
    if span < reach:
        least = np.minimum(least[:m], least[reach - span:reach - span + m])
    window = np.flatnonzero(w.doc[:m] == w.doc[WIDTH - 1:])
    if not len(window):
        return none, none, none, none, none
    low = (least[window] & LOW).astype(np.int64)
    opens = np.ones(len(window), bool)
    opens[1:] = low[1:] != low[:-1]
    first, low = window[opens], low[opens]
    count = np.diff(np.append(np.flatnonzero(opens), len(window)))
    whole = spans.of(first, first + count - 1 + WIDTH)
    doc = w.doc[first]
    return gram[low].view(np.int64), mixed(whole + (low - first).astype(np.uint64)).view(np.int64), doc, \
        first - w.first[doc], count


def _cells(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    g = mixed(gram.view(np.uint64) + np.uint64(1))
    return (g % np.uint64(CELLS)).astype(np.int64), ((g >> np.uint64(32)) % np.uint64(CELLS)).astype(np.int64)


class Sketch:
    """Two rows of counters that stop at 2."""

    def __init__(self):
        self.rows = np.zeros((2, CELLS), np.uint8)

    def add(self, gram: np.ndarray, times: np.ndarray | None = None) -> None:
        for row, cell in zip(self.rows, _cells(gram)):
            more = np.bincount(cell, times, CELLS)
            np.minimum(more + row, 2, out=more, casting="unsafe")
            row[:] = more

    def repeated(self, gram: np.ndarray) -> np.ndarray:
        one, two = _cells(gram)
        return np.minimum(self.rows[0, one], self.rows[1, two]) > 1


def _dealt(n_slices: int):
    """Segments of the rows (doc, text) with what the task's own sketch tells of them."""

    def judged(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        gram, segment, doc, place = (np.concatenate(c) for c in zip(*parts))
        # Of equal segments the first goes on; the others are later copies.
        order = np.lexsort((place, doc, segment, gram))
        gram, segment, doc, place = gram[order], segment[order], doc[order], place[order]
        state = np.full(len(gram), OPEN, np.int32)
        state[1:][(gram[1:] == gram[:-1]) & (segment[1:] == segment[:-1])] = COPY
        sketch = Sketch()
        sketch.add(gram)
        again = sketch.repeated(gram)
        state[again & (state == OPEN)] = REPEATED
        seen = np.unique(gram[again])
        spread = mixed(doc.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + place.view(np.uint64))
        home = np.where(state == OPEN, mixed(gram.view(np.uint64)), spread)
        none = np.zeros(len(seen), np.int64)
        home = (np.concatenate([home, mixed(seen.view(np.uint64))]) % np.uint64(n_slices)).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(home), pa.array(np.concatenate([state, np.full(len(seen), SEEN, np.int32)])),
             *(pa.array(np.concatenate(c)) for c in ((gram, seen), (segment, none), (doc, none), (place, none)))],
            ["slice", "state", "gram", "segment", "doc", "place"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            key = batch.column(0).to_numpy()
            for i, j, data, offsets in slices(batch.column(1)):
                gram, segment, doc, first, count = segments(words(data, offsets, False))
                parts.append((gram, segment, key[i:j][doc], first << 8 | count))
                held += len(gram)
                if held >= HELD:
                    yield judged(parts)
                    parts, held = [], 0
        if held:
            yield judged(parts)

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by slice: (gram, segment, doc, place, gone) of segments that the merged sketch calls repeated.

    Rows wait only while their cells say once, so no more wait than a sketch has cells.
    """
    state_of: dict[str, object] = {"slice": None, "sketch": None, "open": None}

    def out(cols: list[np.ndarray], gone: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array(gone)], ["gram", "segment", "doc", "place", "gone"])

    def counted(state: np.ndarray, cols: list[np.ndarray]) -> pa.RecordBatch:
        """Count rows of the present slice; give back what is known now and keep the rest."""
        counts, sketch = (state == OPEN) | (state == SEEN), state_of["sketch"]
        sketch.add(cols[0][counts], np.where(state[counts] == SEEN, 2, 1))
        waits = [np.concatenate(c) for c in zip(state_of["open"], [c[state == OPEN] for c in cols])]
        known = sketch.repeated(waits[0])
        state_of["open"] = [c[~known] for c in waits]
        sure = (state == REPEATED) | (state == COPY)
        return out([np.concatenate([c[sure], x[known]]) for c, x in zip(cols, waits)],
                   np.concatenate([state[sure] == COPY, np.zeros(known.sum(), bool)]))

    def flushed(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(parts).combine_chunks()
        home, state = table.column(0).to_numpy(), table.column(1).to_numpy()
        cols = [table.column(k).to_numpy() for k in range(2, 6)]
        first = np.concatenate([[0], np.flatnonzero(home[1:] != home[:-1]) + 1, [len(home)]])
        for a, b in zip(first[:-1], first[1:]):
            if home[a] != state_of["slice"]:
                state_of.update(slice=home[a], sketch=Sketch(), open=[np.zeros(0, np.int64)] * 4)
            yield counted(state[a:b], [c[a:b] for c in cols])

    parts, held = [], 0
    for batch in batches:
        if batch.num_rows:
            parts.append(batch)
            held += batch.num_rows
        if held >= HELD:
            yield from flushed(parts)
            parts, held = [], 0
    if parts:
        yield from flushed(parts)


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows (one, two, doc, place) of the wanted segments of rows (doc, text, places)."""
    for batch in batches:
        doc, wanted = batch.column(0).to_numpy(), batch.column(2)
        bounds = np.concatenate([[0], np.cumsum(np.diff(wanted.offsets.to_numpy()))])
        places = wanted.flatten().to_numpy()
        for i, j, data, offsets in slices(batch.column(1)):
            w = words(data, offsets, False)
            place = places[bounds[i]:bounds[j]]
            count = place & 255
            of = np.repeat(np.arange(j - i), np.diff(bounds[i:j + 1]))
            start = np.repeat(w.first[of] + (place >> 8), count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            of = np.repeat(of, count)
            one, two = (_Spans(w.hash, k).of(start, start + WIDTH).view(np.int64) for k in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(one), pa.array(two), pa.array(doc[i:j][of]), pa.array(start - w.first[of] << 8 | 1)],
                ["one", "two", "doc", "place"])


def repeated_windows(documents: DataFrame) -> DataFrame:
    """(doc, place) of runs of windows of ``documents`` (doc: unique long, text) that also start earlier.

    ``place`` is the first window of the run, from the document's first word, times 256, plus their number.
    """
    size = documents.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    n_slices = int(size // SLICE_BYTES) + 1
    dealt = documents.select("doc", "text").mapInArrow(_dealt(n_slices), DEALT).repartition("slice").sortWithinPartitions("slice")
    repeated = written(dealt.mapInArrow(_merged, "gram long, segment long, doc long, place long, gone boolean"), "repeated")
    held = repeated.where("NOT gone")
    at = F.struct("doc", "place")
    first = written(held.groupBy("gram", "segment").agg(F.min(at).alias("at")).select("gram", "at.doc", "at.place"), "first")
    copies = repeated.where("gone").select("doc", "place").unionByName(
        held.select("doc", "place").join(first.select("doc", "place"), ["doc", "place"], "left_anti"))
    # Written, so that the join below deals both sides itself and a hot gram's part can be split.
    several = written(first.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram"), "several")
    wanted = first.join(several, "gram").groupBy("doc").agg(F.collect_list("place").alias("places"))
    windows = written(documents.select("doc", "text").join(wanted, "doc").select("doc", "text", "places").mapInArrow(
        _opened, "one long, two long, doc long, place long"), "windows")
    firsts = windows.groupBy("one", "two").agg(F.min(at).alias("at")).select("at.doc", "at.place")
    return copies.unionByName(windows.select("doc", "place").join(firsts, ["doc", "place"], "left_anti"))


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, text, places) to the results of documents."""
    for batch in batches:
        places = batch.column(2)
        counts = np.where(places.is_valid().to_numpy(zero_copy_only=False), np.diff(places.offsets.to_numpy()), 0) if len(places) else []
        bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        items = places.flatten().to_numpy()
        size, removed, kept = [], [], []
        for i, j, data, offsets in slices(batch.column(1)):
            w = words(data, offsets, False)
            raw = data.tobytes()
            for d in range(j - i):
                a, b = w.first[d], w.first[d + 1]
                place = items[bounds[i + d]:bounds[i + d + 1]]
                depth = np.zeros(b - a + 1, np.int64)
                np.add.at(depth, place >> 8, 1)
                np.add.at(depth, (place >> 8) + (place & 255) - 1 + WIDTH, -1)
                stays = np.flatnonzero(np.cumsum(depth)[:-1] == 0) + a
                size.append(int(b - a))
                removed.append(int(b - a) - len(stays))
                kept.append(hashlib.sha256(b" ".join(
                    [raw[s:e] for s, e in zip(w.start[stays].tolist(), w.end[stays].tolist())])).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_sha256"])


def remove_repeated_words(documents: DataFrame) -> DataFrame:
    """Word counts and hash of what stays of every row of ``documents`` (doc_id, text), see the top of this module.

    Returns doc_id, n_words, n_removed and kept_sha256 (kept words joined by one space).  A null
    text has no words; a text of fewer than ``WIDTH`` words keeps all.  Rows with a null doc_id
    come after all others; rows that repeat an id are documents of their own, ordered by their
    text, so of equal rows the first keeps its words.  Other columns are not read; an empty table
    gives no rows.  Windows are told apart by two 64-bit hashes.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    odd = rows.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").limit(1).count()
    if odd:  # ids do not tell the rows apart: number them
        rows = written(running_number(rows, F.col("doc_id").asc_nulls_last(), F.col("text").asc_nulls_first(), out="doc"), "numbered")
    else:
        rows = rows.withColumn("doc", F.col("doc_id"))
    places = repeated_windows(rows.select("doc", "text")).groupBy("doc").agg(F.collect_list("place").alias("places"))
    joined = rows.select("doc_id", "doc", "text").join(places, "doc", "left") if odd else \
        rows.select("doc", "text").join(places, "doc", "left").withColumn("doc_id", F.col("doc"))
    return joined.select("doc_id", "text", "places").mapInArrow(
        _without, "doc_id long, n_words long, n_removed long, kept_sha256 string")
