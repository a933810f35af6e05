"""Exact substring dedup by longest-previous-factor arrays.

A byte is removed if a string of ``WIDTH`` bytes that covers it also starts earlier: in a
document with a smaller id, or earlier in its own.  A place has such a string just if its
longest previous factor is ``WIDTH`` or more.  In suffix order the longest earlier match of a
place is with the nearest smaller place before or after it, so the factor is the larger of
the common prefixes with these two.

One suffix array of everything would go through one task.  Strings of ``WIDTH`` bytes that are
equal have the same smallest ``GRAM`` (by hash), at the same place in them.  The places whose strings
share one such anchor are a segment, and only segments of equal anchors can match:

1. Segments are dealt by their anchor; most anchors occur once and are dropped.  Of equal
   segments only the first stays, the others are removed whole.  Anchors with very
   many different segments are cut into single strings before, so that equal ones meet and
   nothing else does.
2. What is left, different segments of one anchor, is fetched from the texts.  Of their strings that have an
   equal one by hash, suffix order, common prefixes, nearest smaller places and factors are found for many
   anchors at once.
3. The spans found are joined to their documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askloom.llm.frames import written
from askloom.llm.tokens import _UP, buffers, mixed, prefix_hashes, slices, span_hashes
from askloom.operators.windows import running_number

WIDTH, GRAM = 100, 24
#: One of so many documents tells which anchors to cut: those with this many different segments there,
#: or as many as one in ``CUT_SHARE`` of these documents.
SAMPLED, CUT_LEAST, CUT_SHARE = 8, 64, 1000
#: Segments that a task holds before it merges equal ones; bytes of segments in one suffix array; bytes of text
#: cut at once, few enough for the work arrays to stay in the cache.
HELD, ARRAY_BYTES, CUT_BYTES = 1 << 19, 4 << 20, 1 << 17
LOW = np.uint64(0xFFFFFFFF)
SEGMENT = "anchor long, segment long, doc long, place long"


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Segments of documents: anchor and segment hash, first string, last string, distance of the anchor, document."""
    n, reach = len(data), WIDTH - GRAM + 1
    if n < WIDTH:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none, none
    sums = prefix_hashes(data)
    gram = mixed((sums[GRAM:] - sums[:-GRAM]) * _UP.upto(n - GRAM + 1))
    # The smallest hash of each window; a tie goes to the first place.
    least = (gram & ~LOW) | np.arange(n - GRAM + 1, dtype=np.uint64)
    span = 1
    while span * 2 <= reach:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    m = n - WIDTH + 1
    anchor = (np.minimum(least[:m], least[reach - span:reach - span + m]) & LOW).astype(np.int64)
    inside = np.arange(m) + WIDTH <= np.repeat(offsets[1:], np.diff(offsets))[:m]
    new = np.ones(m, bool)
    new[1:] = anchor[1:] != anchor[:-1]
    new[offsets[:-1][offsets[:-1] < m]] = True
    first = np.flatnonzero(new & inside)
    breaks = np.append(np.flatnonzero(new | ~inside), m)
    last = breaks[np.searchsorted(breaks, first, "right")] - 1
    away = anchor[first] - first
    whole = mixed(span_hashes(sums, first, last + WIDTH) ^ away.astype(np.uint64))
    doc = np.searchsorted(offsets, first, "right") - 1
    return gram[anchor[first]].view(np.int64), whole.view(np.int64), first, last, away, doc


def _singles(data, first, last):
    """Every string of the segments as a segment of its own: anchor and segment hash, place, segment number."""
    count = last - first + 1
    of = np.repeat(np.arange(len(first)), count)
    place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + first[of]
    own = span_hashes(prefix_hashes(data), place, place + WIDTH)
    return mixed(own ^ np.uint64(WIDTH)).view(np.int64), own.view(np.int64), place, of


def _packed(place, length, away):
    """Place in the document, number of further strings and distance of the anchor in one number."""
    return (place << 16) | (length << 8) | away


def _cut(cut: np.ndarray):
    """Segments (anchor, segment, doc, place) of rows (doc, text).

    Equal ones met together are merged into the first; the others are passed on under a
    key of their own, with the mark 0 for anchor-less, as already removed.
    """

    def merged(parts: list[tuple]) -> pa.RecordBatch:
        anchor, segment, doc, place = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((place, doc, segment, anchor))
        anchor, segment, doc, place = anchor[order], segment[order], doc[order], place[order]
        again = np.zeros(len(anchor), bool)
        again[1:] = (anchor[1:] == anchor[:-1]) & (segment[1:] == segment[:-1])
        key = mixed(mixed(doc.astype(np.uint64)) + place.astype(np.uint64)).view(np.int64)
        # A removed segment has segment hash 0 and a key that spreads it; real hashes are never 0.
        segment = np.where(segment == 0, 1, segment)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.where(again, key, anchor)), pa.array(np.where(again, 0, segment)), pa.array(doc), pa.array(place)],
            ["anchor", "segment", "doc", "place"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for i, j, data, offsets in slices(batch.column(1), CUT_BYTES):
                anchor, segment, first, last, away, doc = segments(data, offsets)
                split = np.isin(anchor, cut) if len(cut) else np.zeros(len(anchor), bool)
                whole = ~split
                parts.append((anchor[whole], segment[whole], keys[i:j][doc[whole]],
                              _packed(first[whole] - offsets[doc[whole]], (last - first)[whole], away[whole])))
                held += int(whole.sum())
                if split.any():
                    own, same, place, of = _singles(data, first[split], last[split])
                    d = doc[split][of]
                    parts.append((own, same, keys[i:j][d], _packed(place - offsets[d], np.int64(0), np.int64(0))))
                    held += len(own)
                if held >= HELD:
                    yield merged(parts)
                    parts, held = [], 0
        if held:
            yield merged(parts)

    return run


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, data, offsets in slices(batch.column(0), CUT_BYTES):
            anchor, segment, *_ = segments(data, offsets)
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(segment)], ["anchor", "segment"])


def _first_ones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by anchor, segment, document and place: what is removed or still open.

    Kept back for the next rows is one anchor.
    """

    def judged(cols: list[np.ndarray]) -> pa.RecordBatch:
        anchor, segment, doc, place = cols
        new = np.ones(len(anchor), bool)
        new[1:] = anchor[1:] != anchor[:-1]
        first = new.copy()
        first[1:] |= segment[1:] != segment[:-1]
        of = np.cumsum(new) - 1
        kinds = np.bincount(of, weights=first & (segment != 0))
        removed = (segment == 0) | ~first
        is_open = ~removed & (kinds[of] > 1)
        keep = removed | is_open
        return pa.RecordBatch.from_arrays(
            # The anchor of what is removed is not asked for any more.
            [pa.array(np.where(is_open, anchor, 0)[keep]), pa.array(doc[keep]), pa.array(place[keep]), pa.array(is_open[keep])],
            ["anchor", "doc", "place", "open"])

    kept = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy() for k in range(4)]
        if kept is not None:
            cols = [np.concatenate(c) for c in zip(kept, cols)]
        same = cols[0] == cols[0][-1]
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        kept = [c[cut:] for c in cols]
        if cut:
            yield judged([c[:cut] for c in cols])
    if kept is not None:
        yield judged(kept)


def _fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc, text, wanted: array of anchor and place) to (anchor, doc, place, bytes)."""
    for batch in batches:
        data, offsets = buffers(batch.column(1))
        wanted = batch.column(2)
        counts = np.diff(wanted.offsets.to_numpy())
        items = wanted.flatten()
        anchor, place = items.field(0).to_numpy(), items.field(1).to_numpy()
        of = np.repeat(np.arange(batch.num_rows), counts)
        start = offsets[of] + (place >> 16)
        size = WIDTH + ((place >> 8) & 255)
        for k in range(0, len(start), 1 << 14):
            s, n = start[k:k + (1 << 14)], size[k:k + (1 << 14)]
            places = np.zeros(len(n) + 1, np.int32)
            np.cumsum(n, out=places[1:])
            at = np.arange(places[-1]) - np.repeat(places[:-1], n) + np.repeat(s, n)
            held = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(places), pa.py_buffer(data[at].tobytes())])
            part = slice(k, k + (1 << 14))
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor[part]), pa.array(batch.column(0).to_numpy()[of[part]]), pa.array(place[part]), held],
                ["anchor", "doc", "place", "bytes"])


def suffix_order(data: np.ndarray, place: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings of ``WIDTH`` bytes at ``place``, equal ones by ``rank``, and common prefixes of neighbours."""
    strings = np.lib.stride_tricks.sliding_window_view(data, WIDTH)[place]
    order = np.lexsort((rank, np.ascontiguousarray(strings).view(f"S{WIDTH}").ravel()))
    strings = strings[order]
    common = np.zeros(len(place), np.int64)
    for k in range(1, len(place), 1 << 15):
        differ = strings[k - 1:k - 1 + (1 << 15)][:len(strings[k:k + (1 << 15)])] != strings[k:k + (1 << 15)]
        common[k:k + (1 << 15)] = np.where(differ.any(1), differ.argmax(1), WIDTH)
    return order, common


def previous_factors(rank: np.ndarray, common: np.ndarray, least: int = WIDTH) -> np.ndarray:
    """Longest previous factors of places in suffix order, exact from ``least`` on (smaller ones may be too small).

    ``rank`` is the text order of each place and ``common`` its common prefix with the place
    before.  Links to the nearest smaller place jump over larger ones all at once: what lies
    between a place and the place it points at is larger than both.
    """
    def one_side(rank: np.ndarray, common: np.ndarray) -> np.ndarray:
        n = len(rank)
        link, shared = np.arange(-1, n - 1), common.copy()
        if n:
            shared[0] = 0
        while True:
            go = np.flatnonzero((link >= 0) & (shared >= least))
            go = go[rank[link[go]] > rank[go]]
            if not len(go):
                break
            to = link[go]
            link[go], shared[go] = link[to], np.minimum(shared[go], shared[to])
        return np.where(link >= 0, shared, 0)

    before = one_side(rank, common)
    after = one_side(rank[::-1], np.append(common[1:], 0)[::-1])[::-1]
    return np.maximum(before, after)


def repeated(values: np.ndarray) -> np.ndarray:
    """Places of the values that occur more than once."""
    order = np.argsort(values)
    again = np.zeros(len(values), bool)
    again[1:] = values[order[1:]] == values[order[:-1]]
    again[:-1] |= again[1:]
    return np.sort(order[again])


def _factors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From open segments sorted by anchor: (doc, start, end) of the runs of removed bytes.

    Segments are gathered to about ``ARRAY_BYTES``, never parting one anchor.
    """

    def found(table: pa.Table) -> pa.RecordBatch:
        doc, packed = table.column(1).to_numpy(), table.column(2).to_numpy()
        data, offsets = buffers(table.column(3).combine_chunks())
        data, offsets = data[offsets[0]:offsets[-1]], offsets - offsets[0]
        count = np.diff(offsets) - WIDTH + 1
        of = np.repeat(np.arange(len(doc)), count)
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        start = (packed >> 16)[of] + within
        place = offsets[of] + within
        # Only strings that have an equal one by hash; the factors of the others are smaller.
        some = repeated(span_hashes(prefix_hashes(data), place, place + WIDTH))
        rank = np.empty(len(some), np.int64)
        rank[np.lexsort((start[some], doc[of[some]]))] = np.arange(len(some))
        order, common = suffix_order(data, place[some], rank)
        hit = np.zeros(len(of), bool)
        hit[some[order]] = previous_factors(rank[order], common) >= WIDTH
        # Runs of places next to each other in one segment.
        at = np.flatnonzero(hit)
        opens = np.ones(len(at), bool)
        opens[1:] = (np.diff(at) != 1) | (of[at[1:]] != of[at[:-1]])
        first = at[opens]
        last = at[np.append(np.flatnonzero(opens)[1:], len(at)) - 1] if len(at) else at
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[of[first]]), pa.array(start[first]), pa.array(start[last] + WIDTH)], ["doc", "start", "end"])

    kept: list[pa.Table] = []
    size = 0
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not table.num_rows:
            continue
        kept.append(table)
        size += table.column("bytes").nbytes
        if size >= ARRAY_BYTES:
            whole = pa.concat_tables(kept)
            anchor = whole.column(0).to_numpy()
            other = np.flatnonzero(anchor != anchor[-1])
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield found(whole.slice(0, cut))
                kept = [whole.slice(cut)]
                size = (whole.num_rows - cut) * size // whole.num_rows
    if kept:
        yield found(pa.concat_tables(kept))


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, text, spans) to the results of documents."""
    for batch in batches:
        data, offsets = buffers(batch.column(1))
        spans = batch.column(2)
        counts = np.diff(spans.offsets.to_numpy()) if len(spans) else np.zeros(0, np.int64)
        items = spans.flatten()
        start, end = items.field(0).to_numpy(zero_copy_only=False), items.field(1).to_numpy(zero_copy_only=False)
        bounds = np.concatenate([[0], np.cumsum(np.where(spans.is_valid().to_numpy(zero_copy_only=False), counts, 0))])
        size, removed, runs, kept = [], [], [], []
        for k in range(batch.num_rows):
            text = data[offsets[k]:offsets[k + 1]]
            s, e = start[bounds[k]:bounds[k + 1]], end[bounds[k]:bounds[k + 1]]
            gone = n = 0
            if len(s):
                depth = np.zeros(len(text) + 1, np.int64)
                np.add.at(depth, s, 1)
                np.add.at(depth, e, -1)
                out = np.cumsum(depth)[:-1] > 0
                gone = int(out.sum())
                n = int(out[0]) + int((out[1:] & ~out[:-1]).sum())
                text = text[~out]
            size.append(int(offsets[k + 1] - offsets[k]))
            removed.append(gone)
            runs.append(n)
            kept.append(hashlib.sha256(text.tobytes()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()),
             pa.array(kept, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def repeated_spans(documents: DataFrame) -> DataFrame:
    """(doc, start, end) of removed bytes of ``documents`` (doc: unique long, text); spans may overlap."""
    sample = documents.where(F.pmod(F.xxhash64("doc"), F.lit(SAMPLED)) == 0)
    many = max(CUT_LEAST, sample.count() // CUT_SHARE)
    # At most as many anchors as CUT_SHARE documents have.
    cut = sample.select("text").mapInArrow(_anchors, "anchor long, segment long").distinct().groupBy("anchor").count().where(
        F.col("count") >= many).select("anchor").toPandas()["anchor"].to_numpy(np.int64)
    dealt = documents.select("doc", "text").mapInArrow(_cut(np.sort(cut)), SEGMENT).repartition("anchor")
    judged = written(dealt.sortWithinPartitions("anchor", "segment", "doc", "place").mapInArrow(
        _first_ones, "anchor long, doc long, place long, open boolean"), "segments")
    start = F.shiftright("place", 16)
    end = start + F.shiftright("place", 8).bitwiseAND(255) + WIDTH
    copies = judged.where("NOT open").select("doc", start.alias("start"), end.alias("end"))
    wanted = judged.where("open").groupBy("doc").agg(F.collect_list(F.struct("anchor", "place")).alias("wanted"))
    fetched = documents.select("doc", "text").join(wanted, "doc").select("doc", "text", "wanted").mapInArrow(
        _fetched, "anchor long, doc long, place long, bytes binary")
    factors = fetched.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_factors, "doc long, start long, end long")
    return copies.unionByName(factors)


def remove_repeats(documents: DataFrame) -> DataFrame:
    """Lengths and hash of what stays of every row of ``documents`` (doc_id, text), see the top of this module.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and kept_sha256.  Texts
    are UTF-8 bytes, null is empty; a text shorter than ``WIDTH`` keeps all.  Rows with a null
    doc_id come after all others; rows that repeat an id are documents of their own, ordered
    by their text, so of equal rows the first keeps its text.  Other columns are not read; an
    empty table gives no rows.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    odd = rows.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").limit(1).count()
    if odd:  # ids do not tell the rows apart: number them
        rows = written(running_number(rows, F.col("doc_id").asc_nulls_last(), F.col("text").asc_nulls_first(), out="doc"), "numbered")
    else:  # none is null; said here, both joins with the texts share one shuffle of them
        rows = rows.where("doc_id IS NOT NULL").withColumn("doc", F.col("doc_id"))
    spans = repeated_spans(rows.select("doc", "text")).groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    joined = rows.select("doc", "text").join(spans, "doc", "left") if not odd else rows.join(spans, "doc", "left")
    return joined.select(F.col("doc_id") if odd else F.col("doc").alias("doc_id"), "text", "spans").mapInArrow(
        _without, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
