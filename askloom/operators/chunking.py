"""Chunk generators.

``window_chunks`` is built from column functions only.  ``recursive_chunks`` needs a
look-ahead that no built-in offers, so its cut points come from a small Arrow function;
documents are independent, so nothing is shuffled.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askloom.config import CHUNK_OVERLAP, CHUNK_SIZE, SEPARATORS, check_chunking
from askloom.functions.batches import parts_of
from askloom.functions.text import as_column, bind


def windows(text: Column | str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """Character windows of ``size``, each sharing ``overlap`` characters with the next.

    The text is cut once into blocks of ``size - overlap`` characters and every block is
    extended by the start of the blocks after it, so the cost is linear in the length
    (``substring`` from the start for each window would be quadratic).
    """
    check_chunking(size, overlap)
    text, step = as_column(text), size - overlap
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{step}}}"), F.lit(0))
    length = F.char_length(text)
    count = F.greatest(
        F.when(length == 0, 0).otherwise(1), F.ceil((length - overlap) / F.lit(step)).cast("int")
    )
    reach = -(-overlap // step)

    def build(bound: Column) -> Column:
        def extend(block: Column, at: Column) -> Column:
            following = F.array_join(F.slice(bound, at + 2, F.lit(reach)), "")
            return F.concat(block, F.substring(following, 1, overlap))

        return F.transform(F.slice(bound, 1, count), extend if overlap else lambda block: block)

    return bind(blocks, build)


def window_chunks(
    documents: DataFrame,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    text: str = "text",
) -> DataFrame:
    """One row per window; every other column of the document is carried along."""
    return _generate(documents, windows(text, size, overlap), text)


def recursive_chunks(
    documents: DataFrame,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    separators: Sequence[str] = SEPARATORS,
    text: str = "text",
) -> DataFrame:
    """Chunks cut at the coarsest separator that keeps them within ``size``.

    Every other column of the document is carried along.
    """
    return _generate(documents, recursive_pieces(text, size, overlap, separators), text)


def _generate(documents: DataFrame, pieces: Column, text: str) -> DataFrame:
    kept = [c for c in documents.columns if c != text]
    return documents.select(*kept, F.posexplode(pieces).alias("chunk_no", text))


def recursive_pieces(
    text: Column | str,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    separators: Sequence[str] = SEPARATORS,
) -> Column:
    check_chunking(size, overlap)
    ladder = tuple(separators)

    @F.arrow_udf("array<string>")
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.concat_arrays([pa.array(
                [None if t is None else split_text(t, size, overlap, ladder) for t in part.to_pylist()], pa.list_(pa.string()))
                for part in parts_of(batch)])

    return cut(as_column(text))


def split_text(text: str, size: int, overlap: int, separators: Sequence[str]) -> list[str]:
    """Split one document.

    A separator stays with the text after it, hence every chunk is a slice of the
    document and only offsets are handled until the end.
    """
    chunks: list[str] = []
    # Each level: cut points, first piece not handled yet, separators for longer pieces.
    levels = [[*_cut_points(text, 0, len(text), separators), 0]]
    while levels:
        bounds, rest, run = levels[-1]
        last = len(bounds) - 1
        # Short pieces are packed together up to the next long one.
        long = next((i for i in range(run, last) if bounds[i + 1] - bounds[i] >= size), last)
        _pack(text, bounds, run, long, size, overlap, chunks)
        if long == last:
            levels.pop()
            continue
        levels[-1][2] = long + 1
        lo, hi = bounds[long], bounds[long + 1]
        if rest:
            levels.append([*_cut_points(text, lo, hi, rest), 0])
        else:
            chunks.append(text[lo:hi])
    return chunks


def _cut_points(
    text: str, lo: int, hi: int, separators: Sequence[str]
) -> tuple[Sequence[int], Sequence[str]]:
    """Offsets at which the first separator that occurs cuts the range, and the rest."""
    for used, separator in enumerate(separators, 1):
        if separator == "":
            return range(lo, hi + 1), separators[used:]
        at = text.find(separator, lo, hi)
        if at < 0:
            continue
        bounds = [lo]
        while at >= 0:
            if at > lo:
                bounds.append(at)
            at = text.find(separator, at + len(separator), hi)
        bounds.append(hi)
        return bounds, separators[used:]
    return [lo, hi], ()


def _pack(
    text: str, bounds: Sequence[int], first: int, last: int, size: int, overlap: int, out: list[str]
) -> None:
    """Fill chunks greedily with the pieces between ``bounds[first]`` and ``bounds[last]``."""
    start = first
    while start < last:
        stop = bisect_right(bounds, bounds[start] + size, start, last + 1) - 1
        piece = text[bounds[start]:bounds[stop]].strip()
        if piece:
            out.append(piece)
        if stop == last:
            return
        # Step back over whole pieces, as far as the overlap and the next piece allow.
        earliest = max(bounds[stop] - overlap, bounds[stop + 1] - size)
        start = bisect_left(bounds, earliest, start, stop)


def chunk_report(documents: DataFrame, pieces: Column, *by: str) -> DataFrame:
    """Sections in, chunks out, longest chunk; counted before exploding, so one partial
    aggregate and no distinct is needed."""
    counted = documents.select(
        *by,
        F.size(pieces).alias("n"),
        F.array_max(F.transform(pieces, F.char_length)).alias("longest"),
    )
    return counted.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_sections"),
        F.sum("n").alias("n_chunks"),
        F.max("longest").alias("longest_chunk"),
    )


def check_chunk_size(chunks: DataFrame, size: int = CHUNK_SIZE, text: str = "text") -> DataFrame:
    """One row: number of chunks, number over the bound, longest, verdict."""
    length = F.char_length(text)
    return chunks.agg(
        F.count(F.lit(1)).alias("n_chunks"),
        F.count_if(length > size).alias("n_over"),
        F.max(length).alias("longest_chunk"),
        F.coalesce(F.bool_and(length <= size), F.lit(True)).alias("within_bound"),
    )
