"""Embedding a text column with a pluggable model.

An embedder factory is a zero-argument callable that returns a function
``list[str] -> float array (n, dim)``.  It is called once per task, so a real model
is loaded once and then fed parts of Arrow batches.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askloom.config import EMBEDDING_DIM
from askloom.functions.batches import parts_of
from askloom.functions.text import as_column, tokens
from askloom.operators.hooks import Hook

Embedder = Callable[[list[str]], np.ndarray]
EmbedderFactory = Callable[[], Embedder]

TOKENS_REMEMBERED = 1 << 17


def token_bucket(token: Column, dim: int = EMBEDDING_DIM) -> Column:
    """Bucket of a token: the first 8 hex digits of its MD5, modulo ``dim``."""
    return (F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("bigint") % dim).cast("int")


def token_buckets(text: Column | str, dim: int = EMBEDDING_DIM) -> Column:
    """The default embedder's bucket sequence as a column expression."""
    return F.transform(tokens(text), lambda t: token_bucket(t, dim))


def hashing_embedder(dim: int = EMBEDDING_DIM) -> EmbedderFactory:
    """Default model: counts of hashed tokens.  Deterministic, needs no files."""

    def load() -> Embedder:
        find = re.compile(r"[^\W_]+").findall
        known: dict[str, int] = {}

        def bucket(token: str) -> int:
            if len(known) >= TOKENS_REMEMBERED:
                known.clear()
            known[token] = value = int.from_bytes(md5(token.encode()).digest()[:4], "big") % dim
            return value

        def embed(texts: list[str]) -> np.ndarray:
            cells = array("q")
            for row, text in enumerate(texts):
                base = row * dim
                for token in find(text.lower()):
                    at = known.get(token)
                    cells.append(base + (bucket(token) if at is None else at))
            counts = np.bincount(np.frombuffer(cells, np.int64) if cells else np.zeros(0, np.int64), minlength=len(texts) * dim)
            return counts.reshape(len(texts), dim)

        return embed

    return load


def embed_text(
    text: Column | str, factory: EmbedderFactory | None = None, normalize: bool = True
) -> Column:
    """``ARRAY<FLOAT>`` of a text column; NULL for NULL text and for the zero vector.

    ``normalize=False`` keeps the model's own lengths.
    """
    load = factory or hashing_embedder()

    @F.arrow_udf("array<float>")
    def embed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = load()

        def part_of_batch(part: pa.Array) -> pa.Array:
            present = np.asarray(part.is_valid())
            texts = [t for t in part.to_pylist() if t is not None]
            vectors = np.asarray(model(texts) if texts else np.zeros((0, 1)), dtype=np.float64)
            norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
            if normalize:
                vectors = vectors / np.where(norms > 0, norms, 1.0)[:, None]
            return _to_arrow(vectors[norms > 0].astype(np.float32), _place(present, norms > 0))

        for batch in batches:
            yield pa.concat_arrays([part_of_batch(part) for part in parts_of(batch)])

    return embed(as_column(text))


VECTOR_OR_ERROR = pa.struct([("vector", pa.list_(pa.float32())), ("error", pa.string())])


def embed_or_error(
    text: Column | str, factory: EmbedderFactory | None = None, time_limit: float | None = None
) -> Column:
    """``STRUCT<vector, error>``: like ``embed_text``, but a failing model does not stop the job.

    A failing call is repeated text by text, so an error stays with its own row; for
    ``time_limit`` seconds a call see ``hooks.Hook``.
    """
    return F.get(embed_each(F.array(as_column(text)), factory, time_limit), F.lit(0))


def embed_each(
    texts: Column | str, factory: EmbedderFactory | None = None, time_limit: float | None = None
) -> Column:
    """``ARRAY<STRUCT<vector, error>>`` of an array of texts; all texts of a batch of rows are one call.

    NULL for a NULL text and a NULL array.
    """
    load = factory or hashing_embedder()

    def unit(vector: np.ndarray) -> np.ndarray | None:
        norm = float(np.sqrt(vector @ vector))
        return (vector / norm).astype(np.float32) if norm > 0 else None

    @F.arrow_udf("array<struct<vector:array<float>,error:string>>")
    def embed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = load()
        hook = Hook(lambda some: np.asarray(model(some), dtype=np.float64), time_limit)
        for batch in batches:
            rows = batch.to_pylist()
            made = iter(hook.outcomes([t for row in rows for t in row or () if t is not None]))

            def place(text: str | None) -> dict | None:
                if text is None:
                    return None
                found = next(made)
                return {"vector": None if found.error else unit(found.value), "error": found.error}

            yield pa.array([None if row is None else [place(t) for t in row] for row in rows], pa.list_(VECTOR_OR_ERROR))

    return embed.asNondeterministic()(as_column(texts))


def _place(present: np.ndarray, usable: np.ndarray) -> np.ndarray:
    mask = present.copy()
    mask[present] = usable
    return mask


def _to_arrow(vectors: np.ndarray, filled: np.ndarray) -> pa.Array:
    """List array with the vectors at the filled rows and NULL elsewhere; the values are
    handed over as one flat buffer, without Python objects."""
    ends = np.concatenate([[0], np.cumsum(filled)]) * vectors.shape[1]
    offsets = pa.array(ends.astype(np.int32), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(vectors.ravel()), mask=pa.array(~filled))


def embed(
    df: DataFrame,
    factory: EmbedderFactory | None = None,
    text: str = "text",
    vector: str = "embedding",
    normalize: bool = True,
) -> DataFrame:
    """Add the vector of ``text``; used for chunks and for questions alike."""
    return df.withColumn(vector, embed_text(text, factory, normalize))


def nonzero(df: DataFrame, *keys: str, vector: str = "embedding") -> DataFrame:
    """Long form ``(keys, bucket, weight)`` of the non-zero components.

    The outer generator keeps the optimizer from putting a non-empty test on the vector
    below the model, which would run the model twice; NULL weights fall to the filter.
    """
    return df.select(*keys, F.posexplode_outer(vector).alias("bucket", "weight")).where("weight <> 0")
