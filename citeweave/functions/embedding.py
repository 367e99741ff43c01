"""Text embeddings through a pluggable encoder.

The encoder is the one thing here that runs in Python: Spark hands it Arrow
batches of texts and takes a float matrix back.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EMBEDDING_WIDTH = 384


class Encoder(Protocol):
    dim: int

    def encode(self, texts: list[str]) -> np.ndarray:
        """One float32 row of width ``dim`` for each text."""


class _Buckets(dict):
    """Word -> bucket, worked out on first sight and remembered up to a bound."""

    def __init__(self, dim: int, most: int = 500_000):
        self._dim, self._most = dim, most

    def __missing__(self, word: str) -> int:
        if len(self) >= self._most:
            self.clear()
        bucket = int(hashlib.md5(word.encode("utf-8")).hexdigest()[:8], 16) % self._dim
        self[word] = bucket
        return bucket


class HashingEncoder:
    """Deterministic bag of hashed words, scaled to length one.

    It needs no model file.  It does not carry the meaning a trained sentence
    model does; use :class:`SentenceModelEncoder` for that.
    """

    def __init__(self, dim: int = EMBEDDING_WIDTH):
        self.dim = dim
        self._bucket_of = _Buckets(dim)

    def encode(self, texts: list[str]) -> np.ndarray:
        counts = np.zeros((len(texts), self.dim))
        for row, text in enumerate(texts):
            buckets = np.fromiter(map(self._bucket_of.__getitem__, text.split()), dtype=np.int64)
            counts[row] = np.bincount(buckets, minlength=self.dim)
        lengths = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
        return (counts / np.where(lengths == 0, 1.0, lengths)).astype(np.float32)


class SentenceModelEncoder:
    """A sentence-transformers model saved in a folder every executor can read."""

    def __init__(self, path: str):
        try:
            from sentence_transformers import SentenceTransformer
        except ImportError as error:
            raise ImportError("SentenceModelEncoder needs sentence-transformers") from error
        self._model = SentenceTransformer(path)
        self.dim = self._model.get_sentence_embedding_dimension()

    def encode(self, texts: list[str]) -> np.ndarray:
        return self._model.encode(texts, convert_to_numpy=True)


@functools.lru_cache(maxsize=2)
def _built(encoder: type[Encoder], args: tuple) -> Encoder:
    return encoder(*args)


def embed_text(text: Column, encoder: type[Encoder] = HashingEncoder, *args) -> Column:
    """``array<float>`` per text; null for null.

    ``encoder(*args)`` is built in the Python worker, once for each, so weights
    are never shipped with a task.  Spark may not move or repeat the expression:
    a filter or an explode of the vectors would otherwise run the encoder twice.
    """

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = _built(encoder, args)
        for texts in batches:
            present = texts.notna().to_numpy()
            vectors: list[np.ndarray | None] = [None] * len(texts)
            if present.any():
                matrix = np.asarray(model.encode(texts[present].tolist()), dtype=np.float32)
                if matrix.shape != (present.sum(), model.dim):
                    raise ValueError(f"encoder returned {matrix.shape}, not one row of "
                                     f"{model.dim} for each of {present.sum()} texts")
                for at, vector in zip(np.flatnonzero(present), matrix, strict=True):
                    vectors[at] = vector
            yield pd.Series(vectors, index=texts.index, dtype=object)

    return encode.asNondeterministic()(text)


def embedding_wide(frame: DataFrame, column: str = "embedding",
                   width: int = EMBEDDING_WIDTH) -> DataFrame:
    """One float column ``embedding_<i>`` per dimension in place of the array."""
    rest = [f"`{name}`" for name in frame.columns if name != column]
    return frame.selectExpr(*rest, *[f"get(`{column}`, {i}) AS `{column}_{i}`" for i in range(width)])


def attach_vectors(frame: DataFrame, vectors: DataFrame, key: str, vector_key: str,
                   vector: str = "embedding") -> DataFrame:
    """Rows with precomputed vectors by key; null where there is none.

    Of several vectors of a key the smallest counts, so no row is repeated.  Rows without
    a key are not shuffled.
    """
    # The aggregate lies by key, as the join needs it.
    single = (vectors.select(F.col(vector_key).alias(key), F.col(vector)).where(F.col(key).isNotNull())
              .groupBy(key).agg(F.min(vector).alias(vector)))
    keyed = frame.where(F.col(key).isNotNull()).join(single, key, "left").select(*frame.columns, vector)
    kind = vectors.schema[vector].dataType
    return keyed.unionByName(frame.where(F.col(key).isNull()).withColumn(vector, F.lit(None).cast(kind)))
