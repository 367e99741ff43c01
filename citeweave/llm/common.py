"""Shared small parts of the operators: columns of documents, Arrow batches, hashes."""

from __future__ import annotations

import ctypes
import functools
import zlib
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.session import ship_package

# The white space of every contract here, and its complement.
BLANKS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
BLANK_BYTES = b" \t\n\x0b\x0c\r"

# A batch that a Python task hands back holds about this many bytes.
BATCH_BYTES = 4 << 20
# Rows in a batch that a Python task is given: texts may be long.
BATCH_ROWS = 500


def named(column: str) -> Column:
    """The column of this very name, dots and all."""
    return F.col(f"`{column}`")


def prepare(spark: SparkSession) -> None:
    """Make the package importable in tasks, and bound the Arrow batches of the session.

    The session's own bound stays if it is smaller.
    """
    ship_package(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if not 0 < now <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Two columns ``doc_id`` (long) and ``text`` (null as empty); others are left out.

    Reading only these prunes the scan, and no further column of ``docs`` can
    clash with a working column.
    """
    prepare(docs.sparkSession)
    return docs.select(named(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(named(text_col), F.lit("")).alias("text"))


def arrow_batches(rows: Iterable[tuple], schema: pa.Schema,
                  weigh: Callable[[tuple], int] = lambda row: 64) -> Iterator[pa.RecordBatch]:
    """Batches of about :data:`BATCH_BYTES` from rows, so that no output is held whole."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += weigh(row)
        if size >= BATCH_BYTES:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns: list[Any] = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(values, type=field.type) for values, field in zip(columns, schema, strict=True)], schema=schema)


@functools.cache
def _trim() -> Callable[[int], int]:
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda pad: 0)


def give_back() -> None:
    """Hand memory that was freed back to the system.

    A Python worker lives on after its task, and so does what its allocators hold; the workers
    of the next stage would have to fit in beside it.
    """
    pa.default_memory_pool().release_unused()
    _trim()(0)


def giving_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task's function over batches that gives memory back at its end."""
    @functools.wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def remainder(doc_id: int | None, divisor: int) -> int:
    """CRC-32 of the id as text, modulo ``divisor``; -1 without an id."""
    return -1 if doc_id is None else zlib.crc32(str(doc_id).encode()) % divisor


def mixed(values: np.ndarray) -> np.ndarray:
    """Each 64-bit value stirred so that every bit of it reaches every bit of the result."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
