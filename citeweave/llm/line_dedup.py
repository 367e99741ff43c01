"""Line deduplication with two Bloom filters.

A first pass fills, in each task, one filter with the hashes seen and one with the hashes
seen in at least two documents.  Filters of tasks merge segment by segment: a bit that two
tasks have both seen belongs to the second filter.  A second pass looks every line up in
that filter; only lines it suspects are shuffled, with their full keys, to be counted
exactly and to find the document that keeps them.  A filter that is too small for the data
makes more lines suspects, never a wrong result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import BLANK_BYTES, arrow_batches, id_and_text, named, prepare
from citeweave.sources.tables import staged

MIN_POINTS = 20  # keys with fewer code points stay
MIN_DOCUMENTS = 3  # keys found in fewer documents stay
FILTER_BITS = 1 << 26  # of each of the two filters: 8 MB
PROBES = 4
SEGMENT_BYTES = 1 << 16

_SEGMENTS = "segment int, seen binary, again binary"
_SEGMENTS_ARROW = pa.schema([("segment", pa.int32()), ("seen", pa.binary()), ("again", pa.binary())])
_SUSPECTS = "doc_id bigint, row_key bigint, key_hash binary, key binary, line_nos array<int>"
_SUSPECTS_ARROW = pa.schema([("doc_id", pa.int64()), ("row_key", pa.int64()), ("key_hash", pa.binary()),
                             ("key", pa.binary()), ("line_nos", pa.list_(pa.int32()))])
_RESULT = "struct<text:string,n_lines:bigint,n_dropped:bigint,kept_sha256:string>"
_RESULT_ARROW = pa.struct([("text", pa.string()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()),
                           ("kept_sha256", pa.string())])


def line_keys(text: bytes, min_points: int) -> dict[bytes, list[int]]:
    """Key -> numbers of the lines that have it, for keys long enough to count."""
    keys: dict[bytes, list[int]] = {}
    for number, line in enumerate(text.split(b"\n")):
        key = line.strip(BLANK_BYTES).lower()
        if len(key) >= min_points and (key.isascii() or len(key.decode("utf-8", "replace")) >= min_points):
            keys.setdefault(key, []).append(number)
    return keys


def _positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """One row of bit numbers for each 64-bit hash, by double hashing."""
    step = (hashes >> np.uint64(17)) | np.uint64(1)
    probes = np.arange(PROBES, dtype=np.uint64)
    return ((hashes[:, None] + probes * step[:, None]) % np.uint64(bits)).astype(np.int64)


def _holds(filter_: np.ndarray, positions: np.ndarray) -> np.ndarray:
    return ((filter_[positions >> 3] >> (positions & 7).astype(np.uint8)) & 1).all(axis=1)


def _set(filter_: np.ndarray, positions: np.ndarray) -> None:
    flat = positions.ravel()
    np.bitwise_or.at(filter_, flat >> 3, np.left_shift(1, flat & 7).astype(np.uint8))


def _fill(bits: int, min_points: int):
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, again = (np.zeros(bits // 8, dtype=np.uint8) for _ in range(2))
        for batch in batches:
            found: list[int] = []
            for text in batch.column(1):
                found.extend(map(xxhash.xxh3_64_intdigest, line_keys(text.as_py().encode("utf-8"), min_points)))
            if not found:
                continue
            hashes, counts = np.unique(np.array(found, dtype=np.uint64), return_counts=True)
            positions = _positions(hashes, bits)
            twice = (counts > 1) | _holds(seen, positions)
            _set(again, positions[twice])
            _set(seen, positions)

        def rows() -> Iterator[tuple]:
            size = min(SEGMENT_BYTES, bits // 8)
            for segment, start in enumerate(range(0, bits // 8, size)):
                part = seen[start:start + size]
                if part.any():
                    yield segment, part.tobytes(), again[start:start + size].tobytes()

        yield from arrow_batches(rows(), _SEGMENTS_ARROW, lambda row: 2 * len(row[1]))

    return fill


def _merge_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments in order: what two tasks have seen has been seen again."""
    def rows() -> Iterator[tuple]:
        now, seen, again = None, None, None
        for batch in batches:
            for number, first, second in zip(*(batch.column(i) for i in range(3)), strict=True):
                one, two = (np.frombuffer(part.as_py(), dtype=np.uint8) for part in (first, second))
                if number.as_py() == now:
                    again |= two | (seen & one)
                    seen |= one
                else:
                    if now is not None:
                        yield now, b"", again.tobytes()
                    now, seen, again = number.as_py(), one.copy(), two.copy()
        if now is not None:
            yield now, b"", again.tobytes()

    yield from arrow_batches(rows(), _SEGMENTS_ARROW, lambda row: len(row[2]))


def seen_again(texts: DataFrame, bits: int = FILTER_BITS, min_points: int = MIN_POINTS) -> np.ndarray:
    """The second filter over all documents; ``bits / 8`` bytes at any size of the input."""
    parts = texts.select("doc_id", "text").mapInArrow(_fill(bits, min_points), _SEGMENTS)
    merged = parts.repartition("segment").sortWithinPartitions("segment").mapInArrow(_merge_segments, _SEGMENTS)
    whole = np.zeros(bits // 8, dtype=np.uint8)
    size = min(SEGMENT_BYTES, bits // 8)
    for row in merged.select("segment", "again").collect():  # bits / 8 bytes
        whole[row.segment * size:(row.segment + 1) * size] = np.frombuffer(row.again, dtype=np.uint8)
    return whole


def _suspect(filter_, min_points: int, bits: int):
    def suspect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for doc_id, row_key, text in zip(*(batch.column(i) for i in range(3)), strict=True):
                    keys = line_keys(text.as_py().encode("utf-8"), min_points)
                    if not keys:
                        continue
                    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), dtype=np.uint64, count=len(keys))
                    held = _holds(filter_.value, _positions(hashes, bits))
                    for (key, numbers), hit in zip(keys.items(), held, strict=True):
                        if hit:
                            yield doc_id.as_py(), row_key.as_py(), xxhash.xxh3_128_digest(key), key, numbers

        yield from arrow_batches(rows(), _SUSPECTS_ARROW, lambda row: 120 + len(row[3]) + 4 * len(row[4]))

    return suspect


def _without_lines(texts: pa.Array, drops: pa.Array) -> pa.Array:
    results = []
    for text, drop in zip(texts, drops, strict=True):
        whole, numbers = text.as_py() or "", drop.as_py()
        lines = whole.split("\n")
        gone = set(numbers or ())
        kept = "\n".join(line for number, line in enumerate(lines) if number not in gone) if gone else whole
        results.append({"text": kept, "n_lines": len(lines), "n_dropped": len(gone),
                        "kept_sha256": hashlib.sha256(kept.encode("utf-8")).hexdigest()})
    return pa.array(results, type=_RESULT_ARROW)


def dropped_lines(texts: DataFrame, min_points: int = MIN_POINTS, min_documents: int = MIN_DOCUMENTS,
                  filter_bits: int = FILTER_BITS) -> DataFrame:
    """``doc_id, row_key, drops``: for documents that lose lines the numbers of these lines.

    ``texts`` has ``doc_id, row_key, text``.
    """
    spark = texts.sparkSession
    again = spark.sparkContext.broadcast(seen_again(texts, filter_bits, min_points))
    suspects = staged(texts.select("doc_id", "row_key", "text")
                      .mapInArrow(_suspect(again, min_points, filter_bits), _SUSPECTS), "suspect-lines")
    # Two steps, so that the documents of a frequent line are counted in many tasks.
    held = suspects.groupBy("key_hash", "doc_id").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    confirmed = held.groupBy("key_hash").agg(
        F.count(F.lit(1)).alias("n_documents"), F.max("doc_id").alias("keep_id"),
        F.min("low").alias("low"), F.max("high").alias("high"))
    one_key = F.when(F.col("low") == F.col("high"), F.col("key_hash")).otherwise(
        F.raise_error("two different lines have the same 128-bit hash").cast("binary"))
    repeated = staged(confirmed.where(F.col("n_documents") >= min_documents)
                      .select(one_key.alias("key_hash"), "keep_id"), "repeated-lines")
    losing = suspects.select("doc_id", "row_key", "key_hash", "line_nos").join(repeated, "key_hash").where(
        ~F.col("doc_id").eqNullSafe(F.col("keep_id")))
    return losing.groupBy("doc_id", "row_key").agg(F.flatten(F.collect_list("line_nos")).alias("drops"))


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           min_points: int = MIN_POINTS, min_documents: int = MIN_DOCUMENTS,
                           filter_bits: int = FILTER_BITS) -> DataFrame:
    """``docs`` with ``text_col`` rid of repeated lines, plus a struct column ``_lines``.

    A text is split at line feeds; null or empty text is one empty line and comes out
    empty.  A line's key is the line with blanks stripped at both ends and A-Z
    lower-cased.  A key of at least ``min_points`` code points found in at least
    ``min_documents`` documents loses all its lines except in the largest id that holds
    it; there all its lines stay, also repeated ones.  Rows with the same id count as one
    document; rows without an id count as one that never keeps a line others hold.
    A document may lose all lines and then is empty.  All rows and other columns stay.

    ``_lines`` has ``text, n_lines, n_dropped, kept_sha256`` and takes the place of a column of that name.
    """
    prepare(docs.sparkSession)
    texts = id_and_text(docs, id_col, text_col).withColumn("row_key", F.xxhash64("doc_id", "text"))
    drops = dropped_lines(texts, min_points, min_documents, filter_bits).select(
        F.col("doc_id").alias("_ld_id"), F.col("row_key").alias("_ld_key"), F.col("drops").alias("_ld_drops"))
    own_id = named(id_col).cast("bigint")
    own_key = F.xxhash64(own_id, F.coalesce(named(text_col), F.lit("")))
    keyed = docs.withColumns({"_ld_own_key": own_key, "_ld_own_id": own_id})
    joined = keyed.join(drops, (F.col("_ld_own_key") == F.col("_ld_key"))
                        & F.col("_ld_own_id").eqNullSafe(F.col("_ld_id")), "left")
    return joined.withColumn("_lines", F.arrow_udf(_without_lines, _RESULT)(
        named(text_col), F.col("_ld_drops"))).drop(
        "_ld_own_key", "_ld_own_id", "_ld_key", "_ld_id", "_ld_drops")
