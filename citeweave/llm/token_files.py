"""Token ids in Arrow files of equal-length sequences.

A shard is two Arrow files in the random-access form of the stream format (a stream of record
batches with a footer that says where each one begins).  ``...-ids.arrow`` has the columns
``ids`` and ``mask``, both lists of one fixed size: the ids of the shard's documents one after
another, cut into sequences of that size, and whether a place holds an id or fills up the last
sequence.  ``...-docs.arrow`` has ``doc_id, start, n_tokens`` of its documents in order, start
counted from the shard's first id.  All batches but the last have the same number of sequences,
so sequence ``i`` is found by division and, in a mapped file, seen without copying.

Documents are dealt to shards by range of their ids, so shards in order of their numbers hold
all documents in ascending order.  The table of shards, the manifest, is written by Spark and
lists only files of tasks that ended well: a file left behind by a lost executor is in no
manifest.
"""

from __future__ import annotations

import functools
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from citeweave.llm.bpe import WordSplitter, _tokenizer
from citeweave.llm.common import id_and_text
from citeweave.session import fresh_path
from citeweave.sources.tables import staged

SEQUENCE_LENGTH = 2_048
END_ID = 2
# Text bytes that a shard holds on average; the number of shards follows from it.
SHARD_BYTES = 64 << 20
# Sequences in a record batch.
BATCH_SEQUENCES = 128
# Rows of documents in a record batch.
BATCH_DOCS = 50_000
# A worker remembers the ids of up to twice so many words.
KNOWN_WORDS = 300_000

MANIFEST = ("shard int, ids_path string, docs_path string, n_docs bigint, n_tokens bigint, n_sequences bigint, "
            "sequence_length int")
_MANIFEST_ARROW = pa.schema([("shard", pa.int32()), ("ids_path", pa.string()), ("docs_path", pa.string()),
                             ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("n_sequences", pa.int64()),
                             ("sequence_length", pa.int32())])
_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
_READ = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
_READ_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def _spelling() -> dict[int, int]:
    """Byte -> the character that stands for it in the vocabulary: printable ones for themselves,
    the others for the characters from U+0100 on, in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [byte for byte in range(0x100) if byte not in plain]
    return {byte: 0x100 + place for place, byte in enumerate(others)}


_SPELLING = _spelling()


class _WordIds(dict):
    """Word -> its ids as bytes; what is not remembered is encoded by the tokenizer's model.

    Half of the words at most are dropped at a time: those not met since the last time.
    """

    def __init__(self, data: str, unit: str):
        super().__init__()
        tokenizer = _tokenizer(data)
        self._pieces = tokenizer.model.tokenize
        self._code = "H" if unit == "<u2" else "I"
        self._special = {token.content: self._bytes([number]) for number, token in tokenizer.get_added_tokens_decoder().items()}
        self._older: dict[str, bytes] = {}

    def _bytes(self, ids: list[int]) -> bytes:
        return array(self._code, ids).tobytes()

    def __missing__(self, word: str) -> bytes:
        held = self._older.get(word) or self._special.get(word)
        if held is None:
            spelled = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(_SPELLING)
            held = self._bytes([piece.id for piece in self._pieces(spelled)])
        self[word] = held
        return held

    def age(self) -> None:
        if len(self) > KNOWN_WORDS:
            self._older = dict(self)
            self.clear()


class Encoder:
    """Text -> ids, each word encoded once for as long as it is remembered."""

    def __init__(self, data: str, unit: str):
        self.split = WordSplitter(data)
        self.unit = unit
        self.ids_of = _WordIds(data, unit)

    def __call__(self, text: str) -> np.ndarray:
        self.ids_of.age()
        return np.frombuffer(b"".join(map(self.ids_of.__getitem__, self.split(text))), dtype=self.unit)


@functools.lru_cache(maxsize=1)
def _encoder(data: str, unit: str) -> Encoder:
    """One for all tasks that a worker process runs."""
    return Encoder(data, unit)


class ShardWriter:
    """Writes one shard as ids come in; holds one batch of sequences at a time."""

    def __init__(self, folder: str, name: str, length: int, unit: str, end_id: int):
        self.files, root = pafs.FileSystem.from_uri(folder)
        self.files.create_dir(root)
        self.paths = [f"{folder}/{name}-{part}.arrow" for part in ("ids", "docs")]
        self.length = length
        cell = pa.from_numpy_dtype(np.dtype(unit))
        self.schema = pa.schema([("ids", pa.list_(cell, length)), ("mask", pa.list_(pa.bool_(), length))],
                                {"sequence_length": str(length), "end_id": str(end_id),
                                 "batch_sequences": str(BATCH_SEQUENCES)})
        self.outputs = [self.files.open_output_stream(f"{root}/{name}-{part}.arrow") for part in ("ids", "docs")]
        self.ids = pa.ipc.new_file(self.outputs[0], self.schema)
        self.docs = pa.ipc.new_file(self.outputs[1], _DOCS)
        self.end = np.array([end_id], dtype=unit)
        self.held = np.zeros(BATCH_SEQUENCES * length, dtype=unit)
        self.filled = self.n_tokens = self.n_docs = self.n_sequences = 0
        self.entries: list[tuple[int | None, int, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        start = self.n_tokens
        self._put(ids)
        self._put(self.end)
        self.n_docs += 1
        self.entries.append((doc_id, start, self.n_tokens - start))
        if len(self.entries) >= BATCH_DOCS:
            self._write_docs()

    def _put(self, ids: np.ndarray) -> None:
        at = 0
        while at < len(ids):
            part = ids[at:at + len(self.held) - self.filled]
            self.held[self.filled:self.filled + len(part)] = part
            self.filled += len(part)
            self.n_tokens += len(part)
            at += len(part)
            if self.filled == len(self.held):
                self._write_ids()

    def _write_ids(self) -> None:
        sequences = -(-self.filled // self.length)
        cells = sequences * self.length
        self.held[self.filled:cells] = 0
        values = pa.array(self.held[:cells])
        mask = pa.array(np.arange(cells) < self.filled)
        self.ids.write_batch(pa.RecordBatch.from_arrays(
            [pa.FixedSizeListArray.from_arrays(column, self.length) for column in (values, mask)], schema=self.schema))
        self.n_sequences += sequences
        self.filled = 0

    def _write_docs(self) -> None:
        columns = zip(*self.entries, strict=True)
        self.docs.write_batch(pa.RecordBatch.from_arrays(
            [pa.array(values, pa.int64()) for values in columns], schema=_DOCS))
        self.entries = []

    def close(self) -> None:
        if self.filled:
            self._write_ids()
        if self.entries:
            self._write_docs()
        for part in (self.ids, self.docs, *self.outputs):
            part.close()


def _opened(path: str) -> pa.ipc.RecordBatchFileReader:
    """A local file mapped into memory, any other with reads of just the batches asked for."""
    files, at = pafs.FileSystem.from_uri(path)
    return pa.ipc.open_file(pa.memory_map(at) if isinstance(files, pafs.LocalFileSystem) else files.open_input_file(at))


class Sequences:
    """Random access to the sequences of one shard: ``sequences[i]`` gives ids and mask.

    Ids are a numpy view and the mask an Arrow slice of the file's own bytes where the file
    is mapped; nothing is copied and no other batch is touched.
    """

    def __init__(self, ids_path: str):
        self.reader = _opened(ids_path)
        settings = self.reader.schema.metadata
        self.length = int(settings[b"sequence_length"])
        self.per_batch = int(settings[b"batch_sequences"])
        self._last: tuple[int, pa.RecordBatch | None] = (-1, None)

    def __len__(self) -> int:
        batches = self.reader.num_record_batches
        return (batches - 1) * self.per_batch + self._batch(batches - 1).num_rows if batches else 0

    def _batch(self, number: int) -> pa.RecordBatch:
        if self._last[0] != number:
            self._last = number, self.reader.get_batch(number)
        return self._last[1]

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        if not 0 <= i < len(self):
            raise IndexError(i)
        batch, row = self._batch(i // self.per_batch), i % self.per_batch
        ids, mask = (batch.column(name).values.slice(row * self.length, self.length) for name in ("ids", "mask"))
        return ids.to_numpy(), mask

    def span(self, start: int, n: int) -> Iterator[np.ndarray]:
        """Views of ids ``start`` to ``start + n`` of the shard, one for each batch they lie in."""
        cells = self.per_batch * self.length
        while n > 0:
            number, at = divmod(start, cells)
            values = self._batch(number).column("ids").values
            part = values.slice(at, min(n, len(values) - at))
            if not len(part):
                raise ValueError("the shard ends before its last document")
            yield part.to_numpy()
            start, n = start + len(part), n - len(part)

    def n_tokens(self) -> int:
        """Places that hold an id, by the masks."""
        return sum(self.reader.get_batch(i).column("mask").values.true_count for i in range(self.reader.num_record_batches))


def write_token_files(docs: DataFrame, tokenizer_path: str, folder: str | None = None, id_col: str = "doc_id",
                      text_col: str = "text", length: int = SEQUENCE_LENGTH, end_id: int = END_ID,
                      shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write all texts' ids to shards below ``folder``; returns the manifest, a written table.

    Columns ``shard, ids_path, docs_path, n_docs, n_tokens, n_sequences, sequence_length`` and
    ``first_token``: the number of ids in all shards before.  Each text is encoded as the
    tokenizer gives for the whole text, without special tokens of its own, and followed by
    ``end_id``.  Ids are stored in two bytes if the vocabulary allows, else in four.
    ``folder`` is a path or address that all executors share (default: a fresh one below the
    shared work folder).

    A null text counts as empty and has the end id only.  Documents come in ascending order
    of id, rows without an id first; rows with the same id are ordered by a hash of their
    texts, and may lie in more than one shard, so a much repeated id is split.  Other columns
    are not looked at, whatever their names.  An empty table gives an empty manifest.

    Texts are shuffled once, by range.  A task sorts its share, which may spill, and holds
    one batch of sequences and the words and ids of one document, the longest of which
    decides its memory: some 100 bytes for each of its words.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        data = file.read()
    unit = "<u2" if max(_tokenizer(data).get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
    texts = id_and_text(docs, id_col, text_col)
    folder = folder or fresh_path(spark, "token-files")
    total = texts.agg(F.sum(F.octet_length("text") + 16).alias("n")).first()["n"] or 0
    keys = [F.col("doc_id").asc_nulls_first(), F.col("_tie"), F.col("_row")]
    ordered = (texts.withColumns({"_tie": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
               .repartitionByRange(max(1, -(-total // shard_bytes)), *keys)
               .sortWithinPartitions(*keys).select("doc_id", "text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        shard = context.partitionId()
        encode = _encoder(data, unit)
        writer = None
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                if writer is None:  # a shard without documents has no files
                    writer = ShardWriter(folder, f"shard-{shard:07d}-{context.taskAttemptId()}", length, unit, end_id)
                writer.add(doc_id.as_py(), encode(text.as_py()))
        if writer is not None:
            writer.close()
            row = [shard, *writer.paths, writer.n_docs, writer.n_tokens, writer.n_sequences, length]
            yield pa.RecordBatch.from_arrays(
                [pa.array([value], type=field.type) for value, field in zip(row, _MANIFEST_ARROW, strict=True)],
                schema=_MANIFEST_ARROW)

    written = staged(ordered.mapInArrow(write, MANIFEST), "shards")
    before = F.sum("n_tokens").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1))  # one row for each shard
    return staged(written.withColumn("first_token", F.coalesce(before, F.lit(0))), "manifest")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard in batch.to_pylist():
            sequences = Sequences(shard["ids_path"])
            if sequences.n_tokens() != shard["n_tokens"]:
                raise ValueError(f"the masks of {shard['ids_path']} do not hold the shard's ids")
            docs = _opened(shard["docs_path"])
            for part in (docs.get_batch(i) for i in range(docs.num_record_batches)):
                starts, sizes = (part.column(name).to_numpy() for name in ("start", "n_tokens"))
                sums = np.zeros(len(starts), dtype=np.int64)
                for i, (start, n) in enumerate(zip(starts.tolist(), sizes.tolist(), strict=True)):
                    value = 0
                    for ids in sequences.span(start, n):
                        value = zlib.crc32(ids.astype("<u4"), value)
                    sums[i] = value
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(starts + shard["first_token"]), part.column("n_tokens"), pa.array(sums)],
                    schema=_READ_ARROW)


def documents_in(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, read back from the files of a manifest.

    ``start`` counts the ids of all documents before it; the sum is over its ids as
    little-endian unsigned numbers of four bytes.  One task for each shard.
    """
    n = max(1, manifest.count())
    return manifest.select("ids_path", "docs_path", "n_tokens", "first_token").repartition(n).mapInArrow(_read, _READ)
