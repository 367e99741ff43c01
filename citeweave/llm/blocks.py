"""Blocks of documents coded by their own distinct words.

A table of distinct words is joined back to texts by way of blocks: a block is a run of
documents of one input task, with a dictionary of its distinct words and, for each
document, the numbers of its words in it.  Only dictionary entries travel to the word
table, not every occurrence; what comes back is put in place by number.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from citeweave.llm.common import give_back, giving_back

# Bytes of text that a block holds, or one document if that is longer.
BLOCK_BYTES = 24 << 20

CODES = "block bigint, doc_ids array<bigint>, n_words array<int>, n_bytes array<bigint>, codes binary"
WORDS = "block bigint, pos int, word binary, n int, n_learned int"
_CODES_ARROW = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_words", pa.list_(pa.int32())),
                          ("n_bytes", pa.list_(pa.int64())), ("codes", pa.binary())])
_WORDS_ARROW = pa.schema([("block", pa.int64()), ("pos", pa.int32()), ("word", pa.binary()), ("n", pa.int32()),
                          ("n_learned", pa.int32())])
BOTH = f"{CODES}, pos int, word binary, n_learned int"
_BOTH_ARROW = pa.schema([*_CODES_ARROW, *(_WORDS_ARROW.field(name) for name in ("pos", "word", "n_learned"))])


class Block:
    """Documents of one block: ids, numbers of words, and codes one after another."""

    def __init__(self) -> None:
        self.numbers: dict = {}  # word (text or bytes) -> number, in order of first sight
        self.doc_ids: list[int | None] = []
        self.n_words: list[int] = []
        self.n_bytes: list[int] = []
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id: int | None, text: str, words: list) -> None:
        self.doc_ids.append(doc_id)
        self.n_words.append(len(words))
        n_bytes = len(text.encode("utf-8"))
        self.n_bytes.append(n_bytes)
        numbers = self.numbers
        for word in dict.fromkeys(words):
            if word not in numbers:
                numbers[word] = len(numbers)
        self.parts.append(np.fromiter(map(numbers.__getitem__, words), dtype=np.int32, count=len(words)))
        self.size += n_bytes

    def codes(self) -> np.ndarray:
        return np.concatenate(self.parts) if self.parts else np.zeros(0, dtype=np.int32)

    def key(self, partition: int, number: int) -> int:
        """A hash of place and content: a block made again from other rows has another key."""
        state = xxhash.xxh3_64(f"{partition}-{number}".encode())
        for word in self.numbers:
            state.update(_as_bytes(word) + b"\0")
        for part in self.parts:
            state.update(part)
        for doc_id in self.doc_ids:
            state.update(str(doc_id).encode() + b"\0")
        return state.intdigest() - (1 << 63)


def _as_bytes(word: str | bytes) -> bytes:
    return word.encode("utf-8") if isinstance(word, str) else word


def _blocks(batches: Iterator[pa.RecordBatch], split: Callable[[str], list],
            block_bytes: int) -> Iterator[tuple[int, Block]]:
    partition, number, block = TaskContext.get().partitionId(), 0, Block()
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
            whole = text.as_py()
            block.add(doc_id.as_py(), whole, split(whole))
            if block.size >= block_bytes:
                yield block.key(partition, number), block
                number, block = number + 1, Block()
                give_back()
    if block.doc_ids:
        yield block.key(partition, number), block


def _packed(codes: np.ndarray) -> bytes:
    """The bytes of all codes by significance, as many as the largest code needs; their number first."""
    n = max(1, (int(codes.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(codes.astype("<i4").view(np.uint8).reshape(-1, 4)[:, :n].T)
    return bytes([n]) + zstandard.compress(planes.tobytes(), 1)


def unpacked(data) -> np.ndarray:
    held = memoryview(data)
    planes = np.frombuffer(zstandard.decompress(held[1:]), dtype=np.uint8).reshape(held[0], -1)
    codes = planes[0].astype(np.int32)
    for i, plane in enumerate(planes[1:], 1):
        codes |= plane.astype(np.int32) << (8 * i)
    return codes


def coded(texts: DataFrame, split: Callable[[str], list], block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per block, columns :data:`CODES`; ``texts`` has ``doc_id, text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, block in _blocks(batches, split, block_bytes):
            row = [key, block.doc_ids, block.n_words, block.n_bytes, _packed(block.codes())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([value], type=field.type) for value, field in zip(row, _CODES_ARROW, strict=True)],
                schema=_CODES_ARROW)
            del block, row  # before the next one is filled

    return texts.mapInArrow(giving_back(run), CODES)


def dictionaries(texts: DataFrame, split: Callable[[str], list],
                 learned: Callable[[int | None], bool] = lambda doc_id: True,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per block and distinct word, columns :data:`WORDS`.

    ``n`` counts the word in the block, ``n_learned`` in those documents whose id is
    ``learned``.  Words come in batches, so a block's dictionary is sent piece by piece.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, block in _blocks(batches, split, block_bytes):
            size = len(block.numbers)
            counts, counts_learned = (np.zeros(size, dtype=np.int64) for _ in range(2))
            for doc_id, codes in zip(block.doc_ids, block.parts, strict=True):
                np.add.at(counts, codes, 1)
                if learned(doc_id):
                    np.add.at(counts_learned, codes, 1)
            words = iter(block.numbers)
            for start in range(0, size, 50_000):
                part = slice(start, start + 50_000)
                held = list(map(_as_bytes, itertools.islice(words, 50_000)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(held), key, dtype=np.int64)), pa.array(np.arange(start, start + len(held), dtype=np.int32)),
                     pa.array(held, pa.binary()), pa.array(counts[part].astype(np.int32)),
                     pa.array(counts_learned[part].astype(np.int32))], schema=_WORDS_ARROW)
            del block, words  # before the next one is filled

    return texts.mapInArrow(giving_back(run), WORDS)


def coded_with_words(texts: DataFrame, split: Callable[[str], list], learned: Callable[[int | None], bool],
                     block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of :func:`coded` and those of :func:`dictionaries` from one reading of the texts.

    Columns :data:`BOTH`; a row has ``codes`` or a ``word``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, block in _blocks(batches, split, block_bytes):
            codes, size = block.codes(), len(block.numbers)
            counted = np.repeat([learned(doc_id) for doc_id in block.doc_ids], block.n_words).astype(bool)
            counts = np.bincount(codes[counted], minlength=size).astype(np.int32)
            words = iter(block.numbers)
            for start in range(0, size, 50_000):
                held = list(map(_as_bytes, itertools.islice(words, 50_000)))
                yield _padded({"block": pa.array(np.full(len(held), key, dtype=np.int64)),
                               "pos": pa.array(np.arange(start, start + len(held), dtype=np.int32)),
                               "word": pa.array(held, pa.binary()),
                               "n_learned": pa.array(counts[start:start + len(held)])})
            row = {"block": key, "doc_ids": block.doc_ids, "n_words": block.n_words, "n_bytes": block.n_bytes,
                   "codes": _packed(codes)}
            yield _padded({name: pa.array([value], type=_BOTH_ARROW.field(name).type) for name, value in row.items()})
            del block, words, codes, counted, row  # before the next one is filled

    return texts.mapInArrow(giving_back(run), BOTH)


def _padded(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    size = len(columns["block"])
    return pa.RecordBatch.from_arrays([columns.get(field.name, pa.nulls(size, field.type)) for field in _BOTH_ARROW],
                                      schema=_BOTH_ARROW)
