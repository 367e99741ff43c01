"""BPE encoding and decoding over a table of distinct words.

Texts are split into the tokenizer's words in Spark.  Words of blocks meet by word, so that
each distinct word of the corpus is encoded once, and its ids are joined back by position:
by the word's number in its block's dictionary (see :mod:`citeweave.llm.blocks`).  Decoding looks each id up in the
table of pieces, whose size is that of the vocabulary.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.llm.blocks import BLOCK_BYTES, coded, dictionaries, unpacked
from citeweave.llm.common import arrow_batches, give_back, giving_back, id_and_text
from citeweave.sources.tables import staged

# Letters up to U+024F whose composition, case and class have one reading everywhere.
_LETTERS = "a-zªµºß-öø-ɏ"
_NUMBERS = "0-9²³¹¼-¾"
_SPACES = " \t-\r\u0085 "
# The word pattern of the tokenizer, for lower-cased texts of characters up to U+024F.
_PLAIN_WORDS = re.compile(f"[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[{_NUMBERS}]|[^{_SPACES}{_LETTERS}{_NUMBERS}]+")
_BEYOND_PLAIN = re.compile("[^\u0000-ɏ]|[İ]")


@functools.lru_cache(maxsize=2)
def _tokenizer(data: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(data)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class WordSplitter:
    """Text -> the tokenizer's words, lower-cased, and its special tokens as they stand.

    Texts of characters up to U+024F are split by a pattern; all others by the
    tokenizer's own normaliser and splitter, which are slower and define the result.
    """

    def __init__(self, data: str):
        self._data = data
        special = [token["content"] for token in json.loads(data)["added_tokens"]]
        self._special = frozenset(special)
        self._marks = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

    def __call__(self, text: str) -> list[str]:
        if self._marks is None or "<|" not in text:
            return self._words(text)
        words: list[str] = []
        for part in self._marks.split(text):
            words += [part] if part in self._special else self._words(part)
        return words

    def _words(self, text: str) -> list[str]:
        low = text.lower()  # some capitals up to U+024F have their small letter beyond it
        if text.isascii() or not (_BEYOND_PLAIN.search(text) or _BEYOND_PLAIN.search(low)):
            return _PLAIN_WORDS.findall(low)
        tokenizer = _tokenizer(self._data)
        whole = tokenizer.normalizer.normalize_str(text)
        return [whole[start:end] for _, (start, end) in tokenizer.pre_tokenizer.pre_tokenize_str(whole)]


# Entries that a task encodes at a time.
ENCODED_ROWS = 5_000
_IDS_ARROW = pa.schema([("block", pa.int64()), ("pos", pa.int32()), ("ids", pa.binary())])


def _packed_ids(ids: list[list[int]], indices: pa.Array, unit: str) -> pa.Array:
    """The ids of each entry as numbers of two or four bytes: shorter in a shuffle than arrays."""
    taken = pa.array(ids, pa.list_(pa.int32())).take(indices)
    flat = taken.values.to_numpy().astype(unit)
    bounds = (taken.offsets.to_numpy() * flat.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(taken), [None, pa.py_buffer(bounds), pa.py_buffer(flat)])


def _encode(data: str, unit: str):
    """Ids of dictionary entries in order of their words, each distinct word encoded once."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(data)
        last: tuple[bytes | None, list[int]] = (None, [])

        def done(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            nonlocal last
            table = pa.Table.from_batches(held).combine_chunks()
            entries = table.column("word").combine_chunks().dictionary_encode()
            words = entries.dictionary.to_pylist()
            first = 1 if words[0] == last[0] else 0  # its entries began in the batch before
            encoded = tokenizer.encode_batch_fast([w.decode("utf-8") for w in words[first:]], add_special_tokens=False)
            ids = [last[1]][:first] + [one.ids for one in encoded]
            last = (words[-1], ids[-1])
            return pa.RecordBatch.from_arrays(
                [table.column("block").combine_chunks(), table.column("pos").combine_chunks(),
                 _packed_ids(ids, entries.indices, unit)], schema=_IDS_ARROW)

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(part.num_rows for part in held) >= ENCODED_ROWS:
                yield done(held)
                held = []
        if held:
            yield done(held)

    return giving_back(encode)


def piece_table(spark, data: str) -> DataFrame:
    """``id, piece``: the vocabulary with its special tokens."""
    tokens = json.loads(data)
    pieces = {**tokens["model"]["vocab"], **{token["content"]: token["id"] for token in tokens["added_tokens"]}}
    return spark.createDataFrame([(number, piece) for piece, number in pieces.items()], "id int, piece string")


_OUT = "doc_id bigint, ids array<int>, decoded string"
_DIGEST = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
_OUT_ARROW = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])
_DIGEST_ARROW = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                           ("decoded_sha256", pa.string())])


def _assemble(pieces, unit: str, digests: bool):
    """A block's documents from its codes and its dictionary's ids, met by number."""
    def assemble(key: tuple, blocks: pa.Table, entries: pa.Table) -> pa.Table:
        if blocks.num_rows != 1:
            raise ValueError("the documents changed between two readings; write them to a table first")
        positions = entries.column("pos").to_numpy()
        packed = entries.column("ids").to_pylist()
        flat = np.frombuffer(b"".join(packed), dtype=unit)
        sizes = np.fromiter(map(len, packed), dtype=np.int64, count=len(packed)) // flat.itemsize
        count_of, start_of = np.zeros((2, len(positions)), dtype=np.int64)
        count_of[positions], start_of[positions] = sizes, np.cumsum(sizes) - sizes
        names = pieces.value
        decoded_of = [" ".join([names[i] for i in flat[start:start + n].tolist()])
                      for start, n in zip(start_of.tolist(), count_of.tolist(), strict=True)]
        written_of = [" ".join(map(str, flat[start:start + n].tolist()))
                      for start, n in zip(start_of.tolist(), count_of.tolist(), strict=True)] if digests else []
        doc_ids, n_words = (blocks.column(name)[0].as_py() for name in ("doc_ids", "n_words"))
        codes = unpacked(blocks.column("codes")[0].as_buffer())

        def rows() -> Iterator[tuple]:
            at = 0
            for doc_id, n in zip(doc_ids, n_words, strict=True):
                part = codes[at:at + n]
                own = part.tolist()
                at += n
                decoded = " ".join(map(decoded_of.__getitem__, own))
                if digests:
                    written = " ".join(map(written_of.__getitem__, own))
                    yield (doc_id, int(count_of[part].sum()), hashlib.sha256(written.encode()).hexdigest(),
                           hashlib.sha256(decoded.encode("utf-8")).hexdigest())
                else:
                    yield doc_id, [i for c in own for i in flat[start_of[c]:start_of[c] + count_of[c]].tolist()], decoded

        schema = _DIGEST_ARROW if digests else _OUT_ARROW
        weigh = (lambda row: 160) if digests else (lambda row: 8 * len(row[1]) + len(row[2]))
        done = pa.Table.from_batches(list(arrow_batches(rows(), schema, weigh)), schema=schema)
        give_back()
        return done

    return assemble


def encode_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                     digests: bool = False, written: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Token ids and decoded text of each document, as the tokenizer gives for the whole text.

    Returns ``doc_id, ids, decoded``, or with ``digests`` their number and SHA-256 sums.
    A null text counts as empty and has no ids.  Special tokens that stand in a text
    become their id.  One row per row of ``docs``, in no order; repeated rows and rows
    without an id stay as they are; other columns are not looked at.

    Texts are read twice.  Set ``written`` if ``docs`` is read straight from files, whose
    splits come out the same each time; otherwise ids and texts are written to the shared
    folder first.  Should a block differ all the same, the job fails.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        data = file.read()
    texts = id_and_text(docs, id_col, text_col)
    texts = texts if written else staged(texts, "texts")
    split = WordSplitter(data)
    # The table of distinct words: all entries of a word lie together, one after another.
    entries = dictionaries(texts, split, block_bytes=block_bytes).select("block", "pos", "word")
    pieces = {row["id"]: row["piece"] for row in piece_table(spark, data).collect()}  # one entry per id of the vocabulary
    unit = "<u2" if max(pieces, default=0) < 1 << 16 else "<u4"
    joined = entries.repartition("word").sortWithinPartitions("word").mapInArrow(
        _encode(data, unit), "block bigint, pos int, ids binary")
    assemble = _assemble(spark.sparkContext.broadcast(pieces), unit, digests)
    return coded(texts, split, block_bytes).groupBy("block").cogroup(joined.groupBy("block")).applyInArrow(
        assemble, _DIGEST if digests else _OUT)


def decode(encoded: DataFrame, tokenizer_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, decoded`` of rows of ids, by a join with the table of pieces.

    Rows must have distinct ids.  A row without ids gives an empty text, an id outside
    the vocabulary is passed over.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        pieces = F.broadcast(piece_table(encoded.sparkSession, file.read()))  # the vocabulary's size
    tokens = encoded.select(F.col(id_col).alias("doc_id"), F.posexplode_outer(ids_col).alias("pos", "id"))
    parts = tokens.join(pieces, "id", "left").groupBy("doc_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("piece").isNotNull(), F.struct("pos", "piece")))).alias("parts"))
    return parts.select("doc_id", F.concat_ws(" ", F.transform("parts", lambda part: part["piece"])).alias("decoded"))


def ids_of_text(tokenizer_path: str, text: str) -> np.ndarray:
    """The ids of one text by the tokenizer itself, for comparison."""
    with open(tokenizer_path, encoding="utf-8") as file:
        encoded = _tokenizer(file.read()).encode(text, add_special_tokens=False)
    return np.array(encoded.ids, dtype=np.int32)
