"""Exact deduplication by owners in Patricia tries.

Each input task inserts whole normalised texts into a compressed radix trie whose
terminal nodes hold a count and the identifier that stays, so a text leaves the task
once however often it occurs.  When a trie holds too many bytes, its largest subtree
is handed on and forgotten (spill by subtree): what is handed on are partial owners,
which are merged like any others.  The partial owners meet by length and content hash,
where a trie over the full byte strings settles which of them are equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import arrow_batches, id_and_text, named

# Bytes of text a task's trie holds before subtrees are handed on.
TRIE_BYTES = 64 << 20

_OWNERS = "n_bytes bigint, digest binary, body binary, first_id bigint, last_id bigint, n bigint"
_OWNERS_ARROW = pa.schema([("n_bytes", pa.int64()), ("digest", pa.binary()), ("body", pa.binary()),
                           ("first_id", pa.int64()), ("last_id", pa.int64()), ("n", pa.int64())])
_ROWS_ARROW = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary())])
_GROUPS = "digest binary, first_id bigint, last_id bigint, group_size bigint"
_GROUPS_ARROW = pa.schema([("digest", pa.binary()), ("first_id", pa.int64()), ("last_id", pa.int64()),
                           ("group_size", pa.int64())])


def normalised(text: str) -> bytes:
    """The text with A-Z lower-cased, as UTF-8; all other characters stay as they are."""
    return text.encode("utf-8").lower()


class _Node:
    __slots__ = ("edges", "owner")

    def __init__(self) -> None:
        self.edges: dict[int, list] = {}  # first byte -> [label, node]
        self.owner: tuple | None = None  # (smallest id, largest id, count)


def _merge(a: tuple | None, b: tuple) -> tuple:
    if a is None:
        return b
    ids = [i for i in (a[0], b[0], a[1], b[1]) if i is not None]
    return (min(ids), max(ids), a[2] + b[2]) if ids else (None, None, a[2] + b[2])


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by bisection over byte comparisons."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class PatriciaTrie:
    """Byte strings with one owner each; edges carry the bytes that only they need."""

    def __init__(self) -> None:
        self._root = _Node()
        self._held: dict[int, int] = {}  # first byte -> bytes below it

    @property
    def held(self) -> int:
        return sum(self._held.values())

    def add(self, key: bytes, owner: tuple) -> None:
        """Insert ``key`` or merge ``owner`` into the owner it has."""
        node, at = self._root, 0
        while at < len(key):
            edge = node.edges.get(key[at])
            if edge is None:
                leaf = _Node()
                node.edges[key[at]] = [key[at:], leaf]
                self._held[key[0]] = self._held.get(key[0], 0) + len(key) - at + 200
                node, at = leaf, len(key)
                break
            label, below = edge
            if key.startswith(label, at):
                node, at = below, at + len(label)
                continue
            same = _shared(label, key[at:at + len(label)])
            middle = _Node()
            middle.edges[label[same]] = [label[same:], below]
            node.edges[key[at]] = [label[:same], middle]
            self._held[key[0]] += 200
            node, at = middle, at + same
        node.owner = _merge(node.owner, owner)

    def take_all(self) -> Iterator[tuple[bytes, tuple]]:
        """Every string with its owner; the trie is empty afterwards."""
        root, self._root, self._held = self._root, _Node(), {}
        yield from _terminals(root, b"")

    def take_largest(self) -> Iterator[tuple[bytes, tuple]]:
        """The strings of the subtree that holds most bytes; they leave the trie."""
        first = max(self._held, key=lambda byte: self._held[byte])
        del self._held[first]
        label, node = self._root.edges.pop(first)
        yield from _terminals(node, label)


def _terminals(node: _Node, path: bytes) -> Iterator[tuple[bytes, tuple]]:
    waiting = [(path, node)]
    while waiting:
        path, node = waiting.pop()
        if node.owner is not None:
            yield path, node.owner
        waiting.extend((path + label, below) for label, below in node.edges.values())


def _partial_owners(trie_bytes: int):
    def owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            trie = PatriciaTrie()

            def out(terminals: Iterator[tuple[bytes, tuple]]) -> Iterator[tuple]:
                for body, (first, last, n) in terminals:
                    yield len(body), hashlib.sha256(body).digest(), body, first, last, n

            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    trie.add(normalised(text.as_py()), (doc_id, doc_id, 1))
                    while trie.held > trie_bytes:
                        yield from out(trie.take_largest())
            yield from out(trie.take_all())

        yield from arrow_batches(rows(), _OWNERS_ARROW, lambda row: row[0] + 96)

    return owners


def _merged_owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per text, from partial owners in order of length and hash."""
    def rows() -> Iterator[tuple]:
        trie, key = PatriciaTrie(), None

        def out() -> Iterator[tuple]:
            found = list(trie.take_all())
            if len(found) > 1:
                raise ValueError("two different texts of one length have the same SHA-256")
            for _, (first, last, n) in found:
                yield key[1], first, last, n

        for batch in batches:
            columns = [batch.column(i) for i in range(6)]
            for n_bytes, digest, body, first, last, n in zip(*columns, strict=True):
                now = (n_bytes.as_py(), digest.as_py())
                if now != key:
                    if key is not None:
                        yield from out()
                    key = now
                trie.add(body.as_py(), (first.as_py(), last.as_py(), n.as_py()))
        if key is not None:
            yield from out()

    yield from arrow_batches(rows(), _GROUPS_ARROW)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = [hashlib.sha256(normalised(text.as_py())).digest() for text in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary())], schema=_ROWS_ARROW)


def text_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row per distinct normalised text: digest, smallest and largest id, number of rows."""
    texts = id_and_text(docs, id_col, text_col)
    partial = texts.mapInArrow(_partial_owners(trie_bytes), _OWNERS)
    met = partial.repartition("n_bytes", "digest").sortWithinPartitions("n_bytes", "digest")
    return met.mapInArrow(_merged_owners, _GROUPS)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     keep: str = "largest", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """For each document the one of its group of equal texts that stays.

    Texts are equal when identical after lower-casing A-Z only; a null text counts as
    empty.  Of a group the ``largest`` (or ``smallest``) id stays; a row without an id
    stays only where no row of its group has one.  Repeated rows (same id, same text)
    cannot be told apart and share one decision; :func:`deduplicated` leaves one of
    them.  An empty table gives an empty result.  Other columns are not looked at.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256``.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is 'largest' or 'smallest'")
    groups = text_groups(docs, id_col, text_col, trie_bytes)
    rows = id_and_text(docs, id_col, text_col).mapInArrow(_digests, "doc_id bigint, digest binary")
    keep_id = F.col("last_id" if keep == "largest" else "first_id")
    return rows.join(groups, "digest").select(
        "doc_id", keep_id.alias("keep_id"), "group_size", F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they were."""
    kept = exact_duplicates(docs, id_col, text_col, keep).where("kept").select(
        F.col("keep_id").alias("_ed_id"), F.col("text_sha256").alias("_ed_sha")).distinct()
    digest = F.sha2(F.translate(F.coalesce(named(text_col), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                                "abcdefghijklmnopqrstuvwxyz"), 256)
    keyed = docs.withColumns({"_ed_id": named(id_col).cast("bigint"), "_ed_sha": digest})
    both = (keyed["_ed_sha"] == kept["_ed_sha"]) & keyed["_ed_id"].eqNullSafe(kept["_ed_id"])
    one = keyed.join(kept, both, "left_semi").dropDuplicates(["_ed_id", "_ed_sha"])
    return one.drop("_ed_id", "_ed_sha")
