"""Document fingerprints from prefix polynomial hashes.

For a text c[0..n) the prefix array is P[i] = sum of c[j] * B^j for j < i, modulo a prime.
The hash of any span [l, r) is (P[r] - P[l]) * B^-l, so two spans are compared in constant
time, and the longest common extension of two positions is found by bisection.  The
fingerprint of a text is its length, its hash under two primes, and the smallest mixed
span hash in each of 64 registers over all spans of 12 code points.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import arrow_batches, id_and_text, mixed

PRIME = (1 << 31) - 1
OTHER_PRIME = (1 << 31) - 19
BASE, OTHER_BASE = 1_000_003, 998_117
SPAN = 12
REGISTERS = 64
# Documents of one bucket are read in order by one task; so much text is meant to share one.
BUCKET_BYTES = 64 << 20
# A bucket is streamed, so larger buckets need no more memory.
MOST_BUCKETS = 20_000

_EMPTY = 0xFFFF_FFFF


def _fold(values: np.ndarray) -> np.ndarray:
    """Modulo :data:`PRIME`, for values below 2^62."""
    mask, bits = np.uint64(PRIME), np.uint64(31)
    values = (values & mask) + (values >> bits)
    values = (values & mask) + (values >> bits)
    return np.where(values >= mask, values - mask, values)


class _Powers:
    """Powers of a base modulo a prime, grown on demand."""

    def __init__(self, base: int, prime: int):
        self._base, self._prime = base, prime
        self._table = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> np.ndarray:
        while len(self._table) < n:
            step = np.uint64(pow(self._base, len(self._table), self._prime))
            self._table = np.concatenate([self._table, self._table * step % np.uint64(self._prime)])
        return self._table[:n]


_POWERS = _Powers(BASE, PRIME)
_INVERSES = _Powers(pow(BASE, -1, PRIME), PRIME)
_OTHER_POWERS = _Powers(OTHER_BASE, OTHER_PRIME)
_OTHER_INVERSES = _Powers(pow(OTHER_BASE, -1, OTHER_PRIME), OTHER_PRIME)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)


class PrefixHashes:
    """The prefix arrays of one text under both primes."""

    def __init__(self, codes: np.ndarray):
        self.n = n = len(codes)
        self.first = np.zeros(n + 1, dtype=np.uint64)
        self.other = np.zeros(n + 1, dtype=np.uint64)
        letters = codes + np.uint64(1)
        # A sum of 2^31 terms below 2^31 stays below 2^62.
        self.first[1:] = _fold(np.cumsum(_fold(letters * _POWERS.upto(n))))
        prime = np.uint64(OTHER_PRIME)
        self.other[1:] = np.cumsum(letters * _OTHER_POWERS.upto(n) % prime) % prime

    def span(self, left: int, right: int) -> tuple[int, int]:
        """The hash of ``[left, right)``, the same wherever the span stands."""
        one = (int(self.first[right]) - int(self.first[left])) * int(_INVERSES.upto(left + 1)[left]) % PRIME
        two = (int(self.other[right]) - int(self.other[left])) * int(_OTHER_INVERSES.upto(left + 1)[left])
        return one, two % OTHER_PRIME

    def extension(self, at: int, other: PrefixHashes, other_at: int) -> int:
        """Length of the longest common extension of two positions, by bisection."""
        low, high = 0, min(self.n - at, other.n - other_at)
        while low < high:
            middle = (low + high + 1) // 2
            if self.span(at, at + middle) == other.span(other_at, other_at + middle):
                low = middle
            else:
                high = middle - 1
        return low

    def spans(self, width: int) -> np.ndarray:
        """The hashes of all spans of ``width``; of the whole text if it is shorter."""
        if self.n == 0:
            return np.zeros(0, dtype=np.uint64)
        width = min(width, self.n)
        differences = self.first[width:] + np.uint64(PRIME) - self.first[:-width]
        return _fold(_fold(differences) * _INVERSES.upto(self.n - width + 1))


def registers(prefix: PrefixHashes) -> np.ndarray:
    """The smallest 32-bit mixed span hash of each register; a fixed value if it has none."""
    values = mixed(prefix.spans(SPAN))
    smallest = np.full(REGISTERS, _EMPTY, dtype=np.uint64)
    np.minimum.at(smallest, (values >> np.uint64(58)).astype(np.int64),
                  (values >> np.uint64(8)) & np.uint64(_EMPTY))
    return smallest


def fingerprint(prefix: PrefixHashes, smallest: np.ndarray | None = None) -> str:
    """Hexadecimal: length (16), two whole hashes (8 + 8), registers (8 each)."""
    smallest = registers(prefix) if smallest is None else smallest
    one, two = prefix.span(0, prefix.n)
    return f"{prefix.n:016x}{one:08x}{two:08x}{smallest.astype('>u4').tobytes().hex()}"


def likeness(a: str, b: str) -> float:
    """Likeness of two fingerprints, 0 to 1: 1 if equal, else the share of registers that agree.

    It estimates which share of all spans of two texts is common to both; an empty text
    is like an empty one only.
    """
    if a == b:
        return 1.0
    one, two = (np.frombuffer(bytes.fromhex(x[32:]), dtype=">u4") for x in (a, b))
    used = (one != _EMPTY) | (two != _EMPTY)
    return float(((one == two) & used).sum() / used.sum()) if used.any() else 0.0


def edited_text(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the start of the following one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_COLUMNS = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
            "near_edited double, near_next double, common_edited bigint, common_next bigint, next_doc_id bigint")
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                    ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                    ("near_edited", pa.float64()), ("near_next", pa.float64()),
                    ("common_edited", pa.int64()), ("common_next", pa.int64()), ("next_doc_id", pa.int64())])


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of buckets in order, each met with the following one of its bucket.

    The last row of a bucket is a guest: the first document of the next bucket, which
    only serves as the following one.
    """
    def rows() -> Iterator[tuple]:
        held = None  # (bucket, id, text, prefix arrays, fingerprint)
        for batch in batches:
            for bucket, doc_id, text, guest in zip(*(batch.column(i) for i in range(4)), strict=True):
                bucket, text, guest = bucket.as_py(), text.as_py(), guest.as_py()
                if held is not None and held[0] != bucket:
                    held = None
                if guest and held is None:
                    continue  # a second guest: rows that share the first id of a bucket
                prefix = PrefixHashes(code_points(text))
                now = (bucket, doc_id.as_py(), text, prefix, fingerprint(prefix))
                if held is not None:
                    yield _row(held, now)
                held = None if guest else now

    yield from arrow_batches(rows(), _ARROW, lambda row: 1400)


def _row(own: tuple, following: tuple) -> tuple:
    _, doc_id, text, prefix, mark = own
    changed = edited_text(text, following[2])
    changed_prefix = PrefixHashes(code_points(changed))
    changed_mark = fingerprint(changed_prefix)
    return (doc_id, len(text), hashlib.sha256(changed.encode("utf-8")).hexdigest(), mark, changed_mark,
            likeness(mark, changed_mark), likeness(mark, following[4]),
            prefix.extension(0, changed_prefix, 0), prefix.extension(0, following[3], 0), following[1])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Fingerprints of each text and of its edited text, with likenesses.

    The next document is the next in ascending order of id, rows with equal ids in order
    of their texts; rows without an id come last, in order of text; after the last comes
    the first, and a sole document follows itself.  Null texts count as empty; an empty
    text has an edited text equal to it.  An empty table gives an empty result.

    Documents are dealt into buckets of consecutive ids, so the text is shuffled once; the
    first document of each bucket travels to the bucket before as well.  Buckets are read
    as streams.  Also returned:
    ``next_doc_id`` and the lengths of the longest common prefixes ``common_edited`` and
    ``common_next``.
    """
    texts = id_and_text(docs, id_col, text_col)
    size = texts.agg(F.count("doc_id").alias("n_ids"), F.sum(F.octet_length("text")).alias("bytes")).first()
    n_buckets = min(MOST_BUCKETS, max(1, -(-(size["bytes"] or 0) // bucket_bytes)))
    bounds: list[int] = []
    if n_buckets > 1 and size["n_ids"]:
        # Bounds only balance the buckets; any bounds give the same result.
        shares = [i / n_buckets for i in range(1, n_buckets)]
        bounds = sorted(set(texts.agg(F.percentile_approx("doc_id", shares, max(10_000, 10 * n_buckets))).first()[0]))
    bucketed = texts.withColumn("bucket", _bucket(bounds))
    # One row per bucket, at most MOST_BUCKETS of them.
    firsts = {row["bucket"]: row["first_id"] for row in bucketed.groupBy("bucket").agg(
        F.min("doc_id").alias("first_id")).collect()}
    used = sorted(firsts)
    first_id, before = [[None] * (len(bounds) + 1) for _ in range(2)]
    for i, bucket in enumerate(used):
        first_id[bucket], before[bucket] = firsts[bucket], used[i - 1]
    # The first document of a bucket is a guest of the bucket before; with no id at all, its rows without one.
    is_first = F.col("doc_id").eqNullSafe(F.get(_array(first_id, "bigint"), F.col("bucket")))
    guest_of = F.when(is_first, F.get(_array(before, "int"), F.col("bucket")))
    places = F.filter(F.array(F.struct(F.col("bucket"), F.lit(False).alias("guest")),
                              F.struct(guest_of.alias("bucket"), F.lit(True).alias("guest"))),
                      lambda place: place["bucket"].isNotNull())
    sent = bucketed.select("doc_id", "text", F.explode(places).alias("place")).select(
        F.col("place.bucket").alias("bucket"), "doc_id", "text", F.col("place.guest").alias("guest"))
    ordered = sent.repartition("bucket").sortWithinPartitions(
        "bucket", "guest", F.col("doc_id").isNull(), "doc_id", "text")
    return ordered.mapInArrow(_along, _COLUMNS)


def _array(values: list[int | None], kind: str) -> Column:
    return F.array(*[F.lit(value) for value in values]).cast(f"array<{kind}>")


def _bucket(bounds: list[int]) -> Column:
    """Number of bounds below the id, in two steps over about the root of their number; the last without an id."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))

    def below(table: Column) -> Column:
        return F.size(F.filter(table, lambda bound: bound < F.col("doc_id")))

    skipped = F.greatest(below(_array(bounds[::step], "bigint")) - 1, F.lit(0)) * step
    fine = skipped + below(F.slice(_array(bounds, "bigint"), skipped + 1, F.lit(step)))
    return F.when(F.col("doc_id").isNull(), F.lit(len(bounds))).otherwise(fine)
