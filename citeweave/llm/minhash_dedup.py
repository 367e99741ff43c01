"""Near-duplicate documents by HyperMinHash, with exact confirmation.

The smallest hash of a document's shingles in each of 384 buckets is kept compressed, as
its count of leading zeros and the ten bits that follow them.  Bands of eight registers
bring candidates together; the share of agreeing registers, corrected for accidental
agreement, discards candidates that cannot be near; all others are confirmed on their full
shingle sets.  Documents with equal sets are one node from the start.

A bucket of candidates is not expanded into pairs.  Its members are compared with its
smallest node.  Members that this links are settled.  The shingles of the others are put in
order of rarity.  Two sets of known sizes that are near enough share one of their rarest
shingles, and how many of them have to be looked at follows from the sizes; so nodes meet
under a pair of size classes and a rare shingle.  A passage that many texts share is no
such place unless two of them are near.  Only pairs that meet, between nodes not connected
yet, are compared.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import BATCH_BYTES, arrow_batches, giving_back, id_and_text, mixed, named
from citeweave.sources.tables import staged

BANDS, ROWS = 48, 8
REGISTERS = BANDS * ROWS
MANTISSA_BITS = 10
# Two registers of unlike documents agree about this often (leading zeros and mantissa).
ACCIDENT = 1 / (1 << MANTISSA_BITS) / 2
# Standard deviations by which an estimate may be wrong before a pair is given up.
DEVIATIONS = 6

_SETS = ("doc_id bigint, n_shingles bigint, sign_a bigint, sign_b bigint, registers binary")
_SETS_ARROW = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("sign_a", pa.int64()),
                         ("sign_b", pa.int64()), ("registers", pa.binary())])
_BANDS_ARROW = pa.schema([("node", pa.int64()), ("bands", pa.list_(pa.int64()))])
# Sizes of one class differ by one part in so many at most.
SIZE_PARTS = 64
# So many ids, 16 MB, are sent to every task at most.
BROADCAST_IDS = 1_000_000


class _WordHashes(dict):
    """Word -> 64-bit hash, remembered within a batch."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_hashes(words: list[bytes], width: int, known: dict | None = None) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; of the whole sequence if it is shorter."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    known = _WordHashes() if known is None else known
    hashes = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(width, len(words))
    total = np.zeros(len(words) - width + 1, dtype=np.uint64)
    for i in range(width):
        total = mixed(total * np.uint64(3) + hashes[i:len(words) - width + 1 + i])
    return np.unique(total)


def hyperminhash(distinct: np.ndarray) -> np.ndarray:
    """Registers (0: empty) from sorted distinct hashes: leading zeros, then mantissa bits."""
    out = np.zeros(REGISTERS, dtype=np.uint16)
    if not len(distinct):
        return out
    bucket = ((distinct >> np.uint64(32)) * np.uint64(REGISTERS) >> np.uint64(32)).astype(np.int64)
    # Within a bucket the stirred values order the shingles.
    values = mixed(distinct ^ np.uint64(0x9E3779B97F4A7C15))
    smallest = np.full(REGISTERS, np.iinfo(np.uint64).max, dtype=np.uint64)
    starts = np.flatnonzero(np.diff(bucket, prepend=-1))
    smallest[bucket[starts]] = np.minimum.reduceat(values, starts)
    used = bucket[starts]
    low = smallest[used]
    # Floating point finds the leading one; at most one bit too high after rounding.
    length = np.floor(np.log2(np.maximum(low, np.uint64(1)).astype(np.float64))).astype(np.int64)
    length = np.minimum(length, 63)
    length -= (low >> length.astype(np.uint64)) == 0
    shift = np.maximum(length - MANTISSA_BITS, 0).astype(np.uint64)
    mantissa = (low >> shift) & np.uint64((1 << MANTISSA_BITS) - 1)
    out[used] = (np.minimum(64 - length, 63).astype(np.uint64) << np.uint64(MANTISSA_BITS) | mantissa).astype(np.uint16)
    return out


def estimate(a: np.ndarray, b: np.ndarray, least: float = 0.5) -> tuple[float, float]:
    """Jaccard similarity from two register arrays, corrected for accidental agreement, and its margin.

    The margin is that of an estimate whose true value is ``least``.
    """
    used = (a != 0) | (b != 0)
    n = int(used.sum())
    if not n:
        return 0.0, 1.0
    same = int(((a == b) & used).sum()) / n
    return max(0.0, (same - ACCIDENT) / (1 - ACCIDENT)), DEVIATIONS * (least * (1 - least) / n) ** 0.5


def words_of(text: str) -> list[bytes]:
    """The words of a text, A-Z lower-cased; ``bytes.split`` parts at exactly the blanks meant."""
    return text.encode("utf-8").lower().split()


def _sketches(width: int):
    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                known = _WordHashes()
                for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                    distinct = shingle_hashes(words_of(text.as_py()), width, known)
                    signs = [int(np.add.reduce(mixed(distinct + np.uint64(salt))).astype(np.int64)) if len(distinct)
                             else 0 for salt in (1, 2)]
                    yield (doc_id.as_py(), len(distinct), *signs,
                           hyperminhash(distinct).tobytes() if len(distinct) else None)

        yield from arrow_batches(rows(), _SETS_ARROW, lambda row: 900)

    return giving_back(sketches)


@functools.lru_cache(maxsize=1)
def _donor_order() -> np.ndarray:
    """For each register the order in which it would take the value of each other one."""
    places = np.arange(REGISTERS, dtype=np.uint64)
    return mixed(mixed(places)[:, None] * np.uint64(REGISTERS) + places[None, :])


def filled(registers: np.ndarray) -> np.ndarray:
    """Registers with each empty one filled from the first non-empty one in its order.

    Two sets agree in a filled register with at least the probability that they agree in
    any other, so bands of short texts are as selective as those of long ones.
    """
    empty, full = np.flatnonzero(registers == 0), np.flatnonzero(registers)
    if not len(empty) or not len(full):
        return registers
    out = registers.copy()
    out[empty] = registers[full[_donor_order()[np.ix_(empty, full)].argmin(axis=1)]]
    return out


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One hash per band of filled registers; none for an empty set."""
    if not registers.any():
        return np.zeros(0, dtype=np.int64)
    halves = filled(registers).reshape(BANDS, ROWS).view(np.uint64)  # two per band
    keys = mixed(mixed(halves[:, 0] + np.arange(BANDS, dtype=np.uint64)) * np.uint64(5) + halves[:, 1])
    return keys.view(np.int64)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for batch in batches:
            for node, registers in zip(batch.column(0), batch.column(1), strict=True):
                yield node.as_py(), band_keys(np.frombuffer(registers.as_py(), dtype=np.uint16)).tolist()

    yield from arrow_batches(rows(), _BANDS_ARROW, lambda row: 450)


def _hopeful(least: float):
    def hopeful(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The highest similarity that a pair's estimate allows; below ``least`` it gets no confirmation."""
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("most", pa.float64()), ("close", pa.bool_())])

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for a, b, one, two in zip(*(batch.column(i) for i in range(4)), strict=True):
                    value, margin = estimate(*(np.frombuffer(x.as_py(), dtype=np.uint16) for x in (one, two)), least)
                    yield a.as_py(), b.as_py(), min(1.0, value + 2 * margin), value + margin >= least

        yield from arrow_batches(rows(), schema)

    return giving_back(hopeful)


def _confirm(width: int, least: int):
    """Exact similarity of pairs sorted by their first node, whose set is made once."""
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("similarity", pa.float64()),
                            ("linked", pa.bool_())])

        def rows() -> Iterator[tuple]:
            last, first = None, np.zeros(0, dtype=np.uint64)
            for batch in batches:
                known = _WordHashes()
                for a, b, one, two in zip(*(batch.column(i) for i in range(4)), strict=True):
                    if a.as_py() != last:
                        last, first = a.as_py(), shingle_hashes(words_of(one.as_py()), width, known)
                    second = shingle_hashes(words_of(two.as_py()), width, known)
                    both = len(np.intersect1d(first, second, assume_unique=True))
                    union = len(first) + len(second) - both
                    yield last, b.as_py(), both / union if union else 0.0, bool(union) and 100 * both >= least * union

        yield from arrow_batches(rows(), schema)

    return giving_back(confirm)


_SHINGLES = "node bigint, part bigint, size int, shingle bigint"


def _shingle_rows(width: int):
    """All shingles of each text; ``part`` tells texts of one node apart."""
    schema = pa.schema([("node", pa.int64()), ("part", pa.int64()), ("size", pa.int32()), ("shingle", pa.int64())])

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = _WordHashes()
            for node, text in zip(batch.column(0), batch.column(1), strict=True):
                words = words_of(text.as_py())
                own = shingle_hashes(words, width, known).view(np.int64)
                part = xxhash.xxh3_64_intdigest(b" ".join(words)) - (1 << 63)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), node.as_py(), dtype=np.int64)), pa.array(np.full(len(own), part, dtype=np.int64)),
                     pa.array(np.full(len(own), len(own), dtype=np.int32)), pa.array(own)], schema=schema)

    return giving_back(shingles)


def size_class(size: int) -> int:
    """Classes of sizes, each about one part in :data:`SIZE_PARTS` wide; small sizes have one each."""
    shift = max(0, size.bit_length() - SIZE_PARTS.bit_length())
    return (shift * SIZE_PARTS) + (size >> shift)


def smallest_of_class(number: int) -> int:
    """The smallest size of a class."""
    shift = max(0, number // SIZE_PARTS - 1)
    return (number - shift * SIZE_PARTS) << shift


def needed_overlap(one: int, other: int, percent: int) -> int:
    """Shingles that sets of these sizes have in common at least if they are linked."""
    return -(-percent * (one + other) // (100 + percent))


def meeting_lengths(size: int, percent: int) -> list[tuple[int, int]]:
    """For each class of sizes that a set of ``size`` can be linked with: how many of its rarest shingles to look at.

    Two sets with an intersection of at least ``k`` share one of the ``size - k + 1`` first ones of
    either, in any order that is the same for both.  The smallest size of the class needs the
    smallest intersection, and so the longest part.
    """
    least, most = -(-percent * size // 100), 100 * size // percent
    return [(number, size - needed_overlap(size, max(least, smallest_of_class(number)), percent) + 1)
            for number in range(size_class(least), size_class(most) + 1)]


_MEETINGS = "node bigint, own int, other int, shingle bigint"


def _meetings(percent: int):
    """Rows ``node, part, size, n_shared, shingle`` of shared shingles, by text and rarity, to meeting places.

    A set's shingles that no other node has are the rarest ones; nothing is met there, so
    they only take their places.
    """
    schema = pa.schema([("node", pa.int64()), ("own", pa.int32()), ("other", pa.int32()), ("shingle", pa.int64())])

    def meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = (None, None), 0
        lengths: list[tuple[int, int]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            nodes, parts, sizes, shared, shingles = (batch.column(i).to_numpy() for i in range(5))
            starts = np.flatnonzero(np.append(True, (np.diff(nodes) != 0) | (np.diff(parts) != 0)))
            for start, end in zip(starts, [*starts[1:], len(nodes)], strict=True):
                node, size, alone = int(nodes[start]), int(sizes[start]), int(sizes[start] - shared[start])
                if (node, parts[start]) != last:
                    last, seen = (node, parts[start]), 0
                    lengths = [(number, length - alone) for number, length in meeting_lengths(size, percent)
                               if length > alone]
                for number, length in lengths:
                    part = shingles[start:start + max(0, min(end - start, length - seen))]
                    if len(part):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(part), node)), pa.array(np.full(len(part), size_class(size), dtype=np.int32)),
                             pa.array(np.full(len(part), number, dtype=np.int32)), pa.array(part)], schema=schema)
                seen += end - start

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Few large batches in place of many small ones."""
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in meetings(batches):
            held.append(batch)
            size += batch.nbytes
            if size >= BATCH_BYTES:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, size = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return giving_back(joined)


def meeting_pairs(nodes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """``a, b`` (a < b): pairs of nodes with different labels that share a rare shingle.

    ``nodes`` has ``node, label`` and is a written table, ``texts`` has ``node, text``.  Every
    pair with different labels that is to be linked is among them; of an id with several
    texts each is looked at for itself.
    """
    rows = staged(texts.mapInArrow(_shingle_rows(width), _SHINGLES).distinct(), "shingles")
    held = staged(rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared")
    shared = staged(rows.join(held, "shingle"), "shared-shingles")
    counts = shared.groupBy("node", "part", "size").agg(F.count(F.lit(1)).alias("n_shared")).where(
        100 * F.col("n_shared") >= percent * F.col("size"))
    ordered = (shared.join(counts, ["node", "part", "size"]).repartition("node", "part")
               .sortWithinPartitions("node", "part", "n", "shingle").select("node", "part", "size", "n_shared", "shingle"))
    met = staged(ordered.mapInArrow(_meetings(percent), _MEETINGS).join(nodes, "node")
                 .withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")}), "meetings")
    place = ["low", "high", "shingle"]
    # In each place one label, the most frequent, need not be met with itself.
    labels = met.groupBy(*place, "label").agg(F.count(F.lit(1)).alias("n"))
    tops = staged(labels.groupBy(*place).agg(F.max(F.struct("n", "label"))["label"].alias("top"), F.count(F.lit(1)).alias("n"))
                  .where("n > 1").drop("n"), "places")
    open_ = staged(met.join(tops, place), "open-meetings")
    x, y = open_.where("label <> top").alias("x"), open_.alias("y")
    match = ((F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.own") == F.col("y.other"))
             & (F.col("x.other") == F.col("y.own")) & (F.col("x.label") != F.col("y.label"))
             & ((F.col("y.label") == F.col("y.top")) | (F.col("x.node") < F.col("y.node"))))
    return staged(x.join(y, match).select(F.least("x.node", "y.node").alias("a"),
                                          F.greatest("x.node", "y.node").alias("b")).distinct(), "remaining")


def components(edges: DataFrame) -> DataFrame:
    """``node, label``: for each node of ``a, b`` edges the smallest node it reaches.

    Labels move along edges and then to their own labels' labels; every round is a
    written table, and the number of rounds grows with the logarithm of the longest path.
    """
    both = staged(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                  "edges")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("label").alias("heard"))
        own = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        moved = labels.join(near, "node").join(own, "label").select(
            "node", F.least("label", "heard", "further").alias("new"), "label")
        step = staged(moved, "labels")
        changed = not step.where("new <> label").isEmpty()
        labels = step.select("node", F.col("new").alias("label"))
        if not changed:
            return labels


def _similarities(pairs: DataFrame, sketches: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """``a, b, linked, low, high``: whether a pair is linked and bounds of its similarity."""
    one, two = (sketches.select(F.col("node").alias(side), F.col("registers").alias(f"registers_{side}"))
                for side in "ab")
    guessed = staged(pairs.join(one, "a").join(two, "b").select("a", "b", "registers_a", "registers_b").mapInArrow(
        _hopeful(percent / 100), "a bigint, b bigint, most double, close boolean"), "estimates")
    close = guessed.where("close").select("a", "b")
    needed = close.select(F.col("a").alias("doc_id")).union(close.select("b")).distinct()
    # Few ids go to the texts; with many, both sides are shuffled.
    needed = F.broadcast(needed) if needed.count() <= BROADCAST_IDS else needed
    wanted = texts.join(needed, "doc_id", "left_semi")
    first, second = (wanted.select(F.col("doc_id").alias(side), F.col("text").alias(f"text_{side}")) for side in "ab")
    exact = close.join(second, "b").join(first, "a").select("a", "b", "text_a", "text_b").sortWithinPartitions(
        "a").mapInArrow(_confirm(width, percent), "a bigint, b bigint, similarity double, linked boolean")
    far = guessed.where("not close").select("a", "b", F.lit(False).alias("linked"), F.lit(0.0).alias("low"),
                                            F.col("most").alias("high"))
    known = exact.select("a", "b", "linked", F.col("similarity").alias("low"), F.col("similarity").alias("high"))
    # An id with several texts has several rows here.
    one_row = known.union(far).groupBy("a", "b").agg(
        F.max("linked").alias("linked"), F.max("low").alias("low"), F.max("high").alias("high"))
    return staged(one_row, "similarities")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    percent: int = 80) -> DataFrame:
    """For each document its component of near duplicates.

    Words are runs of non-blanks with A-Z lower-cased, shingles ``width`` words; a text
    with fewer words has its whole sequence as one shingle.  Two documents are linked if
    100 * intersection >= ``percent`` * union of their sets.  Texts without words (null,
    empty) are linked with nothing.  Rows with the same id are one document and share
    its links; a row without an id is linked with nothing, has no component and is
    kept.  An empty table gives an empty result.

    Returns ``doc_id, n_shingles, component_id, kept``, one row per row of ``docs``.
    """
    texts = id_and_text(docs, id_col, text_col)
    sets = staged(texts.mapInArrow(_sketches(width), _SETS), "sets")
    usable = sets.where("registers is not null and doc_id is not null")
    signature = ["n_shingles", "sign_a", "sign_b"]
    # One node for each distinct set: the smallest id that has it.
    nodes = usable.groupBy(*signature).agg(F.min(F.struct("doc_id", "registers")).alias("first"))
    sketches = staged(nodes.select(F.col("first.doc_id").alias("node"), "n_shingles", "sign_a", "sign_b",
                                   F.col("first.registers").alias("registers")), "nodes")
    members = sketches.select("node", "registers").mapInArrow(giving_back(_bands), "node bigint, bands array<bigint>").select(
        "node", F.explode("bands").alias("band"))
    hubs = members.groupBy("band").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1")
    met = staged(members.join(hubs.select("band", "hub"), "band"), "candidates")
    pairs = met.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    against_hub = _similarities(pairs, sketches, texts, width, percent)
    links = against_hub.where("linked").select("a", "b")
    labels = components(links)

    # What the smallest node has not settled, in each bucket where something is left.
    known = against_hub.select(F.col("a").alias("hub"), F.col("b").alias("node"), "linked", "low", "high")
    inside = (met.where("node <> hub").join(known, ["hub", "node"]).join(labels, "node", "left")
              .withColumn("label", F.coalesce("label", "node")))
    left = inside.where("not linked")
    if not left.isEmpty():
        mates = inside.join(left.select("band").distinct(), "band", "left_semi")
        nodes = staged(mates.select("node", "label").distinct(), "unsettled")
        wanted = texts.withColumnRenamed("doc_id", "node").join(nodes.select("node"), "node", "left_semi")
        rest = meeting_pairs(nodes, wanted, width, percent).join(against_hub.select("a", "b"), ["a", "b"], "left_anti")
        if not rest.isEmpty():
            more = _similarities(rest, sketches, texts, width, percent).where("linked").select("a", "b")
            labels = components(links.union(more))

    rows = sets.select("doc_id", *signature).join(
        sketches.select("node", *signature), signature, "left").join(labels, "node", "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None).cast("bigint")).otherwise(
        F.coalesce("label", "node", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                percent: int = 80) -> DataFrame:
    """``docs`` with only the smallest id of each component, all columns as they were."""
    gone = near_duplicates(docs, id_col, text_col, width, percent).where("not kept").select(
        F.col("doc_id").alias("_nd_id")).distinct()
    return docs.join(gone, named(id_col).cast("bigint") == F.col("_nd_id"), "left_anti")
