"""The citation graph: edges, frontiers, lookups, novelty, expansion."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.functions.ids import normalize_doi
from citeweave.sources.tables import staged

# Id types a lookup accepts, with the column each one is matched on.
LOOKUP_KEYS = {"oaid": "id_OpenAlex", "doi": "doi"}


def citation_edges(works: DataFrame, work_id: str = "id_OpenAlex",
                   references: str = "referenced_works_OpenAlex") -> DataFrame:
    """``(src, dst)`` for each entry of each reference list (an array column)."""
    return (works
            .select(F.col(work_id).alias("src"), F.explode(references).alias("dst"))
            .where("dst IS NOT NULL"))


def _distinct_keys(frame: DataFrame, column: str | Column, name: str) -> DataFrame:
    column = F.col(column) if isinstance(column, str) else column
    return frame.select(column.alias(name)).where(F.col(name).isNotNull()).distinct()


def key_table(frame: DataFrame, column: str | Column, name: str) -> DataFrame:
    """The distinct keys as a written table, for the right side of a semi- or anti-join.

    Spark then knows their size: few of them are broadcast and the left side stays
    where it is.  Beyond that the join is shuffled, and AQE may split a frequent key
    of the left side, which it may not where the right side is still an aggregate.
    """
    return staged(_distinct_keys(frame, column, name), "keys")


def reference_frontier(edges: DataFrame, known: DataFrame, known_id: str = "id_OpenAlex") -> DataFrame:
    """Ids that are referenced but not known, once each.

    Both sides are made distinct first, each task dropping its own repeats, so
    a much-cited work does not load one task.
    """
    return (_distinct_keys(edges, "dst", "id")
            .join(_distinct_keys(known, known_id, "id"), "id", "left_anti"))


def _spread_nulls(key: Column, *others: Column) -> Column:
    """The key, nulls replaced by values that match nothing and fall on all tasks."""
    return F.coalesce(key, F.concat(F.lit("\u0000"), F.xxhash64(*others).cast("string")))


def novel_candidates(candidates: DataFrame, held: DataFrame) -> DataFrame:
    """Candidates whose DOI and id are both not held; a null key matches nothing.

    One hash join per key in place of one condition with OR.
    """
    def without(frame: DataFrame, key: str, plain) -> DataFrame:
        others = [F.col(c) for c in candidates.columns]
        keyed = frame.withColumn("_key", _spread_nulls(plain(F.col(key)), *others))
        return keyed.join(key_table(held, plain(F.col(key)), "_key"), "_key", "left_anti").drop("_key")

    novel = without(candidates, "doi", normalize_doi)
    return without(novel, "id_OpenAlex", lambda column: column)


def _lookup_key(by: str) -> str:
    if by not in LOOKUP_KEYS:
        raise ValueError(f"id type {by!r} not supported, expected one of {', '.join(LOOKUP_KEYS)}")
    return LOOKUP_KEYS[by]


def _match_key(by: str, column: Column) -> Column:
    return normalize_doi(column) if by == "doi" else column


def _asked(ids: DataFrame, column: str, by: str) -> DataFrame:
    return _distinct_keys(ids, _match_key(by, F.col(column)), "_asked").where("_asked != ''")


# Bits of a bit map for each key, bits of one of its parts, and parts at most: 256 MB, which serve half a billion rows.
BITS_PER_KEY = 16
PART_BITS = 32_768
MAX_PARTS = 65_536


def likely_among(frame: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose ``column`` may be in the table ``keys``: all that are, and few others.

    For wide rows of which a join takes few: only these are then shuffled.  Hashes of the keys are
    marked in a bit map that every task gets; whether a row is kept in the end is up to the join.
    """
    parts = max(1, min(MAX_PARTS, -(-keys.count() * BITS_PER_KEY // PART_BITS)))

    def mark(name: str) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(parts * PART_BITS)) + 1

    marks = keys.select(mark(key).alias("mark"))
    maps = marks.groupBy(F.bitmap_bucket_number("mark").alias("_part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("mark")).alias("_bits"))
    place = F.bitmap_bit_position(mark(column)).cast("int")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.getbit(byte, F.pmod(place, F.lit(8))) == 1
    return frame.join(F.broadcast(maps), (F.bitmap_bucket_number(mark(column)) == F.col("_part")) & marked, "left_semi")


def lookup(snapshot: DataFrame, ids: DataFrame, by: str = "oaid", *, key: str | None = None,
           ids_column: str = "id") -> DataFrame:
    """Snapshot rows whose key is among ``ids``; null and empty ids are passed over.

    ``by`` is ``oaid`` or ``doi``; ``key`` names the snapshot column if it is not
    the canonical one.  Repeats in ``ids`` do not repeat rows.
    """
    key = key or _lookup_key(by)
    _lookup_key(by)
    asked = staged(_asked(ids, ids_column, by), "keys")
    keyed = likely_among(snapshot.withColumn("_asked", _match_key(by, F.col(key))), "_asked", asked, "_asked")
    return keyed.join(asked, "_asked", "left_semi").drop("_asked")


def lookup_missing(snapshot: DataFrame, ids: DataFrame, by: str = "oaid", *,
                   key: str | None = None, ids_column: str = "id") -> DataFrame:
    """Ledger ``(id, status)`` of the asked-for ids the snapshot does not have."""
    key = key or _lookup_key(by)
    _lookup_key(by)
    held = _distinct_keys(snapshot, _match_key(by, F.col(key)), "_asked")
    return (_asked(ids, ids_column, by).join(held, "_asked", "left_anti")
            .select(F.col("_asked").alias("id"), F.lit("not_found").alias("status")))


def status_counts(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("status").agg(F.count("*").alias("n"))


def _references_of(lists: DataFrame, layer: DataFrame) -> DataFrame:
    """Edges ``(src, dst)`` out of the works of a layer.

    ``lists`` has either ``src, dst`` or ``id, referenced_works``.  Lists are joined whole
    and only those that match are exploded.
    """
    if "dst" in lists.columns:
        return lists.join(layer.select(F.col("id").alias("src")), "src", "left_semi")
    return citation_edges(lists.join(layer.select("id"), "id", "left_semi"), "id", "referenced_works")


# Citing works in one row of a reversed list, on average for much-cited works and at most for others.
CHUNK = 1_000


def cited_by(edges: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The graph reversed, as a written table ``id, referenced_works``: cited work and works that cite it.

    The second name is that of a reference list, so that everything that follows lists also
    follows these.  A work cited more than ``chunk`` times has several rows, over which its
    citing works are dealt by hash, so neither a row nor a task holds a whole hub.  Only
    such works are looked up while dealing: there is at most one for each ``chunk`` edges.
    """
    pairs = edges.where("src IS NOT NULL AND dst IS NOT NULL").select("src", "dst").distinct()
    pairs = staged(pairs, "citations")
    hubs = staged(pairs.groupBy("dst").agg(F.count("*").alias("n")).where(F.col("n") > chunk)
                  .select("dst", F.ceil(F.col("n") / chunk).alias("parts")), "hubs")
    part = F.pmod(F.xxhash64("src"), F.coalesce("parts", F.lit(1)))
    return staged(pairs.join(hubs, "dst", "left").groupBy(F.col("dst").alias("id"), part.alias("part"))
                  .agg(F.collect_list("src").alias("referenced_works")).drop("part"), "cited-by")


def components(links: DataFrame) -> DataFrame:
    """``node, label``: for every node of the links ``a, b`` the smallest node it is connected with.

    Every node hooks onto its smallest neighbour, pointers are followed to their roots by doubling, and
    links between roots go on to the next round.  A round leaves at most half of the nodes that still
    have links, so later rounds are small and whatever is settled is not moved again.  Every step is a
    written table.
    """
    both = links.where("a IS NOT NULL AND b IS NOT NULL")
    edges = staged(both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    rounds = []
    while True:
        ends = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a"))
        hooked = ends.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("label"))
        roots = _roots(staged(hooked, "hooks"))
        rounds.append(roots)
        moved = roots.where("node <> label")
        first = moved.select(F.col("node").alias("a"), F.col("label").alias("to_a"))
        second = moved.select(F.col("node").alias("b"), F.col("label").alias("to_b"))
        led = edges.where("a <> b").join(second, "b", "left").join(first, "a", "left").select(
            F.coalesce("to_a", "a").alias("a"), F.coalesce("to_b", "b").alias("b")).where("a <> b")
        edges = staged(led.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
        if edges.isEmpty():
            break
    labels = rounds.pop()
    while rounds:
        labels = staged(_followed(rounds.pop(), labels.where("node <> label")).drop("goes_on"), "labels")
    return labels


def _followed(pointers: DataFrame, ahead: DataFrame) -> DataFrame:
    """``node, label, goes_on``: pointers whose label is a node of ``ahead`` take over its label."""
    ahead = ahead.select(F.col("node").alias("label"), F.col("label").alias("ahead"))
    return pointers.join(ahead, "label", "left").select(
        "node", F.coalesce("ahead", "label").alias("label"), F.col("ahead").isNotNull().alias("goes_on"))


def _roots(pointers: DataFrame) -> DataFrame:
    """``node, label``: where falling pointers end; the rounds follow the logarithm of the longest path."""
    while True:
        moved = pointers.where("node <> label")
        further = staged(_followed(moved, moved).where("goes_on"), "roots")
        if further.isEmpty():
            return pointers
        fresh = further.select("node", F.col("label").alias("further"))
        pointers = staged(pointers.join(fresh, "node", "left").select(
            "node", F.coalesce("further", "label").alias("label")), "hooks")


def unreachable(lists: DataFrame, reached: DataFrame, available: DataFrame, hops: int) -> DataFrame:
    """Ledger ``(id, status)`` of references that an expansion met and could not follow.

    ``reached`` is what :func:`expand_references` gave; works of the last hop were not followed.
    """
    followed = reached.where(F.col("hop") < hops)
    asked = _distinct_keys(_references_of(lists, followed), "dst", "id")
    held = available.select("id").union(reached.where("hop = 0").select("id"))
    return (asked.join(_distinct_keys(held, "id", "id"), "id", "left_anti")
            .select("id", F.lit("not_found").alias("status")))


def expand_references(seed: DataFrame, edges: DataFrame, available: DataFrame, hops: int = 1, *,
                      seed_id: str = "id_OpenAlex", available_id: str = "id_OpenAlex") -> DataFrame:
    """Works reached from ``seed`` along ``edges``: ``(id, hop)``, the seed at hop 0.

    ``edges`` has ``src, dst`` or, better, whole lists as ``id, referenced_works``.

    Each hop takes what the last one added, follows its references, leaves out
    what is held and keeps what ``available`` has.  A hop is written out before
    the next begins, so the plan stays short and a lost executor costs one hop.
    Only ids travel; look the records up once at the end.
    """
    layers = [staged(_distinct_keys(seed, seed_id, "id").withColumn("hop", F.lit(0)), "hop0")]
    obtainable = _distinct_keys(available, available_id, "id")
    for hop in range(1, hops + 1):
        held = reduce(DataFrame.unionByName, layers)
        found = (reference_frontier(_references_of(edges, layers[-1]), held, "id")
                 .join(obtainable, "id", "left_semi")
                 .withColumn("hop", F.lit(hop)))
        layer = staged(found, f"hop{hop}")
        if layer.isEmpty():
            break
        layers.append(layer)
    return reduce(DataFrame.unionByName, layers)
