"""Mixing sources to target weights, with DataFrame functions only.

Weights become targets by water-filling: no source gives more than three times its size,
and what it cannot give the others share.  Documents of a source lie in blocks by hash, in
an order that is a random permutation; a source's quota is a number of whole passes and,
in the last pass, of the first blocks, the last of which is cut to fit.  A binary tree then
deals the quotas to output shards: at each node, how many blocks of each source go left is
drawn from the multivariate hypergeometric distribution, so every shard gets an exact
quota, and shards draw disjoint runs of the permuted blocks.  Within a shard documents are
shuffled by hash.  Only sizes travel; texts are read once, by the task that counts words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from citeweave.llm.common import WORD, named
from citeweave.sources.tables import staged

# Fixed values of the mix: weights by rank of the source, and the most passes over it.
WEIGHTS = (5, 2, 1)
MOST_PASSES = 3
BLOCK_DOCS = 256  # documents meant to share a block
MOST_BLOCKS = 1 << 16  # blocks of one source; larger sources have larger blocks
SHARD_WORDS = 4 << 20  # words meant to share a shard
BROADCAST_SOURCES = 10_000  # a source table of more rows is joined by shuffle
SEED = 20_240_229


def word_count(text: Column) -> Column:
    """Number of runs of non-blanks; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def water_filled(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_PASSES) -> DataFrame:
    """Adds ``weight`` and ``target`` to one row per ``source`` with its ``source_size``.

    Sources in order of code point, null last, take the weights in turn.  Targets share
    the total size by weight; a target above ``most`` times its source's size is set to
    that, and the rest is shared again until none is above.  Each round is one
    aggregate; there are at most as many rounds as sources.
    """
    # Rank without one task for all: ranks within ranges, plus the rows of the ranges before.
    ranged = staged(sources.withColumn("_null", F.col("source").isNull()).repartitionByRange("_null", "source")
                    .withColumn("_range", F.spark_partition_id()), "sources")
    own = F.row_number().over(W.partitionBy("_range").orderBy("_null", "source"))
    counts = {row["_range"]: row["count"] for row in ranged.groupBy("_range").count().collect()}
    before, total = {}, 0
    for part in sorted(counts):  # one entry per range, as many as there are shuffle partitions
        before[part], total = total, total + counts[part]
    offset = F.element_at(F.create_map(*[F.lit(x) for pair in before.items() for x in pair]),
                          F.col("_range")) if before else F.lit(0)
    rank = (own - 1 + offset) % len(weights) + 1
    weighted = staged(ranged.select("source", "source_size", "n_docs", F.element_at(
        F.array(*[F.lit(w) for w in weights]), rank.cast("int")).cast("double").alias("weight")), "weights")
    limit = F.col("source_size") * F.lit(float(most))
    full = weighted.agg(F.sum("source_size").cast("double")).first()[0] or 0.0
    level, closed = None, -1
    while True:
        # Sources whose share at this level is too high give all they may.
        over = F.lit(False) if level is None else F.col("weight") * F.lit(level) >= limit
        row = weighted.agg(F.coalesce(F.sum(F.when(over, limit)), F.lit(0.0)).alias("fixed"),
                           F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)).alias("open"),
                           F.count_if(over).alias("closed")).first()
        if row["closed"] == closed or not row["open"]:
            break
        closed, level = row["closed"], (full - row["fixed"]) / row["open"]
    share = F.col("weight") * F.lit(level if level is not None else 0.0)
    return weighted.withColumn("target", F.least(share, limit))


def _uniform(*parts: Column) -> Column:
    """A number in (0, 1) from a hash of the parts."""
    return (F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))


def hypergeometric(draws: Column, good: Column, total: Column, uniform: Column) -> Column:
    """How many of ``draws`` drawn from ``total`` without replacement are among the ``good``.

    The distribution function is inverted over the mean plus and minus twelve standard
    deviations; what lies outside has less probability than a double resolves.
    """
    n, k, all_ = (x.cast("double") for x in (draws, good, total))
    mean = n * k / F.greatest(all_, F.lit(1.0))
    spread = F.sqrt(F.greatest(mean * (1 - k / F.greatest(all_, F.lit(1.0)))
                               * (all_ - n) / F.greatest(all_ - 1, F.lit(1.0)), F.lit(0.0)))
    low = F.greatest(F.lit(0.0), n + k - all_, F.floor(mean - 12 * spread - 1).cast("double")).cast("bigint")
    high = F.greatest(low, F.least(n, k, F.ceil(mean + 12 * spread + 1).cast("double")).cast("bigint"))

    def ratio(x: Column) -> Column:  # probability of x + 1 over that of x
        return (k - x) * (n - x) / ((x + 1) * (all_ - k - n + x + 1))

    def start(**more: Column) -> Column:
        return F.struct(F.lit(1.0).alias("p"), F.lit(1.0).alias("sum"), *[v.alias(c) for c, v in more.items()])

    def upto(state: Column, x: Column) -> tuple[Column, Column]:
        p = state["p"] * F.greatest(ratio(x.cast("double")), F.lit(0.0))
        return p, state["sum"] + p

    def weigh(state: Column, x: Column) -> Column:
        p, added = upto(state, x)
        return F.struct(p.alias("p"), added.alias("sum"))

    steps = F.when(high > low, F.sequence(low, high - 1)).otherwise(F.array().cast("array<bigint>"))
    mass = F.aggregate(steps, start(), weigh, lambda state: state["sum"])

    def seek(state: Column, x: Column) -> Column:
        p, added = upto(state, x)
        past = state["sum"] < uniform * state["mass"]
        return F.struct(p.alias("p"), added.alias("sum"), state["mass"].alias("mass"),
                        (state["found"] + past.cast("bigint")).alias("found"))

    found = F.aggregate(steps, start(mass=mass, found=F.lit(0).cast("bigint")), seek, lambda state: state["found"])
    return low + found


def _draw(seed: int, level: int):
    """Takes the left half's share of one source and passes on what is open."""
    def draw(state: Column, run: Column) -> Column:
        uniform = _uniform(F.lit(seed), F.lit(level), F.col("node"), run["source"])
        taken = hypergeometric(state["open"], run["quota"], state["total"], uniform)
        return F.struct((state["open"] - taken).alias("open"), (state["total"] - run["quota"]).alias("total"),
                        F.concat(state["taken"], F.array(taken)).alias("taken"))

    return draw


def shard_quotas(quotas: DataFrame, levels: int, seed: int = SEED) -> DataFrame:
    """``shard, source, first, quota``: for each of ``2 ** levels`` shards its run of each source's blocks.

    ``quotas`` has ``source, blocks``.  Every node of the tree halves its number of blocks
    and draws, source after source, how many of each go left.  A node is one row that
    holds a number per source.
    """
    ordered = quotas.where("blocks > 0").agg(F.array_sort(F.collect_list(F.struct(
        "source", F.lit(0).cast("bigint").alias("first"), F.col("blocks").alias("quota")))).alias("runs"))
    nodes = ordered.select(F.lit(0).cast("bigint").alias("node"), "runs")
    for level in range(levels):
        total = F.aggregate("runs", F.lit(0).cast("bigint"), lambda acc, run: acc + run["quota"])
        left = F.floor((total + F.pmod(F.col("node"), F.lit(2))) / 2).cast("bigint")

        begin = F.struct(left.alias("open"), total.alias("total"), F.array().cast("array<bigint>").alias("taken"))
        drawn = nodes.withColumn("taken", F.aggregate(
            "runs", begin, _draw(seed, level), lambda state: state["taken"]))
        one = F.zip_with("runs", "taken", lambda run, taken: F.struct(
            run["source"].alias("source"), run["first"].alias("first"), taken.alias("quota")))
        two = F.zip_with("runs", "taken", lambda run, taken: F.struct(
            run["source"].alias("source"), (run["first"] + taken).alias("first"),
            (run["quota"] - taken).alias("quota")))
        # Written per level: the next one does not draw again.
        nodes = staged(drawn.select(F.explode(F.array(
            F.struct((F.col("node") * 2).alias("node"), one.alias("runs")),
            F.struct((F.col("node") * 2 + 1).alias("node"), two.alias("runs")))).alias("half")).select("half.*"),
            "shard-tree")
    return nodes.select(F.col("node").alias("shard"), F.inline("runs")).where("quota > 0")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, most_passes: int = MOST_PASSES, shard_words: int = SHARD_WORDS,
        block_docs: int = BLOCK_DOCS, seed: int = SEED) -> DataFrame:
    """For each row of ``docs`` how often and where the mix takes it.

    A document's size is its number of words (null text: 0), null sources are a source of
    their own, and so are empty names.  Documents of size 0 count for nothing and follow
    the blocks they lie in.  Rows with equal id and source are told apart by nothing but
    their text's hash; fully equal rows share their fate.  Rows without an id take part.
    A source of size 0 gives nothing; an empty table gives an empty result.  Reruns on
    the same rows agree.

    Returns ``doc_id, source, size, source_size, target, copies, taken, shards, places,
    row_key``: ``taken`` is ``size * copies``, ``shards`` holds one shard per copy and
    ``places`` orders the documents of that shard.
    """
    row_key = F.xxhash64(named(id_col), F.coalesce(named(text_col), F.lit("")), named(source_col))
    sized = staged(docs.select(
        named(id_col).alias("doc_id"), named(source_col).cast("string").alias("source"),
        word_count(named(text_col)).alias("size"), row_key.alias("row_key")), "sizes")
    sources = water_filled(sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")), weights, most_passes)
    n_blocks = F.least(F.lit(MOST_BLOCKS), F.ceil(F.col("n_docs") / F.lit(block_docs))).cast("bigint")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = staged(sources.withColumns({"n_blocks": n_blocks, "passes": passes.cast("bigint")}).withColumn(
        "rest", F.greatest(F.col("target") - F.col("passes") * F.col("source_size"), F.lit(0.0))), "mix-plan")
    few = plan.count() <= BROADCAST_SOURCES
    planned = (F.broadcast(plan) if few else plan).withColumnRenamed("source", "_source")
    # The block by hash is a place in a random order of the source's documents.
    spot = F.xxhash64(F.lit(seed), F.col("row_key"))
    placed = sized.join(planned, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumns(
        {"spot": spot, "block": F.pmod(spot, F.col("n_blocks"))})
    blocks = placed.groupBy("source", "block").agg(
        F.sum("size").alias("block_size"), F.first("passes").alias("passes"), F.first("rest").alias("rest"))
    order = W.partitionBy("source").orderBy("block")  # at most MOST_BLOCKS rows
    blocks = staged(blocks.withColumns({
        "before": F.coalesce(F.sum("block_size").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
        "draw": F.row_number().over(order) - 1, "n_draws": F.count(F.lit(1)).over(W.partitionBy("source"))}), "blocks")
    room = F.col("rest") - F.col("before")
    blocks = blocks.withColumns({
        "room": room, "whole": (room >= F.col("block_size")) & (F.col("rest") > 0),
        "cut": (room > 0) & (room < F.col("block_size"))})

    # The cut block takes documents, large ones first, as long as they fit.
    cut = blocks.where("cut").select("source", "block", F.col("room").alias("cut_room"))
    inside = placed.join(cut.withColumnsRenamed({"source": "_source", "block": "_block"}),
                         F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block")))
    listed = inside.groupBy("source", "block").agg(
        F.first("cut_room").alias("cut_room"),
        F.sort_array(F.collect_list(F.struct("size", "row_key")), asc=False).alias("docs"))

    def fit(state: Column, doc: Column) -> Column:
        fits = (doc["size"] <= state["room"] + doc["size"] / 2) & (doc["size"] <= state["room"])
        return F.struct(F.when(fits, state["room"] - doc["size"]).otherwise(state["room"]).alias("room"),
                        F.when(fits, F.concat(state["keys"], F.array(doc["row_key"]))).otherwise(state["keys"])
                        .alias("keys"))

    begin = F.struct(F.col("cut_room").alias("room"), F.array().cast("array<bigint>").alias("keys"))
    fitting = listed.select("source", "block", F.explode(F.array_distinct(F.aggregate(
        "docs", begin, fit, lambda state: state["keys"]))).alias("fit_key"))

    # Quotas in blocks, dealt to shards by the tree; a source's blocks are drawn in turn.
    quotas = blocks.groupBy("source").agg(
        (F.first("passes") * F.first("n_draws") + F.count_if(F.col("whole") | F.col("cut"))).alias("blocks"))
    words = sized.agg(F.sum("size")).first()[0] or 0
    levels = max(0, -(-words // shard_words) - 1).bit_length()
    runs = shard_quotas(quotas, levels, seed)
    drawn = runs.withColumnsRenamed({"source": "_source"}).select("_source", "shard", F.explode(F.sequence(
        F.col("first"), F.col("first") + F.col("quota") - 1)).alias("unit"))
    units = blocks.select("source", "block", "draw", "n_draws", "cut").select("*", F.explode(F.sequence(
        F.lit(0), F.lit(most_passes))).alias("turn")).withColumn("unit", F.col("turn") * F.col("n_draws")
                                                                + F.col("draw"))
    dealt = units.join(drawn, F.col("source").eqNullSafe(F.col("_source")) & (units["unit"] == drawn["unit"])).groupBy(
        "source", "block").agg(F.array_sort(F.collect_list(F.struct("turn", "shard"))).alias("turns"),
                               F.first("cut").alias("cut"))

    with_turns = placed.join(dealt.withColumnsRenamed({"source": "_source", "block": "_block"}), F.col("source")
                             .eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block")), "left").drop(
        "_source", "_block")
    chosen = with_turns.join(fitting.withColumnsRenamed({"source": "_source", "block": "_block"}), F.col("source")
                             .eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block"))
                             & (F.col("row_key") == F.col("fit_key")), "left")
    last_is_out = F.coalesce(F.col("cut"), F.lit(False)) & F.col("fit_key").isNull()
    turns = F.coalesce(F.filter("turns", lambda turn: (turn["turn"] < F.col("passes")) | ~last_is_out),
                       F.array().cast("array<struct<turn:int,shard:bigint>>"))
    return chosen.withColumn("turns", turns).select(
        "doc_id", "source", "size", "source_size", "target", F.size("turns").alias("copies"),
        (F.col("size") * F.size("turns")).alias("taken"),
        F.transform("turns", lambda turn: turn["shard"]).alias("shards"),
        F.transform("turns", lambda turn: F.xxhash64(F.lit(seed), turn["shard"], turn["turn"], F.col("row_key")))
        .alias("places"), "row_key")


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with ``_shard`` and ``_place``.

    Rows of a shard lie in one task, shuffled there by ``_place``; all columns of ``docs`` stay,
    but for any that are called ``_shard`` or ``_place`` themselves.
    """
    taken = mix(docs, id_col, text_col, source_col, **options).where("copies > 0").select(
        F.col("row_key").alias("_mx_key"), F.arrays_zip("shards", "places").alias("_mx_turns")).dropDuplicates(
        ["_mx_key"])
    own_key = F.xxhash64(named(id_col), F.coalesce(named(text_col), F.lit("")), named(source_col))
    met = docs.withColumn("_mx_own", own_key).join(taken, F.col("_mx_own") == F.col("_mx_key"))
    rows = met.withColumn("_mx_turn", F.explode("_mx_turns")).withColumns(
        {"_shard": F.col("_mx_turn.shards"), "_place": F.col("_mx_turn.places")})
    return rows.drop("_mx_own", "_mx_key", "_mx_turns", "_mx_turn").repartition("_shard").sortWithinPartitions(
        "_shard", "_place")
