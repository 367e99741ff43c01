"""Operators on hand-written edge rows and random tables."""

from __future__ import annotations

import random
from statistics import median

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeweave.functions.embedding import attach_vectors
from citeweave.operators import describe, graph, rows, search, yearly
from citeweave.plans.acquire import acquire, expand
from citeweave.schemas import WORK_JSON


def collected(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def medians(spark, pairs, kind="double"):
    frame = spark.createDataFrame(pairs, f"publication_year bigint, citation_count_OpenAlex {kind}")
    return {r[0]: r[1] for r in yearly.median_per_year(frame).collect()}


def test_median_edges(spark):
    nan = float("nan")
    pairs = [(2000, v) for v in (1.0, 2.0, 3.0, 10.0)] + [(2001, v) for v in (1.0, 2.0, None, 10.0, nan)]
    pairs += [(2002, None), (2002, nan), (2003, 0.0), (None, 5.0), (2004, -3.0), (2004, -1.0), (2004, 0.5)]
    assert medians(spark, pairs) == {2000: 2.5, 2001: 2.0, 2002: None, 2003: 0.0, 2004: -1.0}


@pytest.mark.parametrize("seed", range(3))
def test_median_equals_plain_python(spark, seed):
    draw = random.Random(seed)
    makers = [lambda: float(draw.randint(-3, 3)), lambda: draw.lognormvariate(2, 3),
              lambda: draw.uniform(-1, 1), lambda: draw.choice([0.0, 0.0, 1e12, -1e-9])]
    by_year = {2000 + i: [make() for _ in range(draw.randint(1, 400))] for i, make in enumerate(makers * 2)}
    by_year[2100] = [0.0] * 1000 + [draw.random() for _ in range(999)]  # one value in half of all rows
    pairs = [(y, v) for y, vs in by_year.items() for v in vs]
    draw.shuffle(pairs)
    assert medians(spark, pairs) == {y: median(vs) for y, vs in by_year.items()}


def test_median_of_any_year_and_of_a_narrow_band(spark):
    """Nearly equal values, all distinct, are ranked in ranges like any others."""
    band = [1e9 + i for i in range(20_001)]
    pairs = [(1500, v) for v in band] + [(9999, 1.0), (9999, float("inf")), (-3, None)]
    assert medians(spark, pairs) == {1500: 1e9 + 10_000, 9999: float("inf"), -3: None}
    frame = spark.createDataFrame(pairs, "publication_year bigint, citation_count_OpenAlex double")
    staged_ranges = []
    plain = yearly.staged
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yearly.staged = lambda made, step: staged_ranges.append(plain(made, step)) or staged_ranges[-1]
    try:
        yearly.median_per_year(frame).collect()
    finally:
        yearly.staged = plain
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["count"] for r in staged_ranges[0].groupBy("_range").count().collect()]
    assert max(sizes) < len(band) / 2


def test_capped_runs_land_every_work_in_the_end(spark):
    url = "https://openalex.org/"
    works = [{"id": f"{url}W{i}", "doi": f"10.1/{i}", "publication_year": 2020, "referenced_works": [],
              "locations": [{"source": {"id": f"{url}S1"}}]} for i in range(5)]
    snapshot = spark.createDataFrame(works, WORK_JSON)
    requests = spark.createDataFrame([("S1", 2020)], "journal_id string, publication_year int")
    held = [("none", "none")]
    landed, left = [], []
    for _ in range(4):
        known = spark.createDataFrame(held, "doi string, id_OpenAlex string")
        found = acquire(snapshot, requests, known, known, cap=2, fields=["id", "doi"])
        new = [(r.doi, r.id_OpenAlex) for r in found.works.collect()]
        held += new
        landed.append(sorted(i.removeprefix(f"{url}W") for _, i in new))
        left.append([r.n for r in found.left_out.collect()])
    assert landed == [["0", "1"], ["2", "3"], ["4"], []] and left == [[3], [1], [], []]
    plan = search.cap_per_group(spark.range(9_000).withColumn("g", F.col("id") % 3), ["g"], ["id"], 1001)
    assert "WindowGroupLimit" in plan._jdf.queryExecution().executedPlan().toString()


def test_histograms_account_for_every_row(spark):
    for values in ([1.0, 2.0, float("inf")], [float("-inf"), 3.0, None, float("nan")], [-1e308, 0.0, 1e308],
                   [float("inf")], [5e-324, 0.0]):
        found = describe.histograms(spark.createDataFrame([(v,) for v in values], "x double"), ["x"], 4).collect()
        assert sum(r.n for r in found) + found[0].n_missing + found[0].n_infinite == found[0].n_rows == len(values)
        assert all(np.isfinite([r.bin_start, r.bin_end]).all() for r in found)


def test_contract_report_on_a_column_that_cannot_be_cast(spark):
    frame = spark.createDataFrame([([1],), (None,)], "x array<int>")
    row = rows.contract_report(frame, T.StructType([T.StructField("x", T.LongType())])).first()
    assert (row.n_values, row.n_unfit, row.problem) == (1, 1, "type")


def test_attached_vectors_do_not_repeat_rows(spark):
    frame = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "k bigint, t string")
    vectors = spark.createDataFrame([(1, [0.5]), (1, [0.25]), (None, [9.0])], "v bigint, embedding array<float>")
    assert collected(attach_vectors(frame, vectors, "k", "v"), "t", "embedding") == [
        ("a", [0.25]), ("b", None), ("c", None)]


def test_yearly_stats_keep_every_work(spark):
    frame = spark.createDataFrame(
        [(1, 2000, 1.0), (2, 2000, 3.0), (3, None, 9.0), (4, 2001, None)],
        "id int, publication_year bigint, citation_count_OpenAlex double")
    found = collected(yearly.add_yearly_stats(frame), "id", "median_citation_count_year", "higher_than_median_year")
    assert found == [(1, 2.0, 0), (2, 2.0, 1), (3, None, 0), (4, None, 0)]


def test_keep_first_and_drop_null_key(spark):
    frame = spark.createDataFrame(
        [("a", 2, 30), ("a", 0, 10), ("a", 1, 20), (None, 0, 1), (None, 1, 2), ("b", 2, 5), ("", 0, 7)],
        "id_OpenAlex string, origin int, count int")
    kept = rows.keep_first(rows.drop_null_key(frame), "id_OpenAlex", ["origin"])
    assert collected(kept, "id_OpenAlex", "count") == [("", 7), ("a", 10), ("b", 5)]
    assert collected(rows.drop_null_key(frame, empty_too=True), "count") == [(5,), (10,), (20,), (30,)]
    again = rows.keep_first(kept, "id_OpenAlex", ["origin"])
    assert collected(again, "id_OpenAlex", "count") == collected(kept, "id_OpenAlex", "count")


def test_stage_counts(spark):
    frame = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "id_OpenAlex string")
    assert tuple(rows.stage_counts(frame).first()) == (4, 3, 2)


def test_contract_report(spark):
    contract = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType()),
                             T.StructField("c", T.LongType()), T.StructField("d", T.DoubleType())])
    frame = spark.createDataFrame([("1", "x", 1, None), ("y", None, 2, None)], "a string, b string, c int, e int")
    found = {r.column_name: (r.n_values, r.n_unfit, r.problem) for r in rows.contract_report(frame, contract).collect()}
    assert found == {"a": (2, 1, "values"), "b": (1, 0, None), "c": (2, 0, "type"),
                     "d": (None, None, "missing"), "e": (None, None, "extra")}


def test_frontier(spark):
    works = spark.createDataFrame([("a", ["b"]), ("c", []), ("d", None), ("e", ["e", "a", None])],
                                  "id_OpenAlex string, referenced_works_OpenAlex array<string>")
    edges = graph.citation_edges(works)
    assert collected(edges, "src", "dst") == [("a", "b"), ("e", "a"), ("e", "e")]
    assert collected(graph.reference_frontier(edges, works), "id") == [("b",)]


def test_novelty(spark):
    held = spark.createDataFrame([("10.1/a", "W1"), (None, "W2"), ("10.1/c", None)], "doi string, id_OpenAlex string")
    candidates = spark.createDataFrame(
        [("https://doi.org/10.1/a", "W9"), (None, "W3"), (None, "W2"), ("10.1/b", "W1"), ("10.1/d", "W4"),
         ("10.1/c", "W5"), (None, None), ("10.1/e", None), ("10.1/d", "W4")], "doi string, id_OpenAlex string")
    found = graph.novel_candidates(candidates, held)
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, [
        (None, "W3"), ("10.1/d", "W4"), ("10.1/d", "W4"), (None, None), ("10.1/e", None)]))
    assert found.columns == candidates.columns


def test_lookup(spark):
    snapshot = spark.createDataFrame([("W1", "10.1/a", 1), ("W2", "10.1/b", 2), (None, None, 3)],
                                     "id_OpenAlex string, doi string, n int")
    ids = spark.createDataFrame([("W1",), ("W1",), ("",), (None,), ("W7",)], "id string")
    assert collected(graph.lookup(snapshot, ids), "n") == [(1,)]
    missing = graph.lookup_missing(snapshot, ids)
    assert collected(missing, "id", "status") == [("W7", "not_found")]
    assert collected(graph.status_counts(missing), "status", "n") == [("not_found", 1)]
    dois = spark.createDataFrame([("https://doi.org/10.1/b",)], "id string")
    assert collected(graph.lookup(snapshot, dois, by="doi"), "n") == [(2,)]
    with pytest.raises(ValueError, match="not supported"):
        graph.lookup(snapshot, ids, by="isbn")


@pytest.fixture
def shuffled_joins(spark):
    """No broadcasts, and skew handling for small data."""
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k"}
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_frequent_keys_are_split(spark, shuffled_joins):
    """A third of the rows have one key: the join is right and the key is spread over tasks."""
    works = spark.range(0, 90_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("string").alias("id_OpenAlex"),
        F.when(F.col("id") % 3 != 1, F.concat(F.lit("10.1/"), F.col("id"))).alias("doi"),
        F.sha2(F.col("id").cast("string"), 512).alias("rest"))
    ids = spark.range(0, 1000).select(F.col("id").cast("string").alias("id")).union(
        spark.range(30_000).select(F.lit("7").alias("id")))
    found = graph.lookup(works, ids).agg(F.count("rest"))
    assert found.collect()[0][0] == 30_000 + sum(1 for i in range(1000) if i % 3)
    held = ids.select(F.col("id").alias("id_OpenAlex"), F.lit(None).cast("string").alias("doi"))
    novel = graph.novel_candidates(works, held).agg(F.count("rest"))
    assert novel.collect()[0][0] == 60_000 - sum(1 for i in range(1000) if i % 3)
    for frame in (found, novel):
        assert "skew=true" in frame._jdf.queryExecution().executedPlan().toString()


def test_expansion(spark):
    edges = spark.createDataFrame(
        [("a", "b"), ("a", "a"), ("b", "c"), ("c", "d"), ("d", "a"), ("b", "gone")]
        + [("a", f"r{i}") for i in range(7)], "src string, dst string")
    available = spark.createDataFrame([(c,) for c in "abcd"] + [(f"r{i}",) for i in range(7)], "id_OpenAlex string")
    seed = spark.createDataFrame([("a",), ("a",), (None,)], "id_OpenAlex string")
    reached = collected(graph.expand_references(seed, edges, available, hops=2), "id", "hop")
    assert reached == sorted([("a", 0), ("b", 1), ("c", 2)] + [(f"r{i}", 1) for i in range(7)])
    # More steps than there are: ends when nothing is added.
    assert graph.expand_references(seed, edges, available, hops=9).where("hop > 0").count() == 10


def test_histogram_edges(spark):
    def counts(values, bins):
        frame = spark.createDataFrame([(v,) for v in values], "x double")
        found = describe.histograms(frame, ["x"], bins).orderBy("bin").collect()
        return [r.n for r in found], found

    assert counts([1.0, 1.0, 1.0], 4)[0] == [0, 0, 3, 0]
    assert counts([0.0, 1.0, 2.0, 3.0, 4.0], 4)[0] == [1, 1, 1, 2]
    n, found = counts([1.0, 1.0, None, float("nan")], 4)
    assert n == [0, 0, 2, 0] and {r.n_rows for r in found} == {4}
    assert (found[0].bin_start, found[-1].bin_end) == (0.5, 1.5)
    n, found = counts([None], 2)
    assert n == [0, 0] and (found[0].bin_start, found[-1].bin_end) == (0.0, 1.0)


@pytest.mark.parametrize("seed", range(2))
def test_histogram_equals_numpy(spark, seed):
    draw = np.random.default_rng(seed)
    columns = {"a": draw.normal(size=3000), "b": draw.integers(0, 50, 3000) * 0.1, "c": np.round(draw.random(3000), 2)}
    frame = spark.createDataFrame([tuple(map(float, r)) for r in zip(*columns.values())],
                                  "a double, b double, c double")
    found = describe.histograms(frame, list(columns)).orderBy("column_name", "bin").collect()
    for name, cells in columns.items():
        expected, edges = np.histogram(cells, bins=200)
        lines = [r for r in found if r.column_name == name]
        assert [r.n for r in lines] == expected.tolist()
        assert np.allclose([r.bin_start for r in lines] + [lines[-1].bin_end], edges)


def test_year_density_counts_every_point(spark):
    frame = spark.createDataFrame([(2000, 1.0), (2000, 1.0), (2001, 5.0), (2001, None), (None, 2.0)],
                                  "publication_year int, x double")
    found = describe.year_density(frame, "x", bins=4)
    assert collected(found, "publication_year", "bin", "bin_start", "n") == [(2000, 0, 1.0, 2), (2001, 3, 4.0, 1)]
    assert describe.year_points(frame, "x").columns == ["publication_year", "x"]


def test_searches(spark):
    works = spark.createDataFrame(
        [("W1", "d1", 2000, [{"source": {"id": "https://openalex.org/S1"}}, {"source": {"id": "https://openalex.org/S1"}}]),
         ("W2", "d2", 2000, [{"source": {"id": "https://openalex.org/S2"}}, {"source": None}]),
         ("W3", "d3", 2001, [{"source": {"id": "https://openalex.org/S1"}}]), ("W4", "d4", 2000, None)],
        "id string, doi string, publication_year int, locations array<struct<source:struct<id:string>>>")
    assert collected(search.filter_journal_year(works, "S1", 2000), "id") == [("W1",)]
    assert collected(search.filter_journal_year(works, "https://openalex.org/S2", 2000), "id") == [("W2",)]
    assert collected(search.filter_year_range(works, 2001, 2001), "id") == [("W3",)]
    assert search.filter_year_range(works, 2001, 2000).count() == 4
    requests = spark.createDataFrame([("S1", 2000), ("S1", 2000), ("S1", 2001), ("S3", 2000)],
                                     "journal_id string, publication_year int")
    assert collected(search.search_works(works, requests), "id_OpenAlex", "publication_year") == [
        ("W1", 2000), ("W3", 2001)]


@pytest.mark.parametrize("cap", [1, 7, 500])
def test_cap_of_a_hot_group(spark, cap):
    frame = spark.range(3000).select(
        F.when(F.col("id") < 2000, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 40)).alias("g"),
        ((F.col("id") * 7919) % 3001).alias("o"), F.col("id").alias("v"))
    groups = {}
    for g, o, v in frame.collect():
        groups.setdefault(g, []).append((o, v))
    expected = sorted((g, o, v) for g, members in groups.items() for o, v in sorted(members)[:cap])
    assert collected(search.cap_per_group(frame, ["g"], ["o"], cap), "g", "o", "v") == expected


def test_journal_lookup(spark):
    journals = spark.createDataFrame([("https://openalex.org/S3", "Cell"), ("https://openalex.org/S1", "CELL"),
                                      ("https://openalex.org/S2", "Gut")], "id string, display_name string")
    names = spark.createDataFrame([("Cell",), (" cell ",), ("Gut",), ("Gut",), ("Mind",), (None,)], "name string")
    assert collected(search.journal_lookup(names, journals), "name", "journal_id") == [
        (" cell ", "S1"), ("Cell", "S3"), ("Gut", "S2")]


def test_attach_vectors(spark):
    frame = spark.createDataFrame([(1,), (2,)], "k int")
    vectors = spark.createDataFrame([(1, [0.5]), (3, [1.0])], "v int, embedding array<float>")
    assert collected(attach_vectors(frame, vectors, "k", "v"), "k", "embedding") == [(1, [0.5]), (2, None)]


@pytest.mark.parametrize("parts", [1, 17])
def test_results_do_not_depend_on_partitions(spark, sf_dir, parts):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").repartition(parts)
    order = [c for c in lines.columns if c != "l_orderkey"]
    first = rows.keep_first(lines, "l_orderkey", order)
    assert first.count() == lines.select("l_orderkey").distinct().count()
    totals = first.agg(F.sum("l_partkey"), F.sum("l_suppkey"), F.sum("l_linenumber")).first()
    plain = lines.groupBy("l_orderkey").agg(F.min(F.struct(*order)).alias("r"))
    assert totals == plain.agg(F.sum("r.l_partkey"), F.sum("r.l_suppkey"), F.sum("r.l_linenumber")).first()


def test_lookup_moves_few_of_the_rows_it_leaves_out(spark):
    works = spark.range(50_000).select(F.when(F.col("id") % 7 != 3, F.concat(F.lit("W"), "id")).alias("id_OpenAlex"), "id")
    keys = spark.range(0, 50_000, 10).select(F.concat(F.lit("W"), "id").alias("key"))
    # Before, there was no such step: a lookup shuffled all rows, wide ones too.
    likely = graph.likely_among(works, "id_OpenAlex", keys, "key")
    assert likely.count() < 10_000
    wanted = {(f"W{i}", i) for i in range(0, 50_000, 10) if i % 7 != 3}
    assert wanted <= {tuple(r) for r in likely.collect()}
    assert {tuple(r) for r in graph.lookup(works.union(works), keys, ids_column="key").collect()} == wanted
    assert graph.lookup(works.union(works), keys, ids_column="key").count() == 2 * len(wanted)
    assert graph.lookup(works, keys.limit(0), ids_column="key").count() == 0
    plan = graph.lookup(works, keys, ids_column="key")._jdf.queryExecution().optimizedPlan().toString()
    assert "bitmap_construct_agg" in plan


def test_expansion_shuffles_flat_records(spark):
    records = [(f"W{i}", [f"W{i + 1}"], {"b": [1], "a": [0]}) for i in range(5)]
    snapshot = spark.createDataFrame(records, "id string, referenced_works array<string>, abstract_inverted_index map<string,array<int>>")
    seed = spark.createDataFrame([("W0",)], "id_OpenAlex string")
    found = expand(snapshot, seed, hops=2, fields=["abstract_inverted_index"])
    assert sorted(map(tuple, found.collect())) == [("a b", 1), ("a b", 2)]
    # Before, all records went into the join, and with their inverted indexes.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "bitmap_construct_agg" in plan and plan.index("Join Inner") < plan.index("map_entries")
