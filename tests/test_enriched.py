"""Merging services, citing works, bibliometrics, standing and trends on hand-written and skewed rows."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from citeweave.functions.ids import canonical_doi
from citeweave.operators import graph, impact, merge, standing, trends


def tuples(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=lambda r: [(v is not None, v or 0) if not
                  isinstance(v, str) else (True, v) for v in r])


# --- merging

RECORDS = "service string, doi string, id_OpenAlex string, s2_paper_id string, title string, citation_count bigint"


def merged(spark, rows):
    frame = spark.createDataFrame(rows, RECORDS)
    aligned = [merge.aligned(frame.where(F.col("service") == s), s, {n: n for n in frame.columns}) for s in
               ("openalex", "semantic_scholar", "crossref", "other")]
    return aligned[0].unionByName(aligned[1]).unionByName(aligned[2]).unionByName(aligned[3])


def test_merge_follows_shared_identifiers(spark):
    records = merged(spark, [
        ("openalex", "https://doi.org/10.1/A", "W1", None, "first", 5),
        ("semantic_scholar", "10.1/a", None, "p1", None, 7),          # same DOI
        ("crossref", " DOI:10.1/B ", None, None, "other title", None),
        ("semantic_scholar", "10.1/b", None, "p1", None, 9),          # same paper: both DOIs are one work
        ("openalex", None, "W2", None, "alone", None), ("openalex", None, "W2", None, "Alone", 0),
        ("other", "10.1/c", None, " ", "x", 1), ("crossref", None, None, "", "lost", 1), ("other", None, None, None, None, None)])
    matched = merge.with_entity(records)
    table = {r["entity"]: r for r in merge.merge_records(matched).collect()}
    assert set(table) == {"doi:10.1/a", "id_OpenAlex:W2", "doi:10.1/c"}
    one = table["doi:10.1/a"]
    assert (one["doi"], one["id_OpenAlex"], one["s2_paper_id"], one["title"], one["citation_count"]) == (
        "10.1/a", "W1", "p1", "first", 5)
    assert (one["n_records"], one["services"]) == (4, ["crossref", "openalex", "semantic_scholar"])
    assert (table["id_OpenAlex:W2"]["title"], table["id_OpenAlex:W2"]["citation_count"]) == ("Alone", 0)
    ledger = merge.conflicts(matched).collect()
    assert {(r["field"], r["value"], r["service"], r["chosen"]) for r in ledger if r["entity"] == "doi:10.1/a"} == {
        ("doi", "10.1/a", "openalex", True), ("doi", "10.1/b", "semantic_scholar", False),
        ("title", "first", "openalex", True), ("title", "other title", "crossref", False),
        ("citation_count", "5", "openalex", True), ("citation_count", "7", "semantic_scholar", False),
        ("citation_count", "9", "semantic_scholar", False)}
    assert merge.unidentified(records).count() == 2
    # Every field takes the value that the ledger marks.
    for row in ledger:
        if row["chosen"]:
            assert str(table[row["entity"]][row["field"]]) == row["value"]


def test_merge_of_a_chain_and_of_a_much_shared_key(spark):
    chain = [("semantic_scholar", f"10.1/{i}", None, f"p{i // 2 if i % 2 else i // 2 - 1}", None, i) for i in range(400)]
    chain += [("openalex", f"10.1/{i}", None, f"p{i // 2}", None, i) for i in range(400)]
    hot = [("crossref", "10.9/hot", f"W{i}", None, "t", i) for i in range(3000)]
    table = merge.merge_records(merge.with_entity(merged(spark, chain + hot))).collect()
    assert sorted(r["n_records"] for r in table) == [800, 3000]


def test_merge_of_nothing(spark):
    assert merge.merge_records(merge.with_entity(merged(spark, []))).count() == 0
    assert merge.conflicts(merge.with_entity(merged(spark, []))).count() == 0


def test_components_equal_plain_python(spark):
    draw = random.Random(4)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(1000, 1000), (None, 5)]
    label = {n: n for pair in links if None not in pair for n in pair}
    for _ in label:
        for a, b in links:
            if a is not None:
                label[a] = label[b] = min(label[a], label[b])
    found = graph.components(spark.createDataFrame(links, "a bigint, b bigint"))
    assert dict(map(tuple, found.collect())) == label


def test_canonical_doi(spark):
    given = ["https://doi.org/10.1/A", "http://dx.doi.org/10.1/a", "doi: 10.1/a", " 10.1/A ", "", "  ", None]
    frame = spark.createDataFrame([(d,) for d in given], "doi string")
    assert [r[0] for r in frame.select(canonical_doi(F.col("doi"))).collect()] == ["10.1/a"] * 4 + [None] * 3


# --- citing works

def test_a_hub_is_many_rows_in_many_tasks(spark):
    """100,000 works cite one; lists stay short, lie in many tasks, and no citing work is lost."""
    edges = spark.range(100_000).select(F.col("id").alias("src"), F.lit(-1).cast("bigint").alias("dst")).union(
        spark.range(50).select("id", (F.col("id") + 1).alias("dst")))
    name = "spark.sql.adaptive.coalescePartitions.enabled"  # small parts would be put together again
    spark.conf.set(name, "false")
    try:
        lists = graph.cited_by(edges.union(edges))
    finally:
        spark.conf.unset(name)
    hub = lists.where("id = -1").select(F.size("referenced_works").alias("n"), F.input_file_name().alias("written_by"))
    sizes = [r["n"] for r in hub.collect()]
    assert sum(sizes) == 100_000 and len(sizes) == 100 and max(sizes) < 2 * graph.CHUNK
    assert hub.select("written_by").distinct().count() > 1
    works = spark.range(-1, 100_000).withColumnRenamed("id", "id_OpenAlex")
    reached = graph.expand_references(spark.createDataFrame([(-1,)], "id_OpenAlex bigint"), lists, works, 2)
    assert dict(map(tuple, reached.groupBy("hop").count().collect())) == {0: 1, 1: 100_000}


def test_reversed_lists_of_few_and_no_citations(spark):
    edges = spark.createDataFrame([(1, 2), (1, 2), (3, 2), (2, 1), (None, 1), (4, None)], "src bigint, dst bigint")
    lists = {r["id"]: sorted(r["referenced_works"]) for r in graph.cited_by(edges).collect()}
    assert lists == {2: [1, 3], 1: [2]}
    assert graph.cited_by(edges.limit(0)).count() == 0


def test_unreachable_references_are_listed(spark):
    lists = spark.createDataFrame([(1, [2, 9, None]), (2, [3, 8]), (3, [7])], "id bigint, referenced_works array<bigint>")
    held = spark.createDataFrame([(2,), (3,)], "id bigint")
    seed = spark.createDataFrame([(1,)], "id_OpenAlex bigint")
    reached = graph.expand_references(seed, lists, held, 2, available_id="id")
    assert tuples(graph.unreachable(lists, reached, held, 2), "id", "status") == [(8, "not_found"), (9, "not_found")]


# --- bibliometrics

def plain_h(counts):
    ranked = sorted((int(c) for c in counts if c is not None and c == c and c >= 1), reverse=True)
    return sum(c >= nth for nth, c in enumerate(ranked, 1))


@pytest.mark.parametrize("seed", range(3))
def test_h_index_equals_plain_python(spark, seed):
    draw = random.Random(seed)
    groups = {"small": [draw.choice([0, 1, 2, 3, None, float("nan"), -4, 2.9]) for _ in range(40)],
              "none": [0, None], "one": [7], "large": [draw.paretovariate(0.4) for _ in range(20_000)],
              "equal": [9_000.0] * 9_500, "beyond": [float(draw.randint(8_000, 20_000)) for _ in range(17_000)],
              "huge": [1e15] * 5, None: [5, 6]}
    rows = [(name, None if c is None else float(c)) for name, counts in groups.items() for c in counts]
    frame = spark.createDataFrame(rows, "journal string, citation_count_OpenAlex double").repartition(7)
    found = {r["journal"]: (r["n_works"], r["h_index"]) for r in impact.h_index(frame).collect()}
    assert found == {name: (len(c), plain_h(c)) for name, c in groups.items() if name is not None}


def test_h_index_does_not_bring_a_journal_together(spark):
    """Nine tenths of the works in one journal: windows run over steps and the counts of one step."""
    works = spark.range(200_000).select(F.when(F.col("id") % 10 > 0, "main").otherwise("other").alias("journal"),
                                        (F.col("id") * 7 % 50_000).alias("citation_count_OpenAlex"))
    found = impact.h_index(works)
    assert {r["journal"]: r["h_index"] for r in found.collect()} == {
        name: plain_h([i * 7 % 50_000 for i in range(200_000) if (i % 10 > 0) == (name == "main")])
        for name in ("main", "other")}


def test_calendar_and_velocity_of_odd_works(spark):
    works = spark.createDataFrame([(1, 2000), (2, 2003), (2, 2004), (3, None), (4, 2010), (5, 2001), (None, 2000)],
                                  "id_OpenAlex bigint, publication_year int")
    edges = spark.createDataFrame([(2, 1), (2, 1), (5, 1), (3, 1), (77, 1), (4, 1), (1, 2), (2, 3), (None, 1), (1, None), (1, 88)],
                                  "src bigint, dst bigint")
    citations = impact.dated_citations(works, edges)
    calendar = impact.citation_calendar(works, citations, 2004)
    assert tuples(calendar.where("id = 1"), "year", "age", "n", "n_upto") == [
        (2000, 0, 0, 0), (2001, 1, 1, 1), (2002, 2, 0, 1), (2003, 3, 1, 2), (2004, 4, 0, 2)]
    # Cited before it appeared; no calendar without a year or after the last one.
    assert tuples(calendar.where("id = 2"), "year", "age", "n") == [
        (2000, -3, 1), (2001, -2, 0), (2002, -1, 0), (2003, 0, 0), (2004, 1, 0)]
    assert {r["id"] for r in calendar.select("id").distinct().collect()} == {1, 2, 5}
    velocity = {r["id"]: tuple(r)[1:] for r in impact.citation_velocity(works, citations, 2004).collect()}
    assert velocity == {1: (2000, 2, 2, 2001, 2001, 1, 0.4, 1 / 3), 2: (2003, 1, 0, 2000, 2000, 0, 0.5, 0.0),
                        3: (None, 1, 0, 2003, 2003, 1, None, None), 4: (2010, 0, 0, None, None, 0, None, None),
                        5: (2001, 0, 0, None, None, 0, 0.0, 0.0)}


# --- standing

def test_percentiles_with_ties_and_missing_values(spark):
    rows = [(1, 2000, 5.0), (2, 2000, 5.0), (3, 2000, 9.0), (4, 2000, None), (5, 2000, float("nan")), (6, 2001, 1.0),
            (7, None, 1.0), (8, 2002, float("inf")), (9, 2000, -0.0), (10, 2000, 0.0)]
    works = spark.createDataFrame(rows, "id int, publication_year int, citation_count_OpenAlex double")
    found = standing.add_percentile(works, "share")
    assert dict(tuples(found, "id", "share")) == {1: 0.5, 2: 0.5, 3: 1.0, 4: None, 5: None, 6: 0.0, 7: None, 8: None, 9: 0.0, 10: 0.0}
    assert found.columns == [*works.columns, "share"]


def test_percentiles_of_one_large_year(spark):
    """A third of a year has one value; ranges, not the year, are the groups of the window."""
    draw = np.random.default_rng(3)
    values = np.where(draw.random(30_000) < 0.33, 0.0, draw.lognormal(3, 2, 30_000))
    works = spark.createDataFrame([(i, 2000, float(v)) for i, v in enumerate(values)],
                                  "id int, publication_year int, citation_count_OpenAlex double").repartition(9)
    order = np.sort(values)
    expected = np.searchsorted(order, values, "left") / (len(values) - 1)
    found = dict(tuples(standing.add_percentile(works, "share"), "id", "share"))
    assert [found[i] for i in range(len(values))] == expected.tolist()


def test_normalised_counts_far_from_zero(spark):
    base = 1e15
    rows = [(i, 2000, base + i % 5) for i in range(1000)] + [(2000, 2001, 7.0), (2001, 2001, 7.0), (2002, 2002, None),
                                                              (2003, 2003, 0.0), (2004, None, 3.0)]
    works = spark.createDataFrame(rows, "id int, publication_year int, citation_count_OpenAlex double").repartition(6)
    name = "citation_count_OpenAlex"
    found = {r[0]: tuple(r)[1:] for r in standing.add_normalised(works).select(
        "id", *[f"{name}_{part}" for part in ("mean", "std", "z", "ratio")]).collect()}
    assert len(found) == len(rows)
    assert found[0][0] == base + 2 and abs(found[0][1] - 2 ** 0.5) < 1e-9
    assert abs(found[0][2] + 2 ** 0.5) < 1e-9 and abs(found[4][2] - 2 ** 0.5) < 1e-9 and abs(sum(found[i][2] for i in range(1000))) < 1e-9
    assert found[2000] == (7.0, 0.0, 0.0, 1.0) and found[2002] == (None, None, None, None)
    assert found[2003] == (0.0, 0.0, 0.0, 1.0) and found[2004] == (None, None, None, None)


# --- trends

def test_trend_with_a_gap_and_a_single_year(spark):
    rows = [("a", 2000, 4.0), ("a", 2000, None), ("a", 2003, 6.0), ("b", 1999, float("nan")), (None, 2000, 1.0), ("a", None, 1.0)]
    works = spark.createDataFrame(rows, "field string, publication_year int, citation_count_OpenAlex double")
    found = trends.yearly_trends(works, by=["field"]).orderBy("field", "publication_year")
    a = [tuple(r)[1:] for r in found.where("field = 'a'").collect()]
    assert [r[:5] for r in a] == [(2000, 2, 1, 4.0, 4.0), (2001, 0, 0, 0.0, None), (2002, 0, 0, 0.0, None), (2003, 1, 1, 6.0, 6.0)]
    assert [r[5:8] for r in a] == [(None, None, None), (2, -2, -1.0), (0, 0, None), (0, 1, None)]
    assert [r[8] for r in a] == [2.0, 1.0, 2 / 3, 1 / 3] and [r[9] for r in a] == [4.0, 4.0, 4.0, 6.0]
    assert [r[10] for r in a] == [2, 2, 2, 3] and abs(a[0][11] - np.polyfit([0, 1, 2, 3], [2, 0, 0, 1], 1)[0]) < 1e-12
    b = [tuple(r) for r in found.where("field = 'b'").collect()]
    assert b == [("b", 1999, 1, 0, 0.0, None, None, None, None, 1.0, None, 1, None)]


def test_trend_of_all_works(spark):
    years = [2000, 2000, 2002]
    works = spark.createDataFrame([(y, 1.0) for y in years], "publication_year int, citation_count_OpenAlex double")
    found = {r["publication_year"]: r["n_works"] for r in trends.yearly_trends(works).collect()}
    assert found == {2000: 2, 2001: 0, 2002: 1} and Counter(years)[2000] == 2
    assert trends.yearly_trends(works.limit(0)).count() == 0


def rows_written(monkeypatch, module):
    """Rows of the tables that a module writes from here on, one number for each."""
    sizes, write = [], module.staged

    def counted(frame, step):
        table = write(frame, step)
        sizes.append(table.count())
        return table

    monkeypatch.setattr(module, "staged", counted)
    return sizes


def test_settled_components_are_not_written_again(spark, monkeypatch):
    links = [(10_000 + 2 * i, 10_001 + 2 * i) for i in range(1_000)] + [(i, i + 1) for i in range(64)] + [(7, 7), (99_999, 99_999)]
    sizes = rows_written(monkeypatch, graph)
    found = {r["node"]: r["label"] for r in graph.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {**{n: n - n % 2 for n in range(10_000, 12_000)}, **dict.fromkeys(range(65), 0), 99_999: 99_999}
    # Links and hooks once with all rows, then only what still moves: before, every round wrote all 2,066 labels.
    assert sum(size > 1_200 for size in sizes) <= 2 + (64).bit_length()
    assert sum(size for size in sizes if size <= 1_200) < 4_000


def test_identifiers_of_one_record_and_agreeing_fields_are_not_moved(spark, monkeypatch):
    alone = [("openalex", f"10.1/{i}", f"W{i}", None, "t") for i in range(500)]
    alone += [("crossref", f"10.1/{i}", None, None, None) for i in range(500)]
    joined = [("openalex", "10.1/a", "Wa", None, "t"), ("semantic_scholar", "10.1/a", None, "p", None),
              ("semantic_scholar", "10.1/b", None, "p", None)]
    frame = spark.createDataFrame(alone + joined, "service string, doi string, id_OpenAlex string, s2_paper_id string, title string")
    records = frame.select("service", *[(F.col(f.name) if f.name in frame.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                                        for f in merge.MERGED_WORK])
    assert [tuple(r) for r in merge.identities(records).collect()] == [("doi:10.1/b", "doi:10.1/a")]
    matched = merge.with_entity(records)
    assert matched.where("entity = 'doi:10.1/a'").count() == 3 and matched.count() == 1_003
    sizes = rows_written(monkeypatch, merge)
    assert sorted((r["field"], r["value"], r["service"], r["n_records"], r["chosen"]) for r in merge.conflicts(matched).collect()) == [
        ("doi", "10.1/a", "openalex", 2, True), ("doi", "10.1/b", "semantic_scholar", 1, False)]
    assert sizes == [1_003, 1]  # records, entities with a conflict; before, all 1,508 values were written
