"""Dated snapshots, merged ids, records that do not fit, topics, counts and figures."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from citeweave.operators import describe, rows
from citeweave.operators.search import journals_not_found
from citeweave.operators.topics import find_topics, frequent_words
from citeweave.sources import snapshot, works_json


def write(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines))


def test_newest_version_of_each_work(spark, tmp_path):
    write(tmp_path / "works/updated_date=2024-01-01/part_000.jsonl", [{"id": "W1", "cited_by_count": 1}, {"id": "W2", "cited_by_count": 2}])
    write(tmp_path / "works/updated_date=2024-02-01/part_000.jsonl", [{"id": "W1", "cited_by_count": 5}, {"id": "W1", "cited_by_count": 6}])
    write(tmp_path / "works/updated_date=2023-12-31/part_000.jsonl",
          [{"id": "W1", "cited_by_count": 9}, {"id": "W3", "cited_by_count": 3}, {"id": None}, {"id": ""}, {"id": "W4"}])
    write(tmp_path / "merged_ids/2024.csv", ["merge_date,id,merge_into_id", "2024-01-05,W4,W1"])
    works = snapshot.read_parts(spark, str(tmp_path))
    assert {(r["id"], r["cited_by_count"], r["updated_date"]) for r in snapshot.newest(works).collect()} == {
        ("W1", 6, "2024-02-01"), ("W2", 2, "2024-01-01"), ("W3", 3, "2023-12-31"), ("W4", None, "2023-12-31")}
    gone = snapshot.survivors(snapshot.read_merges(spark, str(tmp_path)))
    assert {r["id"] for r in snapshot.current_works(works, gone).collect()} == {"W1", "W2", "W3"}
    late = snapshot.read_parts(spark, str(tmp_path), since="2024-01-01")
    assert late.count() == 4 and "updated_date" in late._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]


def test_merge_chains_circles_and_withdrawals(spark):
    merges = [("2024-01-01", f"c{i}", f"c{i + 1}") for i in range(33)]  # a chain that ends in c33
    merges += [("2024-01-01", "a", "b"), ("2024-01-02", "b", "a"), ("2024-01-02", "to-circle", "a"), (None, "self", "self"),
               ("2024-01-01", "twice", "old"), ("2024-03-01", "twice", "new"), ("2024-01-01", "gone", None),
               ("2024-01-01", "into-gone", "gone"), ("2024-01-01", "blank", " "), (None, None, "x"), ("2024-01-01", "", "x")]
    frame = spark.createDataFrame(merges, snapshot.MERGES)
    found = {r["id"]: r["survivor"] for r in snapshot.survivors(frame).collect()}
    assert found == {**{f"c{i}": "c33" for i in range(33)}, "a": None, "b": None, "to-circle": None, "self": None,
                     "twice": "new", "gone": None, "into-gone": None, "blank": None}
    edges = spark.createDataFrame([("x", "c5"), ("x", "gone"), ("x", "y"), ("x", None), ("x", "twice")], "src string, dst string")
    led = snapshot.redirected(edges, snapshot.survivors(frame), "dst")
    assert {r["dst"] for r in led.collect()} == {"c33", "y", None, "new"} and led.columns == ["src", "dst"]
    assert snapshot.survivors(frame.limit(0)).count() == 0


def test_records_that_do_not_fit(spark, tmp_path):
    good = [{"id": "W1", "cited_by_count": 3_000_000_000, "referenced_works": ["a"]}, {"id": "W2", "unknown": 1}, {}]
    bad = ['{"id": "W3", "cited_by_count": "x"}', '{"id": "W4", "cited', "[]", '"text"', "junk", '{"id": "W5", "referenced_works": 7}',
           '{"id": "W6", "cited_by_count": 99999999999999999999}']
    write(tmp_path / "works.jsonl", [*good, *bad])
    path = str(tmp_path / "works.jsonl")
    ledger = {r["record"]: r["problem"] for r in works_json.bad_records(spark, path).collect()}
    assert set(ledger) == set(bad) - {"[]"}  # an empty list is no work and no fault
    assert {record for record, problem in ledger.items() if problem == "value"} >= {bad[0], bad[5], bad[6]}
    assert ledger["junk"] == ledger['"text"'] == "not_json"
    assert works_json.bad_records(spark, path).select(F.col("file").endswith("works.jsonl")).distinct().first()[0]
    works = {r["id"]: r["cited_by_count"] for r in works_json.read_works(spark, path).collect()}
    assert works["W1"] == 3_000_000_000 and works["W3"] is None and works["W6"] is None
    write(tmp_path / "good.jsonl", good)
    assert works_json.bad_records(spark, str(tmp_path / "good.jsonl")).count() == 0


def test_planted_topics_are_found(spark):
    draw = random.Random(2)
    themes = [[f"{stem}{chr(97 + i)}{chr(97 + j)}" for i in range(6) for j in range(4)] for stem in ("star", "cell", "coin")]
    works = [(i, " ".join(draw.choice(themes[i % 3]) for _ in range(40)) + " the and of") for i in range(300)]
    works += [(900, None), (901, ""), (902, "of the 123"), (903, "neverseenbefore")]
    frame = spark.createDataFrame(works, "id int, title_abstract string")
    found = find_topics(frame, topics=3, iterations=30)
    main = {r["id"]: r["topic"] for r in found.works.collect()}
    assert len(main) == len(works) and all(main[i] is None for i in (900, 901, 902, 903))
    groups = [{main[i] for i in range(theme, 300, 3)} for theme in range(3)]
    assert all(len(group) == 1 for group in groups) and len(set().union(*groups)) == 3
    for r in found.terms.collect():
        stem = ("star", "cell", "coin")[next(i for i, group in enumerate(groups) if r["topic"] in group)]
        assert r["term"].startswith(stem)
    assert {r["id"]: r["topic"] for r in find_topics(frame, topics=3, iterations=30).works.collect()} == main
    none = find_topics(frame.where("id >= 900 AND id < 903"))
    assert none.terms.count() == 0 and none.works.where("topic IS NULL").count() == 3


def test_equally_frequent_words_keep_their_order(spark):
    """Topics follow the numbers of words; before, words that occur equally often came in any order."""
    words = [f"word{chr(97 + i // 20)}{chr(97 + i % 20)}" for i in range(200)]
    for seed in range(3):
        mixed = random.Random(seed).sample(words, len(words))
        rows_of_words = [(mixed[:120] + ["top"],), (mixed[80:] + ["top", "rare", "rare", "rare"],), (mixed,), ([],)]
        split = spark.createDataFrame(rows_of_words, "_words array<string>").repartition(seed + 1)
        assert frequent_words(split.where("size(_words) = 200 OR size(_words) = 0").union(split.where("size(_words) = 200")),
                              500, 2) == words
        found = frequent_words(split, 20, 2)
        assert found == sorted(mixed[80:120])[:20]  # three times each; "rare" too, but in one work
        assert frequent_words(split, 500, 4) == []
    # Nor do topics follow the files or the order that works come in, as samples did before.
    draw = random.Random(5)
    works = spark.createDataFrame([(i, " ".join(draw.choices(words[i % 2 * 100:][:100], k=30))) for i in range(80)], "id int, text string")
    one, other = ({r["id"]: r["topic"] for r in find_topics(frame, "text", topics=2, iterations=5).works.collect()}
                  for frame in (works.coalesce(1).sortWithinPartitions("id"), works.repartition(5)))
    assert one == other and len(one) == 80
    none = find_topics(spark.createDataFrame([(1, "alone here"), (2, "other words")], "id int, title_abstract string"))
    assert none.terms.count() == 0 and none.works.where("topic IS NULL").count() == 2


def test_counts_are_taken_on_the_way(spark, tmp_path):
    frame, seen = rows.observed(spark.range(10), n=F.count("*"), big=F.count_if(F.col("id") > 6))
    frame.write.parquet(f"{tmp_path}/out")
    rows.write_counts(frame, f"{tmp_path}/counts", **seen.get)
    assert spark.read.parquet(f"{tmp_path}/counts").first().asDict() == {"n": 10, "big": 3}


def test_names_without_a_journal(spark):
    names = spark.createDataFrame([("Cell",), ("cell ",), ("Gut",), (None,), ("Gut",)], "name string")
    journals = spark.createDataFrame([("S1", "Cell")], "id string, display_name string")
    assert [tuple(r) for r in journals_not_found(names, journals).collect()] == [("Gut", "not_found")]


def test_figures_equal_the_single_ones(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.when(F.col("o_orderkey") % 9 > 0, F.year("o_orderdate")).alias("publication_year"), "o_totalprice",
        F.when(F.col("o_orderkey") % 5 > 0, F.col("o_custkey")).alias("few"))
    made = describe.figures(frame, ["o_totalprice", "few"])

    def same(a, b):
        return sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.select(*a.columns).collect()), key=str)

    assert same(made["histograms"], describe.histograms(frame, ["o_totalprice", "few"]))
    for column in ("o_totalprice", "few"):
        assert same(made[f"scatter-{column}"], describe.year_density(frame, column))


@pytest.mark.parametrize("bins", [4])
def test_figures_of_nothing(spark, bins):
    empty = spark.createDataFrame([], "publication_year int, x double")
    made = describe.figures(empty, ["x"], bins=bins)
    assert made["histograms"].count() == bins and made["scatter-x"].count() == 0
