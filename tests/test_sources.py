"""Readers, writers, response pages, incremental landing, stage plans."""

from __future__ import annotations

import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeweave.catalog import REGISTRY
from citeweave.functions.embedding import HashingEncoder
from citeweave.plans.describe import DESCRIBED, describe
from citeweave.plans.features import feature_journal, sorted_features, tasks_for
from citeweave.plans.integrate import integrate, integrate_journal
from citeweave.schemas import FEATURE_WORK
from citeweave.session import fresh_path, ship_package, work_root
from citeweave.sources import landing, pages, tables, works_json
from citeweave.streaming.ingest import ingest_landing

HEADER = "id_OpenAlex,citation_count_OpenAlex,title,publication_date"


def put(folder, name, *lines, header=HEADER):
    folder = Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")


def rows_of(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=str)


def test_csv_cells(spark, tmp_path):
    put(tmp_path, "Batch0.csv", 'W1,5,"a, ""b""\nc",2020-01-05', "W2,abc,NA,", "W3,12.0,None,x",
        'W4,,"",', "W5,1.5, t ,")
    cells = landing.read_text_cells(spark, [str(tmp_path), str(tmp_path / "citations")])
    typed = landing.type_cells(cells)
    assert rows_of(typed, "id_OpenAlex", "citation_count_OpenAlex", "title") == [
        ("W1", 5, 'a, "b"\nc'), ("W2", None, None), ("W3", 12, None), ("W4", None, None), ("W5", None, " t ")]
    assert rows_of(landing.bad_cells(cells), "column", "text") == [
        ("citation_count_OpenAlex", "1.5"), ("citation_count_OpenAlex", "abc")]
    assert typed.schema["topics"].dataType == T.StringType()


def test_csv_files_with_other_header_order(spark, tmp_path):
    put(tmp_path, "a.csv", "W1,x", header="id_OpenAlex,title")
    put(tmp_path, "b.csv", "x,W2", header="title,id_OpenAlex")
    with pytest.raises(Exception, match="header does not conform"):
        landing.read_landing(spark, [str(tmp_path)]).collect()
    # Folders may differ from one another: columns are matched by name.
    put(tmp_path / "m", "a.csv", "W1,x", header="id_OpenAlex,title")
    put(tmp_path / "n", "b.csv", "x,W2,9", header="title,id_OpenAlex,more")
    both = landing.read_landing(spark, [str(tmp_path / "m"), str(tmp_path / "n")])
    assert rows_of(both, "id_OpenAlex", "title", "more") == [("W1", "x", None), ("W2", "x", "9")]


def test_no_landed_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        landing.read_landing(spark, [str(tmp_path / "none")])
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "notes.txt").write_text("not a batch")
    with pytest.raises(FileNotFoundError):
        landing.read_landing(spark, [str(tmp_path / "empty")])


def test_known_ids_at_any_depth(spark, tmp_path):
    put(tmp_path / "j", "a.csv", "W1,d1", "W1,d1", header="id_OpenAlex,doi")
    put(tmp_path / "j" / "references" / "x", "b.csv", "W2,", header="id_OpenAlex,doi")
    assert rows_of(landing.known_ids(spark, str(tmp_path)), "id_OpenAlex", "doi") == [("W1", "d1"), ("W2", None)]
    assert landing.no_known_ids(spark).count() == 0


def test_append_keeps_earlier_files(spark, tmp_path):
    folder = str(tmp_path / "out")
    frame = spark.createDataFrame([("W1", [1], " pad ")], "id_OpenAlex string, l array<int>, title string")
    landing.append_batch(frame, folder)
    landing.append_batch(frame, folder)
    assert rows_of(landing.read_landing(spark, [folder]), "id_OpenAlex", "l", "title") == [("W1", "[1]", " pad ")] * 2


def test_write_table_and_contract(spark, tmp_path):
    contract = T.StructType([T.StructField("n", T.LongType())])
    frame = spark.createDataFrame([("1", "x")], "n string, rest string")
    path = str(tmp_path / "t")
    for _ in range(2):
        tables.write_table(frame, path, contract)
    assert rows_of(tables.read_table(spark, path), "n", "rest") == [(1, "x")]
    with pytest.raises(ValueError, match="missing"):
        tables.cast_to_contract(frame.drop("n"), contract)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        tables.write_table(frame.withColumn("n", F.lit("x")), path, contract)


def test_sorted_table(spark):
    frame = spark.range(1000).select(((F.col("id") * 7919) % 1009).alias("k"))
    out = tables.sort_by_id(frame, "k", partitions=4).select("k", F.spark_partition_id().alias("p")).collect()
    assert [r.k for r in sorted(out, key=lambda r: (r.p,))] == sorted(r.k for r in out)
    assert len({r.p for r in out}) > 1
    # A key in most of the rows is spread as well.
    hot = tables.sort_by_id(frame.select(F.when(F.col("k") < 900, 5).otherwise(F.col("k")).alias("k")), "k", partitions=4)
    sizes = [r["count"] for r in hot.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 1000 and max(sizes) < 500


def test_staged_tables_go_to_the_shared_folder(spark):
    staged = tables.staged(spark.range(3), "step")
    assert staged.count() == 3
    assert staged.inputFiles()[0].removeprefix("file://").startswith(work_root(spark))
    assert fresh_path(spark, "a") != fresh_path(spark, "a")


def test_tidy_staged_tables_hold_the_same_and_can_be_discarded(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    frame = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    staged = tables.staged(frame, "tidy", tidy=True)
    assert sorted(staged.collect()) == sorted(frame.collect())
    assert staged.schema.simpleString() == frame.schema.simpleString()
    assert spark.conf.get(name, None) == before
    folder = Path(staged.inputFiles()[0].removeprefix("file://")).parent
    other = tables.staged(spark.range(3), "kept")
    tables.discard(staged)
    assert not folder.exists() and other.count() == 3


def test_pages(spark):
    def bodies(*texts):
        return spark.createDataFrame(list(enumerate(texts)), "page_no int, body string")

    page = json.dumps({"message": {"items": [{"DOI": "d1"}, {"x": 1}]}})
    assert rows_of(pages.crossref_dois(bodies(page, "{}")), "doi") == [("d1",), (None,)]
    page = json.dumps({"data": [{"paperId": "p1", "externalIds": {"DOI": "d"}}, {"paperId": "p2"}]})
    assert rows_of(pages.s2_search_hits(bodies(page)), "s2_paper_id", "doi") == [("p1", "d"), ("p2", None)]
    page = json.dumps({"results": [{"id": "W1", "doi": None}]})
    assert rows_of(pages.openalex_search_hits(bodies(page)), "id_OpenAlex", "doi") == [("W1", None)]
    first = json.dumps([{"paperId": "p1", "abstract": "old"}, None,
                        {"paperId": "p1", "abstract": "new", "citations": [{"paperId": "p9"}]}])
    second = json.dumps([{"paperId": "p2", "referenceCount": 3, "citationCount": 4, "citations": None}])
    found = pages.s2_details(bodies(first, second))
    assert rows_of(found, "s2_paper_id", "s2_abstract", "s2_reference_count", "s2_citation_count", "s2_citing_papers") == [
        ("p1", "new", None, None, ["p9"]), ("p2", None, 3, 4, [])]
    late = pages.s2_details(bodies(first, json.dumps([{"paperId": "p1", "abstract": "last"}])))
    assert rows_of(late, "s2_abstract", "s2_citing_papers") == [("last", [])]


def test_flatten_works(spark, tmp_path):
    work = {"id": "https://openalex.org/W1", "doi": "https://doi.org/10.1/a", "cited_by_count": 3,
            "referenced_works": ["W2"], "open_access": {"is_oa": True}, "topics": [{"id": "T1"}],
            "abstract_inverted_index": {"b": [1], "a": [0]}, "source": {"id": "S1", "display_name": "J"}}
    (tmp_path / "w.jsonl").write_text(json.dumps(work) + "\n" + json.dumps({"id": "W9"}) + "\n")
    flat = works_json.flatten_works(works_json.read_works(spark, str(tmp_path)),
                                    [*works_json.DEFAULT_FIELDS, "referenced_count", "unheard_of"])
    one, nine = sorted(flat.collect(), key=lambda r: len(r.id_OpenAlex), reverse=True)
    assert one.asDict(True) == {
        "id_OpenAlex": "https://openalex.org/W1", "doi": "10.1/a", "title": None, "type": None,
        "open_access": '{"is_oa": true}', "topics": '[{"id": "T1"}]', "citation_count_OpenAlex": 3,
        "referenced_works_OpenAlex": ["W2"], "publication_date": None, "abstract_OpenAlex": "a b",
        "source": {"id": "S1", "name": "J", "is_open_access": None, "database": "OpenAlex"},
        "reference_count_OpenAlex": None, "unheard_of": None}
    assert nine.source is None and nine.abstract_OpenAlex is None


def test_ingest_is_incremental_and_repeatable(spark, tmp_path):
    root = str(tmp_path)
    header = T.StructType([T.StructField(c, T.StringType()) for c in HEADER.split(",")])

    def ingest(checkpoint="checkpoint"):
        ingest_landing(spark, f"{root}/landing", f"{root}/target", f"{root}/{checkpoint}", header=header)
        return rows_of(tables.read_table(spark, f"{root}/target"), "id_OpenAlex", "citation_count_OpenAlex")

    put(tmp_path / "landing", "Batch0.csv", "W1,1,a,", "W2,2,b,", "W1,9,again,", ",5,no id,")
    assert ingest() == [("W1", 1), ("W2", 2)]
    assert ingest() == [("W1", 1), ("W2", 2)]
    put(tmp_path / "landing", "Batch1.csv", "W2,8,known,", "W3,3,new,")
    assert ingest() == [("W1", 1), ("W2", 2), ("W3", 3)]
    # All files once more, as after the loss of the checkpoint: nothing is added twice.
    assert ingest("other") == [("W1", 1), ("W2", 2), ("W3", 3)]


def test_stages_end_to_end(spark, tmp_path):
    ship_package(spark)
    header = "id_OpenAlex,doi,type,open_access,source,citation_count_OpenAlex,cited_by_percentile_year_OpenAlex," \
             "citation_normalized_percentile_OpenAlex,referenced_works_OpenAlex,title,abstract_OpenAlex,topics,publication_date"
    url = "https://openalex.org/W"

    def line(number, count, title, day):
        return f"{url}{number},,article,,,{count},,,\"['{url}7']\",{title},,,{day}"

    put(tmp_path / "in" / "J", "Batch0.csv", line(1, 10, "One (a)", "2020-01-05"), line(2, 4, "Two", "2020-1-6"), header=header)
    put(tmp_path / "in" / "J" / "citations", "Batch0.csv", line(1, 20, "Citing copy", "2020-01-05"), header=header)
    put(tmp_path / "in" / "J" / "references", "Batch0.csv", line(2, 30, "Referenced copy", "2020-01-05"),
        line(3, 5, "Three", "bad"), line(4, 6, "", "2020-05-05"), header=header)
    integrate_journal(spark, f"{tmp_path}/in", "J", f"{tmp_path}/db")
    integrated = tables.read_table(spark, f"{tmp_path}/db/J")
    assert rows_of(integrated, "id_OpenAlex", "citation_count_OpenAlex") == [
        (f"{url}1", 10), (f"{url}2", 4), (f"{url}3", 5), (f"{url}4", 6)]
    for by_year in (False, True):
        out = f"{tmp_path}/features{by_year}"
        feature_journal(spark, f"{tmp_path}/db", "J", out, HashingEncoder, by_year=by_year)
        table = tables.read_table(spark, f"{out}/J/parquet")
        assert set(FEATURE_WORK.names) | {"embedding"} == set(table.columns)
        # The work without text counts for the median of its year, then leaves.
        assert rows_of(table, "id_OpenAlex", "median_citation_count_year", "higher_than_median_year", "title_abstract") == [
            (1, 6.0, 1, "one a"), (2, 6.0, 0, "two")]
    figures = describe(table)
    assert set(figures) == {"histograms", *[f"scatter-{c}" for c in DESCRIBED]}
    assert figures["histograms"].where("n > 0").count() == 5
    assert figures["scatter-citation_count_OpenAlex"].agg(F.sum("n")).first()[0] == 2


WRITES_FIRST = {name for name in REGISTRY if name.startswith(("integrate", "describe_", "feature", "src_csv", "csv_",
                                                              "known", "sink", "stage_r", "incremental", "keep_first_b"))}


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - WRITES_FIRST))
def test_plans(spark, sf_dir, name):
    """No cross or nested-loop join; row-number limits also act before the shuffle."""
    frame = REGISTRY[name].run(spark, sf_dir)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    if "row_number()" in plan:
        assert "Partial" in plan and "WindowGroupLimit" in plan
    assert "BatchEvalPython" not in plan
    if "ArrowEvalPython" in plan:
        assert name in ("embed_text", "embedding_wide")


def test_scans_read_only_what_is_used(spark, sf_dir):
    plan = REGISTRY["sql_projection"].run(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan
    plan = REGISTRY["reference_frontier"].run(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,F)" in plan and "l_extendedprice" not in plan
    plan = REGISTRY["yearly_stats_join"].run(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan


def test_the_first_of_many_batches_stays(spark, tmp_path):
    """File names of a batch are random; the time of landing decides, in both ways of taking in."""
    for number in range(10):
        landing.append_batch(spark.createDataFrame([("W1", number)], "id_OpenAlex string, citation_count_OpenAlex int"),
                             f"{tmp_path}/in/life")
    integrate_journal(spark, f"{tmp_path}/in", "life", f"{tmp_path}/db")
    assert spark.read.parquet(f"{tmp_path}/db/life").first()["citation_count_OpenAlex"] == 0
    ingest_landing(spark, f"{tmp_path}/in/life", f"{tmp_path}/table", f"{tmp_path}/state")
    assert spark.read.parquet(f"{tmp_path}/table").first()["citation_count_OpenAlex"] == 0


def test_batches_keep_their_order_in_a_copy(spark, tmp_path):
    """A copy of a landing folder has other times and names; the numbers of the batches stay."""
    for number in range(4):
        landing.append_batch(spark.createDataFrame([("W1", number)], "id_OpenAlex string, citation_count_OpenAlex int"),
                             f"{tmp_path}/in/life", numbered=True if number == 0 else None)
    files = sorted((tmp_path / "in" / "life").glob("*.csv"), key=lambda file: file.stat().st_mtime_ns)
    copy = tmp_path / "copy" / "life"
    copy.mkdir(parents=True)
    for place, file in enumerate(files):  # later batches get earlier names, all one time
        target = copy / f"part-{9 - place}.csv"
        target.write_bytes(file.read_bytes())
        os.utime(target, (1_700_000_000, 1_700_000_000))
    integrate_journal(spark, f"{tmp_path}/copy", "life", f"{tmp_path}/db")
    table = spark.read.parquet(f"{tmp_path}/db/life")
    assert table.first()["citation_count_OpenAlex"] == 0 and landing.BATCH not in table.columns
    header = T.StructType([T.StructField(c, T.StringType()) for c in ("id_OpenAlex", "citation_count_OpenAlex")])
    ingest_landing(spark, str(copy), f"{tmp_path}/table", f"{tmp_path}/state", header=header)
    assert spark.read.parquet(f"{tmp_path}/table").first()["citation_count_OpenAlex"] == 0


def test_folders_without_numbers_stay_without(spark, tmp_path):
    put(tmp_path / "j", "a.csv", "W1,d1", header="id_OpenAlex,doi")
    row = spark.createDataFrame([("W2", "d2")], "id_OpenAlex string, doi string")
    assert not landing.numbers_batches(spark, str(tmp_path / "j"))
    landing.append_batch(row, str(tmp_path / "j"))
    landing.append_batch(row, str(tmp_path / "j" / "references"), numbered=landing.numbers_batches(spark, str(tmp_path / "j")))
    assert rows_of(landing.known_ids(spark, str(tmp_path)), "id_OpenAlex", "doi") == [("W1", "d1"), ("W2", "d2")]
    assert landing.numbers_batches(spark, str(tmp_path / "new"), fresh=True)
    assert not landing.numbers_batches(spark, str(tmp_path / "new"))


def test_numbers_are_decimal(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id_OpenAlex,citation_count_OpenAlex\nW1,5d\nW2,7F\nW3,0x1p3\nW4,12.0\nW5,1e3\n")
    cells = landing.read_text_cells(spark, [f"{tmp_path}/in"])
    typed = landing.type_cells(cells).select("id_OpenAlex", "citation_count_OpenAlex").collect()
    assert sorted(map(tuple, typed)) == [("W1", None), ("W2", None), ("W3", None), ("W4", 12), ("W5", 1000)]
    assert sorted(r.text for r in landing.bad_cells(cells).collect()) == ["0x1p3", "5d", "7F"]


def test_texts_are_joined_after_the_rows_are_dealt_out(spark):
    works = spark.createDataFrame([("W1", "2020-01-01", 1.0, "T", "A")],
                                  "id_OpenAlex string, publication_date string, citation_count_OpenAlex double, "
                                  "title string, abstract_OpenAlex string")
    plan = sorted_features(works, partitions=3)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("rangepartitioning(id_OpenAlex"):]
    assert "title_abstract" not in below and "rangepartitioning" in plan
    assert tasks_for(works, 1) == 1 and tasks_for(works.union(works).union(works), 2) == 2


def test_costly_rows_of_one_file_are_spread(spark, tmp_path):
    spark.range(4_000).selectExpr(
        "id AS doc_id", "concat_ws(' ', transform(sequence(1, 400), i -> left(md5(concat(id, '-', i)), 6))) AS text"
    ).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    whole = spark.read.parquet(f"{tmp_path}/documents.parquet")
    with_rows = lambda frame: sum(n > 0 for n in frame.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect())
    assert with_rows(whole) == 1
    assert with_rows(tables.spread(whole)) > 1
    # Before, all texts were inverted and read back in one task.
    assert with_rows(REGISTRY["deinvert_abstract"].run(spark, str(tmp_path))) > 1


def test_files_are_sorted_by_number(spark, tmp_path):
    """A sort holds a file's number for each row, not its path; rows keep the order of paths."""
    folder = tmp_path / "a b%20ü"
    for place, name in enumerate(["z.csv", "Ä+1.csv", "a%41.csv", "a .csv", "\U0001f600.csv", "\uffee.csv"]):
        put(folder, name, f"W1,{place}", f"W{place + 2},{place}", ",9", header="id_OpenAlex,citation_count_OpenAlex")
        os.utime(folder / name, (1_700_000_000, 1_700_000_000))
    landed = landing.read_landing(spark, [str(folder)])
    numbered, order = landing.number_files(landed)
    assert numbered.where("origin_number IS NULL OR origin_file IS NOT NULL").count() == 0
    by_path, by_number = (frame.orderBy(*columns).select("id_OpenAlex", "citation_count_OpenAlex").collect()
                          for frame, columns in ((landed, landing.ORIGIN), (numbered, order)))
    assert by_path == by_number and len(by_path) == 18
    first = next(r["citation_count_OpenAlex"] for r in by_path if r["id_OpenAlex"] == "W1")
    kept = integrate(landed)
    assert not [name for name in kept.columns if name.startswith("origin")]
    assert rows_of(kept, "id_OpenAlex", "citation_count_OpenAlex") == [
        ("W1", first), *[(f"W{place + 2}", place) for place in range(6)]]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    sort = next(line for line in plan.splitlines() if "Sort [" in line)
    assert "origin_number" in sort  # before, the path alone told files apart
    # Rows of no file keep their order too.
    loose = spark.createDataFrame([("W1", 1, 0, "b"), ("W1", 2, 0, "a")], "id_OpenAlex string, n int, origin_rank int, origin_file string")
    for name in landing.ORIGIN:
        if name not in loose.columns:
            loose = loose.withColumn(name, F.lit(0))
    assert rows_of(integrate(loose), "id_OpenAlex", "n") == [("W1", 2)]
