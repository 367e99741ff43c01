"""The command line, from a snapshot to the figures."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from citeweave.__main__ import main

URL = "https://openalex.org/"


def work(number, journal, year, *references):
    return {"id": f"{URL}W{number}", "doi": f"https://doi.org/10.1/{number}", "title": f"Title {number}",
            "cited_by_count": number, "referenced_works": [f"{URL}W{r}" for r in references],
            "publication_date": f"{year}-03-0{number % 9 + 1}", "publication_year": year,
            "abstract_inverted_index": {"said,": [1], "\"so": [0]},
            "source": {"id": journal, "display_name": "Cell"},
            "locations": [{"source": {"id": f"{URL}{journal}"}}]}


def test_all_stages(spark, tmp_path):
    works = [work(1, "S1", 2020, 4, 5), work(2, "S1", 2021, 4), work(3, "S1", 2030, 9), work(4, "S2", 2020, 6),
             work(5, "S2", 2020), work(6, "S2", 2020, 1, 7), work(7, "S2", 2020)]
    (tmp_path / "snapshot.jsonl").write_text("\n".join(map(json.dumps, works)))
    (tmp_path / "journals.jsonl").write_text(json.dumps({"id": f"{URL}S1", "display_name": "Cell"}))
    landing = ["--landing", f"{tmp_path}/in", "--label", "cell"]
    search = ["acquire", "--snapshot", f"{tmp_path}/snapshot.jsonl", "--journals", f"{tmp_path}/journals.jsonl",
              *landing, "--names", "CELL", "--years", "2021", "2020"]

    def landed(folder):
        frame = spark.read.csv(f"{tmp_path}/in/cell/{folder}", header=True, multiLine=True, escape='"',
                               pathGlobFilter="*.csv")
        return sorted(r[0].removeprefix(f"{URL}W") for r in frame.select("id_OpenAlex").collect())

    main(search)
    assert (landed(""), landed("references")) == (["1", "2"], ["4", "5"])
    main(search)  # nothing new, nothing twice
    assert (landed(""), landed("references")) == (["1", "2"], ["4", "5"])
    main(["expand", "--snapshot", f"{tmp_path}/snapshot.jsonl", *landing, "--hops", "2"])
    assert landed("references") == ["4", "5", "6", "7"]
    # Work 9 is referenced by a work of another year only; nothing that was followed is missing.
    assert spark.read.parquet(f"{tmp_path}/in/cell/ledger/references_not_found").count() == 0
    assert spark.read.parquet(f"{tmp_path}/in/cell/ledger/journals_not_found").count() == 0
    assert spark.read.parquet(f"{tmp_path}/in/cell/ledger/bad_records").count() == 0
    main(["integrate", *landing, "--out", f"{tmp_path}/db"])
    main(["ingest", "--landing", f"{tmp_path}/in/cell", "--out", f"{tmp_path}/taken", "--checkpoint", f"{tmp_path}/state"])
    main(["ingest", "--landing", f"{tmp_path}/in/cell", "--out", f"{tmp_path}/taken", "--checkpoint", f"{tmp_path}/state"])
    both = [sorted(r[0] for r in spark.read.parquet(f"{tmp_path}/{t}").select("id_OpenAlex").collect())
            for t in ("db/cell", "taken")]
    assert both[0] == both[1] and len(both[0]) == 6
    assert spark.read.parquet(f"{tmp_path}/db/cell-bad-cells").count() == 0
    assert spark.read.parquet(f"{tmp_path}/db/cell-counts").first().asDict() == {"n_rows": 6, "n_with_key": 6, "n_kept": 6}
    (tmp_path / "ids.txt").write_text("https://doi.org/10.1/7\n10.1/404\n")
    main(["details", "--snapshot", f"{tmp_path}/snapshot.jsonl", "--ids", f"{tmp_path}/ids.txt",
          "--landing", f"{tmp_path}/in", "--label", "asked", "--by", "doi"])
    assert [r.id for r in spark.read.parquet(f"{tmp_path}/in/asked/ledger/not_found").collect()] == ["10.1/404"]
    main(["features", "--integrated", f"{tmp_path}/db", "--label", "cell", "--out", f"{tmp_path}/features", "--percentiles"])
    assert spark.read.parquet(f"{tmp_path}/features/cell/counts").first().asDict() == {"n_integrated": 6, "n_written": 6}
    main(["describe", "--features", f"{tmp_path}/features/cell/parquet", "--out", f"{tmp_path}/figures"])
    table = spark.read.parquet(f"{tmp_path}/features/cell/parquet")
    found = sorted(table.select("id_OpenAlex", "median_citation_count_year", "title_abstract").collect())
    assert [tuple(r) for r in found][:2] == [(1, 5.0, 'title 1 "so said,'), (2, 2.0, 'title 2 "so said,')]
    assert len(found) == 6
    shares = dict(map(tuple, table.select("id_OpenAlex", "cited_by_percentile_year_OpenAlex").collect()))
    assert shares == {1: 0.0, 4: 25.0, 5: 50.0, 6: 75.0, 7: 100.0, 2: 0.0}
    histograms = spark.read.parquet(f"{tmp_path}/figures/histograms")
    assert histograms.groupBy("column_name").agg(F.sum("n")).count() == 3


def test_citing_works_and_ledgers(spark, tmp_path):
    """Citations are followed; landed lists count; what the snapshot lacks is listed."""
    works = [work(1, "S1", 2020), work(2, "S2", 2020, 1), work(3, "S2", 2021, 2), work(4, "S2", 2021, 3), work(5, "S2", 2022, 1)]
    (tmp_path / "snapshot.jsonl").write_text("\n".join([*map(json.dumps, works), '{"id": "W6", "cited', json.dumps({"id": "W7", "cited_by_count": "x"})]))
    (tmp_path / "journals.jsonl").write_text(json.dumps({"id": f"{URL}S1", "display_name": "Cell"}))
    landing = ["--landing", f"{tmp_path}/in", "--label", "cell"]
    main(["acquire", "--snapshot", f"{tmp_path}/snapshot.jsonl", "--journals", f"{tmp_path}/journals.jsonl", *landing,
          "--names", "Cell", "Nowhere", "--years", "2020", "2020"])
    ledger = f"{tmp_path}/in/cell/ledger"
    assert [r["name"] for r in spark.read.parquet(f"{ledger}/journals_not_found").collect()] == ["Nowhere"]
    assert {r["problem"] for r in spark.read.parquet(f"{ledger}/bad_records").collect()} == {"not_json", "value"}
    main(["expand", "--snapshot", f"{tmp_path}/snapshot.jsonl", *landing, "--hops", "2", "--citing",
          "--fields", "id", "doi", "title", "referenced_works"])
    cited = spark.read.csv(f"{tmp_path}/in/cell/citations", header=True, multiLine=True, escape='"', pathGlobFilter="*.csv")
    assert {r["id_OpenAlex"].removeprefix(f"{URL}W") for r in cited.collect()} == {"2", "3", "5"}
    assert cited.columns == ["id_OpenAlex", "doi", "title", "referenced_works_OpenAlex"]
    assert spark.read.parquet(f"{ledger}/citations_not_found").count() == 0
    # A landed work that the snapshot lacks is followed; its other reference is nowhere.
    (tmp_path / "in/other").mkdir(parents=True)
    (tmp_path / "in/other/a.csv").write_text(
        'id_OpenAlex,doi,referenced_works_OpenAlex\n' + f'{URL}W50,,"[""{URL}W4"", ""{URL}W404""]"\n')
    main(["expand", "--snapshot", f"{tmp_path}/snapshot.jsonl", "--landing", f"{tmp_path}/in", "--label", "other"])
    found = spark.read.csv(f"{tmp_path}/in/other/references", header=True, multiLine=True, escape='"', pathGlobFilter="*.csv")
    assert [r["id_OpenAlex"] for r in found.collect()] == [f"{URL}W4"]
    missing = spark.read.parquet(f"{tmp_path}/in/other/ledger/references_not_found")
    assert [tuple(r) for r in missing.collect()] == [(f"{URL}W404", "not_found")]
