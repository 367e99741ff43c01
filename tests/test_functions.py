"""Column expressions on hand-written edge rows."""

from __future__ import annotations

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from citeweave.functions import abstracts, embedding, ids, text
from citeweave.operators.yearly import above_median, parse_dates


def values(spark, kind, cells, expression):
    frame = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], f"i int, c {kind}")
    return [r[0] for r in frame.orderBy("i").select(expression(F.col("c"))).collect()]


CLEANED = [
    ("A(b)[C]{d}  E", "a b c d e"),
    ("x y\x1cz\x85w v", "x y z w v"),
    ("keep​this", "keep​this"),
    ("  1,2 (3).\n\tEnd ", "1,2 3 . end"),
    ("()", ""),
    (None, None),
]


def test_clean_text(spark):
    assert values(spark, "string", [c for c, _ in CLEANED], text.clean_text) == [c for _, c in CLEANED]


def test_whitespace_is_what_python_splits_on(spark):
    every = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())
    assert set(text.WHITESPACE) == set(every)
    joined = "a" + "b".join(every) + "c"
    assert values(spark, "string", [joined], text.collapse_whitespace) == [" ".join(joined.split())]


def test_blank_to_null_keeps_other_text_unchanged(spark):
    cells = ["", "  　\n", " a ", "()", None]
    assert values(spark, "string", cells, text.blank_to_null) == [None, None, " a ", "()", None]


def test_null_to_empty(spark):
    assert values(spark, "string", [None, "a"], text.null_to_empty) == ["", "a"]
    assert values(spark, "int", [None, 3], text.null_to_empty) == ["", "3"]


def test_title_abstract(spark):
    rows = [(0, None, None), (1, None, "X"), (2, "()", None), (3, "T", "A"), (4, " ", "\n"), (5, "T", None)]
    frame = spark.createDataFrame(rows, "i int, title string, abstract_OpenAlex string")
    from citeweave.plans.features import add_title_abstract

    found = {r.i: r.title_abstract for r in add_title_abstract(frame).collect()}
    assert found == {1: "x", 2: "", 3: "t a", 5: "t"}


DATES = [
    ("2020-01-05", "2020-01-05"), ("2020-1-5", "2020-01-05"), ("2020-01", None), ("2020", None),
    ("20200105", None), (" 2020-01-05", None), ("2020-01-05 ", None), ("2020-01-05T00:00:00", None),
    ("2020-02-30", None), ("2020-13-01", None), ("2020-00-10", None), ("1600-01-01", None),
    ("2300-01-01", None), ("1677-09-21", None), ("1677-09-22", "1677-09-22"),
    ("2262-04-11", "2262-04-11"), ("2262-04-12", None), ("12020-01-05", None), ("20-01-05", None),
    ("-2020-01-05", None), ("2024-02-29", "2024-02-29"), ("x", None), ("", None), (None, None),
]


def test_parse_dates(spark):
    frame = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(DATES)], "i int, publication_date string")
    found = {r.i: r for r in parse_dates(frame).collect()}
    assert {i: str(r.publication_date) for i, r in found.items()} == {
        i: day for i, (_, day) in enumerate(DATES) if day}
    assert found[0].publication_date_int == found[1].publication_date_int == 1578182400000000000
    assert found[0].publication_year == 2020


def test_ids(spark):
    url = "https://openalex.org/W"
    assert values(spark, "string", [url + "12", None], ids.work_number) == [12, None]
    assert values(spark, "string", [url + "12", "x"], ids.try_work_number) == [12, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, "string", ["x"], ids.work_number)
    dois = ["https://doi.org/10.1/a", "10.1/a", "", None]
    assert values(spark, "string", dois, ids.normalize_doi) == ["10.1/a", "10.1/a", "", None]
    assert values(spark, "string", ["https://openalex.org/S1", "S2"], ids.last_segment) == ["S1", "S2"]


def test_lists(spark):
    cells = ["['W1', 'W2']", '["W1"]', "[]", "None", "[1,", "", None]
    assert values(spark, "string", cells, ids.parse_list) == [
        ["W1", "W2"], ["W1"], [], None, None, None, None]
    assert values(spark, "string", cells, ids.list_length) == [2, 1, 0, None, None, None, None]


INDEXES = [
    ({"the": [0, 3], "cat": [1], "sat": [4], "x": [6]}, "the cat  the sat  x"),
    ({"z": [2]}, "  z"),
    ({"only": [0]}, "only"),
    ({"": [1], "a": [0], "b": [2]}, "a  b"),
    ({}, None),
    (None, None),
]


def test_deinvert_abstract(spark):
    found = values(spark, "map<string,array<int>>", [c for c, _ in INDEXES], abstracts.deinvert_abstract)
    assert found == [t for _, t in INDEXES]


def test_deinvert_against_plain_python(spark):
    draw = random.Random(1)
    cells = []
    for _ in range(200):
        words = {}
        for place in range(draw.randint(1, 12)):
            for _ in range(draw.choice([0, 1, 1, 1, 2])):
                words.setdefault(draw.choice("abcdefgh"), []).append(place)
        cells.append(words)
    expected = []
    for words in cells:
        slots = [""] * (max((max(p) for p in words.values()), default=-1) + 1)
        for word, places in words.items():
            for place in places:
                slots[place] = word
        expected.append(" ".join(slots) if slots else None)
    # Through JSON, since a Python dict loses its order on the way into Spark.
    index = "map<string,array<int>>"
    assert values(spark, "string", [json.dumps(c) for c in cells],
                  lambda c: abstracts.deinvert_abstract(F.from_json(c, index))) == expected


def test_invert_then_deinvert(spark):
    cells = ["a b a", "", " a  b ", "x", "a\nb c", " "]
    back = values(spark, "string", cells, lambda c: abstracts.deinvert_abstract(abstracts.invert_text(c)))
    assert back == cells


def test_above_median(spark):
    rows = [(3.0, 2.0), (2.0, 2.0), (1.0, 2.0), (None, 2.0), (3.0, None), (float("nan"), 2.0),
            (3.0, float("nan"))]
    frame = spark.createDataFrame(rows, "c double, m double")
    found = [r[0] for r in frame.coalesce(1).select(above_median(F.col("c"), F.col("m"))).collect()]
    assert found == [1, 0, 0, 0, 0, 0, 0]


def test_embedding_null_empty_and_typed(spark):
    from citeweave.session import ship_package

    ship_package(spark)
    frame = spark.createDataFrame([(0, "a b a"), (1, None), (2, "")], "i int, t string")
    out = frame.select("i", embedding.embed_text(F.col("t")).alias("embedding"))
    assert out.schema["embedding"].dataType.simpleString() == "array<float>"
    rows = {r.i: r.embedding for r in out.collect()}
    assert rows[1] is None
    assert len(rows[0]) == 384 and not any(rows[2])
    assert np.isclose(np.linalg.norm(rows[0]), 1) and np.count_nonzero(rows[0]) in (1, 2)
    assert out.where("i > 9").collect() == []
    wide = embedding.embedding_wide(out)
    assert wide.columns == ["i"] + [f"embedding_{k}" for k in range(384)]
    assert list(wide.where("i = 0").first())[1:] == rows[0]


class BadEncoder:
    dim = 3

    def encode(self, texts):
        return np.zeros((len(texts), 2))


def test_encoder_of_wrong_shape_is_an_error(spark):
    from pyspark import cloudpickle

    import tests.test_functions as here

    cloudpickle.register_pickle_by_value(here)
    frame = spark.createDataFrame([("a",)], "t string")
    with pytest.raises(Exception, match="encoder returned"):
        frame.select(embedding.embed_text(F.col("t"), here.BadEncoder)).collect()


def test_embedding_runs_once_under_explode(spark):
    frame = spark.range(3).select(F.col("id").cast("string").alias("t"))
    plan = (frame.select(embedding.embed_text(F.col("t")).alias("e")).select(F.explode("e"))
            ._jdf.queryExecution().executedPlan().toString())
    assert plan.count("ArrowEvalPython") == 1
