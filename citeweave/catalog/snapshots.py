"""Dated parts of a snapshot, records that do not fit, topics."""

from __future__ import annotations

from pyspark.sql import functions as F

from citeweave.catalog.registry import query, table
from citeweave.catalog.standins import WORK, orders, work_id
from citeweave.operators.topics import find_topics
from citeweave.session import fresh_path
from citeweave.sources import snapshot, works_json

# Three parts: all works, later those of status O, later still every tenth.  Every seventh work is merged
# into the next one, some of these again into theirs; some are withdrawn, some go in a circle.
PARTS = {"2024-01-01": "true", "2024-02-01": "o_orderstatus = 'O'", "2024-03-01": "o_orderkey % 10 = 0"}
TARGET = """CASE WHEN o_orderkey % 7 = 0 THEN o_orderkey + 1 WHEN o_orderkey % 21 = 1 THEN o_orderkey + 1
  WHEN o_orderkey % 70 = 4 THEN o_orderkey + 1 WHEN o_orderkey % 70 = 5 THEN o_orderkey - 1 END"""
MERGED = "o_orderkey % 7 = 0 OR o_orderkey % 21 = 1 OR o_orderkey % 70 IN (4, 5) OR o_orderkey % 35 = 3"
SURVIVORS = f"""
m AS (SELECT o_orderkey AS id, {TARGET} AS target FROM orders WHERE {MERGED}),
walk AS (
  SELECT id, target, 1 AS steps FROM m
  UNION ALL SELECT walk.id, m.target, steps + 1 FROM walk JOIN m ON walk.target = m.id WHERE steps < 5),
ends AS (SELECT id, arg_max(target, steps) AS target, max(steps) AS steps FROM walk GROUP BY id),
survivors AS (
  SELECT id, CASE WHEN steps < 5 AND NOT bool_or(target IS NULL) THEN any_value(target) END AS survivor
  FROM (SELECT w.id, w.target, e.steps FROM walk w JOIN ends e ON w.id = e.id AND w.steps = e.steps) GROUP BY id, steps)"""


def write_snapshot(spark, sf_dir):
    root = fresh_path(spark, "snapshot")
    works = orders(spark, sf_dir)
    for place, (day, condition) in enumerate(PARTS.items()):
        works.where(condition).select(work_id("o_orderkey").alias("id"), (F.col("o_orderkey") % 1000 + place).alias("cited_by_count")
                                      ).write.json(f"{root}/works/updated_date={day}")
    works.where(MERGED).selectExpr(f"'{WORK}' || o_orderkey AS id", f"'{WORK}' || ({TARGET}) AS merge_into_id").select(
        F.lit("2024-03-02").alias("merge_date"), "id", "merge_into_id").write.option("header", True).csv(f"{root}/merged_ids")
    return root


@query(f"""
WITH versions AS ({' UNION ALL '.join(
    f"SELECT o_orderkey AS id, o_orderkey % 1000 + {place} AS cited_by_count, '{day}' AS updated_date FROM orders WHERE {condition}"
    for place, (day, condition) in enumerate(PARTS.items()))})
SELECT '{WORK}' || id AS id, max_by(cited_by_count, updated_date) AS cited_by_count, max(updated_date) AS updated_date
FROM versions WHERE id NOT IN (SELECT o_orderkey FROM orders WHERE {MERGED}) GROUP BY id""")
def snapshot_current(spark, sf_dir):
    root = write_snapshot(spark, sf_dir)
    gone = snapshot.survivors(snapshot.read_merges(spark, root))
    return snapshot.current_works(snapshot.read_parts(spark, root), gone).select("id", "cited_by_count", "updated_date")


# Citations of merged-away works count for their survivors; those of withdrawn ones are lost.
@query(f"""
WITH RECURSIVE {SURVIVORS}
SELECT DISTINCT '{WORK}' || l_orderkey AS src, '{WORK}' || coalesce(survivor, l_partkey) AS dst
FROM lineitem LEFT JOIN survivors ON l_partkey = id WHERE id IS NULL OR survivor IS NOT NULL""")
def snapshot_redirected(spark, sf_dir):
    led = snapshot.survivors(snapshot.read_merges(spark, write_snapshot(spark, sf_dir)))
    edges = table(spark, sf_dir, "lineitem").select(work_id("l_orderkey").alias("src"), work_id("l_partkey").alias("dst"))
    return snapshot.redirected(edges, led, "dst").distinct()


# Of fifty lines one is cut off, one has a text for a count; large counts fit.
LINE = f"""CASE o_orderkey % 50 WHEN 0 THEN '{{"id": "{WORK}' || o_orderkey || '", "cited_by_'
  WHEN 1 THEN '{{"id": "{WORK}' || o_orderkey || '", "cited_by_count": "x"}}'
  ELSE '{{"id": "{WORK}' || o_orderkey || '", "cited_by_count": ' || (3000000000 + o_orderkey) || '}}' END"""


@query(f"""
SELECT CASE o_orderkey % 50 WHEN 0 THEN 'not_json' ELSE 'value' END AS problem,
       CASE o_orderkey % 50 WHEN 1 THEN '{WORK}' || o_orderkey END AS id, {LINE} AS record FROM orders WHERE o_orderkey % 50 < 2""")
def bad_json_records(spark, sf_dir):
    path = fresh_path(spark, "lines")
    orders(spark, sf_dir).selectExpr(LINE).write.text(path)
    return works_json.bad_records(spark, path).select("problem", "id", "record")


@query(f"""
SELECT '{WORK}' || o_orderkey AS id, CASE WHEN o_orderkey % 50 > 1 THEN 3000000000 + o_orderkey END AS cited_by_count
FROM orders WHERE o_orderkey % 50 > 0""")
def large_json_counts(spark, sf_dir):
    path = fresh_path(spark, "lines")
    orders(spark, sf_dir).selectExpr(LINE).write.text(path)
    return works_json.read_works(spark, path).where("id IS NOT NULL").select("id", "cited_by_count")


# No SQL: tests plant topics and look for them.
@query()
def work_topics(spark, sf_dir):
    found = find_topics(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    return found.works.select("doc_id", "topic", F.round("topic_share", 6).alias("topic_share"))
