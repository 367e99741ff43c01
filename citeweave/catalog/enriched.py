"""Merged records of several services, citing works, bibliometrics, standing and trends."""

from __future__ import annotations

from pyspark.sql import functions as F

from citeweave.catalog.registry import query
from citeweave.catalog.standins import WORK, midway, orders, work_id
from citeweave.operators import graph, impact, merge, standing, trends
from citeweave.sources import pages, works_json
from citeweave.sources.tables import staged

# Four services answer about each order.  Work and DOI of an order have its number; two orders share a
# paper, so their works are one where each has its DOI.  Services write DOIs differently.  The DOI is
# missing for low priorities in one service and for every third number in another.
RECORDS = f"""
records AS (
  SELECT 'openalex' AS service, 1 AS rank, CASE WHEN o_orderpriority <> '5-LOW' THEN '10.5555/x' || o_orderkey END AS doi,
    '{WORK}' || o_orderkey AS id_OpenAlex, NULL AS s2_paper_id, o_orderpriority AS title, NULL AS abstract,
    strftime(o_orderdate, '%Y-%m-%d') AS publication_date, trunc(o_totalprice)::BIGINT AS citation_count,
    NULL::BIGINT AS reference_count FROM orders
  UNION ALL SELECT 'semantic_scholar', 2, CASE WHEN o_orderkey % 3 <> 0 THEN '10.5555/x' || o_orderkey END, NULL,
    'p' || o_orderkey // 2, NULL, NULL, NULL, NULL, NULL FROM orders
  UNION ALL SELECT 'semantic_scholar', 2, NULL, NULL, 'p' || o_orderkey // 2, NULL, arg_max(o_orderstatus, o_orderkey), NULL,
    max(o_orderkey) + 1, max(o_orderkey) FROM orders GROUP BY o_orderkey // 2
  UNION ALL SELECT 'crossref', 3, '10.5555/x' || o_orderkey, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM orders
    WHERE o_orderkey % 2 = 0),
keyed AS (
  SELECT *, list_filter(['doi:' || doi, 'id_OpenAlex:' || id_OpenAlex, 's2_paper_id:' || s2_paper_id],
                        lambda k: k IS NOT NULL) AS keys FROM records),
links AS (SELECT DISTINCT list_min(keys) AS a, unnest(keys) AS b FROM keyed),
ends AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT a AS node, a AS other FROM ends
  UNION SELECT reach.node, ends.b FROM reach JOIN ends ON reach.other = ends.a),
entities AS (SELECT node, min(other) AS entity FROM reach GROUP BY node),
matched AS (SELECT entity, keyed.* FROM keyed JOIN entities ON list_min(keys) = node)"""


def service_records(spark, sf_dir):
    """The services' answers as pages and records, read by the package's readers and aligned."""
    number, prefix = F.col("o_orderkey"), F.lit("10.5555/X")
    own_doi = F.concat(prefix, number.cast("string"))
    work = F.struct(
        work_id("o_orderkey").alias("id"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.lit("https://doi.org/"), own_doi)).alias("doi"),
        F.col("o_orderpriority").alias("title"), F.col("o_totalprice").cast("int").alias("cited_by_count"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("publication_date"))
    paper_id = F.concat(F.lit("p"), F.floor(number / 2).cast("string"))
    external = F.when(number % 3 != 0, F.struct(F.concat(F.lit(" doi:"), F.lower(own_doi)).alias("DOI")))
    hit = F.struct(paper_id.alias("paperId"), external.alias("externalIds"))
    paper = F.struct(paper_id.alias("paperId"), F.col("o_orderstatus").alias("abstract"), number.alias("referenceCount"),
                     (number + 1).alias("citationCount"))
    item = F.struct(own_doi.alias("DOI"))
    bodies = orders(spark, sf_dir).select(
        "o_orderkey", number.alias("page_no"), F.to_json(work).alias("work"),
        F.to_json(F.struct(F.array(hit).alias("data"))).alias("search"), F.to_json(F.array(paper)).alias("detail"),
        F.to_json(F.struct(F.struct(F.array(item).alias("items")).alias("message"))).alias("registered"))
    fields = ["id", "doi", "title", "cited_by_count", "publication_date"]
    return staged(merge.aligned(works_json.flatten_works(works_json.parse_bodies(bodies, "work"), fields), "openalex").unionByName(
        merge.aligned(pages.s2_search_hits(bodies, "search"), "semantic_scholar")).unionByName(
        merge.aligned(pages.s2_details(bodies, "detail"), "semantic_scholar")).unionByName(
        merge.aligned(pages.crossref_dois(bodies.where(number % 2 == 0), "registered"), "crossref")), "records")


def first_by_rank(field, kind="VARCHAR"):
    """The value of the service with most say, the smallest as text if it has several."""
    return (f"(min(struct_pack(rank := rank, text := {field}::VARCHAR, value := {field})) "
            f"FILTER ({field} IS NOT NULL)).value::{kind} AS {field}")


FIELD_KINDS = {"doi": "VARCHAR", "id_OpenAlex": "VARCHAR", "s2_paper_id": "VARCHAR", "title": "VARCHAR", "abstract": "VARCHAR",
               "publication_date": "VARCHAR", "citation_count": "BIGINT", "reference_count": "BIGINT"}


@query(f"""
WITH RECURSIVE {RECORDS}
SELECT entity, {', '.join(first_by_rank(field, kind) for field, kind in FIELD_KINDS.items())}, count(*) AS n_records,
  array_to_string(list_sort(list(DISTINCT service)), '|') AS services FROM matched GROUP BY entity""")
def merge_services(spark, sf_dir):
    matched = merge.with_entity(service_records(spark, sf_dir))
    return merge.merge_records(matched).withColumn("services", F.array_join("services", "|"))


@query(f"""
WITH RECURSIVE {RECORDS},
cells AS ({' UNION ALL '.join(
    f"SELECT entity, rank, service, '{field}' AS field, {field}::VARCHAR AS value FROM matched" for field in FIELD_KINDS)}),
seen AS (
  SELECT entity, field, value, min(struct_pack(rank := rank, service := service)) AS first, count(*) AS n_records
  FROM cells WHERE value IS NOT NULL GROUP BY ALL),
judged AS (
  SELECT *, count(*) OVER same AS n, min(struct_pack(rank := first.rank, value := value)) OVER same AS taken
  FROM seen WINDOW same AS (PARTITION BY entity, field))
SELECT entity, field, value, first.service AS service, n_records, value = taken.value AS chosen FROM judged WHERE n > 1""")
def merge_conflicts(spark, sf_dir):
    return merge.conflicts(merge.with_entity(service_records(spark, sf_dir)))


# Two steps from the works of one journal to the works that cite them, and to those that cite these.
@query("""
WITH edges AS (SELECT o_orderkey AS src, unnest([o_custkey, (o_orderkey + o_custkey) // 2]) AS dst FROM orders),
h0 AS (SELECT o_orderkey AS id FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'),
h1 AS (SELECT DISTINCT src AS id FROM edges SEMI JOIN h0 ON dst = id WHERE src NOT IN (SELECT id FROM h0)),
h2 AS (SELECT DISTINCT src AS id FROM edges SEMI JOIN h1 ON dst = id
       WHERE src NOT IN (SELECT id FROM h0 UNION ALL SELECT id FROM h1))
SELECT id, 0 AS hop FROM h0 UNION ALL SELECT id, 1 FROM h1 UNION ALL SELECT id, 2 FROM h2""")
def expand_citations(spark, sf_dir):
    works = orders(spark, sf_dir)
    edges = graph.citation_edges(works.select("o_orderkey", F.array(F.col("o_custkey"), midway()).alias("refs")),
                                 "o_orderkey", "refs")
    seed = works.where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'")
    return graph.expand_references(seed, graph.cited_by(edges, chunk=20), works, hops=2, seed_id="o_orderkey",
                                   available_id="o_orderkey")


# What a two-step expansion along references met and the snapshot, all works but those of status P, lacks.
@query(f"""
WITH edges AS (SELECT o_orderkey AS src, unnest([l_partkey, l_orderkey + 20000]) AS dst FROM orders JOIN lineitem
               ON o_orderkey = l_orderkey),
held AS (SELECT o_orderkey AS id FROM orders WHERE o_orderstatus <> 'P'),
h0 AS (SELECT o_orderkey AS id FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'),
h1 AS (SELECT DISTINCT dst AS id FROM edges SEMI JOIN h0 ON src = id
       WHERE dst IN (SELECT id FROM held) AND dst NOT IN (SELECT id FROM h0))
SELECT DISTINCT dst AS id, 'not_found' AS status FROM edges
WHERE src IN (SELECT id FROM h0 UNION ALL SELECT id FROM h1) AND dst NOT IN (SELECT id FROM held)""")
def expansion_not_found(spark, sf_dir):
    works = orders(spark, sf_dir)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    lists = staged(lines.groupBy(F.col("l_orderkey").alias("id")).agg(F.collect_set("l_partkey").alias("parts")).select(
        "id", F.concat("parts", F.array(F.col("id") + 20000)).alias("referenced_works"))
        .join(works.select(F.col("o_orderkey").alias("id")), "id", "left_semi"), "lists")
    held = works.where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("id"))
    seed = works.where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'")
    reached = staged(graph.expand_references(seed, lists, held, 2, seed_id="o_orderkey", available_id="id"), "reached")
    return graph.unreachable(lists, reached, held, 2)


# One journal holds nine tenths of all works; counts are cut and sometimes missing.
JOURNALS = """
SELECT CASE WHEN o_orderkey % 10 <> 0 THEN 'main' WHEN o_orderkey % 100 <> 0 THEN o_orderpriority END AS journal,
       CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice / 97 - 20 END AS cites FROM orders"""


@query(f"""
WITH w AS (SELECT journal, greatest(coalesce(floor(cites), 0), 0)::BIGINT AS c FROM ({JOURNALS}) WHERE journal IS NOT NULL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY journal ORDER BY c DESC) AS nth FROM w)
SELECT journal, count(*) AS n_works, count(*) FILTER (c > 0) AS n_cited, count(*) FILTER (c >= nth) AS h_index
FROM ranked GROUP BY journal""")
def h_index(spark, sf_dir):
    number = F.col("o_orderkey")
    journal = F.when(number % 10 != 0, "main").when(number % 100 != 0, F.col("o_orderpriority"))
    cites = F.when(number % 7 != 0, F.col("o_totalprice") / 97 - 20)
    works = orders(spark, sf_dir).select(journal.alias("journal"), cites.alias("citation_count_OpenAlex"))
    return impact.h_index(works)


# Works of status P have no date; every fifth citing work is not among the works.
CITED = """
WITH works AS (
  SELECT o_orderkey AS id, CASE WHEN o_orderstatus <> 'P' THEN year(o_orderdate)::INTEGER END AS y FROM orders
  WHERE o_orderkey % 5 <> 0),
edges AS (SELECT DISTINCT o_orderkey AS src, unnest([o_custkey, (o_orderkey + o_custkey) // 2]) AS dst FROM orders),
cites AS (SELECT dst AS id, y, count(*) AS n FROM edges LEFT JOIN works ON src = works.id GROUP BY ALL)"""


def cited_orders(spark, sf_dir):
    all_works = orders(spark, sf_dir)
    works = all_works.where("o_orderkey % 5 <> 0").select(
        F.col("o_orderkey").alias("id_OpenAlex"),
        F.when(F.col("o_orderstatus") != "P", F.year("o_orderdate")).alias("publication_year"))
    edges = graph.citation_edges(all_works.select("o_orderkey", F.array(F.col("o_custkey"), midway()).alias("refs")),
                                 "o_orderkey", "refs")
    return works, impact.dated_citations(works, edges)


@query(f"""
{CITED},
first AS (SELECT id, min(y) AS first FROM cites WHERE y <= 1999 GROUP BY id),
days AS (
  SELECT works.id, works.y AS born, unnest(generate_series(least(works.y, coalesce(first, works.y)), 1999))::INTEGER AS year
  FROM works LEFT JOIN first USING (id) WHERE works.y IS NOT NULL)
SELECT days.id, year, year - born AS age, coalesce(n, 0) AS n,
  (sum(coalesce(n, 0)) OVER (PARTITION BY days.id ORDER BY year))::BIGINT AS n_upto
FROM days LEFT JOIN cites ON days.id = cites.id AND days.year = cites.y""")
def citation_calendar(spark, sf_dir):
    return impact.citation_calendar(*cited_orders(spark, sf_dir), last_year=1999)


@query(f"""
{CITED},
per AS (
  SELECT id, sum(n) FILTER (y <= 1999) AS n_citations, sum(n) FILTER (y IS NULL) AS n_undated, min(y) FILTER (y <= 1999) AS first_cited,
    (max(struct_pack(n := n, back := -y)) FILTER (y <= 1999)).back AS back, sum(n) FILTER (y BETWEEN 1997 AND 1999) AS n_recent
  FROM cites GROUP BY id)
SELECT works.id, y AS publication_year, coalesce(n_citations, 0)::BIGINT AS n_citations, coalesce(n_undated, 0)::BIGINT AS n_undated,
  first_cited, -back AS peak_year, coalesce(n_recent, 0)::BIGINT AS n_recent,
  CASE WHEN y <= 1999 THEN coalesce(n_citations, 0)::DOUBLE / (1999 - y + 1) END AS velocity,
  CASE WHEN y <= 1999 THEN coalesce(n_recent, 0)::DOUBLE / least(1999 - y + 1, 3) END AS recent_velocity
FROM works LEFT JOIN per USING (id)""")
def citation_velocity(spark, sf_dir):
    return impact.citation_velocity(*cited_orders(spark, sf_dir), as_of=1999)


# Few distinct values, so most are tied; some are missing.
COUNTED = """
SELECT o_orderkey, o_orderpriority, year(o_orderdate)::INTEGER AS publication_year,
       CASE WHEN o_orderkey % 11 <> 0 THEN floor(o_totalprice / 1000) END AS cites FROM orders"""


def counted_orders(spark, sf_dir):
    return orders(spark, sf_dir).select(
        "o_orderkey", "o_orderpriority", F.year("o_orderdate").alias("publication_year"),
        F.when(F.col("o_orderkey") % 11 != 0, F.floor(F.col("o_totalprice") / 1000).cast("double"))
        .alias("citation_count_OpenAlex"))


@query(f"""
SELECT o_orderkey, CASE WHEN cites IS NOT NULL THEN 100 * percent_rank() OVER (
         PARTITION BY publication_year, cites IS NULL ORDER BY cites) END AS in_year,
       CASE WHEN cites IS NOT NULL THEN percent_rank() OVER (
         PARTITION BY publication_year, o_orderpriority, cites IS NULL ORDER BY cites) END AS in_year_and_journal
FROM ({COUNTED})""")
def percentile_in_year(spark, sf_dir):
    works = standing.add_percentile(counted_orders(spark, sf_dir), "in_year", scale=100.0)
    return standing.add_percentile(works, "in_year_and_journal", by=["publication_year", "o_orderpriority"]).select(
        "o_orderkey", "in_year", "in_year_and_journal")


# Rounded: sums of fractions depend on their order in the last digits.
@query(f"""
WITH m AS (SELECT publication_year, avg(cites) AS mean, stddev_pop(cites) AS std FROM ({COUNTED}) GROUP BY 1)
SELECT o_orderkey, round(mean, 6) AS citation_mean, round(std, 6) AS citation_std, round((cites - mean) / std, 6) + 0 AS citation_z,
       round(cites / mean, 6) AS citation_ratio
FROM ({COUNTED}) JOIN m USING (publication_year)""")
def normalised_counts(spark, sf_dir):
    works = standing.add_normalised(counted_orders(spark, sf_dir))
    return works.select("o_orderkey", *[(F.round(f"citation_count_OpenAlex_{part}", 6) + 0).alias(f"citation_{part}")
                                        for part in ("mean", "std", "z", "ratio")])


# One journal has no works in the middle year, another only those of one year.
TREND = """
SELECT o_orderpriority, year(o_orderdate)::INTEGER AS y, CASE WHEN o_orderkey % 11 <> 0 THEN floor(o_totalprice) END AS cites
FROM orders WHERE NOT (o_orderpriority = '2-HIGH' AND year(o_orderdate) = 1997)
  AND NOT (o_orderpriority = '3-MEDIUM' AND year(o_orderdate) <> 1996)"""


@query(f"""
WITH w AS ({TREND}),
per AS (SELECT o_orderpriority, y, count(*) AS n, count(cites) AS v, sum(cites) AS t FROM w GROUP BY ALL),
dense AS (
  SELECT c.o_orderpriority, c.y, coalesce(n, 0) AS n, coalesce(v, 0) AS v, coalesce(t, 0) AS t
  FROM (SELECT o_orderpriority, unnest(generate_series(lo, hi))::INTEGER AS y
        FROM (SELECT o_orderpriority, min(y) AS lo, max(y) AS hi FROM w GROUP BY ALL)) c
  LEFT JOIN per ON c.o_orderpriority = per.o_orderpriority AND c.y = per.y)
SELECT o_orderpriority, y AS publication_year, n AS n_works, v AS n_valued, t AS total, CASE WHEN v > 0 THEN t / v END AS mean,
  lag(n) OVER o AS works_before, n - lag(n) OVER o AS works_change,
  CASE WHEN lag(n) OVER o > 0 THEN (n - lag(n) OVER o)::DOUBLE / lag(n) OVER o END AS works_growth,
  avg(n) OVER (o ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS works_moving,
  CASE WHEN sum(v) OVER (o ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) > 0 THEN sum(t) OVER (o ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
    / sum(v) OVER (o ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) END AS mean_moving,
  (sum(n) OVER (o ROWS UNBOUNDED PRECEDING))::BIGINT AS works_upto,
  round(regr_slope(n, y) OVER (PARTITION BY o_orderpriority), 6) AS works_slope
FROM dense WINDOW o AS (PARTITION BY o_orderpriority ORDER BY y)""")
def yearly_trends(spark, sf_dir):
    works = orders(spark, sf_dir).select(
        "o_orderpriority", F.year("o_orderdate").alias("publication_year"),
        F.when(F.col("o_orderkey") % 11 != 0, F.floor("o_totalprice").cast("double")).alias("citation_count_OpenAlex"))
    works = works.where("NOT (o_orderpriority = '2-HIGH' AND publication_year = 1997) "
                        "AND NOT (o_orderpriority = '3-MEDIUM' AND publication_year <> 1996)")
    return trends.yearly_trends(works, by=["o_orderpriority"]).withColumn("works_slope", F.round("works_slope", 6))
