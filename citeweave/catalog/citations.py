"""Citation graph and searches."""

from __future__ import annotations

from pyspark.sql import functions as F

from citeweave.catalog.registry import query, table
from citeweave.catalog.standins import JOURNAL, WORK, doi, midway, nested_works, orders, work_id
from citeweave.functions.ids import parse_list, work_number
from citeweave.operators import graph, search

# References of a line: the works numbered like its part and its supplier.
LINE_EDGES = """
SELECT l_orderkey AS src, unnest([l_partkey, l_suppkey]) AS dst FROM lineitem"""


def line_works(spark, sf_dir):
    """Each line item as a work with a printed reference list."""
    printed = F.concat(F.lit("['"), work_id("l_partkey"), F.lit("', '"), work_id("l_suppkey"), F.lit("']"))
    return table(spark, sf_dir, "lineitem").select(
        work_id("l_orderkey").alias("id_OpenAlex"),
        parse_list(printed).alias("referenced_works_OpenAlex"))


def numbered(frame, *columns):
    return frame.withColumns({c: work_number(F.col(c)) for c in columns})


@query(LINE_EDGES)
def citation_edges(spark, sf_dir):
    return numbered(graph.citation_edges(line_works(spark, sf_dir)), "src", "dst")


@query(f"""
SELECT DISTINCT dst AS id FROM ({LINE_EDGES})
WHERE dst NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def reference_frontier(spark, sf_dir):
    held = orders(spark, sf_dir).where("o_orderstatus = 'F'").select(
        work_id("o_orderkey").alias("id_OpenAlex"))
    edges = graph.citation_edges(line_works(spark, sf_dir))
    return numbered(graph.reference_frontier(edges, held), "id")


# Held DOIs are numbered by customer, held ids by order; low-priority candidates have no DOI.
@query(f"""
WITH held AS (SELECT '10.5555/' || o_custkey AS doi, o_orderkey AS id FROM orders WHERE o_orderstatus = 'F'),
candidates AS (
  SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN '10.5555/' || o_orderkey END AS doi, o_orderkey AS id
  FROM orders)
SELECT 'https://doi.org/' || doi AS doi, '{WORK}' || id AS id_OpenAlex FROM candidates c
WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.doi = c.doi)
  AND NOT EXISTS (SELECT 1 FROM held h WHERE h.id = c.id)""")
def novel_candidates(spark, sf_dir):
    candidates = orders(spark, sf_dir).select(
        F.when(F.col("o_orderpriority") != "5-LOW", doi("o_orderkey")).alias("doi"),
        work_id("o_orderkey").alias("id_OpenAlex"))
    held = orders(spark, sf_dir).where("o_orderstatus = 'F'").select(
        doi("o_custkey", "10.5555/").alias("doi"), work_id("o_orderkey").alias("id_OpenAlex"))
    return graph.novel_candidates(candidates, held)


def snapshot(spark, sf_dir):
    return orders(spark, sf_dir).select(
        work_id("o_orderkey").alias("id_OpenAlex"), doi("o_orderkey", "10.5555/").alias("doi"),
        "o_totalprice")


FOUND = f"""
SELECT '{WORK}' || o_orderkey AS id_OpenAlex, '10.5555/' || o_orderkey AS doi, o_totalprice FROM orders
WHERE o_orderkey IN (SELECT l_partkey FROM lineitem)"""


@query(FOUND)
def lookup_by_id(spark, sf_dir):
    asked = table(spark, sf_dir, "lineitem").select(work_id("l_partkey").alias("id"))
    return graph.lookup(snapshot(spark, sf_dir), asked)


@query(FOUND)
def lookup_by_doi(spark, sf_dir):
    asked = table(spark, sf_dir, "lineitem").select(doi("l_partkey").alias("id"))
    return graph.lookup(snapshot(spark, sf_dir), asked, by="doi")


@query(f"""
SELECT DISTINCT '{WORK}' || (l_orderkey + l_partkey) AS id, 'not_found' AS status FROM lineitem
WHERE l_orderkey + l_partkey NOT IN (SELECT o_orderkey FROM orders)""")
def lookup_missing(spark, sf_dir):
    asked = table(spark, sf_dir, "lineitem").select(
        work_id(F.col("l_orderkey") + F.col("l_partkey")).alias("id"))
    return graph.lookup_missing(snapshot(spark, sf_dir), asked)


EDGES = """
SELECT o_orderkey AS src, unnest([o_custkey, (o_orderkey + o_custkey) // 2]) AS dst FROM orders"""


# Seed: one journal's finished works.  Three steps along the references of all works.
@query(f"""
WITH edges AS ({EDGES}),
h0 AS (SELECT o_orderkey AS id FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'),
h1 AS (SELECT DISTINCT dst AS id FROM edges SEMI JOIN h0 ON src = id
       WHERE dst IN (SELECT o_orderkey FROM orders) AND dst NOT IN (SELECT id FROM h0)),
h2 AS (SELECT DISTINCT dst AS id FROM edges SEMI JOIN h1 ON src = id
       WHERE dst IN (SELECT o_orderkey FROM orders)
         AND dst NOT IN (SELECT id FROM h0 UNION ALL SELECT id FROM h1)),
h3 AS (SELECT DISTINCT dst AS id FROM edges SEMI JOIN h2 ON src = id
       WHERE dst IN (SELECT o_orderkey FROM orders)
         AND dst NOT IN (SELECT id FROM h0 UNION ALL SELECT id FROM h1 UNION ALL SELECT id FROM h2))
SELECT id, 0 AS hop FROM h0 UNION ALL SELECT id, 1 FROM h1
UNION ALL SELECT id, 2 FROM h2 UNION ALL SELECT id, 3 FROM h3""")
def expand_references(spark, sf_dir):
    works = orders(spark, sf_dir)
    edges = graph.citation_edges(
        works.select("o_orderkey", F.array(F.col("o_custkey"), midway()).alias("refs")),
        "o_orderkey", "refs")
    seed = works.where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'")
    return graph.expand_references(seed, edges, works, hops=3, seed_id="o_orderkey",
                                   available_id="o_orderkey")


@query(f"""
SELECT '{WORK}' || o_orderkey AS id FROM orders
WHERE o_orderpriority[1] = '2' AND year(o_orderdate) = 1997""")
def filter_journal_year(spark, sf_dir):
    works = nested_works(spark, sf_dir).select("id", "publication_year", "locations")
    return search.filter_journal_year(works, f"{JOURNAL}2", 1997).select("id")


@query("""
SELECT o_orderkey, year(o_orderdate)::INTEGER AS publication_year FROM orders
WHERE year(o_orderdate) BETWEEN 1996 AND 1999""")
def filter_year_range(spark, sf_dir):
    works = orders(spark, sf_dir).select("o_orderkey", F.year("o_orderdate").alias("publication_year"))
    return search.filter_year_range(works, 1999, 1996)


@query("""
SELECT o_orderkey, o_orderpriority, publication_year FROM (
  SELECT o_orderkey, o_orderpriority, year(o_orderdate)::INTEGER AS publication_year,
         row_number() OVER (PARTITION BY o_orderpriority, year(o_orderdate) ORDER BY o_orderkey) AS nth
  FROM orders)
WHERE nth <= 100""")
def cap_per_group(spark, sf_dir):
    works = orders(spark, sf_dir).select("o_orderkey", "o_orderpriority",
                                         F.year("o_orderdate").alias("publication_year"))
    return search.cap_per_group(works, ["o_orderpriority", "publication_year"], ["o_orderkey"], 100)


# Two journals per supplier, one spelled in capitals; customers are no journals.
@query(f"""
WITH journals AS (
  SELECT 'S' || s_suppkey AS id, s_name AS n FROM supplier
  UNION ALL SELECT 'S9' || s_suppkey, upper(s_name) FROM supplier),
names AS (
  SELECT s_name AS n FROM supplier UNION SELECT upper(s_name) FROM supplier
  UNION SELECT lower(s_name) || ' ' FROM supplier UNION SELECT c_name FROM customer),
exact AS (SELECT n, min('{JOURNAL[:-1]}' || id) AS id FROM journals GROUP BY n),
alike AS (SELECT lower(n) AS n, min('{JOURNAL[:-1]}' || id) AS id FROM journals GROUP BY lower(n))
SELECT names.n AS name, replace(coalesce(exact.id, alike.id), '{JOURNAL[:-1]}', '') AS journal_id
FROM names LEFT JOIN exact ON names.n = exact.n LEFT JOIN alike ON lower(trim(names.n)) = alike.n
WHERE alike.id IS NOT NULL""")
def journal_lookup(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier")
    plain = supplier.select(F.concat(F.lit(JOURNAL), F.col("s_suppkey")).alias("id"),
                            F.col("s_name").alias("display_name"))
    capital = supplier.select(F.concat(F.lit(JOURNAL), F.lit("9"), F.col("s_suppkey")).alias("id"),
                              F.upper("s_name").alias("display_name"))
    names = (supplier.select(F.col("s_name").alias("name"))
             .unionAll(supplier.select(F.upper("s_name")))
             .unionAll(supplier.select(F.concat(F.lower("s_name"), F.lit(" "))))
             .unionAll(table(spark, sf_dir, "customer").select("c_name")))
    return search.journal_lookup(names, plain.unionAll(capital))
