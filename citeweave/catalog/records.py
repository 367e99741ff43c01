"""Record shapes: flattening, projection, naming, contracts, response pages, keys."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeweave.catalog.registry import query, table
from citeweave.catalog.standins import JOURNAL, WORK, day_text, doi, nested_works, orders, work_id
from citeweave.operators import rows
from citeweave.sources import pages, tables, works_json


@query(f"""
SELECT '{WORK}' || o_orderkey AS id_OpenAlex, '10.5555/' || o_orderkey AS doi, d.source AS title,
       o_totalprice::BIGINT AS citation_count_OpenAlex,
       '{WORK}' || o_custkey AS first_reference, '{WORK}' || (o_orderkey + o_custkey) // 2 AS second_reference,
       d.text AS abstract_OpenAlex,
       '{JOURNAL}' || o_orderpriority[1] AS source_id, o_orderpriority AS source_name,
       o_orderstatus = 'O' AS source_is_open_access, 'OpenAlex' AS source_database
FROM (SELECT * REPLACE (trunc(o_totalprice) AS o_totalprice) FROM orders)
LEFT JOIN documents d ON o_orderkey = d.doc_id""")
def json_flatten(spark, sf_dir):
    bodies = nested_works(spark, sf_dir).select(F.to_json(F.struct("*")).alias("body"))
    flat = works_json.flatten_works(works_json.parse_bodies(bodies))
    return flat.select(
        "id_OpenAlex", "doi", "title", "citation_count_OpenAlex",
        F.get("referenced_works_OpenAlex", F.lit(0)).alias("first_reference"),
        F.get("referenced_works_OpenAlex", F.lit(1)).alias("second_reference"), "abstract_OpenAlex",
        F.col("source.id").alias("source_id"), F.col("source.name").alias("source_name"),
        F.col("source.is_open_access").alias("source_is_open_access"),
        F.col("source.database").alias("source_database"))


@query("""
SELECT event_id, (props->>'$.k')::BIGINT AS k, CAST(NULL AS VARCHAR) AS z, event_type FROM events""")
def project_fields(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.from_json("props", "k bigint").alias("p")).select("*", "p.k")
    return works_json.project_fields(events, ["event_id", "k", "z", "event_type"])


@query("""
SELECT o_orderkey AS id_OpenAlex, o_totalprice AS citation_count_OpenAlex, o_custkey AS reference_count_OpenAlex,
       o_orderpriority AS referenced_works_OpenAlex, o_orderstatus AS abstract_OpenAlex
FROM orders""")
def rename_canonical(spark, sf_dir):
    raw = orders(spark, sf_dir).select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("cited_by_count"),
        F.col("o_custkey").alias("referenced_count"),
        F.col("o_orderpriority").alias("referenced_works"),
        F.col("o_orderstatus").alias("abstract_inverted_index"))
    return works_json.rename_canonical(raw)


@query(f"""
SELECT o_orderkey,
       CASE WHEN o_orderstatus <> 'P' THEN '{JOURNAL}' || o_custkey END AS id,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS name,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus = 'O' END AS is_open_access,
       CASE WHEN o_orderstatus <> 'P' THEN 'OpenAlex' END AS database
FROM orders""")
def source_struct(spark, sf_dir):
    source = F.when(F.col("o_orderstatus") != "P", F.struct(
        F.concat(F.lit(JOURNAL), F.col("o_custkey")).alias("id"),
        F.col("o_orderpriority").alias("display_name"),
        (F.col("o_orderstatus") == "O").alias("is_oa")))
    works = orders(spark, sf_dir).select("o_orderkey", source.alias("source"))
    return works.select("o_orderkey", works_json.source_struct(F.col("source")).alias("s")).select(
        "o_orderkey", "s.*")


@query("SELECT page_id, url, html FROM pages")
def trim_colnames(spark, sf_dir):
    padded = table(spark, sf_dir, "pages").toDF(" page_id", "url ", "\thtml ")
    return works_json.trim_column_names(padded)


CONTRACT = T.StructType([
    T.StructField("o_orderkey", T.LongType()),
    T.StructField("o_custkey", T.StringType()),
    T.StructField("o_orderpriority", T.IntegerType()),
    T.StructField("o_totalprice", T.ByteType()),
    T.StructField("abstract", T.StringType()),
])


@query("""
SELECT 'o_orderkey' AS column_name, 'bigint' AS expected_type, 'bigint' AS found_type,
       count(o_orderkey) AS n_values, 0::BIGINT AS n_unfit, CAST(NULL AS VARCHAR) AS problem FROM orders
UNION ALL SELECT 'o_custkey', 'string', 'bigint', count(o_custkey), 0, 'type' FROM orders
UNION ALL SELECT 'o_orderpriority', 'int', 'string', count(o_orderpriority),
       count(*) FILTER (o_orderpriority IS NOT NULL AND TRY_CAST(o_orderpriority AS INTEGER) IS NULL), 'values'
FROM orders
UNION ALL SELECT 'o_totalprice', 'tinyint', 'double', count(o_totalprice),
       count(*) FILTER (trunc(o_totalprice) NOT BETWEEN -128 AND 127), 'values' FROM orders
UNION ALL SELECT 'abstract', 'string', NULL, NULL, NULL, 'missing'
UNION ALL SELECT 'o_orderstatus', NULL, 'string', NULL, NULL, 'extra'
UNION ALL SELECT 'o_orderdate', NULL, 'timestamp_ntz', NULL, NULL, 'extra'""")
def schema_contract(spark, sf_dir):
    return rows.contract_report(orders(spark, sf_dir), CONTRACT)


@query("""
SELECT o_orderkey, o_orderpriority AS id_OpenAlex FROM orders
WHERE o_orderpriority NOT IN ('3-MEDIUM', '5-LOW')""")
def drop_null_key(spark, sf_dir):
    key = (F.when(F.col("o_orderpriority") == "5-LOW", "")
           .when(F.col("o_orderpriority") != "3-MEDIUM", F.col("o_orderpriority")))
    works = orders(spark, sf_dir).select("o_orderkey", key.alias("id_OpenAlex"))
    return rows.drop_null_key(works, empty_too=True)


@query("""
SELECT count(*) AS n_rows, count(k) AS n_with_key, count(DISTINCT k) AS n_distinct_keys
FROM (SELECT CASE WHEN l_returnflag <> 'R' THEN l_orderkey END AS k FROM lineitem)""")
def stage_counts(spark, sf_dir):
    works = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") != "R", F.col("l_orderkey")).alias("id_OpenAlex"))
    return rows.stage_counts(works)


TIE_BREAK = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query(f"""
SELECT * EXCLUDE (nth) REPLACE (strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(TIE_BREAK)}) AS nth FROM lineitem)
WHERE nth = 1""")
def dedup_keep_first(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem").withColumn("l_shipdate", day_text("l_shipdate", "yyyy-MM-dd HH:mm:ss"))
    return rows.keep_first(lineitem, "l_orderkey", TIE_BREAK)


@query("SELECT * REPLACE (strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate) FROM orders")
def sort_by_id(spark, sf_dir):
    dated = orders(spark, sf_dir).withColumn("o_orderdate", day_text(form="yyyy-MM-dd HH:mm:ss"))
    return tables.sort_by_id(dated, "o_orderkey")


# Response pages: each order is the one entry (or, for details, two) of a page.

@query("SELECT '10.5555/' || o_orderkey AS doi FROM orders")
def norm_crossref(spark, sf_dir):
    item = F.struct(doi("o_orderkey", "10.5555/").alias("DOI"), F.col("o_orderpriority").alias("title"))
    body = F.struct(F.lit("ok").alias("status"), F.struct(F.array(item).alias("items")).alias("message"))
    return pages.crossref_dois(orders(spark, sf_dir).select(F.to_json(body).alias("body")))


@query("""
SELECT 'p' || o_orderkey AS s2_paper_id,
       CASE WHEN o_orderstatus <> 'P' THEN '10.5555/' || o_orderkey END AS doi FROM orders""")
def norm_s2_search(spark, sf_dir):
    external = F.when(F.col("o_orderstatus") != "P",
                      F.struct(doi("o_orderkey", "10.5555/").alias("DOI")))
    paper = F.struct(F.concat(F.lit("p"), F.col("o_orderkey")).alias("paperId"),
                     external.alias("externalIds"))
    body = F.to_json(F.struct(F.array(paper).alias("data")))
    return pages.s2_search_hits(orders(spark, sf_dir).select(body.alias("body")))


@query("""
SELECT 'p' || o_custkey AS s2_paper_id, arg_max(o_orderpriority, o_orderkey) AS s2_abstract,
       max(o_orderkey) AS s2_reference_count, max(o_orderkey) + 1 AS s2_citation_count,
       arg_max(CASE WHEN o_orderstatus <> 'P' THEN 'p' || o_orderkey ELSE '' END, o_orderkey) AS citing
FROM orders GROUP BY o_custkey""")
def norm_s2_detail(spark, sf_dir):
    def paper(priority):
        citing = F.when(F.col("o_orderstatus") != "P", F.array(
            F.struct(F.concat(F.lit("p"), F.col("o_orderkey")).alias("paperId"))))
        return F.struct(
            F.concat(F.lit("p"), F.col("o_custkey")).alias("paperId"), priority.alias("abstract"),
            F.col("o_orderkey").alias("referenceCount"),
            (F.col("o_orderkey") + 1).alias("citationCount"), citing.alias("citations"))

    none = F.lit(None)
    # Two entries for the same paper with a null, as for one not found, in between.
    entries = F.array(paper(F.lit("older")), F.when(F.col("o_orderkey").isNull(), paper(none)),
                      paper(F.col("o_orderpriority")))
    bodies = orders(spark, sf_dir).select(F.col("o_orderkey").alias("page_no"),
                                          F.to_json(entries).alias("body"))
    return (pages.s2_details(bodies)
            .withColumn("citing", F.array_join("s2_citing_papers", "|")).drop("s2_citing_papers"))


@query(f"""
SELECT '{WORK}' || o_orderkey AS id_OpenAlex, 'https://doi.org/10.5555/' || o_orderkey AS doi FROM orders""")
def norm_openalex_search(spark, sf_dir):
    hit = F.struct(work_id("o_orderkey").alias("id"), doi("o_orderkey").alias("doi"))
    body = F.to_json(F.struct(F.array(hit).alias("results")))
    return pages.openalex_search_hits(orders(spark, sf_dir).select(body.alias("body")))


