"""Files written to the shared folder and read back, and incremental landing."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeweave.catalog.registry import query, table
from citeweave.catalog.standins import WORK, day_text, doi, orders, with_documents, work_id
from citeweave.plans.integrate import integrate
from citeweave.session import fresh_path
from citeweave.sources import landing, tables
from citeweave.streaming.ingest import ingest_landing

# Which sub-folder the works of each status are landed in.
FOLDER_OF = {"F": "", "O": "citations", "P": "references"}


def landed_works(spark, sf_dir):
    return with_documents(spark, sf_dir).select(
        "o_orderstatus",
        work_id("o_orderkey").alias("id_OpenAlex"),
        doi("o_orderkey", "10.5555/").alias("doi"),
        F.floor("o_totalprice").alias("citation_count_OpenAlex"),
        F.col("doc_source").alias("title"),
        F.col("text").alias("abstract_OpenAlex"),
        day_text().alias("publication_date"),
    )


def land_by_status(works, root):
    for status, sub in FOLDER_OF.items():
        part = works.where(F.col("o_orderstatus") == status).drop("o_orderstatus")
        landing.append_batch(part, f"{root}/{sub}".rstrip("/"))


LANDED = f"""
SELECT '{WORK}' || o_orderkey AS id_OpenAlex, '10.5555/' || o_orderkey AS doi,
       floor(o_totalprice)::INTEGER AS citation_count_OpenAlex, d.source AS title,
       d.text AS abstract_OpenAlex, strftime(o_orderdate, '%Y-%m-%d') AS publication_date
FROM orders LEFT JOIN documents d ON o_orderkey = d.doc_id"""
LANDED_COLUMNS = ["id_OpenAlex", "doi", "citation_count_OpenAlex", "title", "abstract_OpenAlex",
                  "publication_date"]


@query(f"""
SELECT l.*, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS origin_rank
FROM ({LANDED}) l JOIN orders ON l.id_OpenAlex = '{WORK}' || o_orderkey""")
def src_csv_typed(spark, sf_dir):
    root = fresh_path(spark, "csv")
    land_by_status(landed_works(spark, sf_dir), root)
    folders = [f"{root}/{sub}".rstrip("/") for sub in landing.SUBFOLDERS]
    return landing.read_landing(spark, folders).select(*LANDED_COLUMNS, "origin_rank")


# The priority text lands in the count column, where it does not fit.
@query("""
SELECT 'citation_count_OpenAlex' AS column, o_orderpriority AS text, count(*) AS n
FROM orders WHERE o_orderstatus = 'P' GROUP BY o_orderpriority""")
def csv_bad_cells(spark, sf_dir):
    root = fresh_path(spark, "csv")
    count = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise(
        F.floor("o_totalprice").cast("string"))
    landing.append_batch(orders(spark, sf_dir).select(
        work_id("o_orderkey").alias("id_OpenAlex"), count.alias("citation_count_OpenAlex")), root)
    cells = landing.read_text_cells(spark, [root])
    return landing.bad_cells(cells).groupBy("column", "text").agg(F.count("*").alias("n"))


@query("SELECT * REPLACE (strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate) FROM orders")
def src_parquet(spark, sf_dir):
    return tables.read_table(spark, f"{sf_dir}/orders.parquet").withColumn(
        "o_orderdate", day_text(form="yyyy-MM-dd HH:mm:ss"))


@query(f"""
SELECT DISTINCT '10.5555/' || o_custkey AS doi, '{WORK}' || o_orderkey AS id_OpenAlex FROM orders
UNION SELECT DISTINCT CAST(NULL AS VARCHAR), '{WORK}' || l_partkey FROM lineitem""")
def known_ids(spark, sf_dir):
    root = fresh_path(spark, "known")
    landing.append_batch(orders(spark, sf_dir).select(
        doi("o_custkey", "10.5555/").alias("doi"), work_id("o_orderkey").alias("id_OpenAlex")),
        f"{root}/journal")
    landing.append_batch(table(spark, sf_dir, "lineitem").select(
        F.lit(None).cast("string").alias("doi"), work_id("l_partkey").alias("id_OpenAlex")),
        f"{root}/journal/references")
    return landing.known_ids(spark, root)


@query(f"""
SELECT '{WORK}' || o_orderkey AS id_OpenAlex, o_custkey::VARCHAR AS title FROM orders
UNION ALL SELECT '{WORK}' || o_orderkey, o_custkey::VARCHAR FROM orders WHERE o_orderstatus = 'F'""")
def sink_append(spark, sf_dir):
    folder = fresh_path(spark, "append")
    works = orders(spark, sf_dir).select(
        "o_orderstatus", work_id("o_orderkey").alias("id_OpenAlex"),
        F.col("o_custkey").cast("string").alias("title"))
    landing.append_batch(works.drop("o_orderstatus"), folder)
    landing.append_batch(works.where("o_orderstatus = 'F'").drop("o_orderstatus"), folder)
    return landing.read_landing(spark, [folder]).select("id_OpenAlex", "title")


SINK_CONTRACT = T.StructType([
    T.StructField("id_OpenAlex", T.StringType()),
    T.StructField("citation_count_OpenAlex", T.DoubleType()),
    T.StructField("publication_year", T.IntegerType()),
])


@query(f"""
SELECT '{WORK}' || o_orderkey AS id_OpenAlex, o_custkey::DOUBLE AS citation_count_OpenAlex,
       year(o_orderdate)::INTEGER AS publication_year, o_orderpriority AS type FROM orders""")
def sink_parquet(spark, sf_dir):
    path = fresh_path(spark, "sink")
    works = orders(spark, sf_dir).select(
        work_id("o_orderkey").alias("id_OpenAlex"),
        F.col("o_custkey").alias("citation_count_OpenAlex"), F.col("o_orderpriority").alias("type"),
        F.year("o_orderdate").cast("bigint").alias("publication_year"))
    ordered = tables.sort_by_id(works, within="publication_year")
    tables.write_table(ordered, path, SINK_CONTRACT, partition_by="publication_year")
    return tables.read_table(spark, path)


@query("SELECT * REPLACE (strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate) FROM orders")
def stage_roundtrip(spark, sf_dir):
    works = tables.staged(tables.staged(orders(spark, sf_dir), "first"), "second")
    return works.withColumn("o_orderdate", day_text(form="yyyy-MM-dd HH:mm:ss"))


# Ten batches land one after another in one folder, each with every work; the first copy stays.
@query(f"SELECT '{WORK}' || o_orderkey AS id_OpenAlex, 0 AS citation_count_OpenAlex FROM orders")
def keep_first_batch(spark, sf_dir):
    root = fresh_path(spark, "batches")
    works = orders(spark, sf_dir).select(work_id("o_orderkey").alias("id_OpenAlex"))
    for number in range(10):
        landing.append_batch(works.withColumn("citation_count_OpenAlex", F.lit(number)), root)
    return integrate(landing.read_landing(spark, [root])).select("id_OpenAlex", "citation_count_OpenAlex")


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'O' THEN o_custkey END AS o_custkey,
       CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice FROM orders""")
def union_sources(spark, sf_dir):
    works = orders(spark, sf_dir)
    return landing.union_sources([
        works.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_totalprice"),
        works.where("o_orderstatus = 'O'").select("o_totalprice", "o_orderkey"),
        works.where("o_orderstatus = 'P'").select("o_custkey", "o_orderkey"),
    ])


# Works of status F land first; then all land, with one more citation each.
@query(f"""
SELECT '{WORK}' || o_orderkey AS id_OpenAlex,
       (floor(o_totalprice) + CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END)::INTEGER AS citation_count_OpenAlex
FROM orders""")
def incremental_ingest(spark, sf_dir):
    root = fresh_path(spark, "ingest")
    works = orders(spark, sf_dir).select(
        "o_orderstatus", work_id("o_orderkey").alias("id_OpenAlex"),
        F.floor("o_totalprice").alias("citation_count_OpenAlex"))
    header = T.StructType([T.StructField(c, T.StringType())
                           for c in ("id_OpenAlex", "citation_count_OpenAlex")])
    later = works.withColumn("citation_count_OpenAlex", F.col("citation_count_OpenAlex") + 1)
    for batch in (works.where("o_orderstatus = 'F'"), later):
        landing.append_batch(batch.drop("o_orderstatus"), f"{root}/landing")
        ingest_landing(spark, f"{root}/landing", f"{root}/target", f"{root}/checkpoint", header=header)
    return tables.read_table(spark, f"{root}/target").select("id_OpenAlex", "citation_count_OpenAlex")
