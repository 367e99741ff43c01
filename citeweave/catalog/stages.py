"""The whole stages."""

from __future__ import annotations

from pyspark.sql import functions as F

from citeweave.catalog.describing import COUNTS, histogram_sql
from citeweave.catalog.landing import LANDED, LANDED_COLUMNS, land_by_status, landed_works
from citeweave.catalog.registry import query
from citeweave.catalog.standins import JOURNAL, WORK, doi, flat_works, nested_works, orders, work_id
from citeweave.catalog.texts import CLEANED
from citeweave.operators.describe import figures, histograms
from citeweave.plans.acquire import acquire, expand, requests_for
from citeweave.plans.describe import DESCRIBED
from citeweave.plans.features import dated_works, features, fill_percentiles, sorted_features
from citeweave.plans.integrate import integrate
from citeweave.schemas import FEATURE_WORK
from citeweave.session import fresh_path
from citeweave.sources import landing
from citeweave.sources.tables import read_table, staged, write_table

# Searches: journals 1, 2 and 3 in 1996 to 1998; held: works of status P.
WANTED = """
WITH wanted AS (
  SELECT * FROM orders
  WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AND year(o_orderdate) BETWEEN 1996 AND 1998
    AND o_orderstatus <> 'P')"""
FLAT = f"""
SELECT '{WORK}' || o_orderkey AS id_OpenAlex, '10.5555/' || o_orderkey AS doi, d.source AS title,
       trunc(o_totalprice)::BIGINT AS citation_count_OpenAlex, d.text AS abstract_OpenAlex,
       o_orderpriority AS journal"""


def acquired(spark, sf_dir):
    snapshot = staged(nested_works(spark, sf_dir), "snapshot")
    works = orders(spark, sf_dir)
    journals = works.select(F.concat(F.lit(JOURNAL), F.substring("o_orderpriority", 1, 1)).alias("id"),
                            F.col("o_orderpriority").alias("display_name")).distinct()
    names = works.where("o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')").select(
        F.lower("o_orderpriority").alias("name"))
    held = works.where("o_orderstatus = 'P'").select(
        doi("o_orderkey", "10.5555/").alias("doi"), work_id("o_orderkey").alias("id_OpenAlex"))
    held_references = works.where("o_orderstatus = 'F'").select(work_id("o_orderkey").alias("id_OpenAlex"))
    return acquire(snapshot, requests_for(names, journals, 1998, 1996), held, held_references)


def flat_columns(works):
    return works.select("id_OpenAlex", "doi", "title", "citation_count_OpenAlex", "abstract_OpenAlex",
                        F.col("source.name").alias("journal"))


@query(f"{WANTED} {FLAT} FROM wanted LEFT JOIN documents d ON o_orderkey = d.doc_id")
def acquire_works(spark, sf_dir):
    return flat_columns(acquired(spark, sf_dir).works)


@query(f"""{WANTED},
frontier AS (
  SELECT o_custkey AS id FROM wanted UNION SELECT (o_orderkey + o_custkey) // 2 FROM wanted)
{FLAT} FROM orders LEFT JOIN documents d ON o_orderkey = d.doc_id
WHERE o_orderkey IN (SELECT id FROM frontier) AND o_orderstatus <> 'F'""")
def acquire_references(spark, sf_dir):
    return flat_columns(acquired(spark, sf_dir).references)


# Works of journal 1 followed for two steps, with their records.
@query(f"""
WITH edges AS (
  SELECT o_orderkey AS src, unnest([o_custkey, (o_orderkey + o_custkey) // 2]) AS dst FROM orders),
h0 AS (SELECT o_orderkey AS id FROM orders WHERE o_orderpriority = '1-URGENT'),
h1 AS (SELECT DISTINCT dst AS id FROM edges SEMI JOIN h0 ON src = id WHERE dst NOT IN (SELECT id FROM h0)),
h2 AS (SELECT DISTINCT dst AS id FROM edges SEMI JOIN h1 ON src = id
       WHERE dst NOT IN (SELECT id FROM h0 UNION ALL SELECT id FROM h1)),
reached AS (SELECT id, 1 AS hop FROM h1 UNION ALL SELECT id, 2 FROM h2)
{FLAT}, hop FROM orders JOIN reached ON o_orderkey = id LEFT JOIN documents d ON o_orderkey = d.doc_id""")
def expand_works(spark, sf_dir):
    seed = orders(spark, sf_dir).where("o_orderpriority = '1-URGENT'").select(
        work_id("o_orderkey").alias("id_OpenAlex"))
    reached = expand(staged(nested_works(spark, sf_dir), "snapshot"), seed, hops=2)
    return reached.select("id_OpenAlex", "doi", "title", "citation_count_OpenAlex", "abstract_OpenAlex",
                          F.col("source.name").alias("journal"), "hop")


# Landed twice: by status in the folders of main, citing and referenced works, and all
# of them once more, without text, as referenced works.
@query(LANDED)
def integrate_works(spark, sf_dir):
    root = fresh_path(spark, "landing")
    works = landed_works(spark, sf_dir).where("o_orderstatus <> 'P'")
    land_by_status(works, root)
    rest = landed_works(spark, sf_dir).drop("o_orderstatus")
    landed = landing.read_landing(spark, [f"{root}/{sub}".rstrip("/") for sub in landing.SUBFOLDERS])
    again = f"{root}/again"
    landing.append_batch(rest, again)
    twice = landing.union_sources([
        landed,
        landing.read_landing(spark, [again]).withColumn("origin_rank", F.lit(len(landing.SUBFOLDERS)))])
    return integrate(twice).select(*LANDED_COLUMNS)


FEATURES = f"""
WITH m AS (
  SELECT year(o_orderdate) AS y, median(o_totalprice) AS median FROM orders GROUP BY 1)
SELECT o_orderkey AS id_OpenAlex, strftime(o_orderdate, '%Y-%m-%d') AS publication_date,
       year(o_orderdate)::BIGINT AS publication_year,
       date_diff('day', DATE '1970-01-01', o_orderdate::DATE)::BIGINT * 86400000000000 AS publication_date_int,
       o_totalprice AS citation_count_OpenAlex, median AS median_citation_count_year,
       (o_totalprice > median)::BIGINT AS higher_than_median_year,
       {CLEANED.format("coalesce(d.source, '') || ' ' || coalesce(d.text, '')")} AS title_abstract
FROM orders JOIN m ON year(o_orderdate) = y JOIN documents d ON o_orderkey = d.doc_id"""


# The whole feature table, written by the sink under its contract and read again.
@query(f"""
WITH f AS ({FEATURES})
SELECT f.*, '10.5555/' || o_orderkey AS doi, 'article' AS type, o_orderstatus AS open_access,
       o_orderpriority AS source, NULL::DOUBLE AS cited_by_percentile_year_OpenAlex,
       NULL::DOUBLE AS citation_normalized_percentile_OpenAlex,
       '[''{WORK}' || o_custkey || ''', ''{WORK}' || (o_orderkey + o_custkey) // 2 || ''']' AS referenced_works_OpenAlex,
       d.source AS title, d.text AS abstract_OpenAlex, NULL::VARCHAR AS topics
FROM f JOIN orders ON id_OpenAlex = o_orderkey JOIN documents d ON o_orderkey = d.doc_id""")
def feature_table(spark, sf_dir):
    path = fresh_path(spark, "features")
    write_table(sorted_features(flat_works(spark, sf_dir)), path, FEATURE_WORK)
    return read_table(spark, path).withColumn("publication_date", F.date_format("publication_date", "yyyy-MM-dd"))


@query(f"WITH features AS ({FEATURES})\n" + "\nUNION ALL\n".join(
    histogram_sql("features", column) for column in DESCRIBED))
def describe_features(spark, sf_dir):
    table = staged(features(flat_works(spark, sf_dir)), "features")
    return histograms(table, DESCRIBED)


def density_sql(column):
    counts = COUNTS.format(keys="publication_year,", select="publication_year,", column=column, table="features")
    return f"""
SELECT '{column}' AS column_name, publication_year, bin::BIGINT AS bin,
       lo + bin * (hi / 200 - lo / 200) AS bin_start, n
FROM ({counts}), (SELECT min({column}) AS lo, max({column}) AS hi FROM features)"""


# Every figure but the histograms, all from the same two scans.
@query(f"WITH features AS ({FEATURES})\n" + "\nUNION ALL\n".join(density_sql(column) for column in DESCRIBED))
def describe_densities(spark, sf_dir):
    made = figures(staged(features(flat_works(spark, sf_dir)), "features"), DESCRIBED)
    return landing.union_sources([made[f"scatter-{column}"].select(F.lit(column).alias("column_name"), "*")
                                  for column in DESCRIBED])


# Works of status P come with a percentile, which stays.
@query("""
WITH w AS (SELECT o_orderkey, o_orderstatus, o_totalprice, year(o_orderdate) AS y, o_orderpriority AS t FROM orders)
SELECT o_orderkey AS id_OpenAlex,
       CASE WHEN o_orderstatus = 'P' THEN 50.0::DOUBLE ELSE percent_rank() OVER (PARTITION BY y ORDER BY o_totalprice) * 100 END
         AS cited_by_percentile_year_OpenAlex,
       percent_rank() OVER (PARTITION BY y, t ORDER BY o_totalprice) AS citation_normalized_percentile_OpenAlex
FROM w""")
def feature_percentiles(spark, sf_dir):
    works = flat_works(spark, sf_dir).select(
        "id_OpenAlex", F.col("source").alias("type"), "citation_count_OpenAlex", "publication_date",
        F.when(F.col("open_access") == "P", 50.0).alias("cited_by_percentile_year_OpenAlex"),
        "citation_normalized_percentile_OpenAlex")
    return fill_percentiles(dated_works(works)).select(
        "id_OpenAlex", "cited_by_percentile_year_OpenAlex", "citation_normalized_percentile_OpenAlex")
