"""The given tables read as scholarly works.

An order is a work, its price the citation count, its priority the journal; the
document of the same number gives title and abstract; an order references the
order numbered like its customer and the one midway between the two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.catalog.registry import table
from citeweave.functions.abstracts import invert_text

WORK = "https://openalex.org/W"
JOURNAL = "https://openalex.org/S"
DOI = "https://doi.org/10.5555/"


def work_id(number: str | Column) -> Column:
    return F.concat(F.lit(WORK), (F.col(number) if isinstance(number, str) else number).cast("string"))


def doi(number: str, prefix: str = DOI) -> Column:
    return F.concat(F.lit(prefix), F.col(number).cast("string"))


def midway() -> Column:
    return F.floor((F.col("o_orderkey") + F.col("o_custkey")) / 2)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


def day_text(column: str = "o_orderdate", form: str = "yyyy-MM-dd") -> Column:
    return F.date_format(column, form)


def with_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("source").alias("doc_source"))
    # The partitioning a shuffled join needs anyway; it also spreads the texts if Spark broadcasts.
    works = orders(spark, sf_dir).repartition("o_orderkey")
    return works.join(documents, F.col("o_orderkey") == F.col("doc_id"), "left")


def flat_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Works as rows of the integrated table."""
    return with_documents(spark, sf_dir).select(
        work_id("o_orderkey").alias("id_OpenAlex"),
        doi("o_orderkey", "10.5555/").alias("doi"),
        F.lit("article").alias("type"),
        F.col("o_orderstatus").alias("open_access"),
        F.col("o_orderpriority").alias("source"),
        F.col("o_totalprice").alias("citation_count_OpenAlex"),
        F.lit(None).cast("double").alias("cited_by_percentile_year_OpenAlex"),
        F.lit(None).cast("double").alias("citation_normalized_percentile_OpenAlex"),
        F.concat(F.lit("['"), work_id("o_custkey"), F.lit("', '"), work_id(midway()),
                 F.lit("']")).alias("referenced_works_OpenAlex"),
        F.col("doc_source").alias("title"),
        F.col("text").alias("abstract_OpenAlex"),
        F.lit(None).cast("string").alias("topics"),
        day_text().alias("publication_date"),
    )


def nested_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Works as the records of a snapshot."""
    journal = F.struct(
        F.concat(F.lit(JOURNAL), F.substring("o_orderpriority", 1, 1)).alias("id"),
        F.col("o_orderpriority").alias("display_name"),
        (F.col("o_orderstatus") == "O").alias("is_oa"),
    )
    return with_documents(spark, sf_dir).select(
        work_id("o_orderkey").alias("id"),
        doi("o_orderkey").alias("doi"),
        F.col("doc_source").alias("title"),
        F.lit("article").alias("type"),
        F.col("o_totalprice").cast("bigint").alias("cited_by_count"),
        F.array(work_id("o_custkey"), work_id(midway())).alias("referenced_works"),
        day_text().alias("publication_date"),
        F.year("o_orderdate").alias("publication_year"),
        invert_text(F.col("text")).alias("abstract_inverted_index"),
        journal.alias("source"),
        F.array(F.struct(F.struct(journal["id"].alias("id")).alias("source"))).alias("locations"),
    )
