"""Dates and yearly statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from citeweave.catalog.registry import query
from citeweave.catalog.standins import day_text, orders
from citeweave.functions.dates import epoch_nanos
from citeweave.operators import yearly

MEDIANS = """
SELECT year(o_orderdate)::BIGINT AS publication_year, median(o_totalprice) AS median_citation_count_year
FROM orders GROUP BY 1"""


def dated_orders(spark, sf_dir):
    return yearly.parse_dates(orders(spark, sf_dir).select(
        "o_orderkey",
        F.col("o_totalprice").alias("citation_count_OpenAlex"),
        day_text().alias("publication_date"),
    ))


@query(MEDIANS)
def median_per_year(spark, sf_dir):
    return yearly.median_per_year(dated_orders(spark, sf_dir))


@query(f"""
WITH m AS ({MEDIANS})
SELECT o_orderkey, o_totalprice AS citation_count_OpenAlex, m.publication_year, m.median_citation_count_year
FROM orders LEFT JOIN m ON year(o_orderdate) = m.publication_year""")
def yearly_stats_join(spark, sf_dir):
    return yearly.add_yearly_stats(dated_orders(spark, sf_dir)).select(
        "o_orderkey", "citation_count_OpenAlex", "publication_year", "median_citation_count_year")


@query(f"""
WITH m AS ({MEDIANS})
SELECT o_orderkey, m.publication_year,
       coalesce(o_totalprice > m.median_citation_count_year, false)::BIGINT AS higher_than_median_year
FROM orders LEFT JOIN m ON year(o_orderdate) = m.publication_year""")
def above_median_flag(spark, sf_dir):
    return yearly.add_yearly_stats(dated_orders(spark, sf_dir)).select(
        "o_orderkey", "publication_year", "higher_than_median_year")


# Orders of status P carry a time of day, which is not a valid date.
@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS publication_date,
       year(o_orderdate)::BIGINT AS publication_year,
       date_diff('day', DATE '1970-01-01', o_orderdate::DATE)::BIGINT * 86400000000000 AS publication_date_int
FROM orders WHERE o_orderstatus IN ('F', 'O')""")
def parse_dates(spark, sf_dir):
    written = (F.when(F.col("o_orderstatus") == "F", day_text())
               .when(F.col("o_orderstatus") == "O", day_text(form="yyyy-M-d"))
               .otherwise(day_text(form="yyyy-MM-dd HH:mm:ss")))
    works = orders(spark, sf_dir).select("o_orderkey", written.alias("publication_date"))
    return (yearly.parse_dates(works)
            .withColumn("publication_date", F.date_format("publication_date", "yyyy-MM-dd")))


@query("""
SELECT o_orderkey,
       date_diff('day', DATE '1970-01-01', o_orderdate::DATE)::BIGINT * 86400000000000 AS publication_date_int
FROM orders""")
def date_epoch_ns(spark, sf_dir):
    return orders(spark, sf_dir).select(
        "o_orderkey", epoch_nanos(F.to_date("o_orderdate")).alias("publication_date_int"))
