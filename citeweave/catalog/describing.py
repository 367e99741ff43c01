"""Descriptive summaries and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from citeweave.catalog.registry import query, table
from citeweave.catalog.standins import orders
from citeweave.operators import describe
from citeweave.sources import tables

HISTOGRAM = """
SELECT '{column}' AS column_name, g.bin::BIGINT AS bin, lo + g.bin * (hi / 200 - lo / 200) AS bin_start,
       CASE WHEN g.bin = 199 THEN hi ELSE lo + (g.bin + 1) * (hi / 200 - lo / 200) END AS bin_end,
       coalesce(c.n, 0)::BIGINT AS n, n_rows - n_valued AS n_missing, 0::BIGINT AS n_infinite, n_rows
FROM (SELECT unnest(generate_series(0, 199)) AS bin) g
CROSS JOIN (SELECT min({column}) AS lo, max({column}) AS hi, count(*) AS n_rows, count({column}) AS n_valued FROM {table}) r
LEFT JOIN ({counts}) c ON c.bin = g.bin"""

COUNTS = """
SELECT {keys} bin, count(*) AS n FROM (
  SELECT {keys} CASE WHEN x < lo + b * w THEN b - 1
              WHEN b < 199 AND x >= lo + (b + 1) * w THEN b + 1 ELSE b END AS bin
  FROM (SELECT {select} {column} AS x, lo, hi / 200 - lo / 200 AS w,
               greatest(least(floor({column} / (hi / 200 - lo / 200) - lo / (hi / 200 - lo / 200)), 199), 0) AS b
        FROM {table}, (SELECT min({column}) AS lo, max({column}) AS hi FROM {table})))
GROUP BY {keys} bin"""


def histogram_sql(name: str, column: str) -> str:
    counts = COUNTS.format(keys="", select="", column=column, table=name)
    return HISTOGRAM.format(column=column, table=name, counts=counts)


COLUMNS = ["l_extendedprice", "l_quantity", "l_discount"]


@query("\nUNION ALL\n".join(histogram_sql("lineitem", c) for c in COLUMNS))
def histogram_200(spark, sf_dir):
    return describe.histograms(table(spark, sf_dir, "lineitem"), COLUMNS)


@query(f"""
WITH c AS ({COUNTS.format(keys="publication_year,", select="year(o_orderdate)::INTEGER AS publication_year,",
                          column="o_totalprice", table="orders")})
SELECT publication_year, bin::BIGINT AS bin, lo + bin * (hi / 200 - lo / 200) AS bin_start, n
FROM c, (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)""")
def scatter_year(spark, sf_dir):
    works = orders(spark, sf_dir).select(F.year("o_orderdate").alias("publication_year"), "o_totalprice")
    return describe.year_density(works, "o_totalprice")


@query("SELECT o_totalprice, o_orderkey FROM orders")
def sql_projection(spark, sf_dir):
    return tables.sql_projection(spark, [f"{sf_dir}/orders.parquet"], ["o_totalprice", "o_orderkey"])
