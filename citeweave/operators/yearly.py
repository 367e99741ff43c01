"""Publication dates and citation statistics per year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from citeweave.functions.dates import (
    day_of,
    epoch_nanos,
    in_range,
    written_as_day,
    year_of,
)
from citeweave.sources.tables import staged


def parse_dates(works: DataFrame, column: str = "publication_date") -> DataFrame:
    """Text dates to dates with year and epoch nanoseconds; rows without a valid day are dropped."""
    return (works
            .where(written_as_day(F.col(column)))
            .withColumn(column, day_of(F.col(column)))
            .where(in_range(F.col(column)))
            .withColumns({"publication_year": year_of(F.col(column)),
                          "publication_date_int": epoch_nanos(F.col(column))}))


def _number(value: Column) -> Column:
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def median_per_year(works: DataFrame, value: str = "citation_count_OpenAlex",
                    year: str = "publication_year",
                    name: str = "median_citation_count_year") -> DataFrame:
    """Exact median (mean of the middle two) per year; null and NaN are not counted.

    A year may hold a large part of all rows and nearly as many distinct values, so no
    task gets all of a year.  Equal values are counted together and dealt out by range of
    year and value; the counts of the ranges tell which of them hold the middle ranks,
    and only those are ranked.  The ranges are a written table, so that both passes see
    the same ones.
    """
    counted = (works.where(F.col(year).isNotNull())
               .select(F.col(year).alias("_year"), _number(F.col(value)).alias("_value"))
               .groupBy("_year", "_value").agg(F.count("*").alias("_n")))
    ranged = staged(counted.repartitionByRange("_year", "_value").withColumn("_range", F.spark_partition_id()),
                    "ranges")

    of_year = W.partitionBy("_year")
    valued = F.when(F.col("_value").isNotNull(), F.col("_n")).otherwise(0)
    upto = F.sum("_valued").over(of_year.orderBy("_range").rowsBetween(W.unboundedPreceding, 0))
    total = F.sum("_valued").over(of_year)
    # One row for each year and range.
    middle = (ranged.groupBy("_year", "_range").agg(F.sum(valued).alias("_valued"))
              .select("_year", "_range", (upto - F.col("_valued")).alias("_before"),
                      upto.alias("_upto"), total.alias("_total"))
              .withColumns({"_low": F.greatest(F.floor((F.col("_total") - 1) / 2), F.lit(0)),
                            "_high": F.floor(F.col("_total") / 2)})
              # A year without any value keeps its row: its median is null.
              .where("(_before <= _high AND _upto > _low) OR _total = 0")
              .select("_year", "_range", "_before", "_low", "_high", "_total"))

    inside = ranged.join(middle, ["_year", "_range"]).where("_value IS NOT NULL OR _total = 0")
    in_range = W.partitionBy("_year", "_range").orderBy("_value")
    rank_upto = F.col("_before") + F.sum("_n").over(in_range.rowsBetween(W.unboundedPreceding, 0))
    return (inside.withColumn("_upto", rank_upto)
            .where("(_upto - _n <= _high AND _upto > _low) OR _total = 0")
            .groupBy("_year")
            .agg(((F.min("_value") + F.max("_value")) / 2).alias(name))
            .withColumnRenamed("_year", year))


def above_median(count: Column, median: Column) -> Column:
    """1 where the count is above the median, else 0, also where either is missing."""
    return F.coalesce(_number(count) > _number(median), F.lit(False)).cast("bigint")


def add_yearly_stats(works: DataFrame, value: str = "citation_count_OpenAlex",
                     year: str = "publication_year") -> DataFrame:
    """Each work with its year's median and the above-median flag.

    The medians are a written table of known size: with few years, as of a calendar, Spark
    sends them to the works, which then are not shuffled.
    """
    medians = staged(median_per_year(works, value, year), "medians")
    return (works.join(medians, year, "left")
            .withColumn("higher_than_median_year",
                        above_median(F.col(value), F.col("median_citation_count_year"))))
