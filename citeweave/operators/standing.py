"""How a work stands among those of its year: percentiles and normalised counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from citeweave.sources.tables import staged


def _finite(column: str) -> Column:
    value = F.col(f"`{column}`").cast("double")
    return F.when(F.abs(value) < float("inf"), value)


def _present(by: Sequence[str]) -> str:
    return " AND ".join(f"`{name}` IS NOT NULL" for name in by)


def percentiles(works: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """``(*by, _value, _share)``, a written table: for each value of a group the share of the group's
    other values that are smaller.

    Equal values are counted together and dealt out by range, so that a group is spread over
    tasks by its values.  What lies in the ranges before is added from one number per range.
    """
    counted = (works.where(_present(by)).select(*by, _finite(value).alias("_value")).where("_value IS NOT NULL")
               .groupBy(*by, "_value").agg(F.count("*").alias("_n")))
    ranged = staged(counted.repartitionByRange(*by, "_value").withColumn("_range", F.spark_partition_id()), "ranges")
    of_group = W.partitionBy(*by)
    before = F.sum("_here").over(of_group.orderBy("_range").rowsBetween(W.unboundedPreceding, 0)) - F.col("_here")
    ranges = staged(ranged.groupBy(*by, "_range").agg(F.sum("_n").alias("_here")).select(
        *by, "_range", before.alias("_before"), F.sum("_here").over(of_group).alias("_total")), "range-counts")
    inside = W.partitionBy(*by, "_range").orderBy("_value").rowsBetween(W.unboundedPreceding, 0)
    below = F.col("_before") + F.sum("_n").over(inside) - F.col("_n")
    share = F.when(F.col("_total") > 1, below / (F.col("_total") - 1)).otherwise(0.0)
    return staged(ranged.join(ranges, [*by, "_range"]).select(*by, "_value", share.alias("_share")), "percentiles")


def add_percentile(works: DataFrame, name: str, value: str = "citation_count_OpenAlex",
                   by: Sequence[str] = ("publication_year",), scale: float = 1.0) -> DataFrame:
    """With ``name``: ``scale`` times the percent rank of the value in its group, 0 for the smallest.

    Equal values have the rank of the first of them; the only value of a group has 0.
    Missing and infinite values are not ranked and have null, and so have works without a group.
    """
    shares = percentiles(works, value, by)
    return (works.withColumn("_value", _finite(value)).join(shares, [*by, "_value"], "left")
            .withColumn(name, F.col("_share") * scale).select(*[f"`{c}`" for c in works.columns if c != name], name))


def moments(works: DataFrame, value: str = "citation_count_OpenAlex",
            by: Sequence[str] = ("publication_year",)) -> DataFrame:
    """``(*by, n, anchor, shift, mean, spread)``, a written table: count, mean and population deviation.

    Values are taken from the smallest of their group, so that neither the mean nor the
    deviation loses digits where all values lie far from 0: ``mean = anchor + shift``.
    Parts of a group are reduced to count, mean and sum of squares in each task and combined.
    """
    numbers = works.where(_present(by)).select(*by, _finite(value).alias("_value")).where("_value IS NOT NULL")
    anchors = staged(numbers.groupBy(*by).agg(F.min("_value").alias("anchor")), "anchors")
    moved = numbers.join(anchors, list(by)).withColumn("_moved", F.col("_value") - F.col("anchor"))
    return staged(moved.groupBy(*by, "anchor").agg(
        F.count("*").alias("n"), F.avg("_moved").alias("shift"), F.stddev_pop("_moved").alias("spread"))
        .withColumn("mean", F.col("anchor") + F.col("shift")), "moments")


def add_normalised(works: DataFrame, value: str = "citation_count_OpenAlex",
                   by: Sequence[str] = ("publication_year",)) -> DataFrame:
    """With ``<value>_mean, <value>_std, <value>_z, <value>_ratio`` of the group.

    The z-score is 0 where all values of a group are equal; the ratio to the mean is 1 for 0 of
    a mean 0 and null for other values of a mean 0.  Missing and infinite values have neither.
    """
    own = moments(works, value, by).select(*by, *[F.col(c).alias(f"_{c}") for c in ("anchor", "shift", "mean", "spread")])
    number = _finite(value)
    z = F.when(F.col("_spread") > 0, (number - F.col("_anchor") - F.col("_shift")) / F.col("_spread")).when(
        number.isNotNull() & F.col("_spread").isNotNull(), F.lit(0.0))
    ratio = F.when(F.col("_mean") != 0, number / F.col("_mean")).when(number == 0, F.lit(1.0))
    return works.join(own, list(by), "left").select(
        *[f"`{c}`" for c in works.columns], F.col("_mean").alias(f"{value}_mean"), F.col("_spread").alias(f"{value}_std"),
        z.alias(f"{value}_z"), F.when(F.col("_mean").isNotNull(), ratio).alias(f"{value}_ratio"))
