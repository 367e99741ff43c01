"""Trends over the years."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from citeweave.sources.tables import staged


def yearly_trends(works: DataFrame, value: str = "citation_count_OpenAlex", by: Sequence[str] = (),
                  year: str = "publication_year", span: int = 3) -> DataFrame:
    """Works and citations of every year between the first and the last of a group.

    ``(*by, publication_year, n_works, n_valued, total, mean, works_before, works_change,
    works_growth, works_moving, mean_moving, works_upto, works_slope)``.  A year without works
    has 0 works, total 0 and no mean.  Change and growth compare with the year before, growth
    has null after a year without works; moving means reach ``span`` years back, this year
    included, the mean of values over all values of these years; the slope is the least-squares
    change of works a year, null where a group has one year.  Missing and NaN values are not
    valued; works without a year or group are left out.

    Works are reduced to one row per group and year in each task first; everything after
    that has at most as many rows to a group as the calendar has years.
    """
    by = list(by)
    number = F.nanvl(F.col(f"`{value}`").cast("double"), F.lit(None).cast("double"))
    present = " AND ".join(f"`{name}` IS NOT NULL" for name in [*by, year])
    per_year = staged(works.where(present).groupBy(*by, F.col(year).cast("int").alias("publication_year")).agg(
        F.count("*").alias("n_works"), F.count(number).alias("n_valued"), F.sum(number).alias("total")), "years")
    calendar = per_year.groupBy(*by).agg(F.sequence(F.min("publication_year"), F.max("publication_year")).alias("_years"))
    calendar = calendar.where("_years IS NOT NULL").select(*by, F.explode("_years").alias("publication_year"))
    dense = calendar.join(per_year, [*by, "publication_year"], "left").withColumns({
        "n_works": F.coalesce("n_works", F.lit(0)), "n_valued": F.coalesce("n_valued", F.lit(0)),
        "total": F.coalesce("total", F.lit(0.0))})
    group = W.partitionBy(*(by or [F.lit(0)]))
    in_order = group.orderBy("publication_year")
    lately = in_order.rangeBetween(-(span - 1), 0)
    before = F.lag("n_works").over(in_order)
    return dense.select(
        *by, "publication_year", "n_works", "n_valued", "total",
        F.try_divide("total", "n_valued").alias("mean"), before.alias("works_before"),
        (F.col("n_works") - before).alias("works_change"),
        F.try_divide(F.col("n_works") - before, before).alias("works_growth"),
        F.avg("n_works").over(lately).alias("works_moving"),
        F.try_divide(F.sum("total").over(lately), F.sum("n_valued").over(lately)).alias("mean_moving"),
        F.sum("n_works").over(in_order.rowsBetween(W.unboundedPreceding, 0)).alias("works_upto"),
        F.regr_slope(F.col("n_works").cast("double"), F.col("publication_year").cast("double")).over(group).alias("works_slope"))
