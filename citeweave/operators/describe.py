"""The data behind the descriptive figures: histograms and year-by-value densities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.sources.tables import staged

# Fixed value: bins of a histogram.
BINS = 200


def _widened(lo: Column, hi: Column) -> tuple[Column, Column]:
    """The range binned: 0 to 1 without data, half a unit each way around a single value."""
    return (F.when(lo.isNull(), 0.0).when(lo == hi, lo - 0.5).otherwise(lo),
            F.when(hi.isNull(), 1.0).when(lo == hi, hi + 0.5).otherwise(hi))


def _numbers(columns: Sequence[str]) -> list[Column]:
    """The finite values of each column."""
    cells = [F.col(f"`{c}`").cast("double") for c in columns]
    return [F.when(F.abs(cell) < float("inf"), cell) for cell in cells]


def _infinite(column: str) -> Column:
    return F.count_if(F.abs(F.col(f"`{column}`").cast("double")) == float("inf"))


def _ranges(frame: DataFrame, columns: Sequence[str]) -> Column:
    """Row count and value range of each column as a scalar subquery: one row, one scan."""
    return range_row(frame, columns).scalar()


def range_row(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    ranges = []
    for column, number in zip(columns, _numbers(columns), strict=True):
        lo, hi = _widened(F.min(number), F.max(number))
        infinite = _infinite(column)
        missing = F.count("*") - F.count(number) - infinite
        ranges.append(F.struct(lo.alias("lo"), hi.alias("hi"), missing.alias("n_missing"),
                               infinite.alias("n_infinite")))
    return frame.agg(F.struct(F.count("*").alias("n_rows"), F.array(*ranges).alias("of")).alias("ranges"))


def _with_bin(valued: DataFrame, bins: int) -> DataFrame:
    """Adds ``bin``, from 0, to rows of ``value``, ``lo`` and ``hi``.

    Each bin is closed below and open above, the last closed on both ends.
    """
    value, lo, width, guess = F.col("value"), F.col("lo"), F.col("width"), F.col("guess")
    # Division may land one bin off at an edge; the edges decide.
    placed = (F.when(value < lo + guess * width, guess - 1)
              .when((guess < bins - 1) & (value >= lo + (guess + 1) * width), guess + 1)
              .otherwise(guess))
    return (valued.where("value IS NOT NULL")
            .withColumn("width", F.col("hi") / bins - lo / bins)  # the range itself may be too wide for a double
            .withColumn("guess", F.greatest(F.least(F.floor(
                F.try_divide(value, width) - F.try_divide(lo, width)), F.lit(bins - 1)), F.lit(0)))
            .withColumn("bin", placed))


def histograms(frame: DataFrame, columns: Sequence[str], bins: int = BINS) -> DataFrame:
    """Equal-width histogram of each column, empty bins included.

    Rows ``(column_name, bin, bin_start, bin_end, n, n_missing, n_infinite, n_rows)``.
    Finite values are binned; ``n_missing`` counts nulls and NaN, ``n_infinite`` the infinite
    ones, so that they and all ``n`` of a column add up to ``n_rows``, the rows of the table.
    Two scans of these columns serve all of them, and no more than ``bins`` rows for each
    leave the tasks.
    """
    ranges = _ranges(frame, columns)
    return _histogram_rows(binned_counts(frame, columns, ranges, bins), columns, ranges, bins)


def binned_counts(frame: DataFrame, columns: Sequence[str], ranges: Column, bins: int,
                  by: Sequence[str] = ()) -> DataFrame:
    """``(*by, place, bin, n)``: how many values of each column lie in each bin; one scan for all columns."""
    cells = F.array(*[
        F.struct(F.lit(i).alias("place"), number.alias("value"))
        for i, number in enumerate(_numbers(columns))])
    placed = frame.select(*by, F.explode(cells).alias("cell")).select(
        *by, "cell.*", F.get(ranges["of"], F.col("cell.place")).alias("range")).select(
        *by, "place", "value", "range.*")
    return _with_bin(placed, bins).groupBy(*by, "place", "bin").agg(F.count("*").alias("n"))


def _histogram_rows(counts: DataFrame, columns: Sequence[str], ranges: Column, bins: int) -> DataFrame:
    """All bins of all columns, empty ones included."""
    outlines = F.array(*[
        F.struct(F.lit(i).alias("place"), F.lit(c).alias("column_name"),
                 F.get(ranges["of"], F.lit(i)).alias("range"), ranges["n_rows"].alias("n_rows"))
        for i, c in enumerate(columns)])
    grid = (counts.sparkSession.range(bins).withColumnRenamed("id", "bin")
            .select("bin", F.explode(outlines).alias("outline")).select("bin", "outline.*")
            .select("bin", "place", "column_name", "range.*", "n_rows"))
    width = F.col("hi") / bins - F.col("lo") / bins
    # One row for each bin and column on either side: safe to broadcast.
    return grid.join(F.broadcast(counts), ["place", "bin"], "left").select(
        "column_name", "bin",
        (F.col("lo") + F.col("bin") * width).alias("bin_start"),
        F.when(F.col("bin") == bins - 1, F.col("hi"))
        .otherwise(F.col("lo") + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
        "n_missing", "n_infinite", "n_rows")


def figures(frame: DataFrame, columns: Sequence[str], year: str = "publication_year",
            bins: int = BINS) -> dict[str, DataFrame]:
    """``histograms`` and one ``scatter-<column>`` for each column, from two scans in all.

    The first takes all ranges, the second counts per year and bin; both are written tables of
    a few rows per column, year and bin, from which every figure is made.
    """
    ranges = staged(range_row(frame, columns), "ranges").scalar()
    counts = staged(binned_counts(frame.withColumnRenamed(year, "publication_year"), columns, ranges, bins,
                                  ["publication_year"]), "bins")
    summed = counts.groupBy("place", "bin").agg(F.sum("n").alias("n"))
    made = {"histograms": _histogram_rows(summed, columns, ranges, bins)}
    for place, column in enumerate(columns):
        one = F.get(ranges["of"], F.lit(place))
        start = one["lo"] + F.col("bin") * (one["hi"] / bins - one["lo"] / bins)
        made[f"scatter-{column}"] = counts.where((F.col("place") == place) & F.col("publication_year").isNotNull()).select(
            "publication_year", "bin", start.alias("bin_start"), "n")
    return made


def year_density(frame: DataFrame, column: str, year: str = "publication_year",
                 bins: int = BINS) -> DataFrame:
    """Points of the year-by-value scatter counted per year and value bin.

    Rows ``(publication_year, bin, bin_start, n)``: all points, in an output
    bounded by years and bins.
    """
    ranges = _ranges(frame, [column])
    points = frame.where(F.col(year).isNotNull()).select(
        F.col(year).alias("publication_year"), _numbers([column])[0].alias("value"),
        F.get(ranges["of"], F.lit(0)).alias("range")).select("publication_year", "value", "range.*")
    return (_with_bin(points, bins)
            .groupBy("publication_year", "bin", (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_start"))
            .agg(F.count("*").alias("n")))


def year_points(frame: DataFrame, column: str, year: str = "publication_year") -> DataFrame:
    """The points themselves: ``(publication_year, value)``."""
    return frame.select(F.col(year).alias("publication_year"), F.col(f"`{column}`"))
