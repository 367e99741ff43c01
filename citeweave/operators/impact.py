"""Bibliometrics of journals and works: h-index, citation calendars, velocity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from citeweave.sources.tables import staged

# Steps of the count scale between two powers of two, as a power of two: a step below 2**13 holds
# one count, later ones grow with the count.
STEP_BITS = 12


def _step(count: Column) -> tuple[Column, Column]:
    """Number of the step that holds a positive count, and the smallest count of that step."""
    length = F.length(F.bin(count))
    shift = F.greatest(length - (STEP_BITS + 1), F.lit(0))
    low = F.call_function("shiftright", count, shift)
    number = F.call_function("shiftleft", shift.cast("bigint"), F.lit(STEP_BITS)) + low
    return number, F.call_function("shiftleft", low, shift)


def h_index(works: DataFrame, by: str | Sequence[str] = "journal", count: str = "citation_count_OpenAlex") -> DataFrame:
    """``(*by, n_works, n_cited, h_index)``: the largest h for which h works have at least h citations.

    A count that is missing or below one is no citation; broken counts are cut to whole
    numbers.  Groups without a citation have index 0, works without a group are left out.

    No group is brought together.  Works are counted per citation count, these per step of a
    scale that has some thousand steps between powers of two; sums over the steps from above
    tell which step holds the threshold, and only the counts of that step are added up one
    by one.  There are at most 64 * 2**12 steps to a group, however many works it has.
    """
    by = [by] if isinstance(by, str) else list(by)
    number = F.floor(F.nanvl(F.col(count).cast("double"), F.lit(None).cast("double"))).cast("bigint")
    grouped = works.where(" AND ".join(f"`{name}` IS NOT NULL" for name in by))
    counted = staged(grouped.select(*by, F.greatest(F.coalesce(number, F.lit(0)), F.lit(0)).alias("_count"))
                     .groupBy(*by, "_count").agg(F.count("*").alias("_n")), "counts")
    totals = counted.groupBy(*by).agg(F.sum("_n").alias("n_works"),
                                      F.sum(F.when(F.col("_count") > 0, F.col("_n")).otherwise(0)).alias("n_cited"))
    step, low = _step(F.col("_count"))
    cited = counted.where("_count > 0").withColumns({"_step": step, "_low": low})
    downwards = W.partitionBy(*by).orderBy(F.desc("_step")).rowsBetween(W.unboundedPreceding, 0)
    # The highest step whose smallest count is reached by as many works.
    steps = (cited.groupBy(*by, "_step", "_low").agg(F.sum("_n").alias("_here"))
             .withColumn("_from", F.sum("_here").over(downwards))
             .where("_from >= _low")
             .groupBy(*by).agg(F.max(F.struct("_step", (F.col("_from") - F.col("_here")).alias("_above"))).alias("_at"))
             .select(*by, "_at.*"))
    inside = cited.join(staged(steps, "steps"), [*by, "_step"])
    upto = F.col("_above") + F.sum("_n").over(
        W.partitionBy(*by, "_step").orderBy(F.desc("_count")).rowsBetween(W.unboundedPreceding, 0))
    found = (inside.withColumn("_best", F.greatest("_above", F.least("_count", upto)))
             .groupBy(*by).agg(F.max("_best").alias("h_index")))
    # Where no step is reached, every cited work has more citations than there are cited works.
    return totals.join(found, by, "left").withColumn("h_index", F.coalesce("h_index", "n_cited"))


def dated_citations(works: DataFrame, edges: DataFrame, work_id: str = "id_OpenAlex",
                    year: str = "publication_year") -> DataFrame:
    """``(id, year, n)``, a written table: citations of each cited work per year of the citing work.

    Every pair of works counts once.  Citing works that are not among ``works`` or have no
    year are counted under the year null.  A work with several rows has its earliest year.
    """
    pairs = edges.where("src IS NOT NULL AND dst IS NOT NULL").select("src", "dst").distinct()
    years = staged(works.where(F.col(work_id).isNotNull()).groupBy(F.col(work_id).alias("src"))
                   .agg(F.min(year).cast("int").alias("year")), "years")
    return staged(pairs.join(years, "src", "left").groupBy(F.col("dst").alias("id"), "year")
                  .agg(F.count("*").alias("n")), "dated-citations")


def _dated_works(works: DataFrame, work_id: str, year: str) -> DataFrame:
    return (works.where(F.col(work_id).isNotNull()).groupBy(F.col(work_id).alias("id"))
            .agg(F.min(year).cast("int").alias("publication_year")))


def citation_calendar(works: DataFrame, citations: DataFrame, last_year: int, work_id: str = "id_OpenAlex",
                      year: str = "publication_year") -> DataFrame:
    """Each dated work with every year from its first to ``last_year``: ``(id, year, age, n, n_upto)``.

    The first year is that of publication, or of the first citation if that is earlier (age
    is then negative).  Years without a citation have 0.  Works without a year and works
    later than ``last_year`` have no calendar; citations without a year are in none.
    """
    dated = citations.where(F.col("year") <= last_year)
    first = dated.groupBy("id").agg(F.min("year").alias("first"))
    start = F.least("publication_year", "first")
    days = (_dated_works(works, work_id, year).where("publication_year IS NOT NULL")
            .join(first, "id", "left").where(start <= last_year)
            .select("id", "publication_year", F.explode(F.sequence(start, F.lit(last_year))).alias("year")))
    so_far = W.partitionBy("id").orderBy("year").rowsBetween(W.unboundedPreceding, 0)  # one row for each year
    return (days.join(dated, ["id", "year"], "left")
            .withColumn("n", F.coalesce("n", F.lit(0)))
            .select("id", "year", (F.col("year") - F.col("publication_year")).alias("age"), "n",
                    F.sum("n").over(so_far).alias("n_upto")))


def citation_velocity(works: DataFrame, citations: DataFrame, as_of: int, recent: int = 3,
                      work_id: str = "id_OpenAlex", year: str = "publication_year") -> DataFrame:
    """One row per work with its citations up to ``as_of``, per year of its age.

    ``id, publication_year, n_citations, n_undated, first_cited, peak_year`` (the earliest
    of equal ones), ``n_recent`` (of the last ``recent`` years), ``velocity`` (citations a year
    since publication, that year included) and ``recent_velocity`` (over the last years,
    or over the work's whole life if that is shorter).  A work that is never cited has 0; one
    without a year, or later than ``as_of``, has no velocity.
    """
    per_work = citations.groupBy("id").agg(
        F.sum(F.when(F.col("year") <= as_of, F.col("n"))).alias("n_citations"),
        F.sum(F.when(F.col("year").isNull(), F.col("n"))).alias("n_undated"),
        F.min(F.when(F.col("year") <= as_of, F.col("year"))).alias("first_cited"),
        F.max(F.when(F.col("year") <= as_of, F.struct(F.col("n"), (-F.col("year")).alias("back")))).alias("peak"),
        F.sum(F.when((F.col("year") <= as_of) & (F.col("year") > as_of - recent), F.col("n"))).alias("n_recent"))
    lived = F.when(F.col("publication_year") <= as_of, F.lit(as_of) - F.col("publication_year") + 1)
    none = F.lit(0).cast("bigint")
    return (_dated_works(works, work_id, year).join(per_work, "id", "left")
            .withColumns({name: F.coalesce(name, none) for name in ("n_citations", "n_undated", "n_recent")})
            .select("id", "publication_year", "n_citations", "n_undated", "first_cited", (-F.col("peak.back")).alias("peak_year"),
                    "n_recent", (F.col("n_citations") / lived).alias("velocity"),
                    F.when(lived.isNotNull(), F.col("n_recent") / F.least(lived, F.lit(recent))).alias("recent_velocity")))
