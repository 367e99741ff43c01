"""Searching a snapshot of works by journal and year."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from citeweave.functions.ids import last_segment
from citeweave.functions.text import collapse_whitespace
from citeweave.sources.tables import staged

# Groups are first capped in this many parts, then as a whole.
CAP_PARTS = 64


def filter_journal_year(works: DataFrame, journal_id: str, year: int) -> DataFrame:
    """Works of one year with a location in the journal (id with or without its URL)."""
    wanted = journal_id.rsplit("/", 1)[-1]
    return works.where(
        (F.col("publication_year") == year)
        & F.exists("locations", lambda place: last_segment(place["source"]["id"]) == wanted))


def filter_year_range(works: DataFrame, start: int, end: int,
                      year: str = "publication_year") -> DataFrame:
    """Works of the years from one bound to the other, both included, in either order."""
    return works.where(F.col(year).between(min(start, end), max(start, end)))


def cap_per_group(frame: DataFrame, group: Sequence[str], order: Sequence[str], cap: int) -> DataFrame:
    """The first ``cap`` rows of each group in ``order``.

    A large group is capped in parts before its parts meet in one task, which
    thus sees at most ``CAP_PARTS * cap`` rows of it.  A row that is in the first
    ``cap`` of its group is in the first ``cap`` of its part: the outcome is exact.
    """
    # One column for group and part: rows that already lie together by group would
    # otherwise stay together.
    part = F.struct(*group, F.pmod(F.xxhash64(*order), F.lit(CAP_PARTS)).alias("part"))
    in_part = W.partitionBy("_part").orderBy(*order)
    in_group = W.partitionBy(*group).orderBy(*order)
    return (frame.withColumn("_part", part)
            .withColumn("_nth", F.row_number().over(in_part)).where(F.col("_nth") <= cap)
            .withColumn("_nth", F.row_number().over(in_group)).where(F.col("_nth") <= cap)
            .drop("_part", "_nth"))


def journal_lookup(names: DataFrame, journals: DataFrame) -> DataFrame:
    """``(name, journal_id)``: the journal of each name, equal spelling first.

    Names match regardless of case and spacing; of several journals the smallest
    id counts.  A name without a journal gives no row.  ``journals`` has ``id``
    and ``display_name``.
    """
    def folded(name: Column) -> Column:
        return F.lower(collapse_whitespace(name))

    exact = (journals.groupBy(F.col("display_name").alias("name"))
             .agg(F.min("id").alias("exact_id")))
    alike = (journals.groupBy(folded(F.col("display_name")).alias("_folded"))
             .agg(F.min("id").alias("alike_id")))
    return (names.select("name").where("name IS NOT NULL").distinct()
            .join(exact, "name", "left")
            .withColumn("_folded", folded(F.col("name")))
            .join(alike, "_folded", "left")
            .select("name", last_segment(F.coalesce("exact_id", "alike_id")).alias("journal_id"))
            .where("journal_id IS NOT NULL"))


def journals_not_found(names: DataFrame, journals: DataFrame) -> DataFrame:
    """Ledger ``(name, status)`` of names that :func:`journal_lookup` finds no journal for."""
    found = staged(journal_lookup(names, journals).select("name"), "keys")
    return (names.select("name").where("name IS NOT NULL").distinct().join(found, "name", "left_anti")
            .select("name", F.lit("not_found").alias("status")))


def search_works(works: DataFrame, requests: DataFrame) -> DataFrame:
    """All hits ``(journal_id, publication_year, id_OpenAlex, doi)`` of many searches at once.

    ``requests`` holds ``(journal_id, publication_year)``; ``works`` are nested records.
    """
    places = F.array_distinct(F.filter(
        F.transform("locations", lambda place: last_segment(place["source"]["id"])),
        lambda journal: journal.isNotNull()))
    # Written out for the same reasons as the key tables of lookups.
    asked = staged(requests.select(
        last_segment(F.col("journal_id")).alias("journal_id"),
        F.col("publication_year").cast("int").alias("publication_year")).distinct(), "requests")
    return (works
            .select(F.explode(places).alias("journal_id"), "publication_year",
                    F.col("id").alias("id_OpenAlex"), "doi")
            .join(asked, ["journal_id", "publication_year"], "left_semi"))
