"""Identifiers and lists of identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefixes of stored identifiers.
DOI_PREFIX = "https://doi.org/"
WORK_PREFIX = "https://openalex.org/W"


def normalize_doi(doi: Column) -> Column:
    return F.replace(doi, F.lit(DOI_PREFIX), F.lit(""))


def canonical_doi(doi: Column) -> Column:
    """A DOI as it is compared between services: without address or label, in small letters, blank as null."""
    bare = F.trim(F.regexp_replace(F.lower(F.trim(doi)), r"^(https?://(dx\.)?doi\.org/|doi:)", ""))
    return F.when(bare != "", bare)


def work_number(work_id: Column) -> Column:
    """The integer behind a work id; an id of another form raises under ANSI mode."""
    return F.replace(work_id, F.lit(WORK_PREFIX), F.lit("")).cast("bigint")


def try_work_number(work_id: Column) -> Column:
    """Like :func:`work_number`, null instead of an error."""
    return F.replace(work_id, F.lit(WORK_PREFIX), F.lit("")).try_cast("bigint")


def last_segment(url: Column) -> Column:
    return F.element_at(F.split(url, "/"), -1)


def parse_list(literal: Column) -> Column:
    """A printed list of strings (single or double quotes) as an array; null if malformed."""
    return F.from_json(literal, "array<string>")


def list_length(literal: Column) -> Column:
    return F.size(parse_list(literal))
