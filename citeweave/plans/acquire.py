"""Stage 1: find works of journals and years in a snapshot, and what they reference."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.operators.graph import (
    cited_by,
    citation_edges,
    expand_references,
    likely_among,
    lookup,
    novel_candidates,
    reference_frontier,
    unreachable,
)
from citeweave.operators.search import cap_per_group, journal_lookup, search_works
from citeweave.sources.tables import staged
from citeweave.sources.works_json import CANONICAL_NAMES, DEFAULT_FIELDS, flatten_works


class Acquired(NamedTuple):
    works: DataFrame
    references: DataFrame
    # New hits of each search that a cap has left for a later run: journal_id, publication_year, n.
    left_out: DataFrame


def requests_for(names: DataFrame, journals: DataFrame, start: int, end: int) -> DataFrame:
    """Search requests: every journal found by name, with every year of the range."""
    years = F.sequence(F.lit(min(start, end)), F.lit(max(start, end)))
    return journal_lookup(names, journals).select(
        "journal_id", F.explode(years).alias("publication_year"))


def acquire(snapshot: DataFrame, requests: DataFrame, held: DataFrame,
            held_references: DataFrame, cap: int | None = None,
            fields: Sequence[str] = DEFAULT_FIELDS) -> Acquired:
    """Flat rows of newly found works and of the works they reference.

    ``snapshot`` holds nested works; ``held`` and ``held_references`` hold
    ``(doi, id_OpenAlex)`` of what was landed before.  With ``cap`` each search gives at
    most so many works that are not held yet, smallest id first; a repeated run goes
    on with the rest.
    """
    search = ["journal_id", "publication_year"]
    # Written out: all results start from these ids, and the search is not run twice.
    novel = staged(novel_candidates(search_works(snapshot, requests), held), "novel")
    wanted = novel if cap is None else staged(cap_per_group(novel, search, ["id_OpenAlex"], cap), "wanted")
    counts = novel.groupBy(*search).agg(F.count("*").alias("n"))
    left_out = (counts.withColumn("n", F.col("n") - F.lit(cap)) if cap is not None else counts.limit(0)).where("n > 0")
    found = lookup(snapshot, wanted, key="id", ids_column="id_OpenAlex")
    frontier = reference_frontier(citation_edges(found, "id", "referenced_works"), held_references)
    referenced = lookup(snapshot, frontier, key="id")
    return Acquired(flatten_works(found, fields), flatten_works(referenced, fields), left_out)


class Expanded(NamedTuple):
    works: DataFrame
    # References that were met and are in neither the snapshot nor the seed: id, status.
    not_found: DataFrame


def expand(snapshot: DataFrame, seed: DataFrame, hops: int = 1,
           fields: Sequence[str] = DEFAULT_FIELDS) -> DataFrame:
    """Flat rows of the works reached from ``seed`` in up to ``hops`` steps, with the step."""
    return expand_with_ledger(snapshot, seed, hops, fields).works


def expand_with_ledger(snapshot: DataFrame, seed: DataFrame, hops: int = 1, fields: Sequence[str] = DEFAULT_FIELDS,
                       landed: DataFrame | None = None, citing: bool = False) -> Expanded:
    """Works reached along references, or with ``citing`` along citations, and what was not found.

    Steps run on ids and reference lists, which are written to a table of their own;
    full records are read once more at the end.  ``landed`` has lists (``id,
    referenced_works``) of works that the snapshot may lack: they are followed as well,
    though only works of the snapshot can be reached.  All works that cite a reached one are
    in the lists, so nothing can be missing where citations are followed.
    """
    # The slim part is read from the snapshot once and serves all steps.
    held = staged(snapshot.select("id", "referenced_works"), "lists")
    lists = held if landed is None else staged(held.unionByName(landed), "lists")
    if citing:
        lists = cited_by(citation_edges(lists, "id", "referenced_works"))
    layers = staged(expand_references(seed, lists, held, hops, available_id="id"), "reached")
    missing = unreachable(lists, layers, held, hops)
    reached = layers.where("hop > 0")
    # Flat before the shuffle: an abstract is several times smaller as a text than as an inverted index.
    flat = flatten_works(likely_among(snapshot, "id", reached, "id"), fields if "id" in fields else [*fields, "id"])
    steps = reached.select(F.col("id").alias("_reached"), "hop")
    records = flat.join(steps, F.col("id_OpenAlex") == F.col("_reached"))
    return Expanded(records.select(*[CANONICAL_NAMES.get(field, field) for field in fields], "hop"),
                    missing.limit(0) if citing else missing)
