"""One enriched record for each work that several services describe.

Records of different services belong together if they share an identifier, directly or by way
of other records: a DOI, a work id, a paper id.  Identity is found on distinct identifiers, not on
records, so an identifier that many records carry counts once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeweave.functions.ids import canonical_doi
from citeweave.operators.graph import components
from citeweave.schemas import MERGED_WORK, SERVICE_FIELDS
from citeweave.sources.tables import staged

# Identifiers by which records are matched, and the services in the order of their say.
KEYS = ["doi", "id_OpenAlex", "s2_paper_id"]
PRIORITY = ["openalex", "semantic_scholar", "crossref"]


def aligned(frame: DataFrame, service: str, names: Mapping[str, str] | None = None,
            contract: T.StructType = MERGED_WORK) -> DataFrame:
    """A service's rows under the common names and types, with ``service``; what it lacks is null.

    ``names`` maps common names to the service's own (default: those of :data:`SERVICE_FIELDS`).
    A value that does not fit its type becomes null.  DOIs get their compared form, blank
    identifiers are missing.
    """
    names = SERVICE_FIELDS[service] if names is None else names

    def cell(field: T.StructField) -> Column:
        own = names.get(field.name)
        if own is None or own not in frame.columns:
            return F.lit(None).cast(field.dataType)
        value = F.col(f"`{own}`")
        nested = isinstance(frame.schema[own].dataType, (T.ArrayType, T.StructType, T.MapType))
        value = value.cast(field.dataType) if nested else value.try_cast(field.dataType)
        if field.name == "doi":
            return canonical_doi(value)
        return F.when(F.trim(value) != "", F.trim(value)) if field.name in KEYS else value

    return frame.select(F.lit(service).alias("service"), *[cell(field).alias(field.name) for field in contract])


def _spelled(keys: Sequence[str]) -> Column:
    """The identifiers a record has, each with its kind."""
    return F.array_compact(F.array(*[F.concat(F.lit(f"{key}:"), F.col(key)) for key in keys]))


def _meetings(records: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Links ``a, b`` between records' smallest identifiers that meet under some identifier.

    Each is linked with the smallest one met there.  An identifier that only one of them comes with
    links nothing, so what goes on does not grow with identifiers that records have for themselves.
    """
    own = _spelled(keys)
    pairs = records.select(F.array_min(own).alias("a"), F.explode(own).alias("b"))
    other = F.when(F.col("a") != F.col("b"), F.col("a"))
    met = staged(pairs.groupBy("b").agg(F.min(other).alias("least"), F.max(other).alias("most"),
                                        F.max(F.col("a") == F.col("b")).alias("is_least")).where("least IS NOT NULL"), "met")
    themselves = met.where("is_least").select(F.col("least").alias("a"), "b")
    several = met.where("least <> most").select("b", "least")
    return pairs.where("a <> b").join(several, "b").where("a <> least").select(
        F.col("least").alias("a"), F.col("a").alias("b")).union(themselves)


def identities(records: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """``key, entity``, a written table: records' smallest identifiers that are connected with a smaller one.

    ``entity`` is the smallest one of all; a smallest identifier that is not listed is its own entity.
    """
    return staged(components(_meetings(records, keys)).where("node <> label").select(
        F.col("node").alias("key"), F.col("label").alias("entity")), "identities")


def with_entity(records: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Records that have an identifier, with ``entity``; see :func:`unidentified` for the others.

    The identities are a written table with one row for each key, so a key of very many
    records is split between tasks.
    """
    keyed = records.withColumn("key", F.array_min(_spelled(keys))).where("key IS NOT NULL")
    led = keyed.join(identities(records, keys), "key", "left").withColumn("entity", F.coalesce("entity", "key"))
    return led.select(*[f"`{name}`" for name in records.columns], "entity")


def unidentified(records: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Records without any identifier: nothing can be matched with them."""
    return records.where(F.array_min(_spelled(keys)).isNull())


def _rank(priority: Sequence[str]) -> Column:
    """Place of the service, from 1; services that are not named come last."""
    place = F.array_position(F.array(*map(F.lit, priority)), F.col("service"))
    return F.when(place > 0, place).otherwise(len(priority) + 1).cast("int")


def _text(field: T.StructField) -> Column:
    nested = isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType))
    return F.to_json(F.col(field.name)) if nested else F.col(field.name).cast("string")


def merge_records(matched: DataFrame, priority: Sequence[str] = PRIORITY,
                  contract: T.StructType = MERGED_WORK) -> DataFrame:
    """One row per entity: each field from the service with most say that has a value.

    Of several values of one service the smallest as text counts.  ``n_records`` and
    ``services`` tell what went into it.  Every part of the aggregate keeps one value for
    each field, so an entity of very many records is reduced in each task first.
    """
    rank = _rank(priority)

    def chosen(field: T.StructField) -> Column:
        cell = F.col(field.name)
        best = F.min(F.when(cell.isNotNull(), F.struct(rank.alias("rank"), _text(field).alias("text"), cell.alias("value"))))
        return best["value"].alias(field.name)

    return matched.groupBy("entity").agg(
        *[chosen(field) for field in contract],
        F.count("*").alias("n_records"), F.array_sort(F.collect_set("service")).alias("services"))


def conflicts(matched: DataFrame, priority: Sequence[str] = PRIORITY,
              contract: T.StructType = MERGED_WORK) -> DataFrame:
    """Ledger of fields for which an entity has several values: one row per value.

    ``entity, field, value, service`` (the one with most say that gives the value),
    ``n_records, chosen`` (whether :func:`merge_records` took it).  Identifiers count as
    fields: two DOIs under one paper id are listed.
    """
    # First whether a field of an entity has several values: most have one, and only the others go on by value.
    cells = {field.name: f"_{i}" for i, field in enumerate(contract)}
    matched = staged(matched.select("entity", "service", _rank(priority).alias("rank"),
                                    *[_text(field).alias(cells[field.name]) for field in contract]), "matched")

    def several(name: str, cell: str) -> Column:
        best = F.min(F.when(F.col(cell).isNotNull(), F.struct("rank", F.col(cell).alias("value"))))
        return F.when(F.min(cell) != F.max(cell), F.struct(F.lit(name).alias("field"), best["value"].alias("taken")))

    contested = staged(matched.groupBy("entity").agg(F.array_compact(F.array(*[several(*cell) for cell in cells.items()]))
                                                     .alias("fields")).where(F.size("fields") > 0), "contested")
    value = F.coalesce(*[F.when(F.col("contest.field") == name, F.col(cell)) for name, cell in cells.items()])
    return (matched.join(contested, "entity").select("*", F.explode("fields").alias("contest"))
            .select("entity", "contest.field", value.alias("value"), "contest.taken", "rank", "service").where("value IS NOT NULL")
            .groupBy("entity", "field", "value")
            .agg(F.min(F.struct("rank", "service"))["service"].alias("service"), F.count("*").alias("n_records"),
                 F.min("taken").alias("taken"))
            .select("entity", "field", "value", "service", "n_records", (F.col("value") == F.col("taken")).alias("chosen")))
