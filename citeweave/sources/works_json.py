"""Works as JSON records: reading, field formatting, canonical names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeweave.functions.abstracts import deinvert_abstract
from citeweave.functions.ids import normalize_doi
from citeweave.schemas import WORK_JSON
from citeweave.sources.tables import staged

# Field names of the API and the column names used downstream.
CANONICAL_NAMES = {
    "id": "id_OpenAlex",
    "cited_by_count": "citation_count_OpenAlex",
    "referenced_count": "reference_count_OpenAlex",
    "referenced_works": "referenced_works_OpenAlex",
    "abstract_inverted_index": "abstract_OpenAlex",
}
DATABASE = "OpenAlex"
DEFAULT_FIELDS = ["id", "doi", "title", "type", "open_access", "topics", "cited_by_count",
                  "referenced_works", "publication_date", "abstract_inverted_index", "source"]


# Name for the text of a line that does not fit.
_CORRUPT = "_corrupt_record"


def source_struct(source: Column) -> Column:
    """Journal record under the names used downstream; null stays null."""
    return F.when(source.isNotNull(), F.struct(
        source["id"].alias("id"),
        source["display_name"].alias("name"),
        source["is_oa"].alias("is_open_access"),
        F.lit(DATABASE).alias("database"),
    ))


FORMATS = {
    "abstract_inverted_index": deinvert_abstract,
    "source": source_struct,
    "doi": normalize_doi,
}


def project_fields(works: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The asked-for fields in the asked-for order; a field the works lack is null."""
    return works.select(*[
        F.col(f) if f in works.columns else F.lit(None).cast("string").alias(f) for f in fields
    ])


def rename_canonical(works: DataFrame) -> DataFrame:
    return works.withColumnsRenamed(CANONICAL_NAMES)


def trim_column_names(frame: DataFrame) -> DataFrame:
    return frame.toDF(*[name.strip() for name in frame.columns])


def flatten_works(works: DataFrame, fields: Sequence[str] = DEFAULT_FIELDS) -> DataFrame:
    """Nested works to one flat row each: chosen fields, formatted and renamed."""
    chosen = project_fields(works, fields)
    formatted = chosen.withColumns({
        f: FORMATS[f](F.col(f)) for f in fields if f in FORMATS and f in works.columns
    })
    return rename_canonical(formatted)


def parse_bodies(bodies: DataFrame, column: str = "body",
                 schema: T.StructType = WORK_JSON) -> DataFrame:
    """Landed response bodies, one work each, as nested works."""
    return bodies.select(F.from_json(column, schema).alias("work")).select("work.*")


def read_works(spark: SparkSession, path: str, schema: T.StructType = WORK_JSON) -> DataFrame:
    """A snapshot of works as JSON lines; see :func:`bad_records` for what does not fit.

    A value of another type is null, a line that is no JSON object gives a row of nulls, which has no id to be found by.
    """
    return spark.read.schema(schema).json(path)


def bad_records(spark: SparkSession, path: str, schema: T.StructType = WORK_JSON) -> DataFrame:
    """Ledger of lines that do not fit: ``file, block, problem, id, record``.

    ``problem`` is ``not_json`` for a line that could not be read at all (a broken one, or one
    that is no object) and ``value`` where some value has another type than the contract;
    ``record`` is the line itself, ``block`` where its part of the file begins.  One pass
    over the snapshot that parses every field; the ledger is a written table, as a later
    choice of columns would leave others unread and unchecked.
    """
    raw = (spark.read.schema(T.StructType([*schema, T.StructField(_CORRUPT, T.StringType())]))
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT).json(path))
    parsed = F.lit(False)
    for name in schema.names:
        parsed = parsed | F.col(f"`{name}`").isNotNull()
    return staged(raw.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.when(parsed, "value").otherwise("not_json").alias("problem"), F.col("id"), F.col(_CORRUPT).alias("record")
    ).where("record IS NOT NULL"), "bad-records")
