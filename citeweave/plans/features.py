"""Stage 3: integrated works to the feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.functions.embedding import Encoder, embed_text, embedding_wide
from citeweave.functions.ids import work_number
from citeweave.functions.text import clean_text, title_abstract
from citeweave.operators.rows import observed, write_counts
from citeweave.operators.standing import add_percentile
from citeweave.operators.yearly import add_yearly_stats, parse_dates
from citeweave.schemas import FEATURE_WORK
from citeweave.sources.tables import read_table, sort_by_id, write_table
from citeweave.sources.works_json import trim_column_names

# Rows of the feature table that one task encodes and writes.
ROWS_PER_TASK = 50_000


def add_title_abstract(works: DataFrame, title: str = "title",
                       abstract: str = "abstract_OpenAlex") -> DataFrame:
    """Cleaned title and abstract; works with neither are dropped."""
    return (works
            .withColumn("title_abstract", title_abstract(F.col(title), F.col(abstract)))
            .where("title_abstract IS NOT NULL")
            .withColumn("title_abstract", clean_text(F.col("title_abstract"))))


def dated_works(works: DataFrame) -> DataFrame:
    """Integer id, dates and yearly citation statistics."""
    dated = parse_dates(trim_column_names(works).withColumn(
        "id_OpenAlex", work_number(F.col("id_OpenAlex"))))
    return add_yearly_stats(dated)


def features(works: DataFrame) -> DataFrame:
    """Integer id, dates, yearly citation statistics and cleaned text."""
    return add_title_abstract(dated_works(works))


def sorted_features(works: DataFrame, within: str | None = None, partitions: int | None = None,
                    percentiles: bool = False) -> DataFrame:
    """:func:`features` sorted by id.

    Rows are dealt out before their texts are joined and cleaned: range partitioning
    samples its input, so what stands below it is evaluated twice, and the cleaned text
    would travel beside title and abstract.  Works without text are left out below it.
    """
    has_text = title_abstract(F.col("title"), F.col("abstract_OpenAlex")).isNotNull()
    dated = dated_works(works)
    # All dated works are ranked, those without text among them.
    dated = fill_percentiles(dated) if percentiles else dated
    ordered = sort_by_id(dated.where(has_text), "id_OpenAlex", within, partitions)
    return add_title_abstract(ordered)


def tasks_for(works: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> int:
    """Number of tasks for a table, from its rows: Parquet files tell their number without being read."""
    return max(1, -(-works.count() // rows_per_task))


def embedded(works: DataFrame, encoder: type[Encoder], *args, text: str = "title_abstract") -> DataFrame:
    """With the embedding of ``text``; the encoder runs in the tasks that hold the rows."""
    return works.withColumn("embedding", embed_text(F.col(text), encoder, *args))


def fill_percentiles(works: DataFrame) -> DataFrame:
    """The contract's percentile columns, computed where the service gave none.

    ``cited_by_percentile_year_OpenAlex`` is 100 times the percent rank of the count among the
    works of the year, ``citation_normalized_percentile_OpenAlex`` the percent rank among those
    of the year and type.
    """
    filled = works
    for name, by, scale in (("cited_by_percentile_year_OpenAlex", ["publication_year"], 100.0),
                            ("citation_normalized_percentile_OpenAlex", ["publication_year", "type"], 1.0)):
        filled = add_percentile(filled, "_rank", by=by, scale=scale)
        filled = filled.withColumn(name, F.coalesce(F.col(name).cast("double"), "_rank")).drop("_rank")
    return filled


def feature_journal(spark: SparkSession, integrated_root: str, journal: str, out_root: str,
                    encoder: type[Encoder], *args, by_year: bool = False, wide: bool = False,
                    percentiles: bool = False) -> None:
    """Write a journal's feature table, with ``<journal>/counts`` of the rows written beside it."""
    integrated = read_table(spark, f"{integrated_root}/{journal}")
    partition_by = "publication_year" if by_year else None
    # No fewer tasks than the session asks for: an encoder takes long for little data.
    tasks = max(tasks_for(integrated), int(spark.conf.get("spark.sql.shuffle.partitions")))
    works = sorted_features(integrated, partition_by, tasks, percentiles)
    done = embedded(works, encoder, *args)
    if wide:
        done = embedding_wide(done)
    done, written = observed(done, n_written=F.count("*"))
    write_table(done, f"{out_root}/{journal}/parquet", FEATURE_WORK, partition_by)
    write_counts(done, f"{out_root}/{journal}/counts", n_integrated=integrated.count(), **written.get)
