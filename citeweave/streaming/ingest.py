"""Take in newly landed files once, leaving out works already held."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeweave.operators.rows import drop_null_key, keep_first
from citeweave.schemas import RAW_WORK
from citeweave.sources.landing import (
    BATCH,
    CSV_READ,
    ORIGIN,
    SUBFOLDERS,
    bad_cells,
    cells_and_batch,
    landed_header,
    type_cells,
)


def held_keys(spark: SparkSession, target: str, key: str) -> DataFrame | None:
    try:
        return spark.read.parquet(target).select(key).where(F.col(key).isNotNull())
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def append_new(batch: DataFrame, target: str, key: str = "id_OpenAlex") -> None:
    """Append the first row of each key the target does not hold.

    The check against the target makes a repeated batch harmless, so a stream
    that runs a batch again after a failure adds nothing twice.
    """
    # First one row for each key, so that a frequent key does not load the join.
    fresh = keep_first(drop_null_key(batch, key), key, ORIGIN).drop(*ORIGIN)
    held = held_keys(batch.sparkSession, target, key)
    if held is not None:
        fresh = fresh.join(held, key, "left_anti")
    fresh.write.mode("append").parquet(target)


def _ingest_folder(spark: SparkSession, folder: str, rank: int, columns: list[str], target: str,
                   checkpoint: str, contract: T.StructType, key: str, multi_line: bool) -> None:
    landed = (spark.readStream
              .schema(T.StructType([T.StructField(name, T.StringType()) for name in columns]))
              .options(**CSV_READ).option("multiLine", multi_line).option("pathGlobFilter", "*.csv")
              .csv(folder))
    placed = landed.select(
        *cells_and_batch(columns),
        F.lit(rank).alias("origin_rank"),
        F.col("_metadata.file_modification_time").alias("origin_time"),
        F.col("_metadata.file_path").alias("origin_file"),
        F.col("_metadata.file_block_start").alias("origin_block"),
    )

    def take_in(batch: DataFrame, batch_id: int) -> None:
        # Row numbers are given here: a stream has no row order of its own.
        numbered = batch.withColumn("origin_row", F.monotonically_increasing_id())
        # One folder for each batch: a batch that runs again replaces its own lines.
        bad_cells(numbered, contract).write.mode("overwrite").parquet(f"{checkpoint}-bad-cells/batch={batch_id}")
        append_new(type_cells(numbered, contract), target, key)

    query = (placed.writeStream.foreachBatch(take_in)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()


def ingest_landing(spark: SparkSession, landing: str, target: str, checkpoint: str,
                   contract: T.StructType = RAW_WORK, key: str = "id_OpenAlex", *,
                   header: T.StructType | None = None, multi_line: bool = True) -> None:
    """Process the CSV files landed since the last call, then return.

    ``landing`` is a journal's folder; its sub-folders follow it in the order that decides
    which copy of a work is kept.  A copy taken in by an earlier call stays.  The files of
    a folder have one header, taken from them unless ``header`` names it; a file with
    another order of columns is an error.  Below the checkpoint folder each sub-folder
    remembers which of its files are done, and ``<sub-folder>-bad-cells`` lists the cells of each
    batch that do not fit the contract (see :func:`citeweave.sources.landing.bad_cells`).
    """
    for rank, sub in enumerate(SUBFOLDERS):
        folder = f"{landing}/{sub}".rstrip("/")
        present = landed_header(spark, folder)
        if present:
            columns = list(header.names) if header else present
            if BATCH in present and BATCH not in columns:
                columns.append(BATCH)
            _ingest_folder(spark, folder, rank, columns, target, f"{checkpoint}/{sub or 'main'}", contract, key,
                           multi_line)
