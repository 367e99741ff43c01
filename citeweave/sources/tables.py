"""Parquet tables: reading, SQL projection, contract sinks, staged tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeweave.session import fresh_path

_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def sql_projection(spark: SparkSession, paths: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``SELECT columns`` over Parquet files; only these columns are read."""
    return spark.sql("SELECT * FROM {works}", works=spark.read.parquet(*paths)).select(
        *[F.col(f"`{name}`") for name in columns])


def cast_to_contract(frame: DataFrame, contract: T.StructType) -> DataFrame:
    """Contract columns first, in their types; other columns follow as they are.

    A missing column or a value that does not fit raises.
    """
    missing = [name for name in contract.names if name not in frame.columns]
    if missing:
        raise ValueError(f"columns missing from the table: {', '.join(missing)}")
    named = set(contract.names)
    return frame.select(
        *[F.col(field.name).cast(field.dataType).alias(field.name) for field in contract],
        *[F.col(f"`{name}`") for name in frame.columns if name not in named])


def sort_by_id(frame: DataFrame, key: str = "id_OpenAlex", within: str | None = None,
               partitions: int | None = None) -> DataFrame:
    """Global order by ``key`` (inside ``within``, if given) through range partitioning.

    Sorted files carry narrow minimum-maximum ranges, so a later filter on the
    key skips row groups.  ``within`` names the partition column of the sink: each
    task then holds few of its values, and a large value is split by key.  Row
    numbers close the ranges, so that a repeated key is split as well.  Without
    ``partitions`` there are at most as many of them as AQE begins a shuffle with (see
    :func:`citeweave.session.build_session`), fewer for small data; give a number that
    follows the rows for a table beyond that.
    """
    keys = [within, key] if within else [key]
    numbered = frame.withColumn("_row", F.monotonically_increasing_id())
    ranges = [*keys, "_row"]
    spread = numbered.repartitionByRange(partitions, *ranges) if partitions else numbered.repartitionByRange(*ranges)
    return spread.sortWithinPartitions(*keys).drop("_row")


def write_table(frame: DataFrame, path: str, contract: T.StructType | None = None,
                partition_by: str | None = None) -> None:
    """Replace the Parquet table at ``path``.  Never the table ``frame`` is read from."""
    out = cast_to_contract(frame, contract) if contract else frame
    writer = out.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def staged(frame: DataFrame, step: str, tidy: bool = False) -> DataFrame:
    """Write ``frame`` once to a fresh shared folder and go on from there.

    Cuts the lineage and survives the loss of executors.  The table read back
    has a known size, on which Spark bases its choice of joins.  With ``tidy`` it is
    compressed with zstd, and what was shuffled to make it leaves the disks at once
    instead of when the driver next collects its memory.
    """
    spark = frame.sparkSession
    path = fresh_path(spark, step)
    if not tidy:
        frame.write.parquet(path)
        return spark.read.schema(frame.schema).parquet(path)
    before = spark.conf.get(_CLEAN_UP, None)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        frame.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEAN_UP)
        else:
            spark.conf.set(_CLEAN_UP, before)
    return spark.read.schema(frame.schema).parquet(path)


def discard(frame: DataFrame) -> None:
    """Remove the files of a staged table that nothing reads any more."""
    context = frame.sparkSession.sparkContext
    for folder in {file.rpartition("/")[0] for file in frame.inputFiles()}:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def spread(frame: DataFrame) -> DataFrame:
    """The rows dealt out evenly, for costly work on each row of a table that lies in few files.

    One file gives as many tasks as it has row groups, which may be fewer than there are cores.
    """
    return frame.hint("rebalance")
