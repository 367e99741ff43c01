"""A whole snapshot in dated parts, as the service publishes it.

Below ``works`` lie folders ``updated_date=YYYY-MM-DD`` of JSON lines, each with the works that
changed on that day, so a work may be in several.  Below ``merged_ids`` lie CSV files that name
works which have been merged into another one, or withdrawn.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeweave.operators.rows import drop_null_key, keep_first
from citeweave.schemas import WORK_JSON
from citeweave.sources.tables import staged

DATE = "updated_date"
MERGES = T.StructType([
    T.StructField("merge_date", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("merge_into_id", T.StringType()),
])
_PLACE = ["_file", "_block", "_row"]


def read_parts(spark: SparkSession, root: str, schema: T.StructType = WORK_JSON, since: str | None = None) -> DataFrame:
    """All versions of all works with the ``updated_date`` of their part (text, so that it sorts).

    With ``since`` only parts of that day or later are read at all.
    """
    dated = T.StructType([*schema, T.StructField(DATE, T.StringType())])
    works = spark.read.schema(dated).json(f"{root}/works")
    return works if since is None else works.where(F.col(DATE) >= since)


def read_merges(spark: SparkSession, root: str) -> DataFrame:
    """``merge_date, id, merge_into_id``; a withdrawn work has no target."""
    return spark.read.schema(MERGES).option("header", True).csv(f"{root}/merged_ids")


def newest(works: DataFrame, key: str = "id") -> DataFrame:
    """The version of each work from the latest part, works without an id left out.

    Should one part hold a work twice, the later file and line counts.  A task sends at most
    one version of each work.
    """
    placed = works.withColumns({"_file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start"),
                                "_row": F.monotonically_increasing_id()})
    order = [F.desc_nulls_last(DATE), *[F.desc(name) for name in _PLACE]]
    return keep_first(drop_null_key(placed, key, empty_too=True), key, order).drop(*_PLACE)


def survivors(merges: DataFrame) -> DataFrame:
    """``id, survivor``, a written table: where each merged-away id leads in the end.

    Of several merges of an id the latest counts.  Chains are followed by halving, each round
    written out, so their number follows the logarithm of the longest chain.  A withdrawn
    work, or one merged into a withdrawn one, has no survivor (null), nor has a circle.
    """
    valid = drop_null_key(merges, "id", empty_too=True)
    target = F.when(F.trim("merge_into_id") != "", F.trim("merge_into_id"))
    latest = keep_first(valid.withColumn("_to", target), "id", [F.desc_nulls_last("merge_date"), F.asc_nulls_last("_to")])
    steps = staged(latest.select("id", F.col("_to").alias("survivor")), "merges")
    merged_away = steps.select(F.col("id").alias("survivor"))
    for _ in range(steps.count().bit_length()):
        ahead = steps.select(F.col("id").alias("survivor"), F.col("survivor").alias("ahead"), F.lit(True).alias("goes_on"))
        steps = staged(steps.join(ahead, "survivor", "left").select(
            "id", F.when(F.col("goes_on"), F.col("ahead")).otherwise(F.col("survivor")).alias("survivor"),
            F.coalesce("goes_on", F.lit(False)).alias("goes_on")), "merges")
        going = not steps.where("goes_on AND survivor IS NOT NULL").isEmpty()
        steps = steps.select("id", "survivor")
        if not going:
            return steps
    # What still goes on after so many rounds goes in a circle.
    circles = steps.join(merged_away.distinct(), "survivor", "left_semi").select("id", F.lit(True).alias("circle"))
    return staged(steps.join(circles, "id", "left").select(
        "id", F.when(F.col("circle").isNull(), F.col("survivor")).alias("survivor")), "survivors")


def redirected(frame: DataFrame, survivors: DataFrame, column: str) -> DataFrame:
    """``frame`` with merged-away ids in ``column`` replaced by their survivors.

    Rows whose id has no survivor are left out; other ids, null among them, stay.
    """
    led = survivors.select(F.col("id").alias(column), F.col("survivor").alias("_to"), F.lit(True).alias("_led"))
    return (frame.join(led, column, "left").where("_led IS NULL OR _to IS NOT NULL")
            .withColumn(column, F.coalesce("_to", F.col(column))).select(*[f"`{name}`" for name in frame.columns]))


def current_works(works: DataFrame, survivors: DataFrame, key: str = "id") -> DataFrame:
    """The newest version of each work that has been neither merged away nor withdrawn."""
    gone = survivors.select(F.col("id").alias(key))
    return newest(works, key).join(gone, key, "left_anti")
