"""Row-level integration: null keys, keep-first, counts, contract checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def drop_null_key(frame: DataFrame, key: str = "id_OpenAlex", *, empty_too: bool = False) -> DataFrame:
    """Without rows whose key is null (or, with ``empty_too``, an empty text)."""
    kept = frame.na.drop(subset=[key])
    return kept.where(F.col(key) != "") if empty_too else kept


def keep_first(frame: DataFrame, key: str | Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in ``order``.

    Spark limits each group before the shuffle as well as after it, so a task
    sends at most one row for each key however often the key occurs.
    """
    keys = [key] if isinstance(key, str) else list(key)
    nth = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return frame.withColumn("_nth", nth).where("_nth = 1").drop("_nth")


def stage_counts(frame: DataFrame, key: str = "id_OpenAlex") -> DataFrame:
    """Rows, rows with a key and distinct keys, in one pass."""
    return frame.agg(
        F.count("*").alias("n_rows"),
        F.count(key).alias("n_with_key"),
        F.count_distinct(F.col(key)).alias("n_distinct_keys"),
    )


def observed(frame: DataFrame, **metrics: Column) -> tuple[DataFrame, Observation]:
    """``frame`` with numbers taken on the way of the job that runs it; no pass of their own.

    ``observation.get`` gives them once that job is done.
    """
    observation = Observation()
    return frame.observe(observation, *[metric.alias(name) for name, metric in metrics.items()]), observation


def write_counts(frame: DataFrame, path: str, **counts: int) -> None:
    """One row of named numbers beside a stage's output; ``frame`` only gives the session."""
    schema = T.StructType([T.StructField(name, T.LongType()) for name in counts])
    frame.sparkSession.createDataFrame([tuple(counts.values())], schema).write.mode("overwrite").parquet(path)


def contract_report(frame: DataFrame, contract: T.StructType) -> DataFrame:
    """One row per column of the contract or the table: what keeps it from fitting.

    ``problem`` is ``missing``, ``extra``, ``type`` (another type, though every
    value converts, or one that none converts from), ``values`` (some value does not
    convert) or null.
    """
    spark = frame.sparkSession
    present = {field.name: field.dataType for field in frame.schema}
    shared = [field for field in contract if field.name in present]

    def castable(field: T.StructField) -> bool:
        try:
            frame.select(F.col(f"`{field.name}`").try_cast(field.dataType))
        except AnalysisException:
            return False
        return True

    casts = {field.name: castable(field) for field in shared}

    def unfit(field: T.StructField) -> Column:
        if present[field.name] == field.dataType:
            return F.lit(0).cast("bigint")
        cell = F.col(f"`{field.name}`")
        if not casts[field.name]:
            return F.count(cell)
        return F.count_if(cell.isNotNull() & cell.try_cast(field.dataType).isNull())

    def line(name: str, expected: str | None, found: str | None, values: Column, bad: Column,
             problem: Column) -> Column:
        return F.struct(
            F.lit(name).alias("column_name"),
            F.lit(expected).cast("string").alias("expected_type"),
            F.lit(found).cast("string").alias("found_type"),
            values.cast("bigint").alias("n_values"),
            bad.cast("bigint").alias("n_unfit"),
            problem.cast("string").alias("problem"),
        )

    none = F.lit(None)
    totals = [m for i, field in enumerate(shared)
              for m in (F.count(f"`{field.name}`").alias(f"values_{i}"), unfit(field).alias(f"unfit_{i}"))]
    lines = []
    for i, field in enumerate(shared):
        same = present[field.name] == field.dataType
        problem = F.when(F.lit(not casts[field.name]), "type").when(F.col(f"unfit_{i}") > 0, "values").when(
            F.lit(not same), "type")
        lines.append(line(field.name, field.dataType.simpleString(),
                          present[field.name].simpleString(),
                          F.col(f"values_{i}"), F.col(f"unfit_{i}"), problem))
    lines += [line(field.name, field.dataType.simpleString(), None, none, none, F.lit("missing"))
              for field in contract if field.name not in present]
    lines += [line(name, None, kind.simpleString(), none, none, F.lit("extra"))
              for name, kind in present.items() if name not in contract.names]
    counted = frame.agg(*totals) if totals else spark.range(1)
    return counted.select(F.inline(F.array(*lines)))
