"""Name -> (Spark query, SQL that gives the same rows)."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


class Query(NamedTuple):
    run: Run
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Run], Run]:
    """Register the function under its name."""

    def register(run: Run) -> Run:
        if run.__name__ in REGISTRY:
            raise ValueError(f"query {run.__name__} is registered twice")
        REGISTRY[run.__name__] = Query(run, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
