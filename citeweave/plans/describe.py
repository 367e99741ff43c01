"""Stage 4: the data of the descriptive figures."""

from __future__ import annotations

from pyspark.sql import DataFrame

from citeweave.operators.describe import figures

# The columns that are described.
DESCRIBED = ["citation_count_OpenAlex", "median_citation_count_year", "higher_than_median_year"]


def describe(features: DataFrame, columns: list[str] = DESCRIBED) -> dict[str, DataFrame]:
    """``histograms`` of all columns and one ``scatter-<column>`` for each."""
    return figures(features, columns)
