"""Stage 2: landed batches to one table with one row per work."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeweave.operators.rows import drop_null_key, keep_first, observed, write_counts
from citeweave.schemas import INTEGRATED_WORK, RAW_WORK
from citeweave.sources.landing import bad_cells, journal_folders, number_files, read_text_cells, type_cells
from citeweave.sources.tables import write_table


def integrate(landed: DataFrame, key: str = "id_OpenAlex") -> DataFrame:
    """Rows with a key, the first copy of each: main, then citing, then referenced works."""
    numbered, order = number_files(drop_null_key(landed, key))
    return keep_first(numbered, key, order).drop(*order)


def integrate_journal(spark: SparkSession, landing_root: str, journal: str, out_root: str,
                      contract: T.StructType = RAW_WORK, *, multi_line: bool = True) -> DataFrame:
    """Write a journal's table; returns the ledger of cells that do not fit the contract.

    Beside the table ``<journal>-counts`` tells the rows landed, those with an id and those kept,
    counted while the table is written.
    """
    cells = read_text_cells(spark, journal_folders(landing_root, journal), multi_line=multi_line)
    landed, before = observed(type_cells(cells, contract), n_rows=F.count("*"), n_with_key=F.count("id_OpenAlex"))
    kept, after = observed(integrate(landed), n_kept=F.count("*"))
    write_table(kept, f"{out_root}/{journal}", INTEGRATED_WORK)
    write_counts(kept, f"{out_root}/{journal}-counts", **before.get, **after.get)
    return bad_cells(cells, contract)
