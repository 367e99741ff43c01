"""Landed CSV batches: typed reading, the ledger of bad values, known ids, appending."""

from __future__ import annotations

import re
import time
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeweave.functions.ids import parse_list
from citeweave.schemas import KNOWN_IDS, RAW_WORK

# Cell texts that stand for a missing value in a landed CSV file.
MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# Sub-folders of a journal's landing folder, in the order that decides
# which copy of a work is kept.
SUBFOLDERS = ["", "citations", "references"]

CSV_READ = {
    "header": "true",
    "escape": '"',
    "enforceSchema": "false",  # a file with another header order is an error, not a mix-up
}
CSV_WRITE = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# Columns that put landed rows in their total order.
ORIGIN = ["origin_rank", "origin_batch", "origin_time", "origin_file", "origin_block", "origin_row"]
# Column of a landed file that numbers its batch; later batches have larger numbers.
BATCH = "landing_batch"
# How numbers are written in a cell; other spellings that a cast would take are bad cells.
WHOLE_NUMBER = r"^\s*[+-]?\d+(\.0*)?([eE][+-]?\d+)?\s*$"
NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def _present(cell: Column) -> Column:
    return F.when(~cell.isin(MISSING), cell)


def _typed(cell: Column, kind: T.DataType) -> Column:
    """``cell`` in the contract's type; whole numbers may be written like ``12.0``."""
    if isinstance(kind, T.IntegerType):
        number = F.when(cell.rlike(WHOLE_NUMBER), cell).try_cast("double")  # holds every int exactly
        return F.when(number == F.rint(number), number.try_cast(kind))
    if isinstance(kind, T.DoubleType):
        return F.when(cell.rlike(NUMBER), cell).try_cast(kind)
    return cell if isinstance(kind, T.StringType) else cell.try_cast(kind)


def _read_text(spark: SparkSession, folder: str, multi_line: bool, recursive: bool) -> DataFrame | None:
    try:
        return (spark.read.options(**CSV_READ)
                .option("multiLine", multi_line)
                .option("recursiveFileLookup", recursive)
                .option("pathGlobFilter", "*.csv")
                .csv(folder))
    except AnalysisException as error:
        # A folder that does not exist or holds no file counts as empty.
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def cells_and_batch(columns: Sequence[str]) -> list[Column]:
    """The cells of a landed file by trimmed name, and ``origin_batch`` from its :data:`BATCH` column."""
    named = {name.strip(): F.col(f"`{name}`") for name in columns}
    batch = named.pop(BATCH, F.lit(None))
    return [*[cell.alias(name) for name, cell in named.items()], batch.try_cast("bigint").alias("origin_batch")]


def read_text_cells(spark: SparkSession, folders: Sequence[str], *, multi_line: bool = True,
                    recursive: bool = False) -> DataFrame:
    """All ``*.csv`` of the folders, every cell as text, matched by column name.

    The :data:`ORIGIN` columns give folder rank, batch, landing time, file and place in the file.
    Batches follow each other by the number that :func:`append_batch` gave them if asked to;
    files without a number come before, by the time they landed.
    Set ``multi_line`` to False where no cell holds a line break: large files
    can then be split between tasks.
    """
    frames = []
    for rank, folder in enumerate(folders):
        text = _read_text(spark, folder, multi_line, recursive)
        if text is None or not text.columns:
            continue
        frames.append(text.select(
            *cells_and_batch(text.columns),
            F.lit(rank).alias("origin_rank"),
            F.col("_metadata.file_modification_time").alias("origin_time"),
            F.col("_metadata.file_path").alias("origin_file"),
            F.col("_metadata.file_block_start").alias("origin_block"),
            F.monotonically_increasing_id().alias("origin_row"),
        ))
    if not frames:
        raise FileNotFoundError(f"no CSV file in {list(folders)}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def type_cells(cells: DataFrame, contract: T.StructType = RAW_WORK) -> DataFrame:
    """Contract columns in their types (absent ones null), then the other columns as text."""
    typed = [
        (_typed(_present(F.col(field.name)), field.dataType) if field.name in cells.columns
         else F.lit(None).cast(field.dataType)).alias(field.name)
        for field in contract
    ]
    named = {field.name for field in contract}
    rest = [F.col(name) if name in ORIGIN else _present(F.col(name)).alias(name)
            for name in cells.columns if name not in named]
    return cells.select(*typed, *rest)


def bad_cells(cells: DataFrame, contract: T.StructType = RAW_WORK) -> DataFrame:
    """Ledger of cells that do not fit the contract: origin, column, text."""
    checks = [
        F.when(_present(F.col(field.name)).isNotNull()
               & _typed(_present(F.col(field.name)), field.dataType).isNull(),
               F.struct(F.lit(field.name).alias("column"), F.col(field.name).alias("text")))
        for field in contract
        if field.name in cells.columns and not isinstance(field.dataType, T.StringType)
    ]
    if not checks:
        checks = [F.lit(None).cast("struct<column:string,text:string>")]
    return (cells
            .select(*ORIGIN, F.explode(F.filter(F.array(*checks), lambda c: c.isNotNull())).alias("bad"))
            .select(*ORIGIN, "bad.*"))


def read_landing(spark: SparkSession, folders: Sequence[str], contract: T.StructType = RAW_WORK, *,
                 multi_line: bool = True) -> DataFrame:
    """Typed rows of several landing folders, with their :data:`ORIGIN`."""
    return type_cells(read_text_cells(spark, folders, multi_line=multi_line), contract)


def number_files(landed: DataFrame) -> tuple[DataFrame, list[str]]:
    """``landed`` with a file's place among all files instead of its path, and the columns that order the rows.

    The order is that of :data:`ORIGIN`.  A path is longer than most other cells of a row, and a sort
    would hold it once for each row.  Rows that are in no file keep the path they have.
    """
    # Rows name a local path with one slash; texts are compared by their bytes, as Spark does.
    paths = sorted({re.sub("^file:/+", "file:/", path) for path in landed.inputFiles()}, key=str.encode)
    if not paths:
        return landed, list(ORIGIN)
    files = landed.sparkSession.createDataFrame(list(enumerate(paths)), "origin_number int, origin_path string")
    # One row per landed file, a list that Spark itself plans the reading with.
    known = landed.join(F.broadcast(files), F.col("origin_file") == F.col("origin_path"), "left")
    return (known.withColumn("origin_file", F.when(F.col("origin_number").isNull(), F.col("origin_file"))).drop("origin_path"),
            [part for name in ORIGIN for part in (["origin_number", name] if name == "origin_file" else [name])])


def journal_folders(root: str, journal: str) -> list[str]:
    return [f"{root}/{journal}/{sub}".rstrip("/") for sub in SUBFOLDERS]


def known_ids(spark: SparkSession, root: str, *, multi_line: bool = True) -> DataFrame:
    """Distinct ``(doi, id_OpenAlex)`` of every CSV below ``root``, at any depth.

    All of them have one header; another one is an error.
    """
    cells = read_text_cells(spark, [root], multi_line=multi_line, recursive=True)
    return type_cells(cells, KNOWN_IDS).select(*KNOWN_IDS.names).distinct()


def landed_lists(spark: SparkSession, root: str, *, multi_line: bool = True) -> DataFrame:
    """``id, referenced_works`` of every CSV below ``root``, at any depth; works without a list are left out."""
    cells = read_text_cells(spark, [root], multi_line=multi_line, recursive=True)
    if "referenced_works_OpenAlex" not in cells.columns:
        return spark.createDataFrame([], "id string, referenced_works array<string>")
    return type_cells(cells).select(F.col("id_OpenAlex").alias("id"),
                                    parse_list(F.col("referenced_works_OpenAlex")).alias("referenced_works")
                                    ).where("id IS NOT NULL AND referenced_works IS NOT NULL")


def no_known_ids(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], KNOWN_IDS)


def landed_header(spark: SparkSession, folder: str) -> list[str]:
    """Column names of the CSV files of a folder (not of its sub-folders); empty if it has none."""
    text = _read_text(spark, folder, multi_line=True, recursive=False)
    return [] if text is None else text.columns


def as_cells(frame: DataFrame) -> DataFrame:
    """Nested columns as JSON text, so that the row fits a CSV line."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return frame.select(*[
        (F.to_json(F.col(field.name)) if isinstance(field.dataType, nested)
         else F.col(field.name)).alias(field.name)
        for field in frame.schema
    ])


def numbers_batches(spark: SparkSession, folder: str, fresh: bool = False) -> bool:
    """Whether batches landed below ``folder`` are numbered; ``fresh`` decides where none has landed yet.

    All files have one header, so those present decide otherwise.
    """
    text = _read_text(spark, folder, multi_line=True, recursive=True)
    return fresh if text is None or not text.columns else BATCH in [name.strip() for name in text.columns]


def append_batch(frame: DataFrame, folder: str, *, rows_per_file: int = 100_000, numbered: bool | None = None) -> None:
    """Add a batch of CSV files; files already there are left as they are.

    With ``numbered`` each row carries the batch's number, the microsecond at which it began
    to land, in the column :data:`BATCH`, so that batches keep their order in a copy of the
    folder and in stores that tell times by the second.  A ``frame`` that has this column keeps
    its own.  Unless ``numbered`` is given, a folder goes on as it began, without numbers.
    """
    spark = frame.sparkSession
    if BATCH not in frame.columns and (numbers_batches(spark, folder) if numbered is None else numbered):
        frame = frame.withColumn(BATCH, F.lit(time.time_ns() // 1000))
    (as_cells(frame).write.mode("append").options(**CSV_WRITE)
     .option("maxRecordsPerFile", rows_per_file).csv(folder))


def union_sources(frames: Iterable[DataFrame]) -> DataFrame:
    """Rows of all frames, columns matched by name, absent ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
