"""From documents to a tokenised mix in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the next one's ``docs``.  All but the last return the columns of
``documents``.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.llm.bpe import encode_documents
from citeweave.llm.language_id import of_known_language
from citeweave.llm.line_dedup import without_repeated_lines
from citeweave.llm.minhash_dedup import one_of_each
from citeweave.llm.mixing import mixed_rows
from citeweave.sources.tables import staged

TOKENIZER = "word_bpe_49k.json"
# Bytes of text in a block of the token stage: ids and decoded text of a block are held at once.
TOKEN_BLOCK_BYTES = 4 << 20

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
# Columns that stages work on; all others are only carried along.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keeping_names(stage: Stage) -> Stage:
    """A stage that returns its columns as they came, whatever further ones are called.

    They have other names while the stage runs, so none can clash with a working column.
    """
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = docs.columns
        free = [name if name in DOCUMENT_COLUMNS else f"carried_{i}" for i, name in enumerate(names)]
        return stage(spark, docs.toDF(*free), sf_dir).toDF(*names)

    return run_stage


@keeping_names
def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; undetermined and rejected ones go."""
    return of_known_language(docs)


@keeping_names
def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that other documents keep; ``n_chars`` follows the text."""
    columns = docs.columns
    done = without_repeated_lines(docs)
    fresh = {"text": F.col("_lines.text")}
    if "n_chars" in columns:
        fresh["n_chars"] = F.length("_lines.text").cast(docs.schema["n_chars"].dataType)
    return done.withColumns(fresh).select(*[f"`{name}`" for name in columns])


@keeping_names
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, similarity 0.8 or more."""
    return one_of_each(docs, width=5, percent=80)


@keeping_names
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, each shard's rows together and shuffled."""
    return mixed_rows(docs).drop("_shard", "_place")


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and decoded text of each document; a null text has none, an empty table gives an empty one."""
    return encode_documents(docs, public_tokenizers.path(TOKENIZER), written=True, block_bytes=TOKEN_BLOCK_BYTES)


STAGES: list[tuple[str, Stage]] = [
    ("language ID", language_stage),
    ("line dedup", line_stage),
    ("MinHash near-dedup", near_duplicate_stage),
    ("mixing sources to target weights", mixing_stage),
    ("BPE encoding and decoding", token_stage),
]

# Character models, Bloom filters, sketches and BPE are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
