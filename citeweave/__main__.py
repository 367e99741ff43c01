"""The stages as jobs: ``spark-submit --py-files citeweave.zip citeweave/__main__.py STAGE ...``.

Locally: ``python -m citeweave STAGE ...``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from citeweave.functions.embedding import HashingEncoder, SentenceModelEncoder
from citeweave.operators.graph import LOOKUP_KEYS, lookup, lookup_missing
from citeweave.operators.search import journals_not_found
from citeweave.plans.acquire import acquire, expand_with_ledger, requests_for
from citeweave.plans.describe import DESCRIBED, describe
from citeweave.plans.features import feature_journal
from citeweave.plans.integrate import integrate_journal
from citeweave.session import build_session, ship_package
from citeweave.sources.landing import append_batch, known_ids, landed_lists, no_known_ids, numbers_batches
from citeweave.sources.tables import read_table
from citeweave.sources.works_json import DEFAULT_FIELDS, bad_records, flatten_works, read_works
from citeweave.streaming.ingest import ingest_landing


def held_below(spark: SparkSession, folder: str) -> DataFrame:
    try:
        return known_ids(spark, folder)
    except FileNotFoundError:
        return no_known_ids(spark)


def write_ledger(ledger: DataFrame, folder: str, name: str) -> None:
    ledger.write.mode("overwrite").parquet(f"{folder}/ledger/{name}")


def run_acquire(spark: SparkSession, args: argparse.Namespace) -> None:
    folder = f"{args.landing}/{args.label}"
    names = spark.createDataFrame([(name,) for name in args.names], "name string")
    journals = spark.read.json(args.journals)
    requests = requests_for(names, journals, *args.years)
    found = acquire(read_works(spark, args.snapshot), requests, held_below(spark, folder),
                    held_below(spark, f"{folder}/references"), args.cap, args.fields)
    numbered = numbers_batches(spark, folder, args.numbered)
    append_batch(found.works, folder, numbered=numbered)
    append_batch(found.references, f"{folder}/references", numbered=numbered)
    write_ledger(journals_not_found(names, journals), folder, "journals_not_found")
    write_ledger(bad_records(spark, args.snapshot), folder, "bad_records")
    if args.cap is not None:
        write_ledger(found.left_out, folder, "left_out")


def run_expand(spark: SparkSession, args: argparse.Namespace) -> None:
    folder = f"{args.landing}/{args.label}"
    followed = "citations" if args.citing else "references"
    try:
        landed = landed_lists(spark, folder)
    except FileNotFoundError:
        landed = None
    reached = expand_with_ledger(read_works(spark, args.snapshot), held_below(spark, folder), args.hops, args.fields,
                                 landed, args.citing)
    append_batch(reached.works.drop("hop"), f"{folder}/{followed}", numbered=numbers_batches(spark, folder, args.numbered))
    write_ledger(reached.not_found, folder, f"{followed}_not_found")


def run_integrate(spark: SparkSession, args: argparse.Namespace) -> None:
    bad = integrate_journal(spark, args.landing, args.label, args.out, multi_line=not args.single_line)
    bad.write.mode("overwrite").parquet(f"{args.out}/{args.label}-bad-cells")


def run_ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    ingest_landing(spark, args.landing, args.out, args.checkpoint, multi_line=not args.single_line)


def run_details(spark: SparkSession, args: argparse.Namespace) -> None:
    """Land the records of given ids, and a ledger of those the snapshot does not have."""
    folder = f"{args.landing}/{args.label}"
    key = "doi" if args.by == "doi" else "id"
    ids = spark.read.text(args.ids).withColumnRenamed("value", "id")
    works = read_works(spark, args.snapshot)
    append_batch(flatten_works(lookup(works, ids, args.by, key=key), args.fields), folder,
                 numbered=numbers_batches(spark, folder, args.numbered))
    write_ledger(lookup_missing(works, ids, args.by, key=key), folder, "not_found")


def run_features(spark: SparkSession, args: argparse.Namespace) -> None:
    ship_package(spark)
    encoder = (SentenceModelEncoder, args.model) if args.model else (HashingEncoder,)
    feature_journal(spark, args.integrated, args.label, args.out, *encoder, by_year=args.by_year, wide=args.wide,
                    percentiles=args.percentiles)


def run_describe(spark: SparkSession, args: argparse.Namespace) -> None:
    for name, figure in describe(read_table(spark, args.features), args.columns).items():
        figure.write.mode("overwrite").parquet(f"{args.out}/{name}")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="citeweave", description=__doc__)
    stages = top.add_subparsers(required=True)

    def stage(run, text: str, *required: str) -> argparse.ArgumentParser:
        sub = stages.add_parser(run.__name__.removeprefix("run_"), help=text)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        sub.set_defaults(run=run)
        return sub

    sub = stage(run_acquire, "search a snapshot and land works and references",
                "snapshot", "journals", "landing", "label")
    sub.add_argument("--names", nargs="+", required=True)
    sub.add_argument("--years", nargs=2, type=int, required=True)
    sub.add_argument("--cap", type=int, help="most new works of each search; without it all")
    sub.add_argument("--fields", nargs="+", default=DEFAULT_FIELDS)
    sub = stage(run_details, "land the records of given ids", "snapshot", "ids", "landing", "label")
    sub.add_argument("--by", choices=sorted(LOOKUP_KEYS), default="oaid")
    sub.add_argument("--fields", nargs="+", default=DEFAULT_FIELDS)
    sub = stage(run_expand, "land works reached along references or citations", "snapshot", "landing", "label")
    sub.add_argument("--hops", type=int, default=1)
    sub.add_argument("--citing", action="store_true", help="follow citations to the works that cite")
    sub.add_argument("--fields", nargs="+", default=DEFAULT_FIELDS)
    for name in ("acquire", "details", "expand"):
        stages.choices[name].add_argument("--numbered", action="store_true",
                                          help="number the batches of a landing folder that is begun with this run")
    for sub in (stage(run_integrate, "landed batches to one table", "landing", "label", "out"),
                stage(run_ingest, "take in newly landed files", "landing", "out", "checkpoint")):
        sub.add_argument("--single-line", action="store_true", help="no cell holds a line break; files can be split")
    sub = stage(run_features, "integrated works to the feature table", "integrated", "label", "out")
    sub.add_argument("--model", help="folder of a sentence model; hashed words without it")
    sub.add_argument("--by-year", action="store_true")
    sub.add_argument("--wide", action="store_true", help="one column per dimension of the embedding")
    sub.add_argument("--percentiles", action="store_true", help="compute the percentile columns where they are missing")
    sub = stage(run_describe, "the data of the figures", "features", "out")
    sub.add_argument("--columns", nargs="+", default=DESCRIBED)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(build_session(), args)


if __name__ == "__main__":
    main()
