"""Jobs that take their paths as arguments."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from weftwork.session import run_job
from weftwork.sources.files import read_json, write_files


def filter_sort(
    spark: SparkSession, source: str, target: str, where: str, order: Sequence[str],
    columns: Sequence[str] | None = None, descending: bool = False, schema: str | None = None,
) -> None:
    """JSON in, filtered, projected and sorted, JSON out."""
    df = read_json(spark, source, schema=schema).where(where)
    if columns:
        df = df.select(*columns)
    ordered = df.orderBy(*[F.desc(c) if descending else F.asc(c) for c in order])
    write_files(ordered, target, "json", "overwrite")


def main(argv: Sequence[str] | None = None) -> None:
    args = argparse.ArgumentParser(description=filter_sort.__doc__)
    args.add_argument("source")
    args.add_argument("target")
    args.add_argument("--where", required=True)
    args.add_argument("--order", nargs="+", required=True)
    args.add_argument("--columns", nargs="+")
    args.add_argument("--descending", action="store_true")
    given = args.parse_args(argv)
    run_job(
        "filter-sort",
        lambda spark: filter_sort(
            spark, given.source, given.target, given.where, given.order, given.columns, given.descending
        ),
    )


if __name__ == "__main__":
    main()
