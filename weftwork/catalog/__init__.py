"""Registered queries: what runs on the test tables, with the equivalent SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """The tables of one data folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


@dataclass(frozen=True)
class Entry:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


ENTRIES: dict[str, Entry] = {}


def query(sql: str | None = None):
    """Register a function from tables to a result under its own name."""

    def register(build: Callable[[Tables], DataFrame]):
        name = build.__name__
        if name in ENTRIES:
            raise ValueError(f"{name} is registered twice")
        ENTRIES[name] = Entry(name, build, sql)
        return build

    return register


def load_all() -> dict[str, Entry]:
    from weftwork.catalog import (  # noqa: F401  (imported for their registrations)
        aggregates, analyses, graphs, joins, layouts, projections, scalars, scans, streams,
    )

    return ENTRIES
