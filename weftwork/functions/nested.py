"""Structs, arrays, maps and JSON text."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_json(df: DataFrame, column: str, schema: str, keep: Sequence[str] = ()) -> DataFrame:
    """JSON text read with a schema and laid out as columns; null where the text is broken."""
    return df.select(*keep, F.from_json(column, schema).alias("__j")).select(*keep, "__j.*")


def build_json(*columns: str | Column) -> Column:
    return F.to_json(F.struct(*columns))


def merge_entries(
    df: DataFrame, owner: Sequence[str], key: str, value: str, combine: Callable[[str], Column]
) -> DataFrame:
    """Maps kept as rows (owner, key, value), merged key by key with ``combine``: sum, max, min, ...

    Rows instead of map columns: a vertex with millions of keys is then many rows over many tasks.
    """
    return df.groupBy(*owner, key).agg(combine(value).alias(value))


def to_map(df: DataFrame, owner: str, key: str, value: str) -> DataFrame:
    """The final map column of an owner, for output, when its size is known to be small."""
    return df.groupBy(owner).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(key, value)))).alias("entries")
    )
