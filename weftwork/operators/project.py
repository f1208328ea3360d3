"""Projections, filters and predicates."""

from __future__ import annotations

import functools
import operator
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute(df: DataFrame, keep: Sequence[str] = (), **expressions: str) -> DataFrame:
    """Kept columns plus named SQL expressions."""
    return df.selectExpr(*keep, *[f"{text} AS `{name}`" for name, text in expressions.items()])


def reshape(
    df: DataFrame,
    add: Mapping[str, Column] | None = None,
    rename: Mapping[str, str] | None = None,
    drop: Sequence[str] = (),
) -> DataFrame:
    """Add, then rename, then drop columns. Names may hold spaces."""
    return df.withColumns(dict(add or {})).withColumnsRenamed(dict(rename or {})).drop(*drop)


def where_all(df: DataFrame, *predicates: Column | str) -> DataFrame:
    for predicate in predicates:
        df = df.where(predicate)
    return df


def exclude_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows whose ``column`` is none of ``values``; as with ``!=``, a null is not kept."""
    return df.where(~F.col(column).isin(list(values)))


def with_flag(df: DataFrame, name: str, predicate: Column) -> DataFrame:
    return df.withColumn(name, predicate)


def contains_any(column: str | Column, words: Sequence[str]) -> Column:
    """True where the text holds any of ``words`` as a part."""
    text = F.col(column) if isinstance(column, str) else column
    return functools.reduce(operator.or_, (text.contains(w) for w in words), F.lit(False))


def any_of_pattern(words: Sequence[str]) -> str:
    return "|".join(re.escape(w) for w in words)


def matches_any(column: str | Column, words: Sequence[str]) -> Column:
    """The same test as one alternation pattern, with special characters taken literally."""
    text = F.col(column) if isinstance(column, str) else column
    return text.rlike(any_of_pattern(words)) if words else F.lit(False)


def scale(df: DataFrame, column: str, factor, at_least=None) -> DataFrame:
    """``column`` times a constant, as ``scaled``; optionally only values from a threshold on."""
    scaled = df.withColumn("scaled", F.col(column) * F.lit(factor))
    return scaled if at_least is None else scaled.where(F.col("scaled") >= F.lit(at_least))


def add_columns(df: DataFrame, base: str, count: int, prefix: str = "newCol") -> DataFrame:
    """``count`` derived columns ``base * i``, in one projection."""
    return df.selectExpr("*", *[f"`{base}` * {i} AS `{prefix}{i}`" for i in range(count)])


def short_strings(df: DataFrame, column: str, at_most: int) -> DataFrame:
    return df.where(F.length(column) <= at_most)


def sample_fraction(df: DataFrame, fraction: float, seed: int | None = None) -> DataFrame:
    """Random rows without replacement. Which rows come depends on how the data is partitioned."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def sample_by_key(df: DataFrame, key: str, keep: int, of: int) -> DataFrame:
    """About ``keep`` of ``of`` keys, the same ones in every run and on every partitioning."""
    bucket = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long") % of
    return df.where(bucket < keep)
