"""Null handling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_known(*columns: str | Column) -> Column:
    return F.coalesce(*columns)


def null_if_equal(column: str | Column, other: str | Column) -> Column:
    return F.nullif(column, other)


def if_known(test: str | Column, known: Column, missing: Column) -> Column:
    return F.nvl2(test, known, missing)


def drop_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=None if columns is None else list(columns))


def fill_nulls(df: DataFrame, value=None, columns: Sequence[str] | None = None, each: Mapping | None = None) -> DataFrame:
    """One value for some columns, or a value for each of several columns."""
    if each is not None:
        return df.na.fill(dict(each))
    return df.na.fill(value, subset=None if columns is None else list(columns))
