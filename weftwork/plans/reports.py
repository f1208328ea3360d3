"""Film-style reports and stock series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftwork.operators.aggregate import exact_sum


def gross(*parts: str, name: str = "total_gross") -> Column:
    """Sum of several columns of a row; null if any of them is null."""
    total = F.col(parts[0])
    for part in parts[1:]:
        total = total + F.col(part)
    return total.alias(name)


def group_report(df: DataFrame, group: str, rating: str, amount: str, scale: int | None = None) -> DataFrame:
    """Mean rating and total amount per group, best rating first, groups without rating last. ``scale``: see ``exact_sum``."""
    return (
        df.groupBy(group)
        .agg(F.avg(rating).alias("mean_rating"), exact_sum(amount, scale).alias("total"))
        .orderBy(F.col("mean_rating").desc_nulls_last(), group)
    )


def genre_list(df: DataFrame, genre: str) -> DataFrame:
    return df.select(genre).where(F.col(genre).isNotNull()).distinct()


def good_of_genre(df: DataFrame, genre: str, wanted: str, rating: str, above: float) -> DataFrame:
    return df.where((F.col(genre) == wanted) & (F.col(rating) > above))


def mean_by_genre(df: DataFrame, genre: str, rating: str) -> DataFrame:
    return df.groupBy(genre).agg(F.avg(rating).alias("mean"))


def symbol_series(stocks: DataFrame, symbol: str) -> DataFrame:
    return stocks.where((F.col("company") == symbol) & (F.col("value") > 0))


def lowest_price(stocks: DataFrame) -> DataFrame:
    return stocks.agg(F.min("value").alias("lowest"))


def companies(stocks: DataFrame) -> DataFrame:
    return stocks.select("company").distinct()


def high_and_low(stocks: DataFrame, above: float) -> Sequence[DataFrame]:
    """Rows over a price, and the others."""
    return stocks.where(F.col("value") > above), stocks.where(F.col("value") <= above)
