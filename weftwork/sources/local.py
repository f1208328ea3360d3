"""Small literal tables, number ranges, and first looks at a table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def rows_table(spark: SparkSession, rows: Iterable, columns: Sequence[str] | StructType | str) -> DataFrame:
    """A table from local tuples, dicts or pairs; for fixed lookup lists, not for data."""
    return spark.createDataFrame(list(rows), columns)


def number_range(
    spark: SparkSession, start: int, end: int, step: int = 1, partitions: int | None = None
) -> DataFrame:
    return spark.range(start, end, step, partitions)


def describe_table(df: DataFrame, preview: int = 5) -> dict:
    """Schema text, a few rows and the row count."""
    return {
        "schema": df.schema.simpleString(),
        "rows": [row.asDict() for row in df.take(preview)],
        "count": df.count(),
    }
