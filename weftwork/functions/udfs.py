"""Python functions inside tasks, Arrow batch by Arrow batch. Built-in functions come first."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


@F.pandas_udf(StringType())
def lower_text(values: pd.Series) -> pd.Series:
    return values.str.lower()


def register_lower(spark: SparkSession, name: str = "weft_lower") -> str:
    """Make the lower-case function known to SQL under ``name``."""
    spark.udf.register(name, lower_text)
    return name


def smallest_per_partition(df: DataFrame, order: list[str], k: int) -> DataFrame:
    """The ``k`` smallest rows of each partition, holding no more than ``k`` rows and one batch."""
    names = df.columns
    keys = [(c, "ascending") for c in order]

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table])
            held = table.take(pc.select_k_unstable(table, k=k, sort_keys=keys))
        if held is not None:
            yield from held.combine_chunks().to_batches()

    return df.select(*names).mapInArrow(best, df.schema)


def in_list(column: str, words: list[str]) -> Column:
    """Membership in a short fixed list; the list travels with the task."""
    return F.col(column).isin(words)
