"""Keys that hold very many rows, found in one pass, and how many parts each should be split into.

Each task keeps a bounded number of counters (Misra and Gries): when there are more keys, the counter of the first key too many is
taken off all, and keys at zero go. What is left is merged by adding. A counter is too low by no more than rows / counters, so no
key with more rows than that is missed, whatever the data is, and the result is as short as the number of counters allows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftwork.session import checkpointed


def key_mark(keys: Sequence[str]) -> Column:
    """A hash that stands for the key. Two keys of one hash are split alike, which does no harm."""
    return F.xxhash64(*keys)


def add_counts(marks: np.ndarray, counts: np.ndarray, more: np.ndarray, counters: int) -> tuple[np.ndarray, np.ndarray]:
    """The counters after some more marks; of equal length, at most ``counters``."""
    new, n = np.unique(more, return_counts=True)
    merged, at = np.unique(np.concatenate([marks, new]), return_inverse=True)
    total = np.bincount(at, weights=np.concatenate([counts, n]), minlength=len(merged)).astype(np.int64)
    if len(merged) > counters:
        total -= np.partition(total, len(total) - counters - 1)[len(total) - counters - 1]
        merged, total = merged[total > 0], total[total > 0]
    return merged, total


def _counted(counters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, counts, rows = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            marks, counts = add_counts(marks, counts, batch.column(0).to_numpy(), counters)
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([None, *marks.tolist()], pa.int64()), pa.array([rows, *counts.tolist()], pa.int64())], names=["mark", "n"]
            )

    return run


def salts_for_hot_keys(df: DataFrame, keys: Sequence[str], target: int | None = None) -> DataFrame:
    """Rows (mark, salts): for each key with more than ``target`` rows the number of parts of about ``target`` rows.

    ``target`` is, unless given, the even share of a shuffle partition, so that there are never more hot keys than partitions; ``df`` is
    read once, its key columns only. Counters are four for each part that all rows would make.
    """
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = df.select(*keys).dropna(how="any")
    if target is None:
        counters = 4 * partitions
    else:
        counters = max(16, 4 * -(-known.count() // max(1, target)))
    counts = checkpointed(
        known.select(key_mark(keys).alias("mark")).mapInArrow(_counted(counters), "mark long, n long")
        .groupBy("mark").agg(F.sum("n").alias("n"))
    )
    total = counts.where("mark IS NULL").select("n").first()
    rows = total["n"] if total else 0
    size = target or max(1, -(-rows // partitions))
    # What a counter may lack is added, so that parts are not too large.
    salts = F.ceil((F.col("n") + rows // counters) / size).cast("int")
    return counts.where("mark IS NOT NULL").where(F.col("n") > size - rows // counters).select("mark", salts.alias("salts")).where("salts > 1")


def spread(df: DataFrame, hot: DataFrame, keys: Sequence[str], row_id: str, salt: str = "__salt") -> DataFrame:
    """``df`` with the part of each row, 0 for all rows of keys that are not hot."""
    part = F.pmod(F.xxhash64(row_id), F.coalesce("salts", F.lit(1))).cast("int")
    return _with_salts(df, hot, keys).withColumn(salt, part).drop("salts")


def copied(df: DataFrame, hot: DataFrame, keys: Sequence[str], salt: str = "__salt") -> DataFrame:
    """``df`` with each row of a hot key once for each of its parts."""
    every = F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))
    return _with_salts(df, hot, keys).withColumn(salt, every).drop("salts")


def _with_salts(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    # Not more rows than four for each partition, or for each part of the target's size: two numbers each.
    return df.withColumn("mark", key_mark(keys)).join(F.broadcast(hot), "mark", "left").drop("mark")
