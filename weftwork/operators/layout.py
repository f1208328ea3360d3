"""Sorting, limits, partitioning, caching, set operations and removal of duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftwork.session import checkpointed
from weftwork.sources.files import partitions_for


def top_k(df: DataFrame, order: Sequence[str | Column], k: int) -> DataFrame:
    """The first ``k`` rows of a total order: each task keeps ``k``, and only these are merged."""
    return df.orderBy(*order).limit(k)


def range_sorted(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Rows in key ranges, each range sorted: globally sorted, without a final merge."""
    ranged = df.repartitionByRange(partitions, key) if partitions else df.repartitionByRange(key)
    return ranged.sortWithinPartitions(key)


def range_sorted_evenly(df: DataFrame, order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Like ``range_sorted``, but rows of one value may lie in several ranges, so that a frequent value fills no task.

    Borders are sampled over ``order`` and then a hash of the whole row. Only rows that are equal in all columns have to stay
    together. The hash is the same when a lost task runs again.
    """
    tie = "__tie"
    tied = df.withColumn(tie, F.xxhash64(*df.columns))
    keys = [*order, tie]
    ranged = tied.repartitionByRange(partitions, *keys) if partitions else tied.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys).drop(tie)


def range_placement(ranged: DataFrame, key: str) -> DataFrame:
    """(key, rows, tasks, ordered): in how many tasks a value lies, and if no other value lies in the tasks between its first and last."""
    # Written down, as borders are sampled anew each time that ``ranged`` runs.
    placed = checkpointed(ranged.groupBy(key, F.spark_partition_id().alias("task")).agg(F.count("*").alias("rows")))
    values = placed.groupBy(key).agg(
        F.sum("rows").alias("rows"), F.count("*").alias("tasks"), F.min("task").alias("first"), F.max("task").alias("last")
    )
    # Tasks between the first and the last one of a value hold no other value.
    before = placed.groupBy("task").agg(F.min(key).alias("least"), F.max(key).alias("most"))
    inside = values.join(before, (F.col("task") > F.col("first")) & (F.col("task") < F.col("last")), "left")
    return inside.groupBy(key, "rows", "tasks").agg(
        F.coalesce(F.bool_and((F.col("least") == F.col(key)) & (F.col("most") == F.col(key))), F.lit(True)).alias("ordered")
    )


def hash_partitioned(df: DataFrame, partitions: int, *keys: str) -> DataFrame:
    return df.repartition(partitions, *keys)


def partitioned_by_length(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """Rows placed by the length of a string, not by its hash."""
    return df.repartitionById(partitions, F.pmod(F.length(key), F.lit(partitions)).cast("int"))


def resized(df: DataFrame, partitions: int, shuffle: bool = True) -> DataFrame:
    """Even partitions by a shuffle, or fewer partitions by merging neighbours without one."""
    return df.repartition(partitions) if shuffle else df.coalesce(partitions)


def sized_for(df: DataFrame, total_bytes: int, target_bytes: int = 64 * 1024 * 1024) -> DataFrame:
    return df.repartition(partitions_for(total_bytes, target_bytes))


def kept(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """``df`` held for reuse; call ``unpersist`` when done. It may spill, so its size is not a limit."""
    return df.persist(level)


def union_all(*frames: DataFrame, by_name: bool = False) -> DataFrame:
    first, *rest = frames
    for df in rest:
        first = first.unionByName(df) if by_name else first.union(df)
    return first


def union_distinct(*frames: DataFrame) -> DataFrame:
    return union_all(*frames).distinct()


def first_of_duplicates(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """One row per key, the first by ``order``; unlike ``dropDuplicates`` always the same one.

    Only ``columns``, by default all, the keys and the order are read.
    """
    columns = list(columns or df.columns)
    rest = [c for c in columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("__first")
    return df.groupBy(*keys).agg(first).select(*keys, "__first.*").select(*columns)
