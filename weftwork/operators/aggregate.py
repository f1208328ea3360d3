"""Aggregations. All of them combine on the map side before they shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftwork.session import checkpointed


def exact_sum(column: str | Column, scale: int | None = None) -> Column:
    """A sum in the column's own type; with ``scale`` one of doubles rounded to that many places.

    Rounded doubles are summed as decimals, so that the sum does not depend on the order of addition. That is for
    amounts known to have no more places.
    """
    value = F.col(column) if isinstance(column, str) else column
    return F.sum(value) if scale is None else F.sum(value.cast(f"decimal(28,{scale})")).cast("double")


def profile(df: DataFrame, column: str, threshold: float) -> DataFrame:
    """Count, threshold, mean, sample deviation, smallest and largest value, in one pass."""
    return df.agg(
        F.count("*").alias("count"),
        F.lit(threshold).alias("threshold"),
        F.mean(column).alias("mean"),
        F.stddev_samp(column).alias("stddev"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )


def latest_row(df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``columns`` of the last row per key in the order of ``order``, without sorting the groups."""
    last = F.max_by(F.struct(*columns), F.struct(*order)).alias("__last")
    return df.groupBy(*keys).agg(last).select(*keys, "__last.*")


def count_groups(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def words_of(df: DataFrame, text: str, keep: Sequence[str] = (), pattern: str = "\\s+") -> DataFrame:
    """One row per non-empty word."""
    return df.select(*keep, F.explode(F.split(text, pattern)).alias("word")).where("word != ''")


def word_counts(
    df: DataFrame, text: str, only: Sequence[str] | None = None, top: int | None = None
) -> DataFrame:
    """How often each word occurs; of a given list only, if one is given; the ``top`` most frequent."""
    words = words_of(df, text)
    if only is not None:
        words = words.where(F.col("word").isin(list(only)))
    counts = count_groups(words, "word")
    return counts if top is None else counts.orderBy(F.desc("n"), "word").limit(top)


def largest_part_count(df: DataFrame, part: str, text: str) -> DataFrame:
    """Occurrences per word within each part, then the largest of them per word."""
    return (
        count_groups(words_of(df, text, [part]), part, "word")
        .groupBy("word").agg(F.max("n").alias("max_n"))
    )


def text_stats(df: DataFrame, source: str, text: str, critical: str) -> DataFrame:
    """Per source: lines, words, length of the longest word, occurrences of a critical word.

    The words stay inside their row as an array; only four numbers per source are shuffled.
    """
    words = F.filter(F.split(text, "\\s+"), lambda w: w != "")
    return (
        df.select(source, words.alias("__w"))
        .groupBy(source)
        .agg(
            F.count("*").alias("lines"),
            F.sum(F.size("__w")).alias("words"),
            F.max(F.array_max(F.transform("__w", lambda w: F.length(w)))).alias("longest_word"),
            F.sum(F.size(F.filter("__w", lambda w: w == critical))).alias("critical_words"),
        )
    )


def repeat_histogram(df: DataFrame, batch: str, key: str) -> DataFrame:
    """Occurrences per (batch, key), the largest per key, and how many keys have each largest."""
    per_key = (
        count_groups(df, batch, key).groupBy(key).agg(F.max("n").alias("multiplier"))
    )
    return per_key.groupBy("multiplier").agg(F.count("*").alias("cnt"))


def sum_numeric(df: DataFrame, group: Column, name: str, scale: int | None = None) -> DataFrame:
    """Sums of every numeric column per group. Names are kept with a ``sum_`` before them.

    With ``scale`` floating columns are rounded to that many places before they are added, as in ``exact_sum``.
    """
    floating = (T.DoubleType, T.FloatType)
    sums = [
        exact_sum(f.name, scale if isinstance(f.dataType, floating) else None).alias(f"sum_{f.name}")
        for f in df.schema.fields if isinstance(f.dataType, T.NumericType)
    ]
    return df.groupBy(group.alias(name)).agg(*sums)


def collect_lists(
    df: DataFrame, keys: str | Sequence[str], value: str, row_id: str | None = None, length: int = 10_000
) -> DataFrame:
    """The sorted values of each key in slices of ``length`` elements, the last one shorter, numbered by ``part`` from 0.

    The rule is the same for keys of any size. Rows are put into one order, cut into ranges of even size wherever keys
    begin and end; a value's place is its place in its range plus what the key's earlier ranges hold. So no group is
    gathered in one task. ``row_id`` tells equal values apart, for a value that repeats very often. Null values are
    left out, null keys are a key.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [*keys, value, *([row_id] if row_id and row_id not in (*keys, value) else [])]
    placed = checkpointed(
        df.where(F.col(value).isNotNull()).select(*order).repartitionByRange(*order)
        .select(*keys, value, F.spark_partition_id().alias("__range"))
    )
    earlier = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy(*keys, "__range").agg(F.count("*").alias("__n")).select(
        *[F.col(k).alias(f"__{k}") for k in keys], F.col("__range").alias("__of"),
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__start"),
    )
    same = F.col("__range") == F.col("__of")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"__{k}"))
    within = F.row_number().over(Window.partitionBy(*keys, "__range").orderBy(value))
    part = F.floor((F.col("__start") + F.col("__place") - 1) / length).cast("int").alias("part")
    return (
        placed.withColumn("__place", within).join(starts, same).select(*keys, value, part)
        .groupBy(*keys, "part").agg(F.sort_array(F.collect_list(value)).alias("collected"))
    )


def collect_distinct(df: DataFrame, keys: str | Sequence[str], value: str, length: int = 10_000) -> DataFrame:
    """Sorted distinct values per key, in slices as in ``collect_lists``.

    Repeats go first, map-side, and what is left is placed by ranges, so neither the rows nor the values of a key meet in one task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return collect_lists(df.select(*keys, value).distinct(), keys, value, length=length)


def integer_mean(column: str, name: str) -> Column:
    """Sum divided by count, truncated to a whole number."""
    return F.expr(f"sum(`{column}`) div count(*)").alias(name)


def summary(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, smallest and largest value, as text rows."""
    return df.describe(column)


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """``df`` unchanged, with aggregates that are known once any action has run over it."""
    watch = Observation(name)
    return df.observe(watch, *[m.alias(n) for n, m in metrics.items()]), watch


def top_per_group(df: DataFrame, group: str, item: str, total: str) -> DataFrame:
    """The item with the largest total per group; among equals the smallest item."""
    best = F.min_by(F.struct(item, total), F.struct(-F.col(total), F.col(item))).alias("__best")
    return df.groupBy(group).agg(best).select(group, "__best.*")
