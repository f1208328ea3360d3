"""Time-window aggregations. Each works the same on a batch table and on a stream.

State of a stream grows with the number of open windows and keys. With a watermark (``late``) windows
are closed and dropped; without one, only complete and update output are possible and state is kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def event_time(df: DataFrame, column: str) -> DataFrame:
    """Watermarks need a timestamp with a time zone."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def windowed(
    df: DataFrame, time: str, size: str, aggregates: Sequence[Column], slide: str | None = None,
    keys: Sequence[str] = (), late: str | None = None,
) -> DataFrame:
    """Aggregates per window and keys, with the window's bounds as columns ``start`` and ``end``."""
    if late is not None:
        df = df.withWatermark(time, late)
    grouped = df.groupBy(F.window(time, size, slide), *keys).agg(*aggregates)
    return grouped.select(
        F.col("window.start").alias("start"), F.col("window.end").alias("end"),
        *[c for c in grouped.columns if c != "window"],
    )


def by_processing_time(df: DataFrame, size: str, text: str) -> DataFrame:
    """Characters that arrived per window of the clock."""
    timed = df.select(F.length(text).alias("chars"), F.current_timestamp().alias("processed"))
    return windowed(timed, "processed", size, [F.sum("chars").alias("characters")])


def word_value(df: DataFrame, time: str, word: str, size: str, slide: str, min_length: int = 10, value: int = 2,
               late: str | None = None) -> DataFrame:
    """Money per window: a fixed value for each long word."""
    long_words = df.where(F.length(word) >= min_length)
    return windowed(long_words, time, size, [F.sum(F.lit(value)).alias("money")], slide, late=late)


def mean_length(df: DataFrame, time: str, text: str, size: str = "5 seconds", late: str | None = None) -> DataFrame:
    return windowed(df, time, size, [F.avg(F.length(text)).alias("mean_length")], late=late)


def hashtag_counts(
    df: DataFrame, time: str, text: str, size: str = "60 seconds", slide: str = "10 seconds", late: str | None = None
) -> DataFrame:
    """Uses of each hashtag per window."""
    tags = df.select(time, F.explode(F.split(text, " ")).alias("tag")).where(F.col("tag").startswith("#"))
    return windowed(tags, time, size, [F.count("*").alias("n")], slide, ["tag"], late)


def most_used_first(counts: DataFrame) -> DataFrame:
    """For a finished table or a complete-mode stream; equal counts are in the order of the tag."""
    return counts.orderBy("start", F.desc("n"), "tag")
