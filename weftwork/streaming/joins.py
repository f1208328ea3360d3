"""Joins of streams.

Permitted outer sides. Stream with table: the outer side must be the stream (left outer and left semi
with the stream on the left, right outer with it on the right), since the table's unmatched rows are
never final. Stream with stream: inner without limits, left and right outer with watermarks on both sides
and a time bound, full outer likewise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.streaming.panes import seconds


def stream_table_join(stream: DataFrame, table: DataFrame, on, how: str = "inner") -> DataFrame:
    if how not in ("inner", "left", "left_semi"):
        raise ValueError("a stream on the left allows inner, left and left_semi joins to a table")
    return stream.join(table, on, how)


def table_stream_join(table: DataFrame, stream: DataFrame, on, how: str = "inner") -> DataFrame:
    """A table on the left; with ``right`` every row of the stream is kept."""
    if how not in ("inner", "right"):
        raise ValueError("a stream on the right allows inner and right joins to a table")
    return table.join(stream, on, how)


def stream_stream_join(
    left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str,
    within: str, late: str, how: str = "inner",
) -> DataFrame:
    """Rows with equal ``key`` where the right time is at most ``within`` after the left time.

    Both watermarks and the bound let Spark drop rows that can find no partner any more.
    """
    left = left.withWatermark(left_time, late)
    right = right.withWatermark(right_time, late).withColumnRenamed(key, f"right_{key}")
    bound = (F.col(right_time) >= F.col(left_time)) & (
        F.col(right_time) <= F.col(left_time) + F.expr(f"INTERVAL {within}")
    )
    return left.join(right, (F.col(key) == F.col(f"right_{key}")) & bound, how)


def interval_join(
    left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str,
    within: str, late: str, how: str = "inner",
) -> DataFrame:
    """The rows of ``stream_stream_join`` for inner and left joins, with the state of a key spread over time buckets.

    Buckets are as long as ``within``. A row on the left is in the bucket of its time, one on the right in that of its time
    and in the one before, so two rows within the bound meet in exactly one. State and shuffle are by (key, bucket): a key with a
    third of all rows is a state key for each bucket, in as many tasks, and not one that holds all its rows.
    """
    if how not in ("inner", "left"):
        raise ValueError("rows on the right are in two buckets; only inner and left joins are possible")
    micros = seconds(within) * 1_000_000

    def bucket(time: str):
        return F.floor(F.unix_micros(time) / F.lit(micros))

    left = left.withWatermark(left_time, late).withColumn("__bucket", bucket(left_time))
    right = (
        right.withWatermark(right_time, late).withColumnRenamed(key, f"right_{key}")
        .withColumn("__right_bucket", F.explode(F.array(bucket(right_time) - 1, bucket(right_time))))
    )
    bound = (F.col(right_time) >= F.col(left_time)) & (F.col(right_time) <= F.col(left_time) + F.expr(f"INTERVAL {within}"))
    same = (F.col(key) == F.col(f"right_{key}")) & (F.col("__bucket") == F.col("__right_bucket"))
    return left.join(right, same & bound, how).drop("__bucket", "__right_bucket")
