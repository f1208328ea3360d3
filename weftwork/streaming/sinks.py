"""Stream sinks, triggers and progress.

A batch may be written twice after a failure. ``batch_files`` overwrites a folder that is named after the batch, so that a repeated
batch leaves the same data. ``BufferedRowWriter`` may send rows again; sinks of ``commits`` hold each row once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import TimestampType

from weftwork.session import scratch_path

TRIGGERS = {
    "once": {"availableNow": True},
    "every": lambda interval: {"processingTime": interval},
    "continuous": lambda interval: {"continuous": interval},
}


def trigger_options(kind: str, interval: str | None = None) -> dict:
    """Arguments for ``trigger``: all that is there and stop, a fixed interval, or continuous."""
    options = TRIGGERS[kind]
    return options if isinstance(options, dict) else options(interval)


def start_console(df: DataFrame, mode: str = "append", **trigger) -> StreamingQuery:
    writer = df.writeStream.format("console").outputMode(mode).option("truncate", False)
    return (writer.trigger(**trigger) if trigger else writer).start()


def start_batches(
    df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append", **trigger
) -> StreamingQuery:
    """Calls ``write(batch, batch_id)`` for each micro-batch."""
    return (
        df.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def batch_files(path: str, fmt: str = "json") -> Callable[[DataFrame, int], None]:
    """Each batch in its own numbered folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path}/batch={batch_id}")

    return write


class RowSink(Protocol):
    """What ``foreach`` wants; one object per partition and batch."""

    def open(self, partition_id: int, epoch_id: int) -> bool: ...
    def process(self, row) -> None: ...
    def close(self, error) -> None: ...


class BufferedRowWriter:
    """Collects rows and hands them to ``send`` in groups, so that a store is not called per row."""

    def __init__(self, send: Callable[[list], None], size: int = 500):
        self.send = send
        self.size = size
        self.rows: list = []

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self.rows = []
        return True

    def process(self, row) -> None:
        self.rows.append(row)
        if len(self.rows) >= self.size:
            self._flush()

    def close(self, error) -> None:
        if error is None:
            self._flush()

    def _flush(self) -> None:
        if self.rows:
            self.send(self.rows)
            self.rows = []


def start_rows(df: DataFrame, sink: RowSink, checkpoint: str, **trigger) -> StreamingQuery:
    return (
        df.writeStream.foreach(sink).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def to_key_value(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """Message payload: the key in upper case, and the columns as JSON."""
    return df.select(F.upper(key).alias("key"), F.to_json(F.struct(*columns)).alias("value"))


def start_messages(payload: DataFrame, servers: str, topic: str, checkpoint: str, **trigger) -> StreamingQuery:
    writer = payload.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def watermark_of(query: StreamingQuery) -> dict | None:
    """Largest, smallest and mean event time and the watermark of the last batch."""
    progress = query.lastProgress
    return None if progress is None else progress["eventTime"]


def run_to_table(df: DataFrame, mode: str = "append") -> DataFrame:
    """Run a stream over all that is there now, and read back what it wrote.

    Append goes to a parquet table. A complete-mode result is one table per batch; the last is read.
    """
    spark = df.sparkSession
    out, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "stream-checkpoint")
    if mode == "append":
        query = (
            df.writeStream.format("parquet").outputMode("append").option("path", out)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return naive(spark.read.schema(df.schema).parquet(out))
    last: list[int] = []
    save = batch_files(out, "parquet")

    def write(batch: DataFrame, batch_id: int) -> None:
        save(batch, batch_id)
        last.append(batch_id)

    start_batches(df, write, checkpoint, mode).awaitTermination()
    if not last:
        return naive(spark.createDataFrame([], df.schema))
    return naive(spark.read.schema(df.schema).parquet(f"{out}/batch={last[-1]}"))


def run_in_steps(build: Callable[[DataFrame], DataFrame], slices: Sequence[DataFrame]) -> tuple[DataFrame, list[dict]]:
    """Feed slices of rows to an append-mode stream, one after the other, and read back what it wrote, with the progress of its batches.

    ``build`` makes the result from the stream of rows. Each slice is written, and the query started again where it had stopped until
    it has read the slice, so a slice never shares a batch with the next one, and watermarks move from slice to slice.
    """
    spark = slices[0].sparkSession
    arrivals, out, checkpoint = (scratch_path(spark, label) for label in ("arrivals", "stream", "stream-checkpoint"))
    progress: list[dict] = []
    for rows in slices:
        rows.write.mode("append").parquet(arrivals)
        result = build(spark.readStream.schema(rows.schema).parquet(arrivals))
        query = (
            result.writeStream.format("parquet").outputMode("append").option("path", out)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        progress.extend(query.recentProgress)
    return naive(spark.read.schema(result.schema).parquet(out)), progress


def naive(df: DataFrame) -> DataFrame:
    """Timestamps without zone."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


def read_batches(spark: SparkSession, path: str, schema, fmt: str = "json") -> DataFrame:
    """Everything that ``batch_files`` has written, with the batch number."""
    return spark.read.schema(schema).format(fmt).load(path)
