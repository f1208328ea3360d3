"""Sinks that hold each row once, although a batch may be written twice or die half-way.

Structured Streaming runs a batch again if it cannot know that the batch ended. What a stream writes must then be named after
(stream, batch), not after the attempt. Three ways, by what the target can do:

* files: an attempt is a folder of its own, which nobody reads until a ledger entry for (stream, batch) names it;
* a database with transactions: the batch goes to a staging table, and one transaction deletes the rows of (stream, batch) and inserts it;
* a store that only replaces rows of equal primary key: rows get a key that the same batch gives again.

Row-at-a-time writers do the same for (partition, epoch). Spark repeats an epoch with the same partitions only
if its source does, as files and message logs do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftwork.sources.jdbc import JdbcTarget, transaction, write_table


class FolderLedger:
    """What has been committed: one small file for each (stream, batch), made by a rename, in any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, stream: str, batch_id: int):
        return self._path(f"{self.path}/{stream}/{batch_id}")

    def find(self, stream: str, batch_id: int) -> bool:
        return self._files.exists(self._at(stream, batch_id))

    def record(self, stream: str, batch_id: int, place: str) -> bool:
        """Whether this attempt is the one that counts; false if there was one before."""
        if self.find(stream, batch_id):
            return False
        draft = self._path(f"{self.path}/.draft-{uuid.uuid4().hex}")
        out = self._files.create(draft, False)
        out.write(bytearray(json.dumps({"batch": batch_id, "place": place}).encode() + b"\n"))
        out.close()
        self._files.mkdirs(self._path(f"{self.path}/{stream}"))
        return self._files.rename(draft, self._at(stream, batch_id))

    def places(self, stream: str) -> list[str]:
        """The folders of committed batches: one name for each batch."""
        if not self._files.exists(self._path(f"{self.path}/{stream}")):
            return []
        rows = self.spark.read.schema("batch long, place string").json(f"{self.path}/{stream}").orderBy("batch").collect()
        return [r["place"] for r in rows]


class FolderSink:
    """Batches of a stream as files. ``write`` is for ``foreachBatch``; ``read`` returns the rows of committed batches only."""

    def __init__(self, spark: SparkSession, path: str, stream: str, fmt: str = "parquet"):
        self.spark, self.path, self.stream, self.fmt = spark, path.rstrip("/"), stream, fmt
        self.ledger = FolderLedger(spark, f"{self.path}/ledger")

    def stage(self, batch: DataFrame, batch_id: int) -> str:
        """The batch written where no reader looks; returns the name of this attempt."""
        place = f"{self.stream}/{batch_id}-{uuid.uuid4().hex}"
        batch.write.format(self.fmt).save(f"{self.path}/attempts/{place}")
        return place

    def write(self, batch: DataFrame, batch_id: int) -> None:
        if not self.ledger.find(self.stream, batch_id):
            self.ledger.record(self.stream, batch_id, self.stage(batch, batch_id))

    def read(self, schema) -> DataFrame:
        places = [f"{self.path}/attempts/{place}" for place in self.ledger.places(self.stream)]
        if not places:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).format(self.fmt).load(places)


def replacement(table: str, staged: str, columns: Sequence[str], stream: str, batch_id: int) -> list[str]:
    """Statements of the transaction that puts a staged batch in the place of what the table has of it."""
    quoted = ", ".join('"' + c.replace('"', '""') + '"' for c in columns)
    name = stream.replace("'", "''")
    return [
        f"DELETE FROM {table} WHERE stream = '{name}' AND batch_id = {int(batch_id)}",
        f"INSERT INTO {table} ({quoted}, stream, batch_id) SELECT {quoted}, '{name}', {int(batch_id)} FROM {staged}",
    ]


class TableSink:
    """Batches of a stream in a database table that has the columns ``stream`` and ``batch_id`` beside those of the rows.

    ``stage`` overwrites a table with a batch, in parallel and without a transaction. ``commit`` runs statements in one
    transaction on one connection. What dies before the commit leaves the table as it was.
    """

    def __init__(
        self, table: str, stream: str, stage: Callable[[DataFrame, str], None], commit: Callable[[list[str]], None], staged: str | None = None
    ):
        self.table, self.stream, self.stage, self.commit = table, stream, stage, commit
        self.staged = staged or f"{table}_staged"

    def write(self, batch: DataFrame, batch_id: int) -> None:
        self.stage(batch, self.staged)
        self.commit(replacement(self.table, self.staged, batch.columns, self.stream, batch_id))


def jdbc_sink(spark: SparkSession, target: JdbcTarget, table: str, stream: str) -> TableSink:
    return TableSink(
        table, stream, lambda batch, staged: write_table(batch, target, staged, "overwrite"),
        lambda statements: transaction(spark, target, statements), f"{table}_staged_{stream}",
    )


def with_row_keys(batch: DataFrame, stream: str, batch_id: int) -> DataFrame:
    """``batch`` with stream, batch_id and row_key, which together name a row and come out the same when the batch is repeated.

    The key is a hash of the row's values, and a number that tells equal rows apart. Equal rows are counted map-side,
    so that very many of them meet in no task. Columns of type map cannot be compared and are not allowed.
    """
    counted = batch.groupBy(*batch.columns).agg(F.count("*").alias("__copies"))
    rows = counted.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "__copies")))
    # Options keep null fields apart from absent ones.
    values = F.to_json(F.struct(*batch.columns), {"ignoreNullFields": "false"})
    return rows.select(
        *batch.columns, F.lit(stream).alias("stream"), F.lit(batch_id).cast("long").alias("batch_id"),
        F.concat_ws("-", F.sha2(values, 256), F.col("__copy")).alias("row_key"),
    )


def connector_sink(fmt: str, stream: str, keyed: bool = False, **options) -> Callable[[DataFrame, int], None]:
    """Batches through a connector to a store where a row of equal primary key replaces the one before.

    ``keyed`` says that the rows hold their primary key; else it is (stream, batch_id, row_key), which are added.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch if keyed else with_row_keys(batch, stream, batch_id)
        rows.write.format(fmt).options(**options).mode("append").save()

    return write


class RowStore(Protocol):
    """Where ``CommittedRowWriter`` puts rows; ``pair`` is (partition, epoch). Rows added count once ``commit`` has returned."""

    def committed(self, pair: tuple[int, int]) -> bool: ...

    def discard(self, pair: tuple[int, int]) -> None: ...

    def add(self, pair: tuple[int, int], rows: list) -> None: ...

    def commit(self, pair: tuple[int, int]) -> None: ...


class CommittedRowWriter:
    """For ``foreach``: skips a (partition, epoch) that is committed, and drops what an attempt that died has left of it."""

    def __init__(self, store: RowStore, size: int = 500):
        self.store, self.size = store, size
        self.pair: tuple[int, int] | None = None
        self.rows: list = []

    def open(self, partition_id: int, epoch_id: int) -> bool:
        pair = (partition_id, epoch_id)
        self.pair, self.rows = None, []
        if self.store.committed(pair):
            return False
        self.store.discard(pair)
        self.pair = pair
        return True

    def process(self, row) -> None:
        self.rows.append(row)
        if len(self.rows) >= self.size:
            self._flush()

    def close(self, error) -> None:
        if self.pair is None or error is not None:
            return
        self._flush()
        self.store.commit(self.pair)

    def _flush(self) -> None:
        if self.rows:
            self.store.add(self.pair, self.rows)
            self.rows = []
