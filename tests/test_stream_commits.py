"""Sinks that hold each row once: batches that come twice, and batches that die half-way."""

import os
import sys
from collections import Counter

import pytest
from pyspark import cloudpickle
from pyspark.errors import StreamingQueryException

from weftwork.session import scratch_path
from weftwork.streaming import commits, sinks, sources

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers do not have the test folder on their path


def lines_in_files(spark, count=6):
    folder = scratch_path(spark, "in")
    os.makedirs(folder)
    for i in range(count):
        with open(f"{folder}/{i}.txt", "w") as f:
            f.write("".join(f"{i}-{k}\n" for k in range(20)) + "same\n" * 3)
    return folder, Counter({**{f"{i}-{k}": 1 for i in range(count) for k in range(20)}, "same": 3 * count})


def restarted(start):
    """Start a query again until it ends by itself; returns how often it failed."""
    failures = 0
    while True:
        try:
            start().awaitTermination()
            return failures
        except StreamingQueryException:
            failures += 1
            assert failures < 20


def values(df):
    return Counter(r.value for r in df.collect())


@pytest.mark.parametrize("where", ["before", "staged", "committed"])
def test_folder_sink_when_batches_die(spark, where):
    folder, expected = lines_in_files(spark)
    sink, checkpoint, died = commits.FolderSink(spark, scratch_path(spark, "out"), "s"), scratch_path(spark, "ckpt"), set()

    def write(batch, batch_id):
        first = batch_id not in died
        died.add(batch_id)
        if first and where == "staged":
            sink.stage(batch, batch_id)
        if first and where == "committed":
            sink.write(batch, batch_id)
        if first:
            raise InterruptedError
        sink.write(batch, batch_id)

    def start():
        return sinks.start_batches(sources.file_stream(spark, folder, "value string", "text", files_per_batch=2), write, checkpoint)

    assert restarted(start) == 3
    assert values(sink.read("value string")) == expected


def test_folder_sink_of_nothing_and_of_two_streams(spark):
    path = scratch_path(spark, "out")
    one, two = commits.FolderSink(spark, path, "one"), commits.FolderSink(spark, path, "two", "json")
    assert one.read("id long").count() == 0
    for sink, rows in ((one, spark.range(3)), (two, spark.range(5)), (one, spark.range(3))):
        sink.write(rows, 0)
    assert one.read("id long").count() == 3 and two.read("id long").count() == 5
    assert not one.ledger.record("one", 0, "elsewhere") and len(one.ledger.places("one")) == 1


class Tables:
    """Rows by table, and transactions that can die between two statements."""

    def __init__(self):
        self.tables, self.dies = {"target": []}, 0

    def stage(self, batch, name):
        self.tables[name] = [r.value for r in batch.collect()]

    def commit(self, statements):
        delete, insert = statements
        after = dict(self.tables)
        assert delete.startswith("DELETE FROM target WHERE stream = 's' AND batch_id = ")
        batch_id = int(delete.rsplit(" ", 1)[1])
        after["target"] = [r for r in after["target"] if r[1] != batch_id]
        if self.dies:
            self.dies -= 1
            raise InterruptedError
        assert insert == f"""INSERT INTO target ("value", stream, batch_id) SELECT "value", 's', {batch_id} FROM target_staged"""
        after["target"] = after["target"] + [(v, batch_id) for v in after["target_staged"]]
        self.tables = after


def test_table_sink_replaces_what_it_has_of_a_batch(spark):
    store = Tables()
    sink = commits.TableSink("target", "s", store.stage, store.commit)
    first, second = (spark.createDataFrame([(v,) for v in vs], "value string") for vs in (["a", "a", "b"], ["c"]))
    sink.write(first, 0)
    sink.write(first, 0)
    store.dies = 1
    with pytest.raises(InterruptedError):
        sink.write(second, 1)
    assert sorted(store.tables["target"]) == [("a", 0), ("a", 0), ("b", 0)]
    sink.write(second, 1)
    sink.write(first, 0)
    assert sorted(store.tables["target"]) == [("a", 0), ("a", 0), ("b", 0), ("c", 1)]


def test_table_sink_statements_on_an_engine():
    import duckdb

    con = duckdb.connect()
    con.execute("""CREATE TABLE t ("odd "" name" INT, stream VARCHAR, batch_id BIGINT)""")
    con.execute("""CREATE TABLE st AS SELECT 7 AS "odd "" name" """)
    for batch_id in (0, 1, 0):
        for statement in commits.replacement("t", "st", ['odd " name'], "it's", batch_id):
            con.execute(statement)
    assert sorted(con.execute("SELECT * FROM t").fetchall()) == [(7, "it's", 0), (7, "it's", 1)]


def test_row_keys_are_the_same_again(spark):
    rows = [("a", 1), ("a", 1), ("a", None), (None, None), (None, None), (None, None)]
    batch = spark.createDataFrame(rows, "k string, n int")
    keys = [sorted(r.row_key for r in commits.with_row_keys(batch.repartition(n), "s", 4).collect()) for n in (1, 5)]
    assert keys[0] == keys[1] and len(set(keys[0])) == len(rows)
    assert Counter((r.k, r.n) for r in commits.with_row_keys(batch, "s", 4).collect()) == Counter(rows)


def test_connector_sink_writes_keys(spark):
    out = scratch_path(spark, "out")
    write = commits.connector_sink("parquet", "s", path=out)
    batch = spark.createDataFrame([("a",), ("a",)], "value string")
    write(batch, 0)
    write(batch, 0)
    found = spark.read.parquet(out)
    assert found.count() == 4 and found.dropDuplicates(["stream", "batch_id", "row_key"]).count() == 2
    plain = scratch_path(spark, "out")
    commits.connector_sink("parquet", "s", keyed=True, path=plain)(batch, 0)
    assert spark.read.parquet(plain).columns == ["value"]


class Folder:
    """A row store of files: drafts until they are committed."""

    def __init__(self, path):
        self.path = path

    def _name(self, pair, end):
        return f"{self.path}/{pair[1]}-{pair[0]}.{end}"

    def committed(self, pair):
        return os.path.exists(self._name(pair, "done"))

    def discard(self, pair):
        if os.path.exists(self._name(pair, "draft")):
            os.truncate(self._name(pair, "draft"), 0)

    def add(self, pair, rows):
        with open(self._name(pair, "draft"), "a") as f:
            f.write("".join(r.value + "\n" for r in rows))

    def commit(self, pair):
        if not os.path.exists(self._name(pair, "draft")):
            open(self._name(pair, "draft"), "w").close()
        os.rename(self._name(pair, "draft"), self._name(pair, "done"))


class DyingFolder(Folder):
    """The first attempt of each pair dies after it has added some rows."""

    def add(self, pair, rows):
        super().add(pair, rows)
        mark = self._name(pair, "died")
        if not os.path.exists(mark):
            open(mark, "w").close()
            raise InterruptedError


class Row:
    def __init__(self, value):
        self.value = value


def test_row_writer_holds_each_row_once(tmp_path):
    store = Folder(str(tmp_path))
    writer = commits.CommittedRowWriter(store, size=2)

    def attempt(pair, count, error=None):
        if not writer.open(*pair):
            writer.close(None)
            return False
        for i in range(count):
            writer.process(Row(f"{pair}-{i}"))
        writer.close(error)
        return True

    assert attempt((0, 0), 5, ValueError())
    assert attempt((0, 0), 5) and not attempt((0, 0), 5)
    assert attempt((1, 0), 0) and not attempt((1, 0), 0)
    lines = [line for p in tmp_path.glob("*.done") for line in p.read_text().split("\n") if line]
    assert sorted(lines) == [f"(0, 0)-{i}" for i in range(5)]


def test_row_writer_in_a_stream_that_dies(spark, tmp_path):
    folder, expected = lines_in_files(spark, 3)
    checkpoint = scratch_path(spark, "ckpt")

    def start():
        stream = sources.file_stream(spark, folder, "value string", "text", files_per_batch=1)
        return sinks.start_rows(stream, commits.CommittedRowWriter(DyingFolder(str(tmp_path)), 4), checkpoint)

    assert restarted(start) >= 1
    assert Counter(line for p in tmp_path.glob("*.done") for line in p.read_text().split()) == expected


def test_jdbc_sink_is_built_for_a_table(spark):
    from weftwork.sources.jdbc import JdbcTarget

    sink = commits.jdbc_sink(spark, JdbcTarget("jdbc:none", "none.Driver"), "public.cars", "cars")
    assert (sink.table, sink.staged, sink.stream) == ("public.cars", "public.cars_staged_cars", "cars")
    with pytest.raises(Exception, match="none.Driver"):
        sink.commit(["SELECT 1"])
