"""Streams fed file by file, sinks, triggers and parsing."""

import os
import time

import pytest
from pyspark.sql import functions as F

from weftwork.session import scratch_path
from weftwork.sources.jdbc import JdbcTarget, KeyRange
from weftwork.streaming import joins, sinks, sources, windows


def feed(spark, batches, build, mode="append"):
    """Run ``build(lines)`` with one file of text lines per batch; returns the rows written."""
    folder, out = scratch_path(spark, "lines"), scratch_path(spark, "out")
    os.makedirs(folder)
    lines = sources.file_stream(spark, folder, "value string", "text")
    df = build(lines)
    query = sinks.start_batches(
        df, sinks.batch_files(out), scratch_path(spark, "ckpt"), mode, processingTime="0 seconds"
    )
    for number, batch in enumerate(batches):
        part = os.path.join(folder, f".{number}.tmp")
        with open(part, "w") as f:
            f.write("\n".join(batch) + "\n")
        os.rename(part, os.path.join(folder, f"{number}.txt"))
        query.processAllAvailable()
    query.stop()
    return sinks.read_batches(spark, out, df.schema).collect(), query


SEQUENCES = {
    "first": (
        [["7000,blue"], ["8000,green"], ["14000,blue"], ["9000,red"], ["15000,red", "8000,blue"],
         ["13000,green", "21000,green"], ["4000,purple"], ["17000,green"]],
        {(6, "blue"), (8, "green"), (12, "green"), (14, "blue"), (14, "red")},
    ),
    "second": (
        [["5000,red", "5000,green", "4000,blue"], ["1000,yellow", "2000,cyan", "3000,magenta", "5000,black"], ["10000,pink"]],
        {(4, "red"), (4, "green"), (4, "blue"), (4, "black"), (2, "cyan"), (2, "magenta")},
    ),
    "third": (
        [["9000,blue"], ["2000,green", "1000,blue", "8000,red"], ["5000,red", "18000,blue"], ["2000,green"],
         ["30000,purple", "10000,green"]],
        {(8, "blue"), (8, "red"), (18, "blue")},
    ),
}


@pytest.mark.parametrize("name", list(SEQUENCES))
def test_watermark_sequences(spark, name):
    batches, expected = SEQUENCES[name]

    def build(lines):
        return windows.windowed(
            sources.colour_events(lines), "created", "2 seconds", [F.count("*").alias("n")],
            keys=["color"], late="2 seconds",
        )

    rows, query = feed(spark, batches, build)
    assert {(int(r.start.timestamp()), r.color) for r in rows} == expected
    assert all(r.n == 1 for r in rows)
    assert query.exception() is None


def test_progress_shows_watermark(spark):
    def build(lines):
        return windows.windowed(
            sources.colour_events(lines), "created", "2 seconds", [F.count("*").alias("n")], late="2 seconds"
        )

    _, query = feed(spark, [["7000,blue"], ["9000,red"]], build)
    assert any(p["eventTime"].get("watermark", "").startswith("1970-01-01T00:00:07") for p in query.recentProgress)
    assert sinks.watermark_of(query) is not None


def test_windows_same_on_batch_and_stream(spark, small):
    table = windows.event_time(spark.read.parquet(f"{small}/events.parquet"), "ts")
    stream = windows.event_time(
        sources.file_stream(spark, small, spark.read.parquet(f"{small}/events.parquet").schema, "parquet", glob="events.parquet"),
        "ts",
    )

    def job(df):
        return windows.windowed(df, "ts", "1 day", [F.sum("user_id").alias("s")], "6 hours", ["event_type"])

    ran = sinks.run_to_table(job(stream), "complete")
    assert sorted(map(tuple, ran.collect())) == sorted(map(tuple, sinks.naive(job(table)).collect()))


def test_state_on_disk(spark):
    """The state store of cluster sessions gives the same counts."""
    from weftwork.session import _CLUSTER_CONF

    for name, value in _CLUSTER_CONF.items():
        spark.conf.set(name, value)
    try:
        test_watermark_sequences(spark, "second")
    finally:
        for name in _CLUSTER_CONF:
            spark.conf.unset(name)


def test_empty_stream(spark):
    folder = scratch_path(spark, "nothing")
    os.makedirs(folder)
    lines = sources.file_stream(spark, folder, "value string", "text")
    assert sinks.run_to_table(lines).count() == 0
    assert sinks.run_to_table(lines.groupBy("value").count(), "complete").count() == 0


def test_word_count_stream(spark):
    rows, _ = feed(
        spark, [["a b a"], ["b c"]],
        lambda lines: sources.words(lines).groupBy("word").agg(F.count("*").alias("n")), "complete",
    )
    assert {("a", 2), ("b", 2), ("c", 1)} <= {(r.word, r.n) for r in rows}


def test_people_parsing(spark):
    lines = spark.createDataFrame([("7:Ann:B:Cole:F:1980-01-02:123:500",), ("x:broken",)], "value string")
    rows = sources.people(lines).collect()
    assert rows[0].id == 7 and rows[0].salary == 500 and rows[0].last_name == "Cole"
    assert rows[1].id is None and rows[1].first_name == "broken" and rows[1].salary is None
    assert [r.name for r in sources.names_of(sources.people(lines).limit(1)).collect()] == ["Ann", "Cole"]


def test_decode_and_payload(spark):
    raw = spark.createDataFrame([("t", bytearray(b"k"), bytearray(b"v"))], "topic string, key binary, value binary")
    assert tuple(sources.decode(raw).first()) == ("t", "k", "v")
    cars = spark.createDataFrame([("ford", 130)], "Name string, Horsepower long")
    assert tuple(sinks.to_key_value(cars, "Name", "Name", "Horsepower").first()) == (
        "FORD", '{"Name":"ford","Horsepower":130}',
    )
    assert sources.topic_options("h:1", "a,b", max_offsets=5)["maxOffsetsPerTrigger"] == "5"


def test_json_records(spark):
    lines = spark.createDataFrame([('{"id": 1, "item": "x"}',)], "value string")
    assert tuple(sources.json_records(lines, "id long, item string").first()) == (1, "x")


def test_triggers():
    assert sinks.trigger_options("once") == {"availableNow": True}
    assert sinks.trigger_options("every", "2 seconds") == {"processingTime": "2 seconds"}
    assert sinks.trigger_options("continuous", "1 second") == {"continuous": "1 second"}


def test_console_and_socket_are_only_declared(spark):
    """A console query over nothing but a file; the socket source is built but never started."""
    folder = scratch_path(spark, "in")
    spark.range(2).selectExpr("CAST(id AS string) AS value").write.text(folder)
    query = sinks.start_console(sources.file_stream(spark, folder, "value string", "text"), **sinks.trigger_options("once"))
    query.awaitTermination()
    assert query.exception() is None
    assert sources.socket_lines(spark, "localhost", 9).isStreaming


def test_row_writer_sends_groups(spark, tmp_path):
    sent = []
    writer = sinks.BufferedRowWriter(lambda rows: sent.append(list(rows)), size=2)
    assert writer.open(0, 0)
    for i in range(5):
        writer.process(i)
    writer.close(None)
    assert sent == [[0, 1], [2, 3], [4]]
    writer.open(0, 1)
    writer.process(9)
    writer.close(ValueError())
    assert len(sent) == 3

    target = str(tmp_path)

    def to_file(rows):
        import uuid

        with open(f"{target}/{uuid.uuid4()}", "w") as f:
            f.write("".join(r.value + "\n" for r in rows))

    folder = scratch_path(spark, "in")
    spark.range(7).selectExpr("CAST(id AS string) AS value").write.text(folder)
    stream = sources.file_stream(spark, folder, "value string", "text")
    sinks.start_rows(stream, sinks.BufferedRowWriter(to_file, 3), scratch_path(spark, "ckpt")).awaitTermination()
    written = [line for p in tmp_path.iterdir() for line in p.read_text().split()]
    assert sorted(written) == [str(i) for i in range(7)]


def test_join_sides(spark):
    stream = spark.readStream.format("rate").load()
    table = spark.range(3).withColumnRenamed("id", "value")
    assert joins.stream_table_join(stream, table, "value").isStreaming
    with pytest.raises(ValueError):
        joins.stream_table_join(stream, table, "value", "right")


def test_processing_time_moves(spark):
    table = spark.createDataFrame([("abc",), ("de",)], "value string")
    before = time.time()
    row = windows.by_processing_time(table, "10 seconds", "value").first()
    assert row.characters == 5 and row.start.timestamp() <= before + 60


def test_jdbc_options():
    target = JdbcTarget("jdbc:postgresql://host/db", "org.postgresql.Driver", "u", "p")
    assert target.options("public.t") == {
        "url": "jdbc:postgresql://host/db", "driver": "org.postgresql.Driver", "dbtable": "public.t", "user": "u", "password": "p",
    }
    assert KeyRange("emp_no", 1, 100, 4).options() == {
        "partitionColumn": "emp_no", "lowerBound": "1", "upperBound": "100", "numPartitions": "4",
    }
