"""Sessions, files, layouts, functions and reports on small tables."""

import datetime as dt
import os
import random
import re
from collections import Counter

import pytest
import regex
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from weftwork import session
from weftwork.functions import dates, nested, sentiment, text, udfs
from weftwork.operators import aggregate, layout, project
from weftwork.plans import jobs, people, reports, trips
from weftwork.sources import files, local, managed
from weftwork.sources.registry import DatasetRegistry


class FakeSession:
    """What ``shared_dir`` looks at."""

    def __init__(self, master, named=None, already_set=None):
        self.master, self.named, self.already_set = master, named, already_set
        self.conf = self.sparkContext = self
        self.applicationId = "fake"

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.named or default

    def getCheckpointDir(self):
        return self.already_set


def test_scratch_folder_is_named_by_the_cluster(spark):
    assert session.scratch_path(FakeSession("yarn", "/shared/place/"), "x").startswith("/shared/place/x-")
    assert session.shared_dir(FakeSession("yarn", None, "hdfs://set")) == "hdfs://set"
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        session.shared_dir(FakeSession("yarn"))


def test_checkpoint_cuts_lineage(spark):
    df = session.checkpointed(spark.range(10).where("id > 3"))
    assert df.count() == 6
    assert "Filter" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_session_settings(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_json_modes(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"k": 1}\n{"k": oops\n{"k": 3}\n')
    path = str(tmp_path)
    assert sorted(r.k for r in files.read_json(spark, path, "k long", "dropMalformed").collect()) == [1, 3]
    assert files.read_json(spark, path, "k long", "permissive").where("k IS NULL").count() == 1
    with pytest.raises(Exception, match="FAILFAST"):
        files.read_json(spark, path, "k long", "failfast").collect()


def test_json_inference_with_single_quotes(spark, tmp_path):
    (tmp_path / "a.json").write_text("{'name': 'x', 'n': 4}\n")
    assert files.read_json(spark, str(tmp_path), allowSingleQuotes=True).first().asDict() == {"name": "x", "n": 4}


def test_csv_dates_and_nulls(spark, tmp_path):
    (tmp_path / "s.csv").write_text("symbol,date,price\nAAPL,Jan 1 2000,25.94\nMSFT,Feb 12 2001,none\n")
    rows = files.read_csv(
        spark, str(tmp_path), "symbol string, date date, price double", nullValue="none", dateFormat="MMM d yyyy"
    ).collect()
    assert rows[0].date == dt.date(2000, 1, 1) and rows[1].price is None


def test_delimited_text(spark, tmp_path):
    (tmp_path / "t.txt").write_text("ann // hello there\nbob\n")
    rows = files.read_delimited_text(spark, str(tmp_path), " // ", [("sender", "string"), ("text", "string")]).collect()
    assert sorted(map(tuple, rows), key=str) == [("ann", "hello there"), ("bob", None)]


def test_save_modes(spark):
    path = session.scratch_path(spark, "modes")
    df = spark.range(3)
    files.write_files(df, path)
    with pytest.raises(PySparkException):
        files.write_files(df, path, mode="error")
    files.write_files(df, path, mode="append")
    files.write_files(df, path, mode="ignore")
    assert spark.read.parquet(path).count() == 6
    files.write_files(df, path, mode="overwrite")
    assert spark.read.parquet(path).count() == 3


def test_file_counts(spark):
    for shuffle, wanted in ((True, 5), (False, 2)):
        path = session.scratch_path(spark, "count")
        files.write_file_count(spark.range(0, 1000, 1, 4), path, wanted, shuffle=shuffle)
        assert len([f for f in os.listdir(path) if f.startswith("part-")]) == wanted


def test_partition_numbers(spark):
    assert files.partitions_for(10 * 2**30) == 160
    assert files.partitions_for(1) == 1
    df = spark.range(0, 100, 1, 4)
    assert layout.resized(df, 8).rdd.getNumPartitions() == 8
    assert layout.resized(df, 2, shuffle=False).rdd.getNumPartitions() == 2
    assert layout.sized_for(df, 300, 100).rdd.getNumPartitions() == 3
    assert "Exchange" not in layout.resized(df, 2, shuffle=False)._jdf.queryExecution().executedPlan().toString()


def test_pushdown_and_pruning(spark, small):
    df = files.read_parquet(spark, f"{small}/orders.parquet", "o_orderkey", "o_custkey").where("o_custkey = 5")
    shown = df.select("o_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_custkey,5)" in shown and "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in shown


def test_partition_and_bucket_pruning(spark, small):
    tag = session.scratch_path(spark, "x").rsplit("-", 1)[1]
    table = managed.save_bucketed(
        spark.read.parquet(f"{small}/orders.parquet"), f"p{tag}", 4, ["o_custkey"],
        partition_by=["o_orderstatus"], path=session.scratch_path(spark, "p"),
    )
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    pruned = table.where("o_orderstatus = 'F' AND o_custkey = 7").select("o_orderkey")
    shown = pruned._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 4" in shown
    assert "PartitionFilters: [isnotnull(o_orderstatus" in shown


def test_databases(spark):
    managed.create_database(spark, "weft_tests", session.scratch_path(spark, "db"))
    assert "weft_tests" in managed.list_databases(spark)
    managed.use_database(spark, "weft_tests")
    managed.use_database(spark, "default")


def test_registry():
    registry = DatasetRegistry()
    with pytest.raises(KeyError):
        registry.schema("nothing")


def test_registry_types(spark):
    registry = DatasetRegistry({"n": "bigint"})
    registry.define("d", ["n", "other"])
    assert registry.schema("d").simpleString() == "struct<n:bigint,other:string>"


def test_describe_table(spark):
    found = local.describe_table(spark.range(7), 2)
    assert found["count"] == 7 and len(found["rows"]) == 2 and found["schema"] == "struct<id:bigint>"


def test_hash_and_range_partitions(spark):
    df = spark.range(1000).select((F.col("id") % 13).alias("k"))
    placed = layout.hash_partitioned(df, 4, "k").select("k", F.spark_partition_id().alias("p")).distinct()
    assert placed.count() == 13
    ranged = layout.range_sorted(df, "k", 4).rdd.map(lambda r: r.k).collect()
    assert ranged == sorted(ranged)


def test_partition_by_length(spark):
    df = spark.createDataFrame([("a",), ("bb",), ("ccc",), ("dddd",), ("eeeee",)], "w string")
    placed = layout.partitioned_by_length(df, "w", 3).select("w", F.spark_partition_id().alias("p")).collect()
    assert all(r.p == len(r.w) % 3 for r in placed)


def test_persist(spark):
    df = layout.kept(spark.range(10))
    assert df.count() == 10 and df.is_cached
    assert not df.unpersist().is_cached


def test_top_k_plan(spark):
    df = layout.top_k(spark.range(100), [F.desc("id")], 3)
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()
    assert [r.id for r in df.collect()] == [99, 98, 97]


def test_first_of_duplicates(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (2, "c", 3)], "k long, v string, o long")
    assert {tuple(r) for r in layout.first_of_duplicates(df, ["k"], ["o"]).collect()} == {(1, "a", 1), (2, "c", 3)}


def test_collect_lists_splits_large_keys(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 900, 0).otherwise(F.col("id")).alias("k"), "id")
    rows = aggregate.collect_lists(df, "k", "id", length=100).collect()
    hot = {r.part: r.collected for r in rows if r.k == 0}
    assert hot == {i: list(range(100 * i, 100 * i + 100)) for i in range(9)}
    assert all(r.part == 0 for r in rows if r.k != 0) and len(rows) == 109


def test_collect_lists_of_ties_and_nulls(spark):
    df = spark.createDataFrame([(None, 5), (None, 5), (None, 4), (1, None), (2, 7), (2, 7), (2, 7)], "k long, v long")
    rows = aggregate.collect_lists(df, "k", "v", length=2).collect()
    assert {(r.k, r.part): r.collected for r in rows} == {
        (None, 0): [4, 5], (None, 1): [5], (2, 0): [7, 7], (2, 1): [7],
    }
    assert aggregate.collect_lists(df.limit(0), "k", "v").count() == 0


def test_sums_keep_small_and_large_amounts(spark):
    """Without a scale doubles are added as they are."""
    df = spark.range(1000).select(F.lit("G").alias("g"), F.lit(0.001).alias("small"), F.lit(1e17).alias("large"))
    row = aggregate.sum_numeric(df, F.lower("g"), "g").first()
    assert abs(row.sum_small - 1.0) < 1e-9 and abs(row.sum_large / 1e20 - 1) < 1e-9
    assert aggregate.sum_numeric(df, F.lower("g"), "g", scale=3).first().sum_small == 1.0


def test_first_of_duplicates_reads_no_other_columns(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 1)], "k long, v string, o long").withColumn("wide", F.lit("x"))
    kept = layout.first_of_duplicates(df, ["k"], ["o"], ["k", "v"])
    assert kept.columns == ["k", "v"] and [tuple(r) for r in kept.collect()] == [(1, "a")]
    assert "wide" not in kept._jdf.queryExecution().optimizedPlan().toString()


def test_observation(spark):
    watched, watch = aggregate.observed(spark.range(10), "seen", even=F.count_if(F.col("id") % 2 == 0))
    watched.count()
    assert watch.get == {"even": 5}


def test_nulls_make_a_group(spark):
    df = spark.createDataFrame([("a",), (None,), (None,)], "g string")
    assert {(r.g, r.n) for r in aggregate.count_groups(df, "g").collect()} == {("a", 1), (None, 2)}


def test_smallest_per_partition(spark):
    rng = random.Random(5)
    values = [rng.randrange(50) for _ in range(500)]
    df = spark.createDataFrame([(f"n{i}", float(v)) for i, v in enumerate(values)], "name string, value double").repartition(6)
    kept = udfs.smallest_per_partition(df, ["value", "name"], 10)
    assert kept.count() <= 60
    merged = kept.orderBy("value", "name").limit(10).collect()
    expected = sorted((float(v), f"n{i}") for i, v in enumerate(values))[:10]
    assert [(r.value, r.name) for r in merged] == expected


def test_patterns_take_words_literally(spark):
    df = spark.createDataFrame([("a.b",), ("axb",)], "t string")
    assert df.where(project.matches_any("t", ["a.b"])).count() == 1
    assert df.where(project.contains_any("t", ["a.b", "x"])).count() == 2
    assert df.where(project.contains_any("t", [])).count() == df.where(project.matches_any("t", [])).count() == 0


def test_dates(spark):
    df = spark.createDataFrame([("07-Aug-98", "2020-02-29")], "a string, b string")
    row = df.select(
        dates.parse_date("a", "dd-MMM-yy").alias("a"), dates.parse_date_any("b", "dd/MM/yyyy", "yyyy-MM-dd").alias("b"),
        dates.parse_date("a", "yyyy").alias("bad"),
        dates.full_years(F.to_date("b"), F.lit("2021-02-28").cast("date")).alias("young"),
        dates.full_years(F.to_date("b"), F.lit("2021-03-01").cast("date")).alias("old"),
        dates.today().alias("today"), dates.now().alias("now"),
    ).first()
    assert row.a == dt.date(2098, 8, 7) and row.b == dt.date(2020, 2, 29) and row.bad is None
    assert row.young in (0, 1) and row.old == 1
    assert row.today == row.now.date()


def test_text_functions(spark):
    row = spark.createDataFrame([("a-b-a",)], "t string").select(
        text.char_count("t", "a").alias("n"), text.word_md5("t").alias("m"), text.split_at("t", "-", 9).alias("none")
    ).first()
    import hashlib

    assert row.n == 2 and row.m == hashlib.md5(b"a-b-a").hexdigest() and row.none is None


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(-9, 9)), min_size=1, max_size=30))
def test_map_merge(spark, rows):
    expected = {}
    for owner, key, value in rows:
        expected[owner, key] = max(expected.get((owner, key), -99), value)
    df = spark.createDataFrame(rows, "o long, k long, v long")
    merged = nested.merge_entries(df, ["o"], "k", "v", F.max)
    assert {(r.o, r.k): r.v for r in merged.collect()} == expected
    maps = {r.o: dict(r.entries) for r in nested.to_map(merged, "o", "k", "v").collect()}
    assert {(o, k): v for o, m in maps.items() for k, v in m.items()} == expected


def test_sentiment(spark):
    texts = ["I love this. It is great!", "Bad. Awful, terrible, horrible.", "Nothing to say.", "", "  ... "]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    rows = {
        r.i: (r.s, r.b) for r in df.select("i", sentiment.text_score("t").alias("s"))
        .select("i", "s", sentiment.band(F.col("s")).alias("b")).collect()
    }
    assert rows[0] == (3.0, "POSITIVE")
    assert rows[1] == (0.5, "VERY_NEGATIVE")
    assert rows[2] == (2.0, "NEUTRAL")
    assert rows[3] == rows[4] == (-1.0, "NOT_UNDERSTOOD")


def test_job_arguments(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"n": 2}\n{"n": 9}\n{"n": 5}\n')
    monkeypatch.setattr(jobs, "run_job", lambda app, job: job(spark))
    jobs.main([str(tmp_path / "in"), str(tmp_path / "out"), "--where", "n > 2", "--order", "n", "--descending"])
    written = sorted((tmp_path / "out").glob("part-*.json"))
    assert "".join(p.read_text() for p in written).split() == ['{"n":9}', '{"n":5}']


def test_stock_series(spark):
    stocks = spark.createDataFrame(
        [("MSFT", dt.date(2000, 1, 1), 39.81), ("MSFT", dt.date(2000, 2, 1), 36.35), ("AAPL", dt.date(2000, 1, 1), 25.94)],
        "company string, date date, value double",
    )
    assert reports.lowest_price(reports.symbol_series(stocks, "MSFT")).first().lowest == 36.35
    assert sorted(r.company for r in reports.companies(stocks).collect()) == ["AAPL", "MSFT"]
    high, low = reports.high_and_low(stocks, 30)
    assert (high.count(), low.count()) == (2, 1)


def test_gross_is_null_if_a_part_is(spark):
    df = spark.createDataFrame([(1, 2), (1, None)], "a long, b long")
    assert [r.total_gross for r in df.select(reports.gross("a", "b")).collect()] == [3, None]


def test_titles(spark):
    titles = spark.createDataFrame([(1, "junior", 1), (1, "senior", 5), (2, "boss", 3)], "emp long, title string, until long")
    pay = spark.createDataFrame([(1, 10), (1, 30), (2, 20)], "emp long, amount long")
    assert {tuple(r) for r in people.current_titles(titles, "emp", ["title"], ["until"]).collect()} == {(1, "senior"), (2, "boss")}
    best = people.top_paid_titles(pay, titles, "emp", "amount", ["title"], ["until"], k=1).collect()
    assert [tuple(r) for r in best] == [(1, 30, "senior")]


def test_sharing_impact(spark):
    rides = spark.createDataFrame(
        [(dt.datetime(2018, 1, 25, 10, 0), 1, 10.0, 1), (dt.datetime(2018, 1, 25, 10, 2), 1, 20.0, 2),
         (dt.datetime(2018, 1, 25, 11, 0), 1, 30.0, 5)],
        "t timestamp, zone int, fare double, party int",
    )
    groups = trips.sharing_groups(rides, "t", "zone", "fare", F.col("party") < 3)
    impact = trips.sharing_impact(groups, rides, "fare").collect()
    assert len(impact) == 1 and impact[0].total_trips == 2 and impact[0].total_amount == 30.0
    assert abs(impact[0].total_impact - 2 * 0.05 * (0.3 * (0.6 * 20 - 5) + 0.7 * 2)) < 1e-9


def test_full_years_of_a_leap_day(spark):
    row = spark.sql("SELECT DATE '2000-02-29' AS born")
    years = [
        row.select(dates.full_years("born", F.lit(day).cast("date"))).first()[0] for day in ("2001-02-28", "2001-03-01", "2004-02-29")
    ]
    assert years == [0, 1, 4]


def test_sentiment_like_words_taken_apart(spark):
    """Accents, digits, apostrophes and repeats: the same as splitting at all but letters and digits."""
    lexicon = sentiment.Lexicon(positive=("gut", "été", "a1"), negative=("schlecht", "no"))
    texts = [
        "Gut gut GUT. étéa été; Été!", "no-no no_no nono. a1 a12 1a1 A1", "gut’s gut's\nschlecht...", "...", "", None, "  . \n", "über gut\u0301 e",
        "gut" * 3 + " " + "gut " * 9,
    ]
    def plain(text):
        if text is None:
            return None
        scores = []
        for sentence in re.split("[.!?\n]+", text.lower()):
            if sentence.strip(" "):
                words = regex.split(r"[^\p{L}\p{N}]+", sentence)
                scores.append(max(0, min(4, 2 + sum((w in lexicon.positive) - (w in lexicon.negative) for w in words))))
        return sum(scores) / len(scores) if scores else -1.0

    table = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.s for r in table.select("i", sentiment.text_score("t", lexicon).alias("s")).collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}
    none = table.select(sentiment.text_score("t", sentiment.Lexicon((), ())).alias("s")).where("s > 0 and s != 2").count()
    assert none == 0


def test_ranges_split_a_frequent_value(spark):
    """A value with a third of the rows lies in several tasks, and the order over all tasks is global."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id")).alias("k"), "id")
    ranged = layout.range_sorted_evenly(df, ["k"], 12)
    rows = ranged.withColumn("task", F.spark_partition_id()).collect()
    assert [r.k for r in rows] == sorted(r.k for r in rows) and len(rows) == 3000
    sizes = Counter(r.task for r in rows)
    assert max(sizes.values()) < 700 and len({r.task for r in rows if r.k == 500}) >= 3
    assert layout.range_placement(ranged, "k").where("not ordered").count() == 0
    assert layout.range_sorted_evenly(df.limit(0), ["k"], 3).count() == 0
