"""Windows made of panes, and interval joins with spread state."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from weftwork.streaming import joins, panes, sinks, windows


def measures():
    return [panes.counted("n"), panes.summed("s", "v"), panes.mean("m", "v"), panes.largest("top", "v"), panes.smallest("low", "v")]


def direct_measures():
    return [F.count("*").alias("n"), F.sum("v").alias("s"), F.avg("v").alias("m"), F.max("v").alias("top"), F.min("v").alias("low")]


def rows_over(spark, hours, count, hot=3):
    """Rows in the order of time; one user has a third of them."""
    return spark.range(count).select(
        "id", F.timestamp_seconds(F.col("id") * (hours * 3600 / count) + 1_700_000_000).alias("ts"),
        F.when(F.col("id") % hot == 0, F.lit(0)).otherwise(F.pmod(F.xxhash64("id"), F.lit(20))).alias("user"),
        F.when(F.col("id") % 11 != 0, F.pmod(F.hash("id"), F.lit(100))).alias("v"),
    )


def parts_of(rows, count):
    total = rows.count()
    return [rows.where((F.col("id") >= total * i // count) & (F.col("id") < total * (i + 1) // count)) for i in range(count)]


@pytest.mark.parametrize("text, length", [("90 seconds", 90), ("1 day 6 hours", 108_000), ("2 Weeks", 1_209_600), (" 1  minute ", 60)])
def test_interval_lengths(text, length):
    assert panes.seconds(text) == length


@pytest.mark.parametrize("text", ["", "1 month", "soon", "5", "1 day and 2 hours", "1.5 hours"])
def test_intervals_without_length(text):
    with pytest.raises(ValueError):
        panes.seconds(text)


@pytest.mark.parametrize("size, slide", [("1 day", "1 hour"), ("45 minutes", "30 minutes"), ("1 hour", "1 hour")])
def test_panes_like_direct_windows(spark, size, slide):
    rows = rows_over(spark, 40, 3000)
    mine = panes.sliding(rows, "ts", size, slide, measures(), ["user"])
    direct = windows.windowed(rows, "ts", size, direct_measures(), slide, ["user"])
    assert mine.columns == direct.columns
    assert sorted(map(tuple, mine.collect()), key=repr) == sorted(map(tuple, direct.collect()), key=repr)


def test_rows_are_not_copied_into_windows(spark):
    rows = rows_over(spark, 40, 3000)
    plan = panes.sliding(rows, "ts", "1 day", "1 hour", measures(), ["user"])._jdf.queryExecution().executedPlan().toString()
    expand = plan.index("Expand")
    assert expand < plan.rindex("HashAggregate"), "windows are made above the aggregation of panes"
    assert plan.count("Expand") == 1


def test_state_holds_open_panes_and_windows(spark):
    """After a batch the state has the panes and windows behind the watermark only, however many rows there were."""
    rows = rows_over(spark, 100, 20_000)
    got, progress = sinks.run_in_steps(
        lambda df: panes.sliding(df, "ts", "1 day", "1 hour", measures(), ["user"], "30 minutes"), parts_of(rows, 5)
    )
    fed = [p for p in progress if p["numInputRows"]]
    assert len(fed) == 5
    closed = [[op["numRowsTotal"] for op in p["stateOperators"]] for p in progress if not p["numInputRows"]]
    users = 20
    assert len(closed) == 5
    for of_windows, of_panes in closed:
        assert of_panes <= 2 * users and of_windows <= 25 * users
    assert all(op["numRowsDroppedByWatermark"] == 0 for p in progress for op in p["stateOperators"])
    last = rows.agg(F.max("ts").alias("t")).first().t
    direct = sinks.naive(windows.windowed(rows, "ts", "1 day", direct_measures(), "1 hour", ["user"])).collect()
    want = {tuple(r) for r in direct if r.end <= last - timedelta(minutes=30)}
    found = got.collect()
    assert len(found) == len(want) and {tuple(r) for r in found} == want


def sides(rows):
    left = rows.where("id % 2 = 0").select(F.col("id").alias("l"), "user", F.col("ts").alias("l_ts"))
    right = rows.where("id % 2 = 1").select(F.col("id").alias("r"), "user", F.col("ts").alias("r_ts"))
    return left, right


def test_interval_join_with_a_hot_user(spark):
    rows = rows_over(spark, 60, 900)
    slices = parts_of(rows, 3)
    got, progress = sinks.run_in_steps(
        lambda df: joins.interval_join(*sides(df), "user", "l_ts", "r_ts", "2 hours", "10 minutes").select("l", "r", "user"), slices
    )
    left, right = sides(rows)
    bound = F.expr("r_ts >= l_ts AND r_ts <= l_ts + INTERVAL 2 HOURS")
    want = left.join(right, "user").where(bound).select("l", "r", "user")
    pairs = [tuple(r) for r in got.collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == {tuple(r) for r in want.collect()}
    assert sum(u == 0 for *_, u in pairs) > len(pairs) / 3
    # Behind the watermark there are two hours of rows on the left and ten minutes on the right, of sixty.
    assert all(p["stateOperators"][0]["numRowsTotal"] < 900 / 60 * 5 for p in progress if not p["numInputRows"])


def test_hot_user_is_many_state_keys(spark):
    """The join is dealt by user and bucket, so that pairs of one user come from several tasks."""
    left, right = sides(rows_over(spark, 60, 900, hot=1))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        pairs = joins.interval_join(left, right.hint("merge"), "user", "l_ts", "r_ts", "2 hours", "10 minutes")
        assert pairs.select("user").distinct().count() == 1
        assert pairs.select(F.spark_partition_id().alias("p")).distinct().count() > 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_interval_left_join_like_table_join(spark):
    rows = rows_over(spark, 60, 900)
    left, right = sides(rows)
    mine = joins.interval_join(left, right, "user", "l_ts", "r_ts", "2 hours", "10 minutes", "left").select("l", "r")
    later = right.withColumnRenamed("user", "u")
    want = left.join(later, (F.col("user") == F.col("u")) & F.expr("r_ts >= l_ts AND r_ts <= l_ts + INTERVAL 2 HOURS"), "left").select("l", "r")
    key = lambda r: (r.l, r.r or 0)
    assert sorted(mine.collect(), key=key) == sorted(want.collect(), key=key)
    for how in ("right", "full", "left_semi"):
        with pytest.raises(ValueError):
            joins.interval_join(left, right, "user", "l_ts", "r_ts", "2 hours", "10 minutes", how)


def test_table_on_the_left_of_a_stream(spark):
    table = spark.range(3).withColumnRenamed("id", "value")
    stream = spark.readStream.format("rate").load()
    assert joins.table_stream_join(table, stream, "value", "right").isStreaming
    for how in ("left", "full", "left_semi", "left_anti"):
        with pytest.raises(ValueError):
            joins.table_stream_join(table, stream, "value", how)
