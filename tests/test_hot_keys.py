"""Keys with very many rows: found by bounded counters, split in proportion, collected in slices."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftwork.operators import aggregate, bandjoin, hotkeys
from weftwork.plans import people, trips


@pytest.mark.parametrize("counters", [1, 3, 10, 100])
def test_counters_miss_no_more_than_their_share(counters):
    draw = random.Random(counters)
    marks, counts, true = np.zeros(0, np.int64), np.zeros(0, np.int64), Counter()
    for _ in range(20):
        batch = [draw.choice([7, 7, 7, 8, 8, draw.randrange(200)]) for _ in range(draw.randrange(60))]
        true.update(batch)
        marks, counts = hotkeys.add_counts(marks, counts, np.array(batch, np.int64), counters)
        assert len(marks) <= counters
    found = dict(zip(marks.tolist(), counts.tolist()))
    rows = sum(true.values())
    for key, n in true.items():
        assert n - rows / (counters + 1) <= found.get(key, 0) <= n


def skewed(spark, rows=9000):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 500))
    return spark.range(rows).select("id", F.when(F.col("id") % 1000 != 1, key).alias("k")).repartition(7)


def test_a_third_of_the_rows_is_split_in_proportion(spark):
    table = skewed(spark)
    for target in (None, 100, 1000):
        size = target or -(-table.where("k IS NOT NULL").count() // 8)
        hot = hotkeys.salts_for_hot_keys(table, ["k"], target).collect()
        assert len(hot) == 1 and 3000 / size <= hot[0].salts <= 1.4 * 3000 / size + 1
    spread = hotkeys.spread(table, hotkeys.salts_for_hot_keys(table, ["k"], 100), ["k"], "id")
    parts = [r["count"] for r in spread.where("k = 'hot'").groupBy("__salt").count().collect()]
    assert len(parts) >= 30 and max(parts) < 200
    assert spread.where("k <> 'hot' OR k IS NULL").where("__salt <> 0").count() == 0


def test_no_key_is_hot(spark):
    even = spark.range(4000).select("id", (F.col("id") % 400).alias("k"))
    assert hotkeys.salts_for_hot_keys(even, ["k"]).count() == 0
    assert hotkeys.salts_for_hot_keys(even.limit(0), ["k"]).count() == 0
    assert hotkeys.salts_for_hot_keys(even.select(F.lit(None).cast("long").alias("k")), ["k"]).count() == 0


def test_salted_join_like_plain_join(spark):
    right = skewed(spark, 3000)
    left = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("none", 4), (None, 5)], "k string, v int")
    for target in (None, 50):
        mine = bandjoin.salted_join(left, right, ["k"], "id", target)
        assert Counter(map(tuple, mine.select("k", "v", "id").collect())) == Counter(
            map(tuple, left.join(right, "k").select("k", "v", "id").collect())
        )


def test_salted_join_reads_each_table_at_most_twice(spark, small):
    lines = spark.read.parquet(f"{small}/lineitem.parquet").select(F.col("l_partkey").alias("key"), "l_orderkey")
    parts = spark.read.parquet(f"{small}/part.parquet").select(F.col("p_partkey").alias("key"), "p_brand")
    plan = bandjoin.salted_join(parts, lines, ["key"], "l_orderkey")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_partkey") and plan.count("Relation [") == 2, "one scan of each for the join, beside the pass over keys"


def test_distinct_values_in_slices(spark):
    rows = [(k, v) for k in ("a", "b", None) for v in range(25) for _ in range(3)] + [("a", None), ("c", None)]
    found = aggregate.collect_distinct(spark.createDataFrame(rows, "k string, v int").repartition(5), "k", "v", length=10).collect()
    assert {(r.k, r.part): r.collected for r in found} == {
        (k, p): list(range(10 * p, min(25, 10 * p + 10))) for k in ("a", "b", None) for p in range(3)
    }


def test_distinct_values_of_a_hot_key_lie_in_several_tasks(spark):
    table = spark.range(20_000).select(F.lit(1).alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        slices = aggregate.collect_distinct(table, "k", "id", length=1000)
        assert slices.count() == 20
        assert slices.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_pay_is_not_rounded(spark):
    hires = spark.createDataFrame([(1, "1996-05-01"), (2, "1996-06-01"), (3, "1999-01-01")], "key long, hired string")
    members = spark.createDataFrame([(1, "d"), (2, "d"), (3, "d")], "key long, department string")
    pay = spark.createDataFrame([(1, 0.001), (2, 0.002), (3, 9.0)], "key long, amount double")
    found = people.pay_by_department(hires, members, pay, "1996-01-01", "1997-01-01").first()
    assert abs(found.mean_amount - 0.0015) < 1e-15
    assert people.pay_by_department(hires, members, pay, "1996-01-01", "1997-01-01", scale=2).first().mean_amount == 0.0


def test_zone_names_replace_the_number(spark):
    groups = spark.createDataFrame([(1, 5), (2, 6), (9, 7)], "zone_id int, trips int")
    zones = spark.createDataFrame([(1, "Bronx"), (2, "Queens")], "zone_id int, zone string")
    named = trips.with_zone_names(groups, zones, "zone_id")
    assert named.columns == ["trips", "zone"] and {tuple(r) for r in named.collect()} == {(5, "Bronx"), (6, "Queens")}
