"""Joins: golden counts, equal forms, and the plans that are wanted."""

import random

import pytest
from pyspark.sql import functions as F

from weftwork.operators import bandjoin, joins
from weftwork.session import scratch_path
from weftwork.sources.managed import save_bucketed


@pytest.fixture(scope="module")
def players(spark):
    return spark.createDataFrame(
        [(0, "Jimmy Page", [0], 0), (1, "Angus Young", [1], 1), (2, "Eric Clapton", [1, 5], 2), (3, "Kirk Hammett", [3], 3)],
        "id long, name string, guitars array<long>, band long",
    )


@pytest.fixture(scope="module")
def bands(spark):
    return spark.createDataFrame(
        [(1, "AC/DC"), (0, "Led Zeppelin"), (3, "Metallica"), (4, "The Beatles")], "id long, name string"
    )


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how,rows", [("inner", 3), ("left", 4), ("right", 4), ("full", 5), ("left_semi", 3), ("left_anti", 1)])
def test_kinds(players, bands, how, rows):
    assert players.join(bands, players["band"] == bands["id"], how).count() == rows


def test_renamed(players, bands):
    joined = joins.join_renamed(players, bands, {"band": "id"})
    assert joined.columns == ["id", "name", "guitars", "band", "right_id", "right_name"]
    assert joined.count() == 3


def test_structs(players, bands):
    pairs = joins.join_structs(players, bands, F.expr("band") == bands["id"])
    assert pairs.columns == ["left_record", "right_record"] and pairs.count() == 3


def test_array_member(spark, players):
    guitars = spark.createDataFrame([(0, "a"), (1, "b"), (3, "c"), (4, "d")], "gid long, make string")
    inner = joins.array_member_join(players, guitars, "guitars", "id", "gid")
    assert sorted((r.id, r.gid) for r in inner.collect()) == [(0, 0), (1, 1), (2, 1), (3, 3)]
    assert "NestedLoop" not in plan(inner) and "Cartesian" not in plan(inner)
    lonely = spark.createDataFrame([(9, "Nobody", [7, None], 9), (8, "Null", None, 8)], players.schema)
    full = joins.array_member_join(players.union(lonely), guitars, "guitars", "id", "gid", how="full")
    found = sorted(((r.id, r.gid) for r in full.collect()), key=str)
    assert found == sorted([(0, 0), (1, 1), (2, 1), (3, 3), (8, None), (9, None), (None, 4)], key=str)


def test_bounded_product(spark):
    left, right = spark.range(10), spark.range(5).withColumnRenamed("id", "other")
    assert joins.bounded_product(left, right, 5).count() == 50
    with pytest.raises(ValueError):
        joins.bounded_product(left, right, 4)


def test_lookup_join_checks_size(spark):
    big, small = spark.range(100), spark.range(10)
    with_hint = joins.lookup_join(big, small, "id", broadcast_rows=10)
    without = joins.lookup_join(big, small, "id", broadcast_rows=9)
    assert with_hint.count() == without.count() == 10
    hinted = [df._jdf.queryExecution().logical().toString() for df in (with_hint, without)]
    assert "broadcast" in hinted[0] and "broadcast" not in hinted[1]


def test_cogroup_nulls_and_pass_mark(spark):
    ids = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    mails = spark.createDataFrame([(1, "b@x"), (1, "a@x"), (2, "c@x")], "id long, mail string")
    scores = spark.createDataFrame([(1, 9.0), (1, 3.0), (3, 10.0), (4, 1.0)], "id long, score double")
    args = (ids, mails, scores, "id", "mail", "score", 9.0)
    assert {tuple(r) for r in joins.cogroup_three(*args).collect()} == {
        (1, "a@x", "PASSED"), (2, "c@x", None), (3, None, None), (4, None, None),
    }
    assert joins.cogroup_three(*args, inclusive=False).where("id = 1").first().result == "FAILED"


def test_equal_orders_of_work(spark):
    rng = random.Random(3)
    scores = spark.createDataFrame([(rng.randrange(30), rng.randrange(100) / 10) for _ in range(400)], "id long, score double")
    names = spark.createDataFrame([(i, f"n{i}") for i in range(25)], "id long, name string")
    late = joins.best_then_join(scores, names, "id", "score").where("score > 9").select("id", "score", "name")
    early = joins.best_then_join(scores, names, "id", "score", above=9).select("id", "score", "name")
    after = joins.join_then_best(scores, names, "id", "score", ["name"], 9).select("id", "score", "name")
    rows = [sorted(tuple(r) for r in df.collect()) for df in (late, early, after)]
    assert rows[0] == rows[1] == rows[2] and rows[0]


def test_bucketed_join_has_no_shuffle(spark):
    tag = scratch_path(spark, "t").rsplit("-", 1)[1]
    left = save_bucketed(spark.range(1000).withColumn("a", F.col("id") * 2), f"l{tag}", 4, ["id"], path=scratch_path(spark, "l"))
    right = save_bucketed(spark.range(500), f"r{tag}", 4, ["id"], path=scratch_path(spark, "r"))
    joined = left.hint("merge").join(right, "id")
    assert joined.count() == 500
    assert "Exchange" not in plan(joined)


def test_copartitioned_join_shuffles_each_side_once(spark):
    left, right = spark.range(1000), spark.range(500)
    joined = joins.copartitioned_join(left, right.hint("merge"), "id", 4)
    assert plan(joined).count("Exchange") == 2
    assert joined.count() == 500


def brute_band(left, right, width):
    means = {}
    for rid, key, x in left:
        near = [p for k, y, p in right if k == key and abs(x - y) <= width]
        if near:
            means[rid] = sum(near) / len(near)
    return means


@pytest.mark.parametrize("width", [1, 3])
def test_band_forms_agree_under_skew(spark, width):
    rng = random.Random(11)
    key = lambda: "hot" if rng.random() < 0.5 else f"k{rng.randrange(5)}"
    left = [(i, key(), rng.randrange(-15, 40)) for i in range(200)]
    right = [(key(), rng.randrange(-15, 40), float(rng.randrange(1000))) for _ in range(600)]
    left_df = spark.createDataFrame(left, "rid long, k string, x int")
    right_df = spark.createDataFrame(right, "k string, x int, price double")
    expected = brute_band(left, right, width)
    for form in (bandjoin.band_average, bandjoin.band_average_bucketed, bandjoin.band_average_salted,
                 bandjoin.band_average_running):
        out = form(left_df, right_df, ["k"], "x", "price", width, ["rid"], scale=2)
        found = {r.rid: r.avg_amount for r in out.collect()}
        assert found.keys() == expected.keys()
        assert all(abs(found[i] - expected[i]) < 1e-9 for i in found)


def test_band_amounts_keep_their_places(spark):
    """Means of very small and very large amounts; the form that subtracts sums refuses doubles."""
    left = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "rid long, k string, x int")
    right = spark.createDataFrame([("a", 1, 0.00001), ("a", 2, 0.00003), ("b", 1, 1e17)], "k string, x int, p double")
    for form in (bandjoin.band_average, bandjoin.band_average_bucketed, bandjoin.band_average_salted):
        found = {r.rid: r.avg_amount for r in form(left, right, ["k"], "x", "p", 1, ["rid"]).collect()}
        assert abs(found[1] - 0.00002) < 1e-15 and found[2] == 1e17
    with pytest.raises(TypeError):
        bandjoin.band_average_running(left, right, ["k"], "x", "p", 1, ["rid"])
    scores = [df.withColumn("x", F.col("x").cast("double")) for df in (left, right)]
    with pytest.raises(TypeError):
        bandjoin.band_average_running(*scores, ["k"], "x", "p", 1, ["rid"], scale=2)


def test_band_with_decimal_scores(spark):
    """Scores as decimals: a band of 0.1 holds both neighbours, which doubles cannot promise."""
    schema = "rid long, k string, x decimal(4,1)"
    from decimal import Decimal as D

    left = spark.createDataFrame([(1, "a", D("4.3"))], schema)
    right = spark.createDataFrame([("a", D(x), 1.0) for x in ("4.1", "4.2", "4.4", "4.5")], "k string, x decimal(4,1), p double")
    right = right.withColumn("p", F.col("x").cast("double"))
    for form in (bandjoin.band_average, bandjoin.band_average_bucketed, bandjoin.band_average_salted,
                 bandjoin.band_average_running):
        out = form(left, right, ["k"], "x", "p", D("0.1"), ["rid"], scale=2).collect()
        assert len(out) == 1 and abs(out[0].avg_amount - 4.3) < 1e-9


def test_salted_join(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k long, name string")
    right = spark.range(1000).select(F.when(F.col("id") < 900, 1).otherwise(F.col("id")).alias("k"), "id")
    assert bandjoin.salted_join(left, right, ["k"], "id").count() == right.join(left, "k").count() == 900


def test_adaptive_skew_join_splits_a_hot_key(spark):
    """What an ordinary join does about one key with most of the rows."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        right = spark.range(0, 200_000, 1, 8).select(
            F.when(F.col("id") % 10 < 8, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
        )
        left = spark.range(0, 5_000).select(F.col("id").alias("k"))
        joined = joins.copartitioned_join(left, right, "k")
        assert len(joined.toArrow()) == right.where("k < 5000").count()
        assert "skew=true" in plan(joined)
    finally:
        for name in settings:
            spark.conf.unset(name)
