"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR is the data folder, BENCH_CPUS the number of local threads. Each query is run once to
warm up and then BENCH_RUNS times; the median counts. ``value`` is the sum over the queries.
``baseline`` repeats the published single-machine cases at their own scale: number ranges of the
same length, and the same skew.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from weftwork.catalog import load_all  # noqa: E402
from weftwork.operators import bandjoin, joins  # noqa: E402
from weftwork.session import build_session, scratch_path  # noqa: E402
from weftwork.sources.managed import save_bucketed  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = """
trips_by_zone trips_by_borough trips_by_length hour_by_length popular_pairs code_per_day ride_share_impact
avg_by_dept best_dept top10_latest report_by_group
filter_and scan_parquet partitioned_bucketed_agg
join_inner join_broadcast join_bucketed join_copartitioned join_preagg join_prefilter join_then_best
band_join_avg band_join_bucketed band_join_salted band_join_offers join_array_contains cogroup3 double_lookup
agg_basic group_multi_agg group_latest sum_by_key word_count text_stats_by_source count_max_histogram
top_k_smallest map_in_partition dedup_subset sentiment_band map_merge
graph_in_degree graph_triplets shortest_path_hops control_shares gang_triples
stream_tumbling stream_watermark_append stream_static_join
""".split()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def drain(df) -> None:
    """Compute every row and column and keep none."""
    df.write.format("noop").mode("overwrite").save()


def baseline_cases(spark) -> dict[str, float]:
    """The published cases, each of which is about how data is laid out before a join or an aggregate."""
    found = {}

    big, small = spark.range(1, 1_000_000).repartition(5), spark.range(1, 10_000).repartition(2)
    found["bucketing_plain_count"] = timed(big.hint("merge").join(small, "id").count)
    tag = scratch_path(spark, "b").rsplit("-", 1)[1]
    tables = []
    found["bucketing_write"] = timed(lambda: tables.extend(
        save_bucketed(df, f"{name}_{tag}", 4, ["id"], path=scratch_path(spark, name))
        for name, df in (("big", big), ("small", small))
    ))
    found["bucketing_count"] = timed(tables[0].hint("merge").join(tables[1], "id").count)

    left, right = spark.range(1, 10_000_000).repartition(10), spark.range(1, 5_000_000).repartition(7)
    widened = [f"id * {i} AS newCol{i}" for i in range(30)]
    plain = right.selectExpr("id", *widened[1:]).hint("merge").join(left, "id")
    found["widen_then_join"] = timed(lambda: drain(plain))
    early = joins.copartitioned_join(left, right.hint("merge"), "id", int(CPUS)).selectExpr("id", *widened[1:])
    found["partition_then_widen"] = timed(lambda: drain(early))

    words = spark.range(2_000_000).select((F.xxhash64("id") % 50_000).alias("word"), (F.col("id") % 1000).alias("n"))
    found["sum_by_key_2m"] = timed(lambda: drain(words.groupBy("word").agg(F.sum("n").alias("n"))))

    def instruments(rows: int, salt: int):
        roll = F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(1000))
        model = F.when(roll < 500, F.lit(0)).otherwise(roll % 40)
        return spark.range(rows).select(
            "id", model.alias("model"), (F.pmod(F.xxhash64("id"), F.lit(401)) + 500).alias("score"),
            F.pmod(F.hash("id"), F.lit(5000)).cast("double").alias("price"),
        )

    guitars, sales = instruments(40_000, 1), instruments(200_000, 2)
    for name, form in (("plain", bandjoin.band_average), ("salted", bandjoin.band_average_salted),
                       ("bucketed", bandjoin.band_average_bucketed), ("running", bandjoin.band_average_running)):
        means = form(guitars, sales, ["model"], "score", "price", 10, ["id"], scale=2)
        found[f"skewed_band_{name}"] = timed(lambda: drain(means))

    records = spark.range(10_000_000).select((F.col("id") % 100).alias("age"), F.col("id").cast("string").alias("name"))
    found["group_10m_by_100"] = timed(lambda: drain(records.groupBy("age").agg(F.count("*").alias("n"))))
    return {name: round(seconds, 3) for name, seconds in found.items()}


def main() -> None:
    chosen = sys.argv[1:] or HEADLINE
    spark = build_session(
        "weftwork-bench", master=f"local[{CPUS}]",
        conf={"spark.sql.shuffle.partitions": CPUS, "spark.default.parallelism": CPUS, "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    entries = load_all()
    seconds = {}
    for name in chosen:
        run = lambda: drain(entries[name](spark, FOLDER))
        run()
        seconds[name] = round(statistics.median(timed(run) for _ in range(RUNS)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    result = {
        "metric": "headline queries, sum of medians", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(CPUS),
    }
    if not sys.argv[1:]:
        result["baseline"] = baseline_cases(spark)
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
