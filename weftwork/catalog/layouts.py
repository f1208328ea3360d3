"""Sorting, limits, partitioning, set operations and removal of duplicates."""

from pyspark.sql import functions as F

from weftwork.catalog import Tables, query
from weftwork.operators import layout


@query("""
SELECT c_custkey, o_orderkey, o_totalprice
FROM customer LEFT JOIN orders ON c_custkey = (o_orderkey // 7) * 2
ORDER BY o_totalprice DESC NULLS LAST, c_custkey, o_orderkey""")
def order_nulls_last(t: Tables):
    joined = t.customer.join(t.orders, F.expr("c_custkey = (o_orderkey div 7) * 2"), "left")
    return joined.select("c_custkey", "o_orderkey", "o_totalprice").orderBy(
        F.col("o_totalprice").desc_nulls_last(), "c_custkey", "o_orderkey"
    )


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def limit_n(t: Tables):
    return layout.top_k(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 25)


@query("""
SELECT l_extendedprice, l_orderkey, l_partkey, l_linenumber FROM lineitem
ORDER BY l_extendedprice, l_orderkey, l_partkey, l_linenumber LIMIT 20""")
def top_k_smallest(t: Tables):
    order = ["l_extendedprice", "l_orderkey", "l_partkey", "l_linenumber"]
    return layout.top_k(t.lineitem.select(*order), order, 20)


@query("SELECT o_orderkey, o_totalprice FROM orders")
def range_sorted(t: Tables):
    return layout.range_sorted(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", 8)


@query("""
SELECT o_orderstatus, count(*) AS "rows", count(*) > (SELECT 2 * count(*) / 12 FROM orders) AS several, true AS ordered
FROM orders GROUP BY o_orderstatus""")
def range_sorted_ties(t: Tables):
    """Few values over twelve tasks: each with more rows than two tasks should hold lies in several."""
    ranged = layout.range_sorted_evenly(t.orders.select("o_orderstatus", "o_orderkey"), ["o_orderstatus"], 12)
    return layout.range_placement(ranged, "o_orderstatus").select(
        "o_orderstatus", "rows", (F.col("tasks") > 1).alias("several"), "ordered"
    )


@query("SELECT p_partkey, p_name, CAST(length(p_name) % 4 AS INTEGER) AS placed FROM part")
def partition_by_length(t: Tables):
    placed = layout.partitioned_by_length(t.part.select("p_partkey", "p_name"), "p_name", 4)
    return placed.withColumn("placed", F.spark_partition_id())


@query("""
SELECT c_custkey AS key, c_name AS name, c_nationkey AS nation FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier""")
def union_all(t: Tables):
    customers = t.customer.select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")
    )
    return layout.union_all(customers, t.supplier.select("s_suppkey", "s_name", "s_nationkey"))


@query("SELECT c_nationkey AS nation, c_custkey AS key FROM customer UNION SELECT s_nationkey, s_suppkey FROM supplier")
def union_distinct(t: Tables):
    customers = t.customer.select(F.col("c_nationkey").alias("nation"), F.col("c_custkey").alias("key"))
    return layout.union_distinct(customers, t.supplier.select("s_nationkey", "s_suppkey"))


@query("SELECT DISTINCT p_name FROM part")
def distinct_vals(t: Tables):
    return t.part.select("p_name").distinct()


@query("""
SELECT event_id, user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
def dedup_subset(t: Tables):
    columns = ["event_id", "user_id", "event_type", "value"]
    return layout.first_of_duplicates(t.events, ["user_id", "event_type"], ["ts", "event_id"], columns)
