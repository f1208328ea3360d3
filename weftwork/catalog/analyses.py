"""The composed analyses: trips, staff questions and reports."""

from pyspark.sql import functions as F

from weftwork.catalog import Tables, query
from weftwork.plans import people, reports, trips

_NATION = "orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"


def _orders_per_nation(t: Tables):
    """Orders counted per customer before the join: only one row per customer is shuffled to it."""
    per_customer = t.orders.groupBy("o_custkey").agg(F.count("*").alias("orders"))
    return per_customer.join(t.customer, F.expr("o_custkey = c_custkey")).select("c_nationkey", "orders")


@query(f"""
SELECT c_nationkey, n_name, count(*) AS total_trips FROM {_NATION} GROUP BY 1, 2 ORDER BY 3 DESC""")
def trips_by_zone(t: Tables):
    zones = t.nation.select("n_nationkey", "n_name")
    return trips.by_zone(_orders_per_nation(t), "c_nationkey", zones, "n_nationkey", weight="orders")


@query(f"""
SELECT r_name, count(*) AS total_trips FROM {_NATION} JOIN region ON n_regionkey = r_regionkey GROUP BY 1""")
def trips_by_borough(t: Tables):
    zones = t.nation.join(t.region, F.expr("n_regionkey = r_regionkey")).select("n_nationkey", "r_name")
    per_zone = trips.by_zone(_orders_per_nation(t), "c_nationkey", zones, "n_nationkey", weight="orders")
    return trips.by_borough(per_zone, "r_name").withColumn("total_trips", F.col("total_trips").cast("long"))


@query("SELECT CAST(hour(ts) AS INTEGER) AS hour_of_day, count(*) AS total_trips FROM events GROUP BY 1")
def trips_by_hour(t: Tables):
    return trips.by_hour(t.events, "ts")


@query("SELECT l_quantity >= 30 AS is_long, count(*) AS total_trips FROM lineitem GROUP BY 1")
def trips_by_length(t: Tables):
    return trips.by_length(t.lineitem, "l_quantity")


@query("""
SELECT CAST(hour(ts) AS INTEGER) AS hour_of_day, value >= 30 AS is_long, count(*) AS total_trips
FROM events GROUP BY 1, 2""")
def hour_by_length(t: Tables):
    return trips.by_hour_and_length(t.events, "ts", "value")


def _pairs(test: str) -> str:
    return f"""
SELECT a.n_name AS pickup_zone, b.n_name AS dropoff_zone, count(*) AS total_trips
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN supplier ON l_suppkey = s_suppkey
JOIN nation a ON c_nationkey = a.n_nationkey JOIN nation b ON s_nationkey = b.n_nationkey
WHERE {test} GROUP BY 1, 2"""


def _popular(t: Tables, predicate):
    """Lines meet the nation of their order, and are counted per supplier before suppliers are joined."""
    nation_of = t.orders.join(t.customer, F.expr("o_custkey = c_custkey")).select("o_orderkey", "c_nationkey")
    rides = trips.with_length(t.lineitem.select("l_orderkey", "l_suppkey", "l_quantity"), "l_quantity")
    counted = (
        rides.join(nation_of, F.expr("l_orderkey = o_orderkey"))
        .groupBy("is_long", "c_nationkey", "l_suppkey").agg(F.count("*").alias("lines"))
    )
    located = counted.join(t.supplier, F.expr("l_suppkey = s_suppkey"))
    return trips.popular_pairs(
        located, predicate, "c_nationkey", "s_nationkey", t.nation, "n_nationkey", "n_name", weight="lines"
    )


@query(_pairs("l_quantity >= 30"))
def popular_pairs(t: Tables):
    return _popular(t, F.col("is_long"))


@query(_pairs("NOT l_quantity >= 30"))
def popular_pairs_short(t: Tables):
    return _popular(t, ~F.col("is_long"))


@query("SELECT o_orderpriority, count(*) AS total_trips FROM orders GROUP BY 1")
def code_distribution(t: Tables):
    return trips.code_distribution(t.orders, "o_orderpriority")


@query("""
SELECT CAST(o_orderdate AS DATE) AS pickup_day, o_orderpriority, count(*) AS total_trips
FROM orders GROUP BY 1, 2""")
def code_per_day(t: Tables):
    return trips.code_per_day(t.orders, "o_orderdate", "o_orderpriority")


_GROUPS = """WITH g AS (
  SELECT CAST(round(floor(epoch(ts)) / 300) AS INTEGER) AS slot, event_type, count(*) AS total_trips,
         CAST(sum(CAST(value AS DECIMAL(28,2))) AS DOUBLE) AS total_amount
  FROM events WHERE value < 100 GROUP BY 1, 2),
m AS (SELECT CAST(sum(CAST(value AS DECIMAL(28,2))) AS DOUBLE) / count(value) AS mean_fare FROM events),
i AS (SELECT *, total_trips * 0.05::DOUBLE AS grouped_rides,
             total_trips * 0.05::DOUBLE * 0.3::DOUBLE * (mean_fare * 0.6::DOUBLE - 5)
             + total_trips * 0.05::DOUBLE * 0.7::DOUBLE * 2 AS total_impact FROM g, m)"""


def _impact(t: Tables):
    small = F.col("value") < 100
    groups = trips.sharing_groups(t.events, "ts", "event_type", "value", small, scale=2)
    return trips.sharing_impact(groups, t.events, "value", scale=2)


@query(_GROUPS + """
SELECT event_type, make_timestamp(slot::BIGINT * 300000000) AS approximate_datetime, total_trips, total_amount,
       round(total_impact, 6) AS total_impact FROM i""")
def ride_share_impact(t: Tables):
    return _impact(t).select(
        "event_type", F.col("approximate_datetime").cast("timestamp_ntz").alias("approximate_datetime"),
        "total_trips", "total_amount", F.round("total_impact", 6).alias("total_impact"),
    )


@query("""
WITH rides AS (SELECT o_orderdate, c_nationkey, o_totalprice, o_orderpriority FROM orders JOIN customer ON o_custkey = c_custkey),
g AS (
  SELECT CAST(round(floor(epoch(o_orderdate)) / 300) AS BIGINT) AS slot, c_nationkey, count(*) AS total_trips,
         CAST(sum(CAST(o_totalprice AS DECIMAL(28,2))) AS DOUBLE) AS total_amount
  FROM rides WHERE o_orderpriority <> '5-LOW' GROUP BY 1, 2)
SELECT r_name AS borough, n_name AS zone, make_timestamp(slot * 300000000) AS approximate_datetime, total_trips, total_amount
FROM g JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def ride_share_zones(t: Tables):
    """Trips of small parties by zone and five minutes, with the names of zone and borough."""
    rides = t.orders.join(t.customer, F.expr("o_custkey = c_custkey"))
    groups = trips.sharing_groups(rides, "o_orderdate", "c_nationkey", "o_totalprice", F.col("o_orderpriority") != "5-LOW", scale=2)
    zones = t.nation.join(t.region, F.expr("n_regionkey = r_regionkey")).select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("borough"), F.col("n_name").alias("zone")
    )
    named = trips.with_zone_names(groups, zones, "c_nationkey")
    return named.withColumn("approximate_datetime", F.col("approximate_datetime").cast("timestamp_ntz"))


@query(_GROUPS + "SELECT round(sum(total_impact), 4) AS total FROM i")
def ride_share_total(t: Tables):
    return trips.sharing_total(_impact(t)).select(F.round("total", 4).alias("total"))


@query("""
SELECT c_custkey, c_name, max(o_totalprice) AS max_amount FROM customer JOIN orders ON c_custkey = o_custkey
GROUP BY 1, 2""")
def max_spend_per_customer(t: Tables):
    pay = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    return people.best_pay(t.customer.select("c_custkey", "c_name"), pay, "c_custkey", "o_totalprice")


@query("SELECT count(*) AS n FROM orders WHERE o_orderdate > '1996-01-01' AND o_orderdate < '1997-01-01'")
def range_count(t: Tables):
    hired = people.hired_between(
        t.orders, "o_orderdate", F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1997-01-01").cast("timestamp_ntz")
    )
    return hired.agg(F.count("*").alias("n"))


_BY_DEPARTMENT = """
SELECT p_brand AS department, CAST(sum(CAST(o_totalprice AS DECIMAL(28,2))) AS DOUBLE) / count(*) AS mean_amount
FROM orders, lineitem, part
WHERE o_orderkey = l_orderkey AND l_partkey = p_partkey AND o_orderdate > '1996-01-01' AND o_orderdate < '1997-01-01'
GROUP BY 1"""


def _by_department(t: Tables):
    hires = t.orders.select(F.col("o_orderkey").alias("key"), F.col("o_orderdate").alias("hired"))
    memberships = t.lineitem.join(t.part, F.expr("l_partkey = p_partkey")).select(
        F.col("l_orderkey").alias("key"), F.col("p_brand").alias("department")
    )
    pay = t.orders.select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("amount"))
    return people.pay_by_department(hires, memberships, pay, "1996-01-01", "1997-01-01", scale=2)


@query(_BY_DEPARTMENT)
def avg_by_dept(t: Tables):
    return _by_department(t)


@query(f"""
SELECT upper(department) AS name, mean_amount FROM ({_BY_DEPARTMENT}) ORDER BY mean_amount DESC, department LIMIT 1""")
def best_dept(t: Tables):
    departments = t.part.select(F.col("p_brand").alias("department"), F.upper("p_brand").alias("name")).distinct()
    return people.best_department(_by_department(t), departments)


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT (o_orderkey // 7) * 2 FROM orders)")
def never_ordered(t: Tables):
    ordered = t.orders.select(F.expr("(o_orderkey div 7) * 2").alias("c_custkey"))
    return people.never_in(t.customer.select("c_custkey", "c_name"), ordered, "c_custkey")


@query("""
WITH best AS (SELECT o_custkey, max(o_totalprice) AS max_amount FROM orders GROUP BY 1
              ORDER BY max_amount DESC, o_custkey LIMIT 10)
SELECT o_custkey, max_amount, o_orderpriority FROM (
  SELECT o.*, max_amount, row_number() OVER (PARTITION BY o.o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders o JOIN best USING (o_custkey)) WHERE rn = 1""")
def top10_latest(t: Tables):
    return people.top_paid_titles(
        t.orders, t.orders.select("o_custkey", "o_orderpriority", "o_orderdate", "o_orderkey"), "o_custkey",
        "o_totalprice", ["o_orderpriority"], ["o_orderdate", "o_orderkey"],
    )


@query("""
SELECT p_brand, CAST(sum(p_size) AS DOUBLE) / count(p_size) AS mean_rating,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(28,2))) AS DOUBLE) AS total
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def report_by_group(t: Tables):
    joined = t.lineitem.join(t.part, F.expr("l_partkey = p_partkey")).select("p_brand", "p_size", "l_extendedprice")
    return reports.group_report(joined, "p_brand", "p_size", "l_extendedprice", scale=2)


@query("""
SELECT o_orderkey, o_totalprice + best AS total_gross FROM orders
LEFT JOIN (SELECT l_orderkey, max(l_extendedprice) AS best FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""")
def row_gross(t: Tables):
    best = t.lineitem.groupBy("l_orderkey").agg(F.max("l_extendedprice").alias("best"))
    joined = t.orders.join(best, F.expr("o_orderkey = l_orderkey"), "left")
    return joined.select("o_orderkey", reports.gross("o_totalprice", "best"))


@query("""
SELECT g.p_type, good, mean FROM (SELECT DISTINCT p_type FROM part) g
LEFT JOIN (SELECT p_type, count(*) AS good FROM part WHERE p_type = 'SMALL' AND p_size > 30 GROUP BY 1) USING (p_type)
LEFT JOIN (SELECT p_type, CAST(sum(p_size) AS DOUBLE) / count(*) AS mean FROM part GROUP BY 1) USING (p_type)""")
def genre_report(t: Tables):
    good = reports.good_of_genre(t.part, "p_type", "SMALL", "p_size", 30)
    good = good.groupBy("p_type").agg(F.count("*").alias("good"))
    return (
        reports.genre_list(t.part, "p_type").join(good, "p_type", "left")
        .join(reports.mean_by_genre(t.part, "p_type", "p_size"), "p_type", "left")
    )
