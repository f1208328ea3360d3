"""Projections, filters and predicates."""

from pyspark.sql import functions as F

from weftwork.catalog import Tables, query
from weftwork.functions import text
from weftwork.operators import project


@query("SELECT c_custkey, c_name, c_acctbal * 2 AS double_balance FROM customer")
def select_cols(t: Tables):
    return t.customer.select("c_custkey", F.col("c_name"), (F.col("c_acctbal") * 2).alias("double_balance"))


@query("""
SELECT l_orderkey, l_linenumber, l_quantity / 2.2 AS kilograms,
       CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) AS net
FROM lineitem""")
def computed_cols(t: Tables):
    return project.compute(
        t.lineitem, ["l_orderkey", "l_linenumber"],
        kilograms="l_quantity / 2.2D",
        net="CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE)",
    )


@query("""
SELECT p_partkey, p_name AS "part name", p_brand, p_size + 10 AS bigger, p_retailprice FROM part""")
def rename_drop(t: Tables):
    return project.reshape(
        t.part, add={"bigger": F.col("p_size") + 10}, rename={"p_name": "part name"}, drop=["p_type", "p_size"]
    )


@query("SELECT s_suppkey, 'plain text' AS note, 47 AS number FROM supplier")
def literal_col(t: Tables):
    return t.supplier.select("s_suppkey", F.lit("plain text").alias("note"), F.lit(47).alias("number"))


@query("""
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderstatus = 'F' AND o_totalprice > 150000 AND (o_orderpriority = '1-URGENT' OR o_orderdate < '1996-01-01')""")
def filter_and(t: Tables):
    return project.where_all(
        t.orders, F.col("o_orderstatus") == "F", "o_totalprice > 150000",
        (F.col("o_orderpriority") == "1-URGENT") | (F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")),
    ).select("o_orderkey", "o_totalprice")


@query("""
SELECT event_id, event_type FROM events
WHERE event_type <> 'click' AND event_type <> 'view' AND event_type <> 'error'""")
def filter_not_in(t: Tables):
    return project.exclude_values(t.events, "event_type", ["click", "view", "error"]).select("event_id", "event_type")


@query("""
SELECT o_orderkey, o_orderstatus = 'O' AND o_totalprice > 100000 AS big_open FROM orders
WHERE NOT (o_orderstatus = 'O' AND o_totalprice > 100000)""")
def bool_flag(t: Tables):
    flag = (F.col("o_orderstatus") == "O") & (F.col("o_totalprice") > 100000)
    return project.with_flag(t.orders, "big_open", flag).where(~F.col("big_open")).select("o_orderkey", "big_open")


@query("SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'ring') OR contains(p_name, 'blue')")
def contains_any(t: Tables):
    return t.part.where(project.contains_any("p_name", ["ring", "blue"])).select("p_partkey", "p_name")


@query("SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, 'bolt|hot')")
def regex_any(t: Tables):
    return t.part.where(project.matches_any("p_name", ["bolt", "hot"])).select("p_partkey", "p_name")


@query("""
SELECT c_custkey FROM customer LEFT JOIN orders ON c_custkey = (o_orderkey // 7) * 2
WHERE o_orderkey IS NULL""")
def null_filter(t: Tables):
    joined = t.customer.join(t.orders.select("o_orderkey"), F.expr("c_custkey = (o_orderkey div 7) * 2"), "left")
    return joined.where(F.col("o_orderkey").isNull()).select("c_custkey")


@query("SELECT p_partkey, upper(p_name) AS name FROM part WHERE p_size > 40")
def typed_filter_map(t: Tables):
    return t.part.where(F.col("p_size") > 40).select("p_partkey", F.upper("p_name").alias("name"))


@query("SELECT p_partkey, p_size * 7 AS scaled FROM part WHERE p_size * 7 >= 100")
def scale_by_const(t: Tables):
    return project.scale(t.part, "p_size", 7, at_least=100).select("p_partkey", "scaled")


@query("""
SELECT p_partkey, p_partkey * 0 AS "newCol0", p_partkey * 1 AS "newCol1", p_partkey * 2 AS "newCol2",
       p_partkey * 3 AS "newCol3", p_partkey * 4 AS "newCol4"
FROM part""")
def add_columns_n(t: Tables):
    return project.add_columns(t.part.select("p_partkey"), "p_partkey", 5)


@query("SELECT p_partkey, p_name FROM part WHERE length(p_name) <= 8")
def short_strings(t: Tables):
    return project.short_strings(t.part, "p_name", 8).select("p_partkey", "p_name")


@query()
def sample_fraction(t: Tables):
    return project.sample_fraction(t.lineitem, 0.1, seed=7).select("l_orderkey", "l_linenumber")


@query("""
SELECT o_orderkey FROM orders
WHERE ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT % 100 < 10""")
def sample_by_key(t: Tables):
    return project.sample_by_key(t.orders, "o_orderkey", 10, 100).select("o_orderkey")


@query("""
SELECT o_orderkey, CASE WHEN o_totalprice >= 250000 THEN 'expensive' ELSE 'cheap' END AS price_label FROM orders""")
def label_case(t: Tables):
    return t.orders.select(
        "o_orderkey", text.label(F.col("o_totalprice") >= 250000, "expensive", "cheap").alias("price_label")
    )


@query("SELECT count(*) AS rows, CAST(0 AS BIGINT) AS repeated, CAST(0 AS BIGINT) AS unknown, true AS share_is_near FROM lineitem")
def sample_fraction_profile(t: Tables):
    """A sample of a tenth: no row twice, none that the table lacks, and a share within six deviations."""
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    # Told apart by their number among equal rows, so that equal rows of the table are no repeats.
    numbered = t.lineitem.groupBy(*key).agg(F.count("*").alias("there"))
    taken = project.sample_fraction(t.lineitem, 0.1, seed=7).groupBy(*key).agg(F.count("*").alias("taken"))
    both = numbered.join(taken, key, "full")
    totals = both.agg(
        F.sum("there").alias("rows"), F.sum("taken").alias("sampled"),
        F.count_if(F.col("taken") > F.col("there")).alias("repeated"), F.count_if(F.col("there").isNull()).alias("unknown"),
    )
    near = F.abs(F.col("sampled") - 0.1 * F.col("rows")) <= 6 * F.sqrt(0.09 * F.col("rows"))
    return totals.select("rows", "repeated", "unknown", near.alias("share_is_near"))
