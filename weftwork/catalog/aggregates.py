"""Aggregations."""

import uuid

from pyspark.sql import functions as F

from weftwork.catalog import Tables, query
from weftwork.functions import udfs
from weftwork.operators import aggregate
from weftwork.session import scratch_path


def money_sum(column: str):
    """The tables hold amounts in cents."""
    return aggregate.exact_sum(column, scale=2)


def _sum(column: str, kind: str = "DECIMAL(28,2)") -> str:
    return f"CAST(sum(CAST({column} AS {kind})) AS DOUBLE)"


@query("""
SELECT count(o_orderkey) AS with_order, count(*) AS all_rows
FROM customer LEFT JOIN orders ON c_custkey = (o_orderkey // 7) * 2""")
def agg_counts(t: Tables):
    orders = t.orders.select("o_orderkey")
    joined = t.customer.select("c_custkey").join(orders, F.expr("c_custkey = (o_orderkey div 7) * 2"), "left")
    return joined.agg(F.count("o_orderkey").alias("with_order"), F.count("*").alias("all_rows"))


@query("SELECT count(DISTINCT user_id) AS users, count(DISTINCT event_type) AS types FROM events")
def agg_count_distinct(t: Tables):
    return t.events.agg(F.count_distinct("user_id").alias("users"), F.count_distinct("event_type").alias("types"))


@query(f"""
SELECT min(l_quantity) AS lo, max(l_quantity) AS hi, {_sum('l_quantity')} AS total,
       {_sum('l_quantity')} / count(l_quantity) AS mean
FROM lineitem""")
def agg_basic(t: Tables):
    total = money_sum("l_quantity")
    return t.lineitem.agg(
        F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi"), total.alias("total"),
        (total / F.count("l_quantity")).alias("mean"),
    )


@query("""
SELECT round(avg(o_totalprice), 2) AS mean, round(stddev_samp(o_totalprice), 2) AS deviation FROM orders""")
def agg_stddev(t: Tables):
    return t.orders.agg(
        F.round(F.mean("o_totalprice"), 2).alias("mean"), F.round(F.stddev_samp("o_totalprice"), 2).alias("deviation")
    )


@query("SELECT round(corr(l_quantity, l_extendedprice), 6) AS correlation FROM lineitem")
def agg_corr(t: Tables):
    return t.lineitem.agg(F.round(F.corr("l_quantity", "l_extendedprice"), 6).alias("correlation"))


@query("""
SELECT count(*) AS count, 30 AS threshold, round(avg(l_quantity), 4) AS mean,
       round(stddev_samp(l_quantity), 4) AS stddev, min(l_quantity) AS min, max(l_quantity) AS max
FROM lineitem""")
def profile_distance(t: Tables):
    row = aggregate.profile(t.lineitem, "l_quantity", 30)
    return row.withColumns({c: F.round(c, 4) for c in ("mean", "stddev")})


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def group_count(t: Tables):
    return aggregate.count_groups(t.events, "event_type")


@query(f"SELECT event_type, {_sum('value')} / count(value) AS mean FROM events GROUP BY 1")
def group_avg(t: Tables):
    return t.events.groupBy("event_type").agg((money_sum("value") / F.count("value")).alias("mean"))


@query(f"""
SELECT p_brand, count(*) AS parts, {_sum('p_retailprice')} AS total, max(p_size) AS largest,
       {_sum('p_retailprice')} / count(*) AS mean_price
FROM part GROUP BY 1 ORDER BY mean_price""")
def group_multi_agg(t: Tables):
    return (
        t.part.groupBy("p_brand").agg(
            F.count("*").alias("parts"), money_sum("p_retailprice").alias("total"), F.max("p_size").alias("largest"),
            (money_sum("p_retailprice") / F.count("*")).alias("mean_price"),
        ).orderBy("mean_price")
    )


@query("SELECT o_custkey, max(o_totalprice) AS best FROM orders GROUP BY 1")
def group_max(t: Tables):
    return t.orders.groupBy("o_custkey").agg(F.max("o_totalprice").alias("best"))


@query("""
SELECT o_custkey, o_orderkey, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1""")
def group_latest(t: Tables):
    return aggregate.latest_row(
        t.orders, ["o_custkey"], ["o_orderkey", "o_orderpriority"], ["o_orderdate", "o_orderkey"]
    )


@query(f"""
SELECT o_orderpriority, o_orderstatus, {_sum('o_totalprice')} / count(*) AS mean
FROM orders WHERE o_totalprice > 100000 AND o_orderstatus <> 'P' GROUP BY 1, 2 ORDER BY mean DESC NULLS LAST""")
def filtered_group_avg(t: Tables):
    return (
        t.orders.where("o_totalprice > 100000 AND o_orderstatus <> 'P'").groupBy("o_orderpriority", "o_orderstatus")
        .agg((money_sum("o_totalprice") / F.count("*")).alias("mean"))
        .orderBy(F.col("mean").desc_nulls_last())
    )


@query(f"SELECT user_id, {_sum('value')} AS total FROM events GROUP BY 1")
def sum_by_key(t: Tables):
    return t.events.groupBy("user_id").agg(money_sum("value").alias("total"))


_WORDS = "SELECT {keep} unnest(regexp_split_to_array(text, '\\s+')) AS word FROM documents"


@query(f"WITH w AS ({_WORDS.format(keep='')}) SELECT word, count(*) AS n FROM w WHERE word <> '' GROUP BY 1")
def word_count(t: Tables):
    return aggregate.word_counts(t.documents, "text")


@query(f"""
WITH w AS ({_WORDS.format(keep='')}) SELECT word, count(*) AS n FROM w WHERE word IN ('the', 'of', 'la', 'und') GROUP BY 1""")
def word_count_listed(t: Tables):
    return aggregate.word_counts(t.documents, "text", only=["the", "of", "la", "und"])


@query(f"""
WITH w AS ({_WORDS.format(keep='')}) SELECT word, count(*) AS n FROM w WHERE word <> '' GROUP BY 1
ORDER BY n DESC, word LIMIT 5""")
def word_count_top(t: Tables):
    return aggregate.word_counts(t.documents, "text", top=5)


@query(f"""
WITH w AS ({_WORDS.format(keep='source,')}),
c AS (SELECT source, word, count(*) AS n FROM w WHERE word <> '' GROUP BY 1, 2)
SELECT word, max(n) AS max_n FROM c GROUP BY 1""")
def sum_then_max(t: Tables):
    return aggregate.largest_part_count(t.documents, "source", "text")


@query("""
WITH w AS (SELECT source, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS words FROM documents)
SELECT source, count(*) AS lines, CAST(sum(len(words)) AS BIGINT) AS words,
       CAST(max(list_max(list_transform(words, lambda x: length(x)))) AS INTEGER) AS longest_word,
       CAST(sum(len(list_filter(words, lambda x: x = 'the'))) AS BIGINT) AS critical_words
FROM w GROUP BY 1""")
def text_stats_by_source(t: Tables):
    return aggregate.text_stats(t.documents, "source", "text", "the")


@query("""
WITH b AS (SELECT l_suppkey, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2),
m AS (SELECT l_partkey, max(n) AS multiplier FROM b GROUP BY 1)
SELECT multiplier, count(*) AS cnt FROM m GROUP BY 1""")
def count_max_histogram(t: Tables):
    return aggregate.repeat_histogram(t.lineitem, "l_suppkey", "l_partkey")


@query("""
WITH lucky AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 450000),
tries AS (SELECT o_orderpriority AS batch, o.o_custkey, count(*) AS n FROM orders o JOIN lucky USING (o_custkey)
          GROUP BY 1, 2),
m AS (SELECT o_custkey, max(n) AS multiplier FROM tries GROUP BY 1)
SELECT multiplier, count(*) AS cnt FROM m GROUP BY 1""")
def filtered_multiplicity(t: Tables):
    """Tries per batch of those who won at some time: filter the winners first, then count."""
    lucky = t.orders.where("o_orderpriority = '1-URGENT' AND o_totalprice > 450000").select("o_custkey")
    tries = t.orders.join(lucky, "o_custkey", "left_semi")
    return aggregate.repeat_histogram(tries, "o_orderpriority", "o_custkey")


@query(f"""
SELECT lower(c_mktsegment) AS segment, CAST(sum(c_custkey) AS BIGINT) AS sum_c_custkey,
       CAST(sum(c_nationkey) AS BIGINT) AS sum_c_nationkey, {_sum('c_acctbal')} AS sum_c_acctbal
FROM customer GROUP BY 1""")
def group_sum_all_numeric(t: Tables):
    return aggregate.sum_numeric(t.customer, F.lower("c_mktsegment"), "segment", scale=2)


@query(f"""
SELECT lower(c_mktsegment) AS segment, count(*) AS n, {_sum('c_acctbal')} AS balance FROM customer GROUP BY 1""")
def udf_lower_group(t: Tables):
    """The registered Python function runs on Arrow batches; the built-in ``lower`` is the faster way."""
    name = udfs.register_lower(t.spark)
    t.customer.createOrReplaceTempView("weft_customer")
    return t.spark.sql(f"""
        SELECT segment, count(*) AS n, CAST(sum(CAST(c_acctbal AS DECIMAL(28,2))) AS DOUBLE) AS balance
        FROM (SELECT {name}(c_mktsegment) AS segment, c_acctbal FROM weft_customer) GROUP BY segment""")


@query("""
WITH placed AS (
  SELECT c_nationkey, c_custkey,
         CAST((row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // 20 AS INTEGER) AS part
  FROM customer)
SELECT c_nationkey, part, list_sort(list(c_custkey)) AS collected FROM placed GROUP BY 1, 2""")
def group_collect(t: Tables):
    """Slices of 20, so that nations have several."""
    return aggregate.collect_lists(t.customer, "c_nationkey", "c_custkey", length=20)


@query("SELECT o_custkey, list_sort(list(DISTINCT o_orderpriority)) AS collected FROM orders GROUP BY 1")
def group_collect_distinct(t: Tables):
    return aggregate.collect_distinct(t.orders, "o_custkey", "o_orderpriority").drop("part")


@query("""
WITH d AS (SELECT DISTINCT l_returnflag, l_orderkey FROM lineitem),
placed AS (
  SELECT *, CAST((row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey) - 1) // 100 AS INTEGER) AS part FROM d)
SELECT l_returnflag, part, list_sort(list(l_orderkey)) AS collected FROM placed GROUP BY 1, 2""")
def group_collect_distinct_parts(t: Tables):
    """Three keys with a third of the rows each, in slices of 100 distinct orders."""
    return aggregate.collect_distinct(t.lineitem, "l_returnflag", "l_orderkey", length=100)


@query("""
SELECT unnest(['count', 'mean', 'stddev', 'min', 'max']) AS summary,
       unnest([count(p_size), round(avg(p_size), 6), round(stddev_samp(p_size), 6), min(p_size), max(p_size)]) AS p_size
FROM part""")
def describe_col(t: Tables):
    return aggregate.summary(t.part, "p_size").select("summary", F.round(F.col("p_size").cast("double"), 6).alias("p_size"))


@query("SELECT p_brand, CAST(sum(p_size) // count(*) AS BIGINT) AS mean_size FROM part GROUP BY 1")
def int_mean(t: Tables):
    return t.part.groupBy("p_brand").agg(aggregate.integer_mean("p_size", "mean_size"))


@query("""
WITH w AS (SELECT doc_id, unnest(regexp_split_to_array(text, '\\s+')) AS word FROM documents)
SELECT md5(word) AS digest, count(*) AS n,
       CAST(sum(CASE WHEN lower(word) = 'the' THEN 1 ELSE 0 END) AS BIGINT) AS marked
FROM w WHERE word <> '' GROUP BY 1""")
def observe_count(t: Tables):
    """Count while transforming: the marked words are counted along the way, by an observed metric as well."""
    words = aggregate.words_of(t.documents, "text")
    is_marked = F.lower("word") == "the"
    watched, _ = aggregate.observed(words, "marked_words", marked=F.count_if(is_marked))
    return watched.groupBy(F.md5(F.col("word").cast("binary")).alias("digest")).agg(
        F.count("*").alias("n"), F.count_if(is_marked).alias("marked")
    )


@query("""
WITH d AS (SELECT CAST(ts AS DATE) AS day, event_type AS item, sum(CAST(value AS DECIMAL(28,2))) AS total
           FROM events GROUP BY 1, 2)
SELECT day, item, CAST(total AS DOUBLE) AS total FROM (
  SELECT *, row_number() OVER (PARTITION BY day ORDER BY total DESC, item) AS rn FROM d) WHERE rn = 1""")
def best_seller_per_day(t: Tables):
    totals = t.events.groupBy(F.to_date("ts").alias("day"), F.col("event_type").alias("item")).agg(
        F.sum(F.col("value").cast("decimal(18,2)")).alias("total")
    )
    return aggregate.top_per_group(totals, "day", "item", "total").withColumn("total", F.col("total").cast("double"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem ORDER BY l_extendedprice, l_orderkey, l_partkey, l_linenumber LIMIT 10")
def map_in_partition(t: Tables):
    """The smallest lines: each task keeps ten while it reads its batches, and the tens are merged."""
    order = ["l_extendedprice", "l_orderkey", "l_partkey", "l_linenumber"]
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return udfs.smallest_per_partition(lines, order, 10).orderBy(*order).limit(10)


@query("SELECT doc_id, lang, source FROM documents WHERE lang IN ('de', 'fr')")
def broadcast_filter(t: Tables):
    return t.documents.where(udfs.in_list("lang", ["de", "fr"])).select("doc_id", "lang", "source")


@query("""
WITH w AS (SELECT unnest(regexp_split_to_array(text, '\\s+')) AS word FROM documents)
SELECT md5(word) AS digest, count(*) AS n, (SELECT count(*) FROM w WHERE lower(word) = 'the') AS marked
FROM w WHERE word <> '' GROUP BY 1""")
def observe_side_count(t: Tables):
    """The number of marked words, counted on the side while the digests are written; no second pass counts them."""
    words = aggregate.words_of(t.documents, "text")
    watched, watch = aggregate.observed(words, f"side_count_{uuid.uuid4().hex}", marked=F.count_if(F.lower("word") == "the"))
    digests = watched.groupBy(F.md5(F.col("word").cast("binary")).alias("digest")).agg(F.count("*").alias("n"))
    path = scratch_path(t.spark, "digests")
    digests.write.parquet(path)
    return t.spark.read.parquet(path).withColumn("marked", F.lit(watch.get["marked"]).cast("long"))
