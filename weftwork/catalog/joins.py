"""Joins."""

from pyspark.sql import functions as F

from weftwork.catalog import Tables, query
from weftwork.operators import bandjoin, joins
from weftwork.session import scratch_path
from weftwork.sources.managed import save_bucketed

_CUST = "c_custkey = o_custkey"


@query(f"SELECT o_orderkey, c_name FROM orders JOIN customer ON {_CUST}")
def join_inner(t: Tables):
    return t.orders.join(t.customer, F.expr(_CUST), "inner").select("o_orderkey", "c_name")


# A key that leaves rows of both tables without a match: odd customers, and orders past the last customer.
_EVEN, _EVEN_SQL = "c_custkey = (o_orderkey div 7) * 2", "c_custkey = (o_orderkey // 7) * 2"


@query(f"SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON {_EVEN_SQL}")
def join_left(t: Tables):
    return t.customer.join(t.orders, F.expr(_EVEN), "left").select("c_custkey", "o_orderkey")


@query(f"SELECT c_custkey, o_orderkey FROM customer RIGHT JOIN orders ON {_EVEN_SQL}")
def join_right(t: Tables):
    return t.customer.join(t.orders, F.expr(_EVEN), "right").select("c_custkey", "o_orderkey")


@query("""
SELECT s_suppkey, c_custkey
FROM supplier FULL JOIN customer ON s_suppkey = c_custkey AND s_nationkey = c_nationkey""")
def join_full(t: Tables):
    return (
        t.supplier.join(t.customer, F.expr("s_suppkey = c_custkey AND s_nationkey = c_nationkey"), "full")
        .select("s_suppkey", "c_custkey")
    )


@query(f"SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE {_EVEN_SQL})")
def join_semi(t: Tables):
    return t.customer.join(t.orders, F.expr(_EVEN), "left_semi").select("c_custkey", "c_name")


@query(f"SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE {_EVEN_SQL})")
def join_anti(t: Tables):
    return t.customer.join(t.orders, F.expr(_EVEN), "left_anti").select("c_custkey", "c_name")


@query("""
SELECT c.c_custkey AS custkey, c.c_name AS name, s.s_name AS right_name, n.n_name
FROM customer c JOIN supplier s ON c.c_custkey = s.s_suppkey JOIN nation n ON n.n_nationkey = c.c_nationkey""")
def join_using(t: Tables):
    customers = t.customer.select(
        F.col("c_custkey").alias("custkey"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey")
    )
    suppliers = t.supplier.select(F.col("s_suppkey").alias("custkey"), F.col("s_name").alias("name"))
    nations = t.nation.select(F.col("n_nationkey").alias("nationkey"), "n_name")
    paired = joins.join_renamed(customers, suppliers, {"custkey": "custkey"}).drop("right_custkey")
    return paired.join(nations, "nationkey").drop("nationkey")


_DOC_WORDS = """
WITH docs AS (SELECT doc_id, regexp_split_to_array(text, '\\s+') AS words FROM documents),
vocabulary AS (SELECT DISTINCT unnest(regexp_split_to_array(text, '\\s+')) AS word FROM benchmark)"""


def _docs_and_words(t: Tables):
    """Documents with their words as an array, and the words of the benchmark items."""
    arrays = t.documents.select("doc_id", F.split("text", "\\s+").alias("words"))
    words = t.benchmark.select(F.explode(F.split("text", "\\s+")).alias("word")).distinct()
    return arrays, words


@query(_DOC_WORDS + """
SELECT doc_id, word FROM docs, vocabulary WHERE list_contains(words, word)""")
def join_array_contains(t: Tables):
    return joins.array_member_join(*_docs_and_words(t), "words", "doc_id", "word", columns=["doc_id"])


@query(_DOC_WORDS + """
SELECT doc_id, word FROM docs FULL JOIN vocabulary ON list_contains(words, word)""")
def join_array_contains_full(t: Tables):
    return joins.array_member_join(*_docs_and_words(t), "words", "doc_id", "word", how="full", columns=["doc_id"])


@query(f"""
SELECT o_orderkey, o_totalprice, c_custkey, c_name FROM orders JOIN customer ON {_CUST}""")
def join_pair_struct(t: Tables):
    pairs = joins.join_structs(
        t.orders.select("o_orderkey", "o_custkey", "o_totalprice"),
        t.customer.select("c_custkey", "c_name"),
        F.expr(_CUST),
    )
    return pairs.select(
        "left_record.o_orderkey", "left_record.o_totalprice", "right_record.c_custkey", "right_record.c_name"
    )


@query("SELECT s_suppkey, r_name FROM supplier, region")
def join_cross(t: Tables):
    """The right side is the fixed list of regions; its length is checked before it is sent out."""
    return joins.bounded_product(t.supplier, t.region, max_rows=100).select("s_suppkey", "r_name")


@query("""
SELECT n_name, CAST(sum(CAST(l_quantity AS DECIMAL(28,2))) AS DOUBLE) AS quantity
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1""")
def join_broadcast(t: Tables):
    """Lines are summed per supplier before anything is joined; the nation list is counted, then sent out."""
    per_supplier = t.lineitem.groupBy("l_suppkey").agg(
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("quantity")
    )
    located = per_supplier.join(t.supplier, F.expr("l_suppkey = s_suppkey"))
    named = joins.lookup_join(located, t.nation, F.expr("s_nationkey = n_nationkey"), broadcast_rows=1000)
    return named.groupBy("n_name").agg(F.sum("quantity").cast("double").alias("quantity"))


_ORDER_LINES = """
SELECT o_orderkey, o_orderpriority, count(*) AS lines
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2"""


@query(_ORDER_LINES)
def join_bucketed(t: Tables):
    """Both tables saved in the same buckets by order key: the join and the count need no shuffle."""
    tag = scratch_path(t.spark, "buckets").rsplit("-", 1)[1]
    orders = save_bucketed(
        t.orders.select(F.col("o_orderkey").alias("key"), "o_orderpriority"), f"orders_{tag}", 8, ["key"],
        path=scratch_path(t.spark, "orders"),
    )
    lines = save_bucketed(
        t.lineitem.select(F.col("l_orderkey").alias("key"), "l_linenumber"), f"lines_{tag}", 8, ["key"],
        path=scratch_path(t.spark, "lines"),
    )
    return (
        orders.hint("merge").join(lines, "key").groupBy("key", "o_orderpriority")
        .agg(F.count("*").alias("lines")).withColumnRenamed("key", "o_orderkey")
    )


@query("""
SELECT o_orderkey, o_totalprice, l_linenumber, l_extendedprice,
       l_extendedprice * 1 AS "newCol1", l_extendedprice * 2 AS "newCol2"
FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def join_copartitioned(t: Tables):
    orders = t.orders.select(F.col("o_orderkey").alias("key"), "o_totalprice")
    lines = t.lineitem.select(F.col("l_orderkey").alias("key"), "l_linenumber", "l_extendedprice")
    joined = joins.copartitioned_join(orders, lines, "key").withColumnRenamed("key", "o_orderkey")
    return joined.selectExpr("*", *[f"l_extendedprice * {i} AS newCol{i}" for i in (1, 2)])


_BEST_LINE = """
SELECT o_orderkey, o_custkey, best FROM orders
JOIN (SELECT l_orderkey, max(l_extendedprice) AS best FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey"""


def _keyed(t: Tables):
    orders = t.orders.select(F.col("o_orderkey").alias("key"), "o_custkey")
    lines = t.lineitem.select(F.col("l_orderkey").alias("key"), F.col("l_extendedprice").alias("best"))
    return orders, lines


@query(_BEST_LINE)
def join_preagg(t: Tables):
    orders, lines = _keyed(t)
    return joins.best_then_join(lines, orders, "key", "best").withColumnRenamed("key", "o_orderkey")


@query(_BEST_LINE + " WHERE best > 60000")
def join_prefilter(t: Tables):
    orders, lines = _keyed(t)
    return joins.best_then_join(lines, orders, "key", "best", above=60000).withColumnRenamed("key", "o_orderkey")


@query(_BEST_LINE + " WHERE best > 60000")
def join_then_best(t: Tables):
    orders, lines = _keyed(t)
    return joins.join_then_best(lines, orders, "key", "best", ["o_custkey"], 60000).withColumnRenamed(
        "key", "o_orderkey"
    )


@query("""
SELECT c_custkey, c_name, max(o_totalprice) AS best
FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2 HAVING max(o_totalprice) > 350000""")
def join_best_attempt(t: Tables):
    """Each customer's best order: reduced to one row per key and filtered while narrow, then joined."""
    scores = t.orders.select(F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("best"))
    return joins.best_then_join(scores, t.customer.select("c_custkey", "c_name"), "c_custkey", "best", above=350000)


_BAND_SQL = """
SELECT l.p_partkey, CAST(sum(CAST(r.p_retailprice AS DECIMAL(28,4))) AS DOUBLE) / count(*) AS avg_price
FROM part l JOIN part r ON l.p_brand = r.p_brand AND l.p_type = r.p_type AND abs(l.p_size - r.p_size) <= 1
GROUP BY 1"""


def _band_query(form):
    def build(t: Tables):
        part = t.part
        means = form(part, part, ["p_brand", "p_type"], "p_size", "p_retailprice", 1, ["p_partkey"], scale=4)
        return means.withColumnRenamed("avg_amount", "avg_price")

    return build


@query(_BAND_SQL)
def band_join_avg(t: Tables):
    return _band_query(bandjoin.band_average)(t)


@query(_BAND_SQL)
def band_join_bucketed(t: Tables):
    return _band_query(bandjoin.band_average_bucketed)(t)


@query(_BAND_SQL)
def band_join_salted(t: Tables):
    return _band_query(bandjoin.band_average_salted)(t)


@query(_BAND_SQL)
def band_join_running(t: Tables):
    return _band_query(bandjoin.band_average_running)(t)


@query("""
WITH sums AS (
  SELECT p_brand, p_type, p_size, sum(CAST(l_extendedprice AS DECIMAL(28,2))) AS total, count(*) AS n
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
SELECT p.p_partkey, CAST(sum(total) AS DOUBLE) / sum(n) AS avg_price
FROM part p JOIN sums s ON p.p_brand = s.p_brand AND p.p_type = s.p_type AND abs(p.p_size - s.p_size) <= 1
GROUP BY 1""")
def band_join_offers(t: Tables):
    """Mean price of the sold lines of similar parts, for each part."""
    offers = t.lineitem.join(t.part, F.expr("l_partkey = p_partkey")).select(
        "p_brand", "p_type", "p_size", "l_extendedprice"
    )
    means = bandjoin.band_average_bucketed(
        t.part, offers, ["p_brand", "p_type"], "p_size", "l_extendedprice", 1, ["p_partkey"], scale=2
    )
    return means.withColumnRenamed("avg_amount", "avg_price")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey""")
def join_salted(t: Tables):
    lines = t.lineitem.select(F.col("l_partkey").alias("key"), "l_orderkey", "l_linenumber")
    parts = t.part.select(F.col("p_partkey").alias("key"), "p_brand")
    return bandjoin.salted_join(parts, lines, ["key"], "l_orderkey").withColumnRenamed("key", "l_partkey")


@query("""
WITH names AS (SELECT c_custkey AS id FROM customer),
mails AS (SELECT c_custkey + 50 AS id, min(c_name) AS mail FROM customer GROUP BY 1),
scores AS (SELECT (o_orderkey // 7) * 2 AS id, max(o_totalprice) AS score FROM orders GROUP BY 1)
SELECT id, mail, CASE WHEN mail IS NULL OR score IS NULL THEN NULL
                      WHEN score >= 300000 THEN 'PASSED' ELSE 'FAILED' END AS result
FROM names FULL JOIN mails USING (id) FULL JOIN scores USING (id)""")
def cogroup3(t: Tables):
    return joins.cogroup_three(
        t.customer.select(F.col("c_custkey").alias("id")),
        t.customer.select((F.col("c_custkey") + 50).alias("id"), F.col("c_name").alias("mail")),
        t.orders.select(F.expr("(o_orderkey div 7) * 2").alias("id"), F.col("o_totalprice").alias("score")),
        "id", "mail", "score", pass_mark=300000,
    )


@query("""
SELECT l_orderkey, l_linenumber, cn.n_name AS customer_nation, sn.n_name AS supplier_nation
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN supplier ON l_suppkey = s_suppkey
JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN nation sn ON s_nationkey = sn.n_nationkey""")
def double_lookup(t: Tables):
    facts = (
        t.lineitem.join(t.orders, F.expr("l_orderkey = o_orderkey"))
        .join(t.customer, F.expr("o_custkey = c_custkey")).join(t.supplier, F.expr("l_suppkey = s_suppkey"))
        .select("l_orderkey", "l_linenumber", "c_nationkey", "s_nationkey")
    )
    return joins.double_lookup(
        facts, t.nation, "n_nationkey", "n_name", "c_nationkey", "s_nationkey", "customer_nation", "supplier_nation"
    ).drop("c_nationkey", "s_nationkey")


@query("""
SELECT l_orderkey, l_linenumber, upper(p_name) AS part_name FROM lineitem JOIN part ON l_partkey = p_partkey""")
def join_precompute(t: Tables):
    """The name is put into upper case once per part, below the join, not once per line above it."""
    named = t.part.select("p_partkey", F.upper("p_name").alias("part_name"))
    return t.lineitem.join(named, F.expr("l_partkey = p_partkey")).select("l_orderkey", "l_linenumber", "part_name")
