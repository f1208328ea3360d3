"""Graphs, shortest paths, ownership and gangs."""

from pyspark.sql import functions as F

from weftwork.catalog import Tables, query
from weftwork.operators import gangs, graph, ownership


def _buys(t: Tables):
    """Customers as vertices; an order is an edge to a number made from its key, half of them customers."""
    vertices = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("kind"))
    edges = t.orders.select(
        F.col("o_custkey").alias("src"), F.expr("o_orderkey div 5").alias("dst"),
        F.col("o_orderpriority").alias("label"),
    )
    return vertices, edges


_BUYS = """WITH v AS (SELECT c_custkey AS id, c_mktsegment AS kind FROM customer),
e AS (SELECT o_custkey AS src, o_orderkey // 5 AS dst, o_orderpriority AS label FROM orders)"""


@query(_BUYS + """
SELECT id, kind FROM v
UNION ALL SELECT id, 'MISSING' FROM (SELECT src AS id FROM e UNION SELECT dst FROM e) WHERE id NOT IN (SELECT id FROM v)""")
def graph_build_default(t: Tables):
    vertices, edges = _buys(t)
    return graph.with_default_vertices(vertices, edges, {"kind": "MISSING"})


@query(_BUYS + """
SELECT (SELECT count(*) FROM v WHERE kind = 'BUILDING') AS vertices, (SELECT count(*) FROM e WHERE src > dst) AS edges""")
def graph_edge_filter(t: Tables):
    vertices, edges = _buys(t)
    counted = edges.agg(F.count_if(F.col("src") > F.col("dst")).alias("edges"))
    return vertices.agg(F.count_if(F.col("kind") == "BUILDING").alias("vertices")).select(
        "vertices", counted.scalar().alias("edges")
    )


@query(_BUYS + """
SELECT a.kind || ' is ' || label || ' of ' || b.kind AS line, count(*) AS n
FROM e JOIN v a ON src = a.id JOIN v b ON dst = b.id GROUP BY 1""")
def graph_triplets(t: Tables):
    vertices, edges = _buys(t)
    lines = graph.triplets(vertices, edges, "kind").select(
        F.concat("src_attr", F.lit(" is "), "label", F.lit(" of "), "dst_attr").alias("line")
    )
    return lines.groupBy("line").agg(F.count("*").alias("n"))


@query(_BUYS + "SELECT id, CASE WHEN kind = 'BUILDING' THEN 'CONSTRUCTION' ELSE kind END AS kind FROM v")
def graph_map_vertices(t: Tables):
    vertices, _ = _buys(t)
    renamed = F.when(F.col("kind") == "BUILDING", "CONSTRUCTION").otherwise(F.col("kind"))
    return vertices.withColumn("kind", renamed)


@query("SELECT l_suppkey AS id, count(*) AS in_degree FROM lineitem GROUP BY 1")
def graph_in_degree(t: Tables):
    edges = t.lineitem.select(F.col("l_orderkey").alias("src"), F.col("l_suppkey").alias("dst"))
    return graph.aggregate_messages(edges, F.lit(1).cast("long"), F.sum, name="in_degree")


@query(_BUYS + """,
m AS (SELECT dst AS id, max(src) AS top FROM e GROUP BY 1)
SELECT v.id, kind, coalesce(greatest(v.id, m.top), v.id) AS best FROM v LEFT JOIN m ON v.id = m.id""")
def graph_outer_join_vertices(t: Tables):
    vertices, edges = _buys(t)
    messages = graph.aggregate_messages(edges, F.col("src"), F.max, name="top")
    return graph.merge_into_vertices(
        vertices.withColumn("best", F.col("id")), messages, "best", F.greatest("best", "top")
    )


@query(_BUYS + """
SELECT src, dst, count(*) AS n FROM e
WHERE label <> '5-LOW' AND src IN (SELECT id FROM v WHERE kind <> 'BUILDING')
  AND dst IN (SELECT id FROM v WHERE kind <> 'BUILDING')
GROUP BY 1, 2""")
def graph_subgraph(t: Tables):
    vertices, edges = _buys(t)
    _, kept = graph.subgraph(vertices, edges, F.col("kind") != "BUILDING", F.col("label") != "5-LOW")
    return kept.groupBy("src", "dst").agg(F.count("*").alias("n"))


# Every part points to two parts further on, so all chains end and have at most seven links.
_PART_EDGES = """e AS (
  SELECT p_partkey AS src, p_partkey + (p_partkey % 7 + 1) * (SELECT count(*) // 8 FROM part) AS dst,
         CAST(p_size AS DOUBLE) AS weight FROM part
  UNION ALL
  SELECT p_partkey, p_partkey + (p_partkey % 3 + 1) * (SELECT count(*) // 8 FROM part) + 1,
         CAST(p_size % 11 + 1 AS DOUBLE) FROM part),
landmarks AS (SELECT p_partkey AS id FROM part WHERE p_size = 50)"""


def _part_graph(t: Tables):
    eighth = t.part.agg(F.floor(F.count("*") / 8)).scalar()
    key = F.col("p_partkey")
    near = t.part.select(
        key.alias("src"), (key + (key % 7 + 1) * eighth).alias("dst"), F.col("p_size").cast("double").alias("weight")
    )
    far = t.part.select(
        key, key + (key % 3 + 1) * eighth + 1, (F.col("p_size") % 11 + 1).cast("double")
    )
    return near.union(far), t.part.where("p_size = 50").select(key.alias("id"))


def _paths(weight: str) -> str:
    return f"""
WITH RECURSIVE {_PART_EDGES},
walk AS (
  SELECT id, id AS landmark, CAST(0 AS DOUBLE) AS distance FROM landmarks
  UNION
  SELECT e.src, walk.landmark, walk.distance + {weight} FROM walk JOIN e ON e.dst = walk.id)
SELECT id, landmark, min(distance) AS distance FROM walk GROUP BY 1, 2"""


@query(_paths("e.weight"))
def shortest_path_weighted(t: Tables):
    edges, landmarks = _part_graph(t)
    return graph.shortest_paths(edges, landmarks, "weight")


@query(_paths("1"))
def shortest_path_hops(t: Tables):
    edges, landmarks = _part_graph(t)
    return graph.shortest_paths(edges, landmarks)


# Holdings: a part holds shares of two parts further on, in eighths and sixteenths, so that sums are exact.
_HOLDINGS = """e AS (
  SELECT p_partkey AS src, p_partkey + (p_partkey % 7 + 1) * (SELECT count(*) // 8 FROM part) AS dst,
         (p_size % 8 + 1) / 8.0 AS rate FROM part
  UNION ALL
  SELECT p_partkey, p_partkey + (p_partkey % 3 + 1) * (SELECT count(*) // 8 FROM part), (p_size % 5 + 1) / 16.0
  FROM part)"""


# Fourteen parts in a row hold the next one, and some the one after it: chains of thirteen links.
_CHAINS = """e AS (
  SELECT p_partkey AS src, p_partkey + 1 AS dst, (p_size % 3 + 5) / 8.0 AS rate FROM part WHERE p_partkey % 14 <> 0
  UNION ALL
  SELECT p_partkey, p_partkey + 2, (p_size % 3 + 1) / 16.0 FROM part WHERE p_partkey % 14 BETWEEN 1 AND 12 AND p_size % 2 = 0)"""


def _control_rounds(rounds: int, holdings: str = _HOLDINGS) -> str:
    """The rules of the propagation, written out round by round."""
    steps = [f"WITH {holdings}",
             "s0 AS (SELECT id, id AS origin, CAST(1 AS DOUBLE) AS share FROM (SELECT src AS id FROM e UNION SELECT dst FROM e))",
             "a0 AS (SELECT src, dst, CAST(rate AS DOUBLE) AS rate FROM e)"]
    for i in range(rounds):
        steps += [
            f"""m{i} AS (SELECT dst AS id, origin, sum(CASE WHEN share > 0.3 THEN rate ELSE rate * share END) AS sent
                FROM a{i} JOIN s{i} ON src = id WHERE share > 0.001 AND origin <> dst GROUP BY 1, 2)""",
            f"""s{i + 1} AS (SELECT id, origin, greatest(share, sent) AS share
                FROM s{i} FULL JOIN m{i} USING (id, origin))""",
            f"""a{i + 1} AS (SELECT src, dst, rate FROM a{i} WHERE dst IN (
                SELECT m.id FROM m{i} m LEFT JOIN s{i} s ON m.id = s.id AND m.origin = s.origin WHERE s.id IS NULL))""",
        ]
    return ",\n".join(steps) + f"\nSELECT origin, id, share FROM s{rounds} WHERE origin <> id"


@query(_control_rounds(8))
def control_shares(t: Tables):
    eighth = t.part.agg(F.floor(F.count("*") / 8)).scalar()
    key, size = F.col("p_partkey"), F.col("p_size")
    holdings = t.part.select(
        key.alias("src"), (key + (key % 7 + 1) * eighth).alias("dst"), ((size % 8 + 1) / 8).alias("rate")
    ).union(t.part.select(key, key + (key % 3 + 1) * eighth, (size % 5 + 1) / 16))
    return ownership.control_shares(holdings)


@query(_control_rounds(14, _CHAINS))
def control_shares_deep(t: Tables):
    key, size = F.col("p_partkey"), F.col("p_size")
    next_one = t.part.where("p_partkey % 14 <> 0").select(key.alias("src"), (key + 1).alias("dst"), ((size % 3 + 5) / 8).alias("rate"))
    one_after = t.part.where("p_partkey % 14 BETWEEN 1 AND 12 AND p_size % 2 = 0").select(key, key + 2, (size % 3 + 1) / 16)
    return ownership.control_shares(next_one.union(one_after))


@query("""
SELECT DISTINCT c_custkey AS src, s_suppkey AS dst, o_totalprice / 100 AS rate, 'BUY' AS kind
FROM orders JOIN customer ON c_name = 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')
JOIN supplier ON s_name = 'Supplier#' || lpad(CAST(o_orderkey // 120 AS VARCHAR), 9, '0')
UNION
SELECT DISTINCT c_custkey, s_suppkey, o_totalprice, 'ASK'
FROM orders JOIN customer ON c_name = 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')
JOIN supplier ON s_name = 'Supplier#' || lpad(CAST(o_orderkey // 200 AS VARCHAR), 9, '0')""")
def edge_resolve(t: Tables):
    """Text names at both ends become numbers; ends that are not known drop their edge."""
    ids = t.customer.select(F.col("c_name").alias("id"), F.col("c_custkey").alias("key")).union(
        t.supplier.select("s_name", "s_suppkey")
    )

    def named(orders_each: int):
        supplier = F.lpad(F.expr(f"CAST(o_orderkey div {orders_each} AS STRING)"), 9, "0")
        return t.orders.select(
            F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("from"),
            F.concat(F.lit("Supplier#"), supplier).alias("to"), F.col("o_totalprice").alias("rate"),
        )

    buys = ownership.resolve_edges(named(120), ids, "BUY", "rate")
    asks = ownership.resolve_edges(named(200), ids, "ASK", "rate", as_percent=False)
    return buys.unionByName(asks).distinct()


@query("""
SELECT count(*) AS unresolved FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
   OR o_orderkey // 120 NOT IN (SELECT s_suppkey FROM supplier)""")
def edge_unresolved(t: Tables):
    ids = t.customer.select(F.concat(F.lit("c"), "c_custkey").alias("id")).union(
        t.supplier.select(F.concat(F.lit("s"), "s_suppkey"))
    )
    edges = t.orders.select(
        F.concat(F.lit("c"), "o_custkey").alias("from"), F.concat(F.lit("s"), F.expr("o_orderkey div 120")).alias("to")
    )
    return ownership.unresolved_count(edges, ids)


@query(_control_rounds(8).replace("SELECT origin, id, share FROM s8", """
SELECT origin, a.p_name AS origin_name, id, b.p_name AS held_name, share
FROM s8 LEFT JOIN part a ON origin = a.p_partkey LEFT JOIN part b ON id = b.p_partkey""") + " AND share > 0.3")
def control_names(t: Tables):
    names = t.part.select(F.col("p_partkey").alias("key"), F.col("p_name").alias("name"))
    return ownership.controllers(control_shares(t), names)


def _links(t: Tables):
    return t.lineitem.select(F.col("l_orderkey").alias("case"), F.col("l_suppkey").alias("member"))


_TRIPLES = """WITH l AS (SELECT DISTINCT l_orderkey AS c, l_suppkey AS m FROM lineitem),
occurrences AS (
  SELECT a.m AS m1, b.m AS m2, d.m AS m3, a.c AS c
  FROM l a JOIN l b ON a.c = b.c AND a.m < b.m JOIN l d ON a.c = d.c AND b.m < d.m),
triples AS (SELECT m1, m2, m3, count(*) AS n FROM occurrences GROUP BY ALL HAVING count(*) >= {least})"""


@query(_TRIPLES.format(least=2) + " SELECT * FROM triples")
def triples_per_group(t: Tables):
    return gangs.triple_counts(_links(t), min_cases=2)


@query(_TRIPLES.format(least=3) + " SELECT * FROM triples")
def gang_triples(t: Tables):
    return gangs.triple_counts(_links(t))


@query(_TRIPLES.format(least=3) + """,
met AS (SELECT unnest([m1, m2, m3]) AS member, c FROM triples JOIN occurrences USING (m1, m2, m3))
SELECT member, count(DISTINCT c) AS cases FROM met GROUP BY member""")
def gang_suspects(t: Tables):
    return gangs.suspects(_links(t))


@query("""
WITH l AS (SELECT DISTINCT o_orderpriority || o_orderstatus AS c, o_custkey AS m FROM orders),
held AS (
  SELECT a.m, a.c AS c1, b.c AS c2, d.c AS c3, count(*) OVER (PARTITION BY a.c, b.c, d.c) AS n
  FROM l a JOIN l b ON a.m = b.m AND a.c < b.c JOIN l d ON a.m = d.m AND b.c < d.c),
met AS (SELECT m AS member, unnest([c1, c2, c3]) AS c FROM held WHERE n >= 3)
SELECT member, count(DISTINCT c) AS cases FROM met GROUP BY member""")
def gang_suspects_large(t: Tables):
    """Fifteen cases at most, each with a large part of all customers; their triples could not be listed."""
    return gangs.suspects(t.orders.select(
        F.concat("o_orderpriority", "o_orderstatus").alias("case"), F.col("o_custkey").alias("member")
    ))


@query(_TRIPLES.format(least=3) + """,
met AS (SELECT l.m AS member, m1, m2, m3, c FROM triples JOIN occurrences USING (m1, m2, m3) JOIN l USING (c)),
placed AS (
  SELECT *, count(*) OVER triple AS n, CAST((row_number() OVER (triple ORDER BY c) - 1) // 2 AS INTEGER) AS part
  FROM met WINDOW triple AS (PARTITION BY member, m1, m2, m3))
SELECT member, m1 || ',' || m2 || ',' || m3 AS triple, part, string_agg(c::VARCHAR, ',' ORDER BY c) AS cases
FROM placed WHERE n >= 3 GROUP BY member, m1, m2, m3, part""")
def gang_members(t: Tables):
    """Lines of two cases, so that every list of three has several."""
    return gangs.gang_report(gangs.gang_members(_links(t)), length=2)
