"""Scalar, date, null and nested functions."""

from pyspark.sql import functions as F

from weftwork.catalog import Tables, query
from weftwork.functions import dates, nested, nulls, sentiment, text


@query("""
SELECT p_partkey, upper(p_name) AS up, lower(p_type) AS low,
       array_to_string(list_transform(string_split(p_name, ' '),
                       lambda x: upper(substr(x, 1, 1)) || lower(substr(x, 2))), ' ') AS cap
FROM part""")
def str_case(t: Tables):
    return t.part.select(
        "p_partkey", F.upper("p_name").alias("up"), F.lower("p_type").alias("low"), F.initcap("p_name").alias("cap")
    )


@query("SELECT p_partkey, regexp_extract(p_name, 'ring|bolt', 0) AS found FROM part")
def str_regex_extract(t: Tables):
    return t.part.select("p_partkey", F.regexp_extract("p_name", "ring|bolt", 0).alias("found"))


@query("SELECT p_partkey, regexp_replace(p_name, 'r|l', '_', 'g') AS changed FROM part")
def str_regex_replace(t: Tables):
    return t.part.select("p_partkey", F.regexp_replace("p_name", "r|l", "_").alias("changed"))


@query("""
SELECT p_partkey, string_split(p_name, ' ') AS words, string_split(p_name, ' ')[1] AS first_word,
       string_split(p_name, ' ')[6] AS sixth_word,
       CAST(len(string_split(p_name, ' ')) AS INTEGER) AS n, list_contains(string_split(p_name, ' '), 'ring') AS is_ring
FROM part""")
def str_split_array(t: Tables):
    words = F.split("p_name", " ")
    return t.part.select(
        "p_partkey", words.alias("words"), text.split_at("p_name", " ", 0).alias("first_word"),
        text.split_at("p_name", " ", 5).alias("sixth_word"), F.size(words).alias("n"),
        F.array_contains(words, "ring").alias("is_ring"),
    )


@query("""
SELECT p_partkey, CAST(length(p_name) AS INTEGER) AS n, concat(p_partkey, '_', p_name) AS joined FROM part""")
def str_len_concat(t: Tables):
    return t.part.select(
        "p_partkey", F.length("p_name").alias("n"), F.concat("p_partkey", F.lit("_"), "p_name").alias("joined")
    )


@query("SELECT p_partkey, CAST(length(p_name) - length(replace(p_name, 'e', '')) AS INTEGER) AS e_count FROM part")
def str_char_count(t: Tables):
    return t.part.select("p_partkey", text.char_count("p_name", "e").alias("e_count"))


@query("SELECT p_partkey, md5(p_name) AS digest FROM part")
def md5_words(t: Tables):
    return t.part.select("p_partkey", text.word_md5("p_name").alias("digest"))


@query("""
SELECT l_orderkey, l_linenumber, abs(l_quantity - 25) AS away, round(l_quantity / 8, 2) AS eighth,
       l_partkey % 7 AS rest, l_quantity * 2 + 1 AS odd
FROM lineitem""")
def math_ops(t: Tables):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", F.abs(F.col("l_quantity") - 25).alias("away"),
        F.round(F.col("l_quantity") / 8, 2).alias("eighth"), F.pmod("l_partkey", F.lit(7)).alias("rest"),
        (F.col("l_quantity") * 2 + 1).alias("odd"),
    )


@query("""
SELECT event_id, TRY_CAST(regexp_extract(props, '[0-9]+', 0) AS INTEGER) AS k, CAST(value AS VARCHAR) AS value_text,
       CAST(floor(value) AS BIGINT) AS whole, TRY_CAST(event_type AS INTEGER) AS not_a_number
FROM events""")
def cast_types(t: Tables):
    return t.events.select(
        "event_id", F.regexp_extract("props", "[0-9]+", 0).try_cast("int").alias("k"),
        F.col("value").cast("string").alias("value_text"), F.floor("value").cast("long").alias("whole"),
        F.col("event_type").try_cast("int").alias("not_a_number"),
    )


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS parsed, CAST(NULL AS DATE) AS unparsed FROM orders")
def parse_date(t: Tables):
    written = t.orders.select("o_orderkey", F.date_format("o_orderdate", "MMM d yyyy").alias("written"))
    return written.select(
        "o_orderkey", dates.parse_date("written", "MMM d yyyy").alias("parsed"),
        dates.parse_date("written", "yyyy-MM-dd").alias("unparsed"),
    )


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS parsed FROM orders""")
def parse_date_multi(t: Tables):
    status = F.col("o_orderstatus")
    written = t.orders.select(
        "o_orderkey",
        F.when(status == "F", F.date_format("o_orderdate", "dd-MM-yyyy"))
        .when(status == "O", F.date_format("o_orderdate", "yyyy/MM/dd"))
        .otherwise("some day").alias("written"),
    )
    return written.select("o_orderkey", dates.parse_date_any("written", "dd-MM-yyyy", "yyyy/MM/dd").alias("parsed"))


@query("""
SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') / 365 AS age,
       CAST(o_orderdate AS DATE) + 10 AS later
FROM orders""")
def date_age(t: Tables):
    as_of = F.lit("2002-01-01").cast("date")
    return t.orders.select(
        "o_orderkey", dates.day_age("o_orderdate", as_of).alias("age"), dates.add_days("o_orderdate", 10).alias("later")
    )


@query("""
SELECT o_orderkey, CAST(date_part('year', age(TIMESTAMP '2002-05-15', o_orderdate)) AS INTEGER) AS years FROM orders""")
def age_years(t: Tables):
    return t.orders.select("o_orderkey", dates.full_years("o_orderdate", F.lit("2002-05-15").cast("date")).alias("years"))


@query("""
SELECT o_orderkey, CAST(date_part('year', age(TIMESTAMP '2003-02-28', born)) AS INTEGER) AS years
FROM (SELECT o_orderkey, CAST(TIMESTAMP '1992-02-28' + INTERVAL (CAST(o_orderkey % 3 AS INTEGER)) DAY AS TIMESTAMP) AS born FROM orders)""")
def age_years_leap(t: Tables):
    """Births on 28 and 29 February and 1 March of a leap year, seen from 28 February."""
    born = F.expr("CAST(date_add(DATE '1992-02-28', CAST(o_orderkey % 3 AS INT)) AS TIMESTAMP)")
    return t.orders.select("o_orderkey", born.alias("born")).select(
        "o_orderkey", dates.full_years("born", F.lit("2003-02-28").cast("date")).alias("years")
    )


@query("""
SELECT event_id, make_timestamp((1704067200000 + event_id * 1500) * 1000) AS created,
       CAST(floor(epoch(ts)) AS BIGINT) AS seconds
FROM events""")
def epoch_ms(t: Tables):
    made = dates.from_epoch_ms(F.lit(1704067200000) + F.col("event_id") * 1500)
    return t.events.select(
        "event_id", made.cast("timestamp_ntz").alias("created"), dates.epoch_seconds("ts").alias("seconds")
    )


_LEFT = """FROM customer LEFT JOIN (SELECT (o_orderkey // 7) * 2 AS even, max(o_totalprice) AS best, min(o_orderkey) AS first_order
  FROM orders GROUP BY 1) ON c_custkey = even"""


def _with_nulls(t: Tables):
    """All orders under a key that leaves every other customer without one."""
    best = t.orders.groupBy(F.expr("(o_orderkey div 7) * 2").alias("even")).agg(
        F.max("o_totalprice").alias("best"), F.min("o_orderkey").alias("first_order")
    )
    return t.customer.join(best, F.expr("c_custkey = even"), "left")


@query(f"SELECT c_custkey, coalesce(best, c_acctbal * 10) AS worth, ifnull(best, 0) AS known {_LEFT}")
def null_coalesce(t: Tables):
    return _with_nulls(t).select(
        "c_custkey", nulls.first_known("best", F.col("c_acctbal") * 10).alias("worth"),
        F.ifnull("best", F.lit(0.0)).alias("known"),
    )


@query(f"""
SELECT c_custkey, nullif(c_nationkey, 3) AS nation,
       CASE WHEN best IS NOT NULL THEN best ELSE -c_acctbal END AS worth {_LEFT}""")
def null_nullif_nvl2(t: Tables):
    return _with_nulls(t).select(
        "c_custkey", nulls.null_if_equal("c_nationkey", F.lit(3)).alias("nation"),
        nulls.if_known("best", F.col("best"), -F.col("c_acctbal")).alias("worth"),
    )


@query(f"SELECT c_custkey, best {_LEFT} WHERE best IS NOT NULL")
def null_drop(t: Tables):
    return nulls.drop_nulls(_with_nulls(t).select("c_custkey", "best"))


@query(f"SELECT c_custkey, coalesce(best, 0.5) AS best, coalesce(first_order, -1) AS first_order {_LEFT}")
def null_fill(t: Tables):
    return nulls.fill_nulls(
        _with_nulls(t).select("c_custkey", "best", "first_order"), each={"best": 0.5, "first_order": -1}
    )


@query(f"SELECT c_custkey, coalesce(best, 0) AS best, coalesce(first_order, 0) AS first_order {_LEFT}")
def null_fill_one_value(t: Tables):
    return nulls.fill_nulls(_with_nulls(t).select("c_custkey", "best", "first_order"), 0, ["best", "first_order"])


@query("SELECT o_orderkey, o_totalprice AS price, o_orderstatus AS status FROM orders")
def struct_roundtrip(t: Tables):
    packed = t.orders.select("o_orderkey", F.struct("o_totalprice", "o_orderstatus").alias("s"))
    return packed.select(
        "o_orderkey", F.col("s").getField("o_totalprice").alias("price"), F.expr("s.o_orderstatus").alias("status")
    )


@query("SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def explode_words(t: Tables):
    return t.part.select("p_partkey", F.explode(F.split("p_name", " ")).alias("word"))


@query("SELECT event_id, CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS k FROM events")
def json_parse(t: Tables):
    return nested.parse_json(t.events, "props", "k bigint", keep=["event_id"])


@query("""
SELECT p_partkey, '{"p_partkey":' || p_partkey || ',"p_name":"' || p_name || '","p_size":' || p_size || '}' AS body
FROM part""")
def json_build(t: Tables):
    return t.part.select("p_partkey", nested.build_json("p_partkey", "p_name", "p_size").alias("body"))


_ENTRIES = "SELECT l_suppkey, l_returnflag, max(l_quantity) AS l_quantity FROM lineitem GROUP BY 1, 2"


@query(_ENTRIES)
def map_merge(t: Tables):
    return nested.merge_entries(t.lineitem, ["l_suppkey"], "l_returnflag", "l_quantity", F.max)


@query("""
SELECT l_suppkey, l_returnflag, CAST(sum(CAST(l_quantity AS DECIMAL(28,2))) AS DOUBLE) AS l_quantity
FROM lineitem GROUP BY 1, 2""")
def map_merge_sum(t: Tables):
    lines = t.lineitem.withColumn("l_quantity", F.col("l_quantity").cast("decimal(18,2)"))
    merged = nested.merge_entries(lines, ["l_suppkey"], "l_returnflag", "l_quantity", F.sum)
    return merged.withColumn("l_quantity", F.col("l_quantity").cast("double"))


# The tables hold invented prose, so the list is made of words that occur in it.
_LIST = sentiment.Lexicon(positive=("the", "and", "la", "un", "der"), negative=("of", "is", "est", "ist", "no"))


@query(f"""
WITH s AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[.!?\\n]+'), lambda x: trim(x, ' ') <> '') AS sentences
  FROM documents),
p AS (
  SELECT doc_id, len(sentences) AS n, list_sum(list_transform(sentences, lambda x: greatest(0, least(4,
    2 + len(list_filter(regexp_split_to_array(x, '[^\\p{{L}}\\p{{N}}]+'), lambda w: w IN {_LIST.positive}))
      - len(list_filter(regexp_split_to_array(x, '[^\\p{{L}}\\p{{N}}]+'), lambda w: w IN {_LIST.negative})))))) AS total
  FROM s),
r AS (SELECT doc_id, CASE WHEN n > 0 THEN total / n ELSE -1 END AS score FROM p)
SELECT doc_id, round(score, 6) AS score, CASE
  WHEN score < 0 THEN 'NOT_UNDERSTOOD' WHEN score < 1 THEN 'VERY_NEGATIVE' WHEN score < 2 THEN 'NEGATIVE'
  WHEN score < 3 THEN 'NEUTRAL' WHEN score < 4 THEN 'POSITIVE' WHEN score < 5 THEN 'VERY_POSITIVE'
  ELSE 'NOT_UNDERSTOOD' END AS band
FROM r""")
def sentiment_band(t: Tables):
    scored = t.documents.select("doc_id", sentiment.text_score("text", _LIST).alias("score"))
    return scored.select("doc_id", F.round("score", 6).alias("score"), sentiment.band(F.col("score")).alias("band"))
