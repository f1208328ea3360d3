"""Sources and sinks. Each query writes a table in some format to the shared folder and scans it."""

from pyspark.sql import functions as F

from weftwork.catalog import Tables, query
from weftwork.plans import jobs
from weftwork.session import scratch_path
from weftwork.sources import files, local, managed
from weftwork.sources.registry import DatasetRegistry
from weftwork.operators.aggregate import exact_sum


@query("SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal FROM supplier")
def scan_json(t: Tables):
    path = files.write_files(t.supplier, scratch_path(t.spark, "json"), "json", compression="gzip")
    return files.read_json(t.spark, path, allowSingleQuotes=True, dateFormat="yyyy-MM-dd")


@query("""
SELECT CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS k FROM events WHERE event_type <> 'error'""")
def scan_json_mode(t: Tables):
    """Every line of an error event is cut short; malformed lines are dropped by the scan."""
    lines = t.events.select(
        F.when(F.col("event_type") == "error", F.expr("left(props, 4)")).otherwise(F.col("props")).alias("value")
    )
    path = scratch_path(t.spark, "broken-json")
    lines.write.text(path)
    # The corrupt-record column makes the parser look at whole lines although only k is asked for.
    return files.read_json(t.spark, path, schema="k bigint", mode="dropMalformed").select("k")


@query("""
SELECT CASE WHEN event_type <> 'error' THEN CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) END AS k FROM events""")
def scan_json_permissive(t: Tables):
    lines = t.events.select(
        F.when(F.col("event_type") == "error", F.lit("{'k': oops")).otherwise(F.col("props")).alias("value")
    )
    path = scratch_path(t.spark, "broken-json")
    lines.write.text(path)
    return files.read_json(t.spark, path, schema="k bigint", mode="permissive")


@query("""
SELECT s_suppkey, CASE WHEN s_acctbal > 1000 THEN s_name END AS s_name, s_acctbal, DATE '1998-12-01' AS seen
FROM supplier""")
def scan_csv(t: Tables):
    written = t.supplier.select(
        "s_suppkey", F.when(F.col("s_acctbal") > 1000, F.col("s_name")).alias("s_name"), "s_acctbal",
        F.lit("Dec 1 1998").alias("seen"),
    )
    path = files.write_files(written, scratch_path(t.spark, "csv"), "csv", sep=";", nullValue="none")
    return files.read_csv(
        t.spark, path, schema="s_suppkey bigint, s_name string, s_acctbal double, seen date",
        sep=";", nullValue="none", dateFormat="MMM d yyyy",
    )


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def scan_csv_inferred(t: Tables):
    path = files.write_files(
        t.customer.select(F.col("c_custkey") + 3_000_000_000, "c_name", "c_acctbal").toDF("c_custkey", "c_name", "c_acctbal"),
        scratch_path(t.spark, "csv"), "csv",
    )
    read = files.read_csv(t.spark, path)
    return read.withColumn("c_custkey", F.col("c_custkey") - 3_000_000_000)


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def register_dataset(t: Tables):
    registry = DatasetRegistry(column_types={"s_suppkey": "bigint", "s_nationkey": "int", "s_acctbal": "double"})
    registry.define("weft_supplier", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])
    path = files.write_files(t.supplier, scratch_path(t.spark, "named"), "csv")
    registry.load(t.spark, "weft_supplier", path)
    return t.spark.table("weft_supplier")


@query("SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def scan_parquet(t: Tables):
    path = files.write_files(t.orders, scratch_path(t.spark, "parquet"), "parquet")
    return files.read_parquet(t.spark, path, "o_orderkey", "o_totalprice", "o_orderpriority")


@query("""
SELECT doc_id, source, TRY_CAST(lang AS INTEGER) AS not_a_number, CAST(NULL AS VARCHAR) AS absent FROM documents""")
def scan_text_kv(t: Tables):
    lines = t.documents.select(F.concat_ws(" // ", F.col("doc_id").cast("string"), "source", "lang").alias("value"))
    path = scratch_path(t.spark, "text")
    lines.write.text(path)
    fields = [("doc_id", "bigint"), ("source", "string"), ("not_a_number", "int"), ("absent", "string")]
    return files.read_delimited_text(t.spark, path, " // ", fields)


@query("SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def transfer_tables(t: Tables):
    tag = scratch_path(t.spark, "x").rsplit("-", 1)[1][:8]
    names = {f"customer_{tag}": t.customer, f"nation_{tag}": t.nation}
    managed.transfer_tables(
        t.spark, names, names.__getitem__, save=True, path_of=lambda name: scratch_path(t.spark, name)
    )
    return t.spark.table(f"customer_{tag}").join(
        t.spark.table(f"nation_{tag}"), F.expr("c_nationkey = n_nationkey")
    ).select("c_custkey", "c_name", "n_name")


@query("""
SELECT o_orderkey, meaning FROM orders
JOIN (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'pending')) v(code, meaning) ON o_orderstatus = code""")
def local_rows(t: Tables):
    meanings = local.rows_table(
        t.spark, [("F", "finished"), ("O", "open"), ("P", "pending")], ["code", "meaning"]
    )
    return t.orders.join(F.broadcast(meanings), F.expr("o_orderstatus = code")).select("o_orderkey", "meaning")


@query("""
SELECT CAST(r.i AS BIGINT) AS size, count(p_partkey) AS parts, coalesce(CAST(sum(p_size) AS BIGINT), 0) AS total
FROM range(0, 61, 3) r(i) LEFT JOIN part ON p_size = r.i GROUP BY 1""")
def range_source(t: Tables):
    per_size = t.part.groupBy("p_size").agg(F.count("*").alias("n"), F.sum("p_size").alias("s"))
    steps = local.number_range(t.spark, 0, 61, 3).withColumnRenamed("id", "size")
    return steps.join(per_size, F.expr("size = p_size"), "left").select(
        "size", F.coalesce("n", F.lit(0)).alias("parts"), F.coalesce("s", F.lit(0)).alias("total")
    )


@query("SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def write_read_tsv(t: Tables):
    """Written in two steps: overwrite, then append."""
    path = scratch_path(t.spark, "tsv")
    columns = ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"]
    files.write_files(t.customer.where("c_nationkey < 8").select(columns), path, "tsv", "overwrite")
    files.write_files(t.customer.where("c_nationkey >= 8").select(columns), path, "tsv", "append")
    files.write_files(t.customer.select(columns), path, "tsv", "ignore")
    return files.read_csv(
        t.spark, path, schema="c_custkey bigint, c_name string, c_acctbal double, c_mktsegment string", sep="\t"
    )


@query("""
SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(28,2))) AS DOUBLE) / count(*) AS mean, count(*) AS n
FROM orders WHERE o_orderstatus = 'F' GROUP BY 1""")
def partitioned_bucketed_agg(t: Tables):
    """A table partitioned by status and bucketed by customer: one partition is read, and grouped as it lies."""
    tag = scratch_path(t.spark, "x").rsplit("-", 1)[1]
    table = managed.save_bucketed(
        t.orders, f"orders_by_status_{tag}", 8, ["o_custkey"], partition_by=["o_orderstatus"],
        path=scratch_path(t.spark, "orders-by-status"),
    )
    return (
        table.where("o_orderstatus = 'F'").groupBy("o_custkey")
        .agg((exact_sum("o_totalprice", 2) / F.count("*")).alias("mean"), F.count("*").alias("n"))
    )


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 400000")
def job_filter_sort(t: Tables):
    source = files.write_files(t.orders.select("o_orderkey", "o_totalprice"), scratch_path(t.spark, "in"), "json")
    target = scratch_path(t.spark, "out")
    jobs.filter_sort(
        t.spark, source, target, where="o_totalprice > 400000", order=["o_totalprice"], descending=True,
        schema="o_orderkey bigint, o_totalprice double",
    )
    return files.read_json(t.spark, target, schema="o_orderkey bigint, o_totalprice double")
