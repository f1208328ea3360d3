"""Catalog tables: bucketed and partitioned layouts, table transfer, databases."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession


def save_bucketed(
    df: DataFrame,
    table: str,
    buckets: int,
    keys: Sequence[str],
    sort: bool = True,
    partition_by: Sequence[str] = (),
    path: str | None = None,
) -> DataFrame:
    """Save ``df`` hashed into ``buckets`` by ``keys``, so that later joins on them need no shuffle.

    The rows are shuffled to their bucket first: each bucket is then one file, not one per task. One key
    is always in one bucket, so a table with a very hot key is better joined by ``salted_join`` or by AQE.
    """
    writer = df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").bucketBy(buckets, *keys)
    if sort:
        writer = writer.sortBy(*keys)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def transfer_tables(
    spark: SparkSession,
    names: Iterable[str],
    read: Callable[[str], DataFrame],
    save: bool = False,
    path_of: Callable[[str], str] | None = None,
) -> dict[str, DataFrame]:
    """Read each named table, register a view, and if asked overwrite a catalog table with it."""
    loaded = {}
    for name in names:
        df = read(name)
        df.createOrReplaceTempView(f"{name}_view")
        if save:
            writer = df.write.mode("overwrite").format("parquet")
            if path_of is not None:
                writer = writer.option("path", path_of(name))
            writer.saveAsTable(name)
            df = spark.table(name)
        loaded[name] = df
    return loaded


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")


def use_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"USE `{name}`")


def list_databases(spark: SparkSession) -> list[str]:
    return [row[0] for row in spark.sql("SHOW DATABASES").collect()]
