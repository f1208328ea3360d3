"""Batch file scans and file sinks."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_MODES = {"permissive": "PERMISSIVE", "failfast": "FAILFAST", "dropmalformed": "DROPMALFORMED"}


def _reader(spark: SparkSession, schema: StructType | str | None, mode: str | None, options: dict):
    reader = spark.read.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    if mode is not None:
        reader = reader.option("mode", _MODES[mode.lower()])
    return reader


def read_json(
    spark: SparkSession, path: str, schema=None, mode: str | None = None, **options
) -> DataFrame:
    """JSON lines. Without ``schema`` Spark reads the data once more to infer it."""
    return _reader(spark, schema, mode, options).json(path)


def read_csv(
    spark: SparkSession, path: str, schema=None, mode: str | None = None, header: bool = True, **options
) -> DataFrame:
    if schema is None:
        options.setdefault("inferSchema", True)
    return _reader(spark, schema, mode, {"header": header, **options}).csv(path)


def read_parquet(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_delimited_text(
    spark: SparkSession, path: str, delimiter: str, fields: Sequence[tuple[str, str]]
) -> DataFrame:
    """Text lines cut at ``delimiter`` into typed columns; a missing or bad field is null."""
    return split_delimited(spark.read.text(path), "value", delimiter, fields)


def split_delimited(
    df: DataFrame, column: str, delimiter: str, fields: Sequence[tuple[str, str]], keep: Sequence[str] = ()
) -> DataFrame:
    parts = F.split(F.col(column), "\\Q" + delimiter + "\\E", -1)
    return df.select(
        *keep, *[F.get(parts, F.lit(i)).try_cast(kind).alias(name) for i, (name, kind) in enumerate(fields)]
    )


def write_files(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "error",
    partition_by: Sequence[str] = (),
    **options,
) -> str:
    """Write ``df`` as parquet, json, csv or tsv with a save mode: overwrite, append, ignore, error."""
    if fmt == "tsv":
        fmt, options = "csv", {"sep": "\t", **options}
    if fmt == "csv":
        options = {"header": True, **options}
    writer = df.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def write_file_count(df: DataFrame, path: str, files: int, fmt: str = "parquet", shuffle: bool = True) -> str:
    """Write about ``files`` files. Without ``shuffle`` partitions are merged where they lie."""
    sized = df.repartition(files) if shuffle else df.coalesce(files)
    return write_files(sized, path, fmt, "overwrite")


def partitions_for(total_bytes: int, target_bytes: int = 64 * 1024 * 1024) -> int:
    """How many partitions keep each near ``target_bytes`` (10 to 100 MB is the useful range)."""
    return max(1, math.ceil(total_bytes / target_bytes))
