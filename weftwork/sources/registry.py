"""Data sets known by name: layout looked up, file loaded, temporary view registered."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from weftwork.sources.files import read_csv


@dataclass
class DatasetRegistry:
    """Column lists per data set, and one type per column name (string unless said otherwise)."""

    column_types: Mapping[str, str] = field(default_factory=dict)
    datasets: dict[str, Sequence[str]] = field(default_factory=dict)

    def define(self, name: str, columns: Sequence[str]) -> None:
        self.datasets[name] = tuple(columns)

    def schema(self, name: str) -> StructType:
        if name not in self.datasets:
            raise KeyError(f"data set {name!r} is not registered")
        fields = (f"`{c}` {self.column_types.get(c, 'string')}" for c in self.datasets[name])
        return StructType.fromDDL(", ".join(fields))

    def load(self, spark: SparkSession, name: str, path: str, **options) -> DataFrame:
        df = read_csv(spark, path, schema=self.schema(name), **options)
        df.createOrReplaceTempView(name)
        return df
