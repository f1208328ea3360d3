"""Tables of a relational database over JDBC."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    driver: str
    user: str | None = None
    password: str | None = None

    def options(self, table: str) -> dict[str, str]:
        found = {"url": self.url, "driver": self.driver, "dbtable": table}
        if self.user is not None:
            found["user"] = self.user
        if self.password is not None:
            found["password"] = self.password
        return found


@dataclass(frozen=True)
class KeyRange:
    """How a table is split into parallel reads: one query per slice of a numeric or date key."""

    column: str
    lower: int | str
    upper: int | str
    slices: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.slices),
        }


def read_table(
    spark: SparkSession, target: JdbcTarget, table: str, split: KeyRange | None = None, fetch_size: int = 10_000
) -> DataFrame:
    """Without ``split`` one task reads the whole table; give one for anything but a dimension."""
    options = {**target.options(table), "fetchsize": str(fetch_size)}
    if split is not None:
        options.update(split.options())
    return spark.read.format("jdbc").options(**options).load()


def write_table(
    df: DataFrame, target: JdbcTarget, table: str, mode: str = "append", connections: int = 16, batch_size: int = 10_000
) -> None:
    """``connections`` bounds the number of sessions that the database sees at the same time."""
    options = {**target.options(table), "batchsize": str(batch_size), "numPartitions": str(connections)}
    df.write.format("jdbc").mode(mode).options(**options).save()


def transaction(spark: SparkSession, target: JdbcTarget, statements: list[str]) -> None:
    """Run statements on one connection of the driver: all of them or none."""
    jvm = spark.sparkContext._jvm
    jvm.java.lang.Class.forName(target.driver)
    login = jvm.java.util.Properties()
    for name, value in (("user", target.user), ("password", target.password)):
        if value is not None:
            login.setProperty(name, value)
    connection = jvm.java.sql.DriverManager.getConnection(target.url, login)
    try:
        connection.setAutoCommit(False)
        try:
            for statement in statements:
                connection.createStatement().execute(statement)
            connection.commit()
        except Exception:
            connection.rollback()
            raise
    finally:
        connection.close()
