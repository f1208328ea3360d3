"""Stream sources, and the parsing of what they deliver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weftwork.sources.files import split_delimited
from weftwork.sources.schemas import PERSON


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Text lines from a socket; for trying things out, as a socket cannot be replayed."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def file_stream(
    spark: SparkSession, path: str, schema: StructType | str, fmt: str = "json",
    glob: str | None = None, files_per_batch: int | None = None, **options,
) -> DataFrame:
    """New files of a folder, with a fixed schema. ``files_per_batch`` bounds the size of a batch."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def topic_options(servers: str, topics: str, starting: str = "earliest", max_offsets: int | None = None) -> dict:
    """Reader options of the message-log source; ``max_offsets`` bounds the size of a batch."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topics, "startingOffsets": starting}
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def topic_stream(spark: SparkSession, servers: str, topics: str, **options) -> DataFrame:
    """Messages of one or more topics. The connector must be among the session's packages."""
    return spark.readStream.format("kafka").options(**topic_options(servers, topics, **options)).load()


def decode(messages: DataFrame, keep: tuple[str, ...] = ("topic",)) -> DataFrame:
    """Message key and value as text."""
    return messages.select(*keep, F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def people(lines: DataFrame) -> DataFrame:
    """Lines ``id:first:middle:last:gender:birth:ssn:salary`` as typed records."""
    fields = [(f.name, f.dataType.simpleString()) for f in PERSON.fields]
    return split_delimited(lines, "value", ":", fields)


def colour_events(lines: DataFrame) -> DataFrame:
    """Lines ``epoch_ms,colour`` as timestamp and colour."""
    return split_delimited(lines, "value", ",", [("ms", "bigint"), ("color", "string")]).select(
        F.timestamp_millis("ms").alias("created"), "color"
    )


def words(lines: DataFrame, column: str = "value", keep: tuple[str | Column, ...] = ()) -> DataFrame:
    return lines.select(*keep, F.explode(F.split(column, " ")).alias("word"))


def names_of(persons: DataFrame) -> DataFrame:
    """First and last names, one row each."""
    return persons.select(F.explode(F.array("first_name", "last_name")).alias("name"))


def json_records(lines: DataFrame, schema: StructType | str, column: str = "value") -> DataFrame:
    return lines.select(F.from_json(column, schema).alias("record")).select("record.*")
