"""Comparing all rows of a key without a key growing beyond a task: pairs of chunks, and sorted streams of groups."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_chunk_pairs(placed: DataFrame, keys: list[str], spread: str, chunk: int) -> DataFrame:
    """``placed`` with a column ``part``: rows of equal ``part`` are to be compared with each other.

    A key with up to ``chunk`` rows is one part. A larger key is dealt into chunks by the hash of ``spread``, and each pair of
    chunks is a part, so that every two rows of the key meet in some part and no part is larger than two chunks. ``chunk`` is
    1 in the rows of a pair's later chunk and else 0.
    Null keys are not allowed.
    """
    large = (
        placed.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > chunk)
        .select(*keys, F.ceil(F.col("n") / chunk).cast("int").alias("chunks"))
    )
    mine = F.pmod(F.xxhash64(spread), F.col("chunks")).cast("int")
    return (
        placed.join(large, keys, "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumn("part", F.xxhash64(*keys, F.least(mine, "other"), F.greatest(mine, "other")))
        .withColumn("chunk", (mine > F.col("other")).cast("int"))
        .drop("chunks", "other")
    )


def by_whole_groups(rows_at_once: int, keys: int, work: Callable[[pa.Table], Iterator[pa.RecordBatch]]):
    """A function for mapInArrow over rows sorted by their first ``keys`` columns, which hands ``work`` whole groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            waiting.append(batch)
            rows += batch.num_rows
            if rows < rows_at_once:
                continue
            table = pa.Table.from_batches(waiting).combine_chunks()
            same = None
            for i in range(keys):
                column = table.column(i).to_numpy()
                equal = column == column[-1]
                same = equal if same is None else same & equal
            whole = int((~same).nonzero()[0][-1]) + 1 if not same.all() else 0
            if whole:
                yield from work(table.slice(0, whole))
            rest = table.slice(whole).combine_chunks()
            waiting, rows = rest.to_batches(), rest.num_rows
        if rows:
            yield from work(pa.Table.from_batches(waiting).combine_chunks())

    return run
