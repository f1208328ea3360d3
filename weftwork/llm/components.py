"""Connected components of a large graph as DataFrame rounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.session import checkpointed


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The vertices of these edges and, for each, the least vertex that it reaches by them."""
    vertices, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[:len(a)], at[len(a):]
    root = np.arange(len(vertices))
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low != high
        a, b, low, high = a[apart], b[apart], low[apart], high[apart]
        np.minimum.at(root, high, low)
        while True:
            next_root = root[root]
            if np.array_equal(next_root, root):
                break
            root = next_root
    return vertices, vertices[root]


def _shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch's edges as stars: as many components, no more edges than vertices."""
    for batch in batches:
        a, b = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        vertices, roots = local_roots(a, b)
        keep = vertices != roots
        yield pa.RecordBatch.from_arrays([pa.array(vertices[keep]), pa.array(roots[keep])], names=["high", "low"])


def components(edges: DataFrame) -> DataFrame:
    """Rows (vertex, root): for each vertex of an edge, the least vertex that it reaches.

    ``edges`` has two long columns; self-loops and repeats are allowed, null ends are not. Each round hangs
    every larger neighbour of a vertex on its least neighbour, then every smaller one. Rounds end when no
    edge changes, after some log(vertices) of them. Minima are aggregated before they are shuffled, and a vertex with very many
    edges is split by the skew join.
    """
    first, second = edges.columns
    stars = checkpointed(
        edges.where(F.col(first) != F.col(second))
        .select(F.greatest(first, second).alias("high"), F.least(first, second).alias("low"))
        .mapInArrow(_shrink, "high long, low long").distinct()
    )
    mark = _mark(stars)
    while mark[0]:
        both = stars.unionByName(stars.select(F.col("low").alias("high"), F.col("high").alias("low")))
        least = both.groupBy("high").agg(F.min("low").alias("near"))
        large = (
            both.join(least, "high").where(F.col("low") > F.col("high"))
            .select(F.col("low").alias("high"), F.least("high", "near").alias("low"))
        ).distinct()
        least = large.groupBy("high").agg(F.min("low").alias("near"))
        small = large.join(least, "high")
        stars = checkpointed(
            small.select(F.col("low").alias("high"), F.col("near").alias("low"))
            .unionByName(small.select("high", F.col("near").alias("low")))
            .where(F.col("high") != F.col("low")).distinct()
        )
        before, mark = mark, _mark(stars)
        if mark == before:
            break
    roots = stars.select(F.col("high").alias("vertex"), F.col("low").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("vertex"), "root").distinct())


def _mark(stars: DataFrame) -> tuple:
    """What tells one set of edges from another: their number and a sum of hashes."""
    row = stars.agg(F.count("*").alias("n"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]
