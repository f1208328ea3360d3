"""Property graphs as two tables: vertices(id, ...) and edges(src, dst, ...).

Iterative results keep their state as rows and write it to the shared folder after each round, so
the plan does not grow and a lost executor does not replay earlier rounds.
"""

from __future__ import annotations

import itertools

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftwork.session import checkpointed


# A frontier counted to be no longer than this is sent to every task.
BROADCAST_ROWS = 100_000


def with_default_vertices(vertices: DataFrame, edges: DataFrame, defaults: dict) -> DataFrame:
    """All vertices; ids that only edges name get default attributes."""
    ends = edges.select(F.col("src").alias("id")).union(edges.select("dst")).distinct()
    extra = ends.join(vertices, "id", "left_anti").select(
        "id", *[F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name) for f in vertices.schema if f.name != "id"]
    )
    return vertices.unionByName(extra)


def triplets(vertices: DataFrame, edges: DataFrame, attribute: str) -> DataFrame:
    """Edges with the attribute of both ends."""
    source = vertices.select(F.col("id").alias("src"), F.col(attribute).alias("src_attr"))
    target = vertices.select(F.col("id").alias("dst"), F.col(attribute).alias("dst_attr"))
    return edges.join(source, "src").join(target, "dst")


def aggregate_messages(
    edges: DataFrame, message: Column, merge: Callable[[str], Column], to: str = "dst", name: str = "msg"
) -> DataFrame:
    """One message per edge to an end of it, merged per vertex. Edge columns may come from ``triplets``."""
    return edges.select(F.col(to).alias("id"), message.alias(name)).groupBy("id").agg(merge(name).alias(name))


def merge_into_vertices(vertices: DataFrame, messages: DataFrame, name: str, merged: Column) -> DataFrame:
    """Vertex table with an attribute computed from the message, which is null where there is none."""
    others = [c for c in vertices.columns if c != name]
    return vertices.join(messages, "id", "left").select(*others, merged.alias(name))


def subgraph(
    vertices: DataFrame, edges: DataFrame, vertex_test: Column | None = None, edge_test: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Vertices and edges that pass; an edge goes with any of its ends."""
    if edge_test is not None:
        edges = edges.where(edge_test)
    if vertex_test is not None:
        vertices = vertices.where(vertex_test)
        ids = vertices.select("id")
        edges = edges.join(ids, edges["src"] == ids["id"], "left_semi")
        edges = edges.join(ids, edges["dst"] == ids["id"], "left_semi")
    return vertices, edges


def shortest_paths(
    edges: DataFrame, landmarks: DataFrame, weight: str | None = None, max_rounds: int | None = None,
    rewrite_below: int = 1_000_000,
) -> DataFrame:
    """Least distance along edge direction from each vertex to each landmark that it can reach.

    ``landmarks`` has a column ``id``. Negative weights are an error; without a weight edges count 1.
    Each round only sends from rows that improved in the last one, against the edges, and ends when
    none did. Parallel edges are reduced to the lightest one before the loop.
    Returns (id, landmark, distance).

    A round rewrites the table of known distances while that is short (``rewrite_below`` rows) or while
    many rows improve. In the long tail of a large graph, where few do, a round reads the table without
    shuffling it and writes the improvements only.
    """
    cost = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    light = checkpointed(
        edges.where("src <> dst").groupBy("src", "dst").agg(F.min(cost).alias("cost"))
    )
    if weight is not None and not light.where("cost < 0").isEmpty():
        raise ValueError("negative weights have no shortest path")
    known = landmarks.select("id", F.col("id").alias("landmark"), F.lit(0.0).alias("distance"))
    frontier, senders, size, improvements = known, None, 0, 0
    for done in itertools.count(1):
        offers = _offers(light, frontier, senders)
        few = senders is not None and size > rewrite_below and senders * 50 < size and improvements < 20
        if few:
            offers = checkpointed(offers.groupBy("id", "landmark").agg(F.min("offer").alias("offer")))
            few = offers.count() <= BROADCAST_ROWS
        if few:
            frontier = checkpointed(_improved(known, offers))
            known = known.union(frontier)
            senders, improvements = frontier.count(), improvements + 1
        else:
            merged = checkpointed(_merged(known, offers))
            known, frontier = merged.drop("fresh"), merged.where("fresh").drop("fresh")
            counted = merged.agg(F.count("*").alias("size"), F.count_if("fresh").alias("fresh")).first()
            size, senders, improvements = counted.size, counted.fresh, 0
        if senders == 0:
            break
        if done == max_rounds:
            raise RuntimeError(f"no fixed point within {max_rounds} rounds")
    if improvements:
        known = known.groupBy("id", "landmark").agg(F.min("distance").alias("distance"))
    return known


def _offers(light: DataFrame, frontier: DataFrame, senders: int | None) -> DataFrame:
    """(id, landmark, offer): the distances that the rows of the frontier offer along each edge."""
    sending = frontier.withColumnRenamed("id", "dst")
    if senders is not None and senders <= BROADCAST_ROWS:
        # Counted to be few: they go to the edges, and the edges are not shuffled in this round.
        sending = F.broadcast(sending)
    return light.join(sending, "dst").select(
        F.col("src").alias("id"), "landmark", (F.col("distance") + F.col("cost")).alias("offer")
    )


def _merged(known: DataFrame, offers: DataFrame) -> DataFrame:
    """Known distances and offers meet in one aggregation; ``fresh`` tells which rows the offers improved."""
    nothing = F.lit(None).cast("double")
    improved = F.col("offer").isNotNull() & (F.col("old").isNull() | (F.col("offer") < F.col("old")))
    return (
        known.withColumn("offer", nothing)
        .unionByName(offers.withColumn("distance", nothing))
        .groupBy("id", "landmark").agg(F.min("distance").alias("old"), F.min("offer").alias("offer"))
        .select("id", "landmark", F.least("old", "offer").alias("distance"), F.coalesce(improved, F.lit(False)).alias("fresh"))
    )


def _improved(known: DataFrame, offers: DataFrame) -> DataFrame:
    """The offers that beat what is known, for offers counted to be few; ``known`` is not shuffled."""
    key = ["id", "landmark"]
    held = known.join(F.broadcast(offers.select(*key)), key, "left_semi")
    best = held.groupBy(*key).agg(F.min("distance").alias("distance"))
    beaten = offers.join(best, key, "left").where(F.col("distance").isNull() | (F.col("offer") < F.col("distance")))
    return beaten.select(*key, F.col("offer").alias("distance"))
