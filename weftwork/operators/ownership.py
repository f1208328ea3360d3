"""Beneficial ownership: who controls a company through chains of holdings."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from weftwork.session import broadcast_bytes, checkpointed

# A holding above this share counts as full control of what lies below it, and shares
# at or below the second number are not passed on.
CONTROL = 0.3
NEGLIGIBLE = 0.001


def resolve_edges(edges: DataFrame, ids: DataFrame, kind: str, rate: str, as_percent: bool = True) -> DataFrame:
    """Holdings with text ids mapped to numbers on both ends and the rate as a fraction.

    ``edges`` has (from, to, rate), ``ids`` has (id, key). Edges with an unknown end are dropped;
    ``unresolved_count`` tells how many there are.
    """
    source = ids.select(F.col("id").alias("from"), F.col("key").alias("src"))
    target = ids.select(F.col("id").alias("to"), F.col("key").alias("dst"))
    share = F.col(rate) / 100 if as_percent else F.col(rate)
    return (
        edges.select("from", "to", rate).join(source, "from").join(target, "to")
        .select("src", "dst", share.cast("double").alias("rate"), F.lit(kind).alias("kind"))
    )


def unresolved_count(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """Number of edges with an end that ``ids`` does not know, as one row."""
    known = ids.select(F.col("id").alias("__id"))
    both = edges.join(known, edges["from"] == F.col("__id"), "left_semi").join(
        known, edges["to"] == F.col("__id"), "left_semi"
    )
    return (
        edges.agg(F.count("*").alias("n")).union(both.agg((-F.count("*")).alias("n")))
        .agg(F.sum("n").alias("unresolved"))
    )


# Fixed-point places of a sum of doubles: 32 bits before and 38 behind, each a whole number that is added without rounding.
_HIGH, _LOW = float(1 << 32), float(1 << 38)


def _sum_parts(value: Column) -> list[Column]:
    scaled = value * _HIGH
    high = F.floor(scaled)
    return [F.sum(high).alias("high"), F.sum(F.floor((scaled - high) * _LOW)).alias("low"), F.count(value).alias("n"), F.max(value).alias("one")]


def _total() -> Column:
    """The sum of doubles, the same in whatever order tasks add. One value is itself.

    A total within two units in the last place of a number with twelve decimals is this number: three times 0.1 is 0.3.
    """
    exact = F.when(F.col("n") == 1, F.col("one")).otherwise((F.col("high") + F.col("low") / _LOW) / _HIGH)
    near = F.round(exact, 12)
    return F.when(F.abs(exact - near) <= exact * 4.5e-16, near).otherwise(exact)


def control_shares(
    edges: DataFrame, control: float = CONTROL, negligible: float = NEGLIGIBLE, max_rounds: int | None = None
) -> DataFrame:
    """Share of every origin in every vertex below it, from edges (src, dst, rate).

    Every vertex starts as its own origin with share 1. A round sends along each active edge the
    rate, times the share unless the share is over ``control``. Messages about one origin to one vertex
    are summed; the larger of the old share and this sum is kept. An edge stays active while its end gains
    a new origin in the round. Returns (origin, id, share) without an origin's row about itself.

    Rounds go on until nothing is gained; with ``max_rounds`` the loop raises an error if that is not enough. Sums do not
    depend on the order of addition, so neither do shares nor what is over ``control``.

    Shares are rows, not a map per vertex, so a vertex with very many origins is spread over tasks. An origin's share in
    itself is never stored: it sends the rates of its edges. A round works on what can change, the ends of active edges:
    only their shares meet the messages in the aggregation, and other shares are not shuffled.
    """
    spark = edges.sparkSession
    edges = checkpointed(edges.select("src", "dst", "rate").repartition("src"))
    if negligible >= 1:
        return edges.limit(0).select(F.col("src").alias("origin"), F.col("dst").alias("id"), F.lit(0.0).alias("share"))
    nothing = F.lit(None).cast("double")
    shares, grown = None, None
    for done in itertools.count(1):
        # Only ends of active edges can grow, so the edges of a round follow from the round before.
        active = edges if grown is None else edges.join(grown, edges["dst"] == grown["grown"], "left_semi")
        meeting = active.where("src <> dst").select(
            F.col("dst").alias("id"), F.col("src").alias("origin"), nothing.alias("share"), F.col("rate").alias("sent")
        )
        if shares is not None:
            sent = F.when(F.col("share") > control, F.col("rate")).otherwise(F.col("rate") * F.col("share"))
            passed_on = active.join(shares.where(F.col("share") > negligible), active["src"] == shares["id"]).where("origin <> dst")
            old = shares.join(grown, shares["id"] == grown["grown"], "left_semi")
            meeting = meeting.unionByName(
                passed_on.select(F.col("dst").alias("id"), "origin", nothing.alias("share"), sent.alias("sent"))
            ).unionByName(old.select("id", "origin", "share", nothing.alias("sent")))
        # Old shares and messages meet in one aggregation, which also sums the messages map-side.
        merged = (
            meeting.groupBy("id", "origin").agg(F.max("share").alias("old"), *_sum_parts(F.col("sent")))
            .select("id", "origin", F.greatest("old", _total()).alias("share"), F.col("old").isNull().alias("gained"))
        )
        if shares is not None:
            others = shares.join(grown, shares["id"] == grown["grown"], "left_anti")
            merged = merged.unionByName(others.select("id", "origin", "share", F.lit(False).alias("gained")))
        counted = Observation()
        shares = checkpointed(merged.observe(counted, F.count_if("gained").alias("gained")))
        rows = counted.get["gained"]
        if rows == 0:
            break
        if done == max_rounds:
            raise RuntimeError(f"shares still grow after {max_rounds} rounds")
        # Eight bytes an id: broadcast if the session allows so many, else shuffled without repeats.
        gained = shares.where("gained").select(F.col("id").alias("grown"))
        grown = F.broadcast(gained) if 8 * rows <= broadcast_bytes(spark) else gained.distinct()
        shares = shares.drop("gained")
    return shares.select("origin", "id", "share")


def controllers(shares: DataFrame, names: DataFrame, above: float = CONTROL) -> DataFrame:
    """Holdings over a share with the names of both ends; ``names`` has (key, name)."""
    owner = names.select(F.col("key").alias("origin"), F.col("name").alias("origin_name"))
    held = names.select(F.col("key").alias("id"), F.col("name").alias("held_name"))
    return (
        shares.where(F.col("share") > above).join(owner, "origin", "left").join(held, "id", "left")
        .select("origin", "origin_name", "id", "held_name", "share")
    )
