"""Taxi demand and an estimate of what sharing rides would bring.

The trips table has one row per ride; ``zones`` has (zone id, zone, borough).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftwork.functions.dates import from_epoch_seconds, nearest_slot
from weftwork.operators.aggregate import count_groups, exact_sum
from weftwork.operators.joins import double_lookup

TOTAL = "total_trips"


def by_zone(trips: DataFrame, pickup: str, zones: DataFrame, zone_id: str, weight: str | None = None) -> DataFrame:
    """Pickups per zone, most first. Trips are counted before the zones are joined.

    With ``weight`` the trips come counted already, that many for each row.
    """
    total = F.count("*") if weight is None else F.sum(weight)
    counts = trips.groupBy(pickup).agg(total.alias(TOTAL))
    return counts.join(zones, counts[pickup] == zones[zone_id]).drop(zone_id).orderBy(F.col(TOTAL).desc_nulls_last())


def by_borough(per_zone: DataFrame, borough: str) -> DataFrame:
    return per_zone.groupBy(borough).agg(F.sum(TOTAL).alias(TOTAL)).orderBy(F.col(TOTAL).desc_nulls_last())


def by_hour(trips: DataFrame, time: str) -> DataFrame:
    hours = trips.select(F.hour(time).alias("hour_of_day"))
    return count_groups(hours, "hour_of_day", name=TOTAL).orderBy(F.col(TOTAL).desc_nulls_last())


def with_length(trips: DataFrame, distance: str, long_from: float = 30) -> DataFrame:
    return trips.withColumn("is_long", F.col(distance) >= long_from)


def by_length(trips: DataFrame, distance: str, long_from: float = 30) -> DataFrame:
    return count_groups(with_length(trips, distance, long_from), "is_long", name=TOTAL)


def by_hour_and_length(trips: DataFrame, time: str, distance: str, long_from: float = 30) -> DataFrame:
    marked = with_length(trips, distance, long_from).withColumn("hour_of_day", F.hour(time))
    return count_groups(marked, "hour_of_day", "is_long", name=TOTAL).orderBy(F.col(TOTAL).desc_nulls_last())


def popular_pairs(
    trips: DataFrame, predicate: Column, pickup: str, dropoff: str, zones: DataFrame, zone_id: str, zone: str,
    weight: str | None = None,
) -> DataFrame:
    """Pickup and dropoff zone names of the trips that pass, most frequent pair first."""
    total = F.count("*") if weight is None else F.sum(weight)
    counts = trips.where(predicate).groupBy(pickup, dropoff).agg(total.alias(TOTAL))
    named = double_lookup(counts, zones, zone_id, zone, pickup, dropoff, "pickup_zone", "dropoff_zone")
    return named.drop(pickup, dropoff).orderBy(F.col(TOTAL).desc_nulls_last())


def code_distribution(trips: DataFrame, code: str) -> DataFrame:
    return count_groups(trips, code, name=TOTAL).orderBy(F.col(TOTAL).desc_nulls_last())


def code_per_day(trips: DataFrame, time: str, code: str) -> DataFrame:
    days = trips.select(F.to_date(time).alias("pickup_day"), code)
    return count_groups(days, "pickup_day", code, name=TOTAL).orderBy("pickup_day")


@dataclass(frozen=True)
class SharingModel:
    """Fixed values of the estimate; money in the currency of the fares."""

    grouped: float = 0.05
    accepted: float = 0.3
    cost_share: float = 0.6
    discount: float = 5
    extra_cost: float = 2
    slot_seconds: int = 300


def sharing_groups(
    trips: DataFrame, time: str, zone: str, fare: str, small_party: Column, model: SharingModel = SharingModel(),
    scale: int | None = None,
) -> DataFrame:
    """Trips and revenue of small parties per zone and time slot. ``scale`` is that of ``exact_sum``."""
    return (
        trips.where(small_party)
        .select(nearest_slot(time, model.slot_seconds).alias("slot"), zone, fare)
        .groupBy("slot", zone)
        .agg(F.count("*").alias(TOTAL), exact_sum(fare, scale).alias("total_amount"))
        .withColumn("approximate_datetime", from_epoch_seconds(F.col("slot") * model.slot_seconds))
        .drop("slot")
    )


def sharing_impact(
    groups: DataFrame, trips: DataFrame, fare: str, model: SharingModel = SharingModel(), scale: int | None = None
) -> DataFrame:
    """Adds the expected impact per group. The mean fare of all trips is a scalar subquery."""
    mean_fare = trips.agg((exact_sum(fare, scale) / F.count(fare)).alias("mean_fare")).scalar()
    grouped = F.col(TOTAL) * model.grouped
    accepted = F.col("grouped_rides") * model.accepted * (mean_fare * model.cost_share - model.discount)
    rejected = F.col("grouped_rides") * (1 - model.accepted) * model.extra_cost
    return (
        groups.withColumn("grouped_rides", grouped)
        .withColumn("accepted_impact", accepted)
        .withColumn("rejected_impact", rejected)
        .withColumn("total_impact", F.col("accepted_impact") + F.col("rejected_impact"))
    )


def with_zone_names(groups: DataFrame, zones: DataFrame, zone: str) -> DataFrame:
    """Groups with the columns of ``zones`` in the place of the zone's number; groups of unknown zones go.

    Names come in when trips have become groups, so they are never shuffled with trips.
    """
    return groups.join(zones, zone).drop(zone)


def sharing_total(impact: DataFrame) -> DataFrame:
    return impact.agg(F.sum("total_impact").alias("total"))
