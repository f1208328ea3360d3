"""Average over a band: for each left row, the mean of right amounts with equal keys and a near value.

A band join makes a row for every near pair, and a key that holds a third of both tables makes
a ninth of the full product. A mean does not need the pairs: right amounts are first summed per
(keys, value), left rows are first reduced to distinct (keys, value), and only these meet. Both
reductions happen map-side, so a hot key shrinks to its distinct values before any shuffle.

Three forms join the reduced tables, in different ways: they suit values that repeat, such as scores or sizes.
The fourth joins nothing and suits any values: the sum over a band is the difference of two running sums.
All give the same result; the fourth refuses doubles, with which it could not. Amounts are added in their own type, or, with
``scale``, as decimals of that many places, so that the mean does not depend on the order of addition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftwork.operators import hotkeys
from weftwork.session import checkpointed


def _reduced(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str, amount: str, scale: int | None):
    probes = left.select(*keys, value).distinct()
    total = F.col(amount) if scale is None else F.col(amount).cast(f"decimal(28,{scale})")
    sums = right.groupBy(*keys, F.col(value).alias("__near")).agg(
        F.sum(total).alias("__sum"), F.count(amount).alias("__n")
    )
    return probes, sums


def _averaged(
    left: DataFrame, met: DataFrame, keys: Sequence[str], value: str, width, row_columns: Sequence[str]
) -> DataFrame:
    near = met.where(F.abs(F.col(value) - F.col("__near")) <= F.lit(width))
    sums = near.groupBy(*keys, value).agg(F.sum("__sum").alias("__sum"), F.sum("__n").alias("__n"))
    return _per_row(left, sums, keys, value, row_columns)


def _per_row(left: DataFrame, sums: DataFrame, keys: Sequence[str], value: str, row_columns: Sequence[str]) -> DataFrame:
    means = sums.select(*keys, value, (F.col("__sum").cast("double") / F.col("__n")).alias("avg_amount"))
    return left.select(*row_columns, *keys, value).join(means, [*keys, value]).select(*row_columns, "avg_amount")


def band_average(left, right, keys, value, amount, width, row_columns, scale: int | None = None) -> DataFrame:
    """Equi join on the keys; the band is a filter on the joined rows."""
    probes, sums = _reduced(left, right, keys, value, amount, scale)
    return _averaged(left, probes.join(sums, list(keys)), keys, value, width, row_columns)


def _bucket(column: str, width):
    return F.floor(F.col(column) / F.lit(width)).cast("long")


def band_average_bucketed(left, right, keys, value, amount, width, row_columns, scale: int | None = None) -> DataFrame:
    """Values cut into buckets one band wide: a probe meets its own bucket and the two beside it.

    For many distinct values per key: a probe reads three buckets, not the whole key.
    The filter stays, since a neighbour bucket also holds values that are too far.
    """
    probes, sums = _reduced(left, right, keys, value, amount, scale)
    reach = F.explode(F.array(*[_bucket(value, width) + step for step in (-1, 0, 1)]))
    met = probes.withColumn("__bucket", reach).join(
        sums.withColumn("__bucket", _bucket("__near", width)), [*keys, "__bucket"]
    )
    return _averaged(left, met, keys, value, width, row_columns)


def band_average_salted(
    left, right, keys, value, amount, width, row_columns, scale: int | None = None, target: int | None = None
) -> DataFrame:
    """A hot key's right side spread by a hash of its value over parts of about ``target`` rows; its probes go to every part.

    The parts are measured on the reduced right side, which is what meets the probes, so a key whose values repeat is not split.
    """
    probes, sums = _reduced(left, right, keys, value, amount, scale)
    sums = checkpointed(sums)
    hot = hotkeys.salts_for_hot_keys(sums, keys, target)
    met = hotkeys.copied(probes, hot, keys).join(hotkeys.spread(sums, hot, keys, "__near"), [*keys, "__salt"])
    return _averaged(left, met, keys, value, width, row_columns)


def band_average_running(left, right, keys, value, amount, width, row_columns, scale: int | None = None) -> DataFrame:
    """Running sums at both ends of each band, subtracted; no row meets another row.

    Values and band ends are put into one order, cut into ranges of even size wherever keys begin and
    end, and summed within each range; a range starts from what the key's earlier ranges sum to. So a
    key of any size is spread over tasks, with any number of distinct values. Values must be whole
    numbers or decimals, since the ends of a band of doubles are rounded, and so must amounts, unless ``scale`` makes
    them decimals, since small sums would be lost in the difference of large ones.
    """
    floating = (T.DoubleType, T.FloatType)
    if isinstance(left.schema[value].dataType, floating) or isinstance(right.schema[value].dataType, floating):
        raise TypeError(f"{value} must be whole numbers or decimals")
    if scale is None and isinstance(right.schema[amount].dataType, floating):
        raise TypeError(f"{amount} must be whole numbers or decimals, or a scale be given")
    probes, sums = _reduced(left, right, keys, value, amount, scale)
    own, none = F.col(value).alias("__own"), F.lit(0)
    # At equal places a lower end comes before the values, and an upper end after them.
    points = (
        sums.select(*keys, F.col("__near").alias("__at"), F.lit(1).alias("__kind"),
                    F.lit(None).cast(left.schema[value].dataType).alias("__own"), "__sum", "__n")
        .union(probes.select(*keys, F.col(value) - F.lit(width), F.lit(0), own, none, none))
        .union(probes.select(*keys, F.col(value) + F.lit(width), F.lit(2), own, none, none))
    )
    order = ["__at", "__kind"]
    placed = checkpointed(
        points.repartitionByRange(*keys, *order).withColumn("__range", F.spark_partition_id())
    )
    # One row per key and range: as many rows per key as there are ranges.
    earlier = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy(*keys, "__range").agg(F.sum("__sum").alias("s"), F.sum("__n").alias("n")).select(
        *keys, "__range", F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("__s0"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__n0"),
    )
    so_far = Window.partitionBy(*keys, "__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    running = placed.select(
        *keys, "__range", "__kind", "__own", F.sum("__sum").over(so_far).alias("__s"), F.sum("__n").over(so_far).alias("__c")
    )
    ends = running.where("__kind <> 1").join(starts, [*keys, "__range"])
    sign = F.when(F.col("__kind") == 2, 1).otherwise(-1)
    bands = ends.groupBy(*keys, F.col("__own").alias(value)).agg(
        F.sum(sign * (F.col("__s") + F.col("__s0"))).alias("__sum"), F.sum(sign * (F.col("__c") + F.col("__n0"))).alias("__n")
    )
    return _per_row(left, bands.where("__n > 0"), keys, value, row_columns)


def salted_join(left: DataFrame, right: DataFrame, keys: Sequence[str], row_id: str, target: int | None = None) -> DataFrame:
    """Inner equi join where keys with very many right rows are split into parts of about ``target`` rows.

    Hot keys and their sizes come from one pass over the keys of ``right`` (see ``hotkeys``), so a key with a third of all rows is
    split in proportion, into a third as many parts as there are partitions, and other keys not at all. Only left rows of hot
    keys are copied. Each table is read once more for the join. For a key too large for one task where AQE's skew join is not at hand.
    """
    hot = hotkeys.salts_for_hot_keys(right, keys, target)
    parts = hotkeys.spread(right, hot, keys, row_id)
    return hotkeys.copied(left, hot, keys).join(parts, [*keys, "__salt"]).drop("__salt")
