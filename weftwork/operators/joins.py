"""Joins. Which physical join is used is left to Catalyst and AQE unless a function says otherwise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_renamed(
    left: DataFrame, right: DataFrame, on: Mapping[str, str], how: str = "inner", prefix: str = "right_"
) -> DataFrame:
    """Equi join of sides that may share column names: clashing right names get ``prefix``.

    ``on`` maps left key names to right key names.
    """
    clash = {c: prefix + c for c in right.columns if c in left.columns}
    renamed = right.withColumnsRenamed(clash)
    keys = [left[a] == renamed[clash.get(b, b)] for a, b in on.items()]
    return left.join(renamed, keys, how)


def join_structs(left: DataFrame, right: DataFrame, condition: Column, how: str = "inner") -> DataFrame:
    """Pairs of whole records, as two struct columns."""
    packed_left = left.select(F.struct(*left.columns).alias("left_record"), *left.columns)
    packed_right = right.select(F.struct(*right.columns).alias("right_record"), *right.columns)
    return packed_left.join(packed_right, condition, how).select("left_record", "right_record")


def has_at_most(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` is no longer than ``rows``; reads no more than it must to tell."""
    return df.select(F.lit(1)).limit(rows + 1).count() <= rows


def lookup_join(
    big: DataFrame, small: DataFrame, on, how: str = "inner", broadcast_rows: int = 100_000
) -> DataFrame:
    """Join to a lookup side. It is broadcast only if counted to be short; otherwise Spark chooses."""
    side = F.broadcast(small) if has_at_most(small, broadcast_rows) else small
    return big.join(side, on, how)


def bounded_product(left: DataFrame, right: DataFrame, max_rows: int = 10_000) -> DataFrame:
    """Every pair of rows, for a right side counted to have at most ``max_rows`` rows."""
    if not has_at_most(right, max_rows):
        raise ValueError(f"the right side of a product may have at most {max_rows} rows")
    return left.join(F.broadcast(right))


def array_member_join(
    left: DataFrame, right: DataFrame, array: str, left_key: str, right_key: str, how: str = "inner",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Join where ``right_key`` is an element of the left ``array``; ``how`` is inner or full.

    The membership test would be a nested loop over both tables. One row per distinct element, with no more than
    ``left_key`` beside it, makes it an equi join. ``left_key`` identifies left rows and is not null. Of the left
    ``columns``, by default all, those beside the key are joined back to what matched.
    """
    if how not in ("inner", "full"):
        raise ValueError("how is inner or full")
    columns = list(columns or left.columns)
    members = left.select(F.col(left_key).alias("__row"), F.explode(F.array_distinct(array)).alias("__member"))
    # A right join keeps unmatched right rows as well, with a null __row.
    met = members.join(right, F.col("__member") == right[right_key], "inner" if how == "inner" else "right")
    sides = {c: F.col("__row") if c == left_key else F.col(c) for c in columns}
    if set(columns) - {left_key}:
        met = met.join(left.select(F.col(left_key).alias("__key"), *[c for c in columns if c != left_key]),
                       F.col("__row") == F.col("__key"), "inner" if how == "inner" else "left")
    pairs = met.select(*[c.alias(name) for name, c in sides.items()], *right.columns)
    if how == "inner":
        return pairs
    known = right.select(F.col(right_key).alias("__known")).distinct()
    has_match = members.join(known, F.col("__member") == F.col("__known"), "left_semi").select("__row")
    left_only = left.join(has_match, left[left_key] == F.col("__row"), "left_anti").select(*columns)
    return pairs.unionByName(left_only, allowMissingColumns=True)


def copartitioned_join(
    left: DataFrame, right: DataFrame, key: str, partitions: int | None = None, how: str = "inner"
) -> DataFrame:
    """Join of sides that are hashed by ``key`` while they are narrow; derive wide columns from the result.

    Each side is shuffled once. With ``partitions`` the layout is fixed, for reuse by later steps on the
    same key. Without it the join's own exchange is that layout, and AQE may split a skewed key.
    """
    if partitions is not None:
        left, right = left.repartition(partitions, key), right.repartition(partitions, key)
    return left.join(right, key, how)


def best_then_join(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    value: str,
    above: float | None = None,
    inclusive: bool = False,
) -> DataFrame:
    """Highest ``value`` per key, optionally over a threshold, joined to ``dimension``.

    The facts are reduced to one row per key before the join, with a map-side step, so a key that
    holds a large part of the rows costs nothing in the join.
    """
    best = facts.groupBy(key).agg(F.max(value).alias(value))
    if above is not None:
        best = best.where(F.col(value) >= above if inclusive else F.col(value) > above)
    return best.join(dimension, key)


def join_then_best(
    facts: DataFrame, dimension: DataFrame, key: str, value: str, attributes: Sequence[str], above: float
) -> DataFrame:
    """The best joined row per key: attributes of the row with the highest value, if over the threshold."""
    joined = facts.select(key, value).join(dimension.select(key, *attributes), key)
    best = joined.groupBy(key).agg(F.max(F.struct(value, *attributes)).alias("b"))
    return best.select(key, "b.*").where(F.col(value) > above)


def cogroup_three(
    names: DataFrame, mails: DataFrame, scores: DataFrame, key: str, mail: str, score: str,
    pass_mark: float, inclusive: bool = True,
) -> DataFrame:
    """Mail and verdict for every key of any of three tables.

    The mail is the first in its order, so that the choice does not depend on row order; the verdict is
    from the highest score, and null where the mail or the score is missing. The tables are stacked and
    grouped once, which combines map-side, instead of being joined: a hot key costs one row per task.
    """
    no_mail = F.lit(None).cast(mails.schema[mail].dataType).alias(mail)
    no_score = F.lit(None).cast(scores.schema[score].dataType).alias(score)
    every = (
        names.select(key, no_mail, no_score)
        .union(mails.select(key, mail, no_score))
        .union(scores.select(key, no_mail, score))
        .groupBy(key).agg(F.min(mail).alias(mail), F.max(score).alias(score))
    )
    passed = F.col(score) >= pass_mark if inclusive else F.col(score) > pass_mark
    verdict = F.when(F.col(mail).isNotNull() & F.col(score).isNotNull(),
                     F.when(passed, "PASSED").otherwise("FAILED"))
    return every.select(key, mail, verdict.alias("result"))


def double_lookup(
    facts: DataFrame, dimension: DataFrame, key: str, name: str, first: str, second: str,
    first_name: str, second_name: str, how: str = "inner",
) -> DataFrame:
    """The same dimension joined twice, for two foreign keys, under two names."""
    one = dimension.select(F.col(key).alias(first), F.col(name).alias(first_name))
    two = dimension.select(F.col(key).alias(second), F.col(name).alias(second_name))
    return facts.join(one, first, how).join(two, second, how)
