"""Sliding windows from panes: each row is counted once, in a pane as long as the slide, and closed panes make up the windows.

The direct form copies each row into size / slide windows, 24 for a day by an hour. Here only panes are copied, one row for each
key. State holds the open panes, and for each key the open windows; the watermark closes both, so the result is
written in append mode, a window when it can get no further row. Each works the same on a table.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400, "week": 604_800}


def seconds(interval: str) -> int:
    """The length of an interval such as ``90 seconds`` or ``1 day 6 hours``; months have no fixed length."""
    parts = re.findall(r"(\d+)\s+([a-z]+?)s?(?=\s|$)", interval.strip().lower())
    if not parts or any(unit not in _SECONDS for _, unit in parts) or not re.fullmatch(r"(\s*\d+\s+[a-z]+)+", interval.strip().lower()):
        raise ValueError(f"not an interval of fixed length in whole seconds: {interval}")
    return sum(int(n) * _SECONDS[unit] for n, unit in parts)


@dataclass(frozen=True)
class Measure:
    """An aggregate in two steps: of the rows of a pane, and of the panes of a window."""

    name: str
    of_rows: tuple[Column, ...]
    of_panes: tuple[Callable[[str], Column], ...]
    finish: Callable[..., Column] = F.col

    def part(self, i: int) -> str:
        return f"{self.name}__{i}"


def counted(name: str) -> Measure:
    return Measure(name, (F.count("*"),), (F.sum,))


def summed(name: str, value: Column | str, finish: Callable[[str], Column] = F.col) -> Measure:
    return Measure(name, (F.sum(value),), (F.sum,), finish)


def largest(name: str, value: Column | str) -> Measure:
    return Measure(name, (F.max(value),), (F.max,))


def smallest(name: str, value: Column | str) -> Measure:
    return Measure(name, (F.min(value),), (F.min,))


def mean(name: str, value: Column | str) -> Measure:
    """From sum and count, since means of panes have no mean."""
    return Measure(name, (F.sum(value), F.count(value)), (F.sum, F.sum), lambda total, n: F.col(total) / F.col(n))


def sliding(
    df: DataFrame, time: str, size: str, slide: str, measures: Sequence[Measure], keys: Sequence[str] = (), late: str | None = None
) -> DataFrame:
    """Measures per window and keys, with the window's bounds as columns ``start`` and ``end``.

    Panes are as long as the largest interval that divides size and slide, which is the slide if it divides the size.
    A stream needs ``late``; rows that come later than that after the last are not counted.
    """
    pane = f"{math.gcd(seconds(size), seconds(slide))} seconds"
    if late is not None:
        df = df.withWatermark(time, late)
    parts = [(m.part(i), of_rows, of_panes) for m in measures for i, (of_rows, of_panes) in enumerate(zip(m.of_rows, m.of_panes))]
    panes = df.groupBy(F.window(time, pane), *keys).agg(*[of_rows.alias(name) for name, of_rows, _ in parts])
    grouped = panes.groupBy(F.window("window", size, slide), *keys).agg(*[of_panes(name).alias(name) for name, _, of_panes in parts])
    return grouped.select(
        F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys,
        *[m.finish(*[m.part(i) for i in range(len(m.of_rows))]).alias(m.name) for m in measures],
    )
