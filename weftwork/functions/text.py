"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def char_count(column: str, char: str) -> Column:
    """How often one character occurs."""
    return F.length(column) - F.length(F.replace(F.col(column), F.lit(char), F.lit("")))


def word_md5(column: str) -> Column:
    """The digest of each word by itself."""
    return F.md5(F.col(column).cast("binary"))


def split_at(column: str, pattern: str, index: int) -> Column:
    """Part ``index`` of the split text; null where there are fewer parts."""
    return F.get(F.split(column, pattern), F.lit(index))


def label(predicate: Column, yes: str, no: str) -> Column:
    return F.when(predicate, yes).otherwise(no)
