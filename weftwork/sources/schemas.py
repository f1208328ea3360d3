"""Record layouts of the data sets that the analyses expect."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"string": T.StringType(), "long": T.LongType()}


def layout(text: str) -> T.StructType:
    """A schema from ``name type`` pairs, without a session; every field may be null."""
    pairs = (field.split() for field in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


PERSON = layout(
    "id long, first_name string, middle_name string, last_name string, gender string,"
    " birth_date string, ssn string, salary long"
)
