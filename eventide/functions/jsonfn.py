"""JSON validity test (FUN8, FLT3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def is_json_object(c: Column) -> Column:
    """True when the text parses as a JSON *object* (``{}`` included); false for
    arrays, scalars, malformed and empty text, and NULL input."""
    return F.coalesce(F.json_object_keys(c).isNotNull(), F.lit(False))


def json_objects_only(df: DataFrame, col: str) -> DataFrame:
    """Keep the rows whose ``col`` is a JSON object."""
    return df.where(is_json_object(F.col(col)))
