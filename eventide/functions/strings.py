"""String scalar functions: the 31-multiplier string hash (FUN11, UDF1) and text helpers (FUN1, FUN6)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, SparkSession, functions as F
from pyspark.sql.types import IntegerType

_M = 1 << 32


def _signed32(u: Column) -> Column:
    return F.when(u >= (1 << 31), u - F.lit(_M)).otherwise(u)


def java_string_hash(s: Column, factor: int = 1) -> Column:
    """``s.hashCode() * factor`` with 32-bit wrap-around, as a pure column expression.

    The hash runs over UTF-16 code units: ``h = 31*h + unit``. Characters
    outside the BMP contribute their surrogate pair.
    """
    cps = F.transform(F.split(s, ""), lambda ch: F.ascii(ch).cast("long"))

    def step(acc, cp):
        off = cp - F.lit(0x10000)
        hi = F.lit(0xD800) + F.shiftright(off, 10)
        lo = F.lit(0xDC00) + off.bitwiseAND(F.lit(0x3FF))
        pair = F.pmod(F.pmod(acc * 31 + hi, F.lit(_M)) * 31 + lo, F.lit(_M))
        return F.when(cp > 0xFFFF, pair).otherwise(F.pmod(acc * 31 + cp, F.lit(_M)))

    h = F.aggregate(cps, F.lit(0).cast("long"), step)
    h = F.when(F.length(s) == 0, F.lit(0).cast("long")).otherwise(h)
    return _signed32(F.pmod(h * F.lit(factor).cast("long"), F.lit(_M))).cast("int")


def register_scalar(spark: SparkSession, name: str, fn, return_type) -> None:
    """Register a function from pandas Series to pandas Series for SQL (UDF1):
    one call per Arrow batch. Prefer a Column expression where one exists."""
    spark.udf.register(name, F.pandas_udf(fn, return_type))


def register_string_hash(spark: SparkSession, name: str, factor: int) -> None:
    """Register ``name(s)`` = string hash x ``factor`` for SQL, with the factor
    bound at registration (the constructor parameter of the reference UDF).

    A pandas UDF that hashes each different text of an Arrow batch once.
    """
    def _hash(text: str | None) -> int | None:
        if text is None:
            return None
        b = text.encode("utf-16-be")
        h = 0
        for i in range(0, len(b), 2):
            h = (31 * h + (b[i] << 8 | b[i + 1])) % _M
        h = (h * factor) % _M
        return h - _M if h >= (1 << 31) else h

    def hash_batch(s: pd.Series) -> pd.Series:
        codes, texts = pd.factorize(s)
        hashes = pd.array([*map(_hash, texts), None], "Int32")     # code -1: no text
        return pd.Series(hashes[codes])

    register_scalar(spark, name, hash_batch, IntegerType())
