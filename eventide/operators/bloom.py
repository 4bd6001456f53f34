"""Approximate "seen before?" with Bloom filters over time (AGG13).

:func:`bloom_flag` cuts time into slices. The keys of a slice set bits in
filters of its own: partial bit sets per task, joined by OR. The filter of
everything before a slice is the running OR over the slices, and a row is a
repeat if all bits of its key are set there, or if its key came earlier in its
own slice, which is looked up exactly. A repeat is never missed; a new key is
taken for a repeat with probability ``fpp`` at most while there are no more than
``n`` distinct keys.

The filter is in blocks of 32,768 bits, and all bits of a key lie in one, so
blocks are dealt out and no task or driver holds a whole filter. Rows move once,
by (slice, block), with the bits of their block beside them; a key with a third
of all rows is spread over its slices.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventide.functions.timefn import slice_id

BLOCK_BITS = 32768           # bits of one bitmap aggregate
#: A block's load varies about its mean by a few percent; this many more bits make up for it.
SPARE = 1.15


def filter_size(n: int, fpp: float) -> tuple[int, int]:
    """Blocks and bits per key of a filter for ``n`` keys."""
    bits = -n * math.log(fpp) / math.log(2) ** 2 * SPARE
    blocks = max(1, math.ceil(bits / BLOCK_BITS))
    return blocks, max(1, round(-math.log2(fpp)))


def _key(keys: Sequence[str]) -> list[Column]:
    """NULL is a key value of its own, apart from every default."""
    return [c for k in keys for c in (F.col(k), F.col(k).isNull())]


def _places(keys: Sequence[str], k: int) -> Column:
    """Bits of a key in its block: double hashing with an odd step."""
    a, b = F.xxhash64(F.lit(1), *_key(keys)), F.xxhash64(F.lit(2), *_key(keys)).bitwiseOR(F.lit(1))
    a, b = F.pmod(a, F.lit(1 << 31)), F.pmod(b, F.lit(1 << 31))
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.pmod(a + i * b + F.floor(i * (i * i - 1) / 6), F.lit(BLOCK_BITS)).cast("int"))


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    return F.getbit(byte, F.pmod(place, F.lit(8))) == 1


def bloom_flag(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, fpp: float = 0.01, slice_size: str = "1 day",
               name: str = "seen_before") -> DataFrame:
    """``df`` with ``name``: whether the row's key came earlier in ``order`` (its
    first column a time; rows without one come first), never missed and wrongly
    set for at most ``fpp`` of the new keys."""
    blocks, k = filter_size(n, fpp)
    rows = (df.withColumn("_s", F.coalesce(slice_id(order[0], slice_size), F.lit(-(1 << 62)).cast("long")))
            .withColumn("_block", F.pmod(F.xxhash64(F.lit(0), *_key(keys)), F.lit(blocks)).cast("int")))
    places = rows.select("_s", "_block", F.explode(_places(keys, k)).alias("_at"))
    sets = places.groupBy("_s", "_block").agg(F.bitmap_construct_agg(F.col("_at").cast("long")).alias("_bits"))
    before = Window.partitionBy("_block").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    earlier = sets.withColumn("_bits", F.bitmap_or_agg("_bits").over(before))
    inside = Window.partitionBy("_s", "_block", *_key(keys)).orderBy(*order)
    d = rows.withColumn("_rn", F.row_number().over(inside)).join(earlier, ["_s", "_block"])
    known = F.col("_bits").isNotNull() & F.forall(_places(keys, k), lambda p: _is_set(F.col("_bits"), p))
    return d.withColumn(name, (F.col("_rn") > 1) | F.coalesce(known, F.lit(False))).drop("_s", "_block", "_rn", "_bits")
