"""Exact deduplication through an extendible-hash index on shared files.

DataFrame operations only:

1. Each text gets a 64-bit key (xxhash64 of its normalised bytes). Equal keys
   are chained: ``groupBy(key, text)`` compares the bytes themselves, so two
   texts that merely share a key are two chain entries. The grouping combines
   on the map side, so a group of copies that holds a third of all rows reaches
   the owner as one row per map task.
2. Directory: bucket ``b`` of local depth ``d`` owns the keys whose top ``d``
   bits are ``b``. Starting from depth 0 or the depth that the key count calls
   for, every bucket with more than ``capacity`` entries is split in two and
   the directory doubles, until none is overfull or ``max_depth`` is reached;
   an overfull bucket of that depth is only larger, nothing is lost.
3. The index is written to the shared folder, each bucket's key range by one
   owner task (``repartitionByRange`` on the key).
4. Probe: rows join the index on (key, digest), an inner equi-join that AQE can
   split where one key is hot.

Null text counts as empty. Rows that repeat a doc_id each count; null doc_id
loses to any other. Columns of the input other than id and text are ignored.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from eventide.llm.shared import saved
from eventide.llm.textops import lower_az

CAPACITY = 1_000_000
MAX_DEPTH = 16


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    norm = lower_az(F.col(text_col))
    return docs.select(F.col(id_col).alias("_id"), norm.alias("_text"))


def top_bits(key: Column, depth: int) -> Column:
    """The top ``depth`` bits of a signed 64-bit key as a number from 0."""
    return F.lit(0).cast("long") if depth == 0 else F.shiftrightunsigned(key, 64 - depth)


def directory(entries: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH) -> dict[tuple[int, int], int]:
    """``{(depth, prefix): entries}`` of the buckets. Its size is bounded by
    ``2**max_depth``, whatever the number of rows: it is the one thing the
    driver holds."""
    total = entries.count()
    depth = 0
    while depth < max_depth and total >> depth > capacity:
        depth += 1
    found = {(depth, r["p"]): r["n"] for r in
             entries.groupBy(top_bits(F.col("key"), depth).alias("p")).agg(F.count("*").alias("n")).collect()}
    while True:
        full = [b for b, n in found.items() if n > capacity and b[0] < max_depth]
        if not full:
            return found
        # the directory doubles: every overfull bucket splits on its next bit
        at = full[0][0]
        split = [p for d, p in full if d == at]
        halves = (entries.where(top_bits(F.col("key"), at).isin(split))
                  .groupBy(top_bits(F.col("key"), at + 1).alias("p")).agg(F.count("*").alias("n")).collect())
        for p in split:
            del found[(at, p)]
        found.update({(at + 1, r["p"]): r["n"] for r in halves})


def bucket_of(key: Column, buckets: dict[tuple[int, int], int]) -> Column:
    """Directory look-up: ``depth:prefix`` of the bucket that owns ``key``."""
    out = None
    for d in sorted({d for d, _ in buckets}):
        p = top_bits(key, d)
        name = F.concat(F.lit(f"{d:02d}-"), p.cast("string"))
        mine = [q for e, q in buckets if e == d]
        hit = F.lit(True) if len(mine) == 1 << d else p.isin(mine)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return F.lit("00-0") if out is None else out


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                capacity: int = CAPACITY, max_depth: int = MAX_DEPTH) -> DataFrame:
    """The index as a table on shared files: one row per distinct text with
    ``key, digest, n_bytes, keep_id, group_size, bucket, chain`` (its place
    among the texts that share the key)."""
    chained = (_keyed(docs, id_col, text_col)
               .groupBy(F.xxhash64("_text").alias("key"), "_text")      # same key: bytes decide
               .agg(F.max("_id").alias("keep_id"), F.count("*").alias("group_size"))
               .select("key", F.sha2("_text", 256).alias("digest"), F.octet_length("_text").alias("n_bytes"),
                       "keep_id", "group_size"))
    entries = saved(chained, "dedup-entries")
    buckets = directory(entries, capacity, max_depth)
    width = max(1, min(len(buckets), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    from pyspark.sql import Window
    placed = (entries.withColumn("bucket", bucket_of(F.col("key"), buckets))
              .repartitionByRange(width, "key")
              .withColumn("chain", F.row_number().over(Window.partitionBy("key").orderBy("digest"))))
    return saved(placed, "dedup-index")


def probe(docs: DataFrame, index: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` with the group each belongs to."""
    rows = (_keyed(docs, id_col, text_col)
            .select("_id", F.xxhash64("_text").alias("key"), F.sha2("_text", 256).alias("digest")))
    return (rows.join(index.select("key", "digest", "keep_id", "group_size"), ["key", "digest"])
            .select(F.col("_id").alias(id_col), "keep_id", "group_size",
                    F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.col("digest").alias("text_sha256")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                capacity: int = CAPACITY, max_depth: int = MAX_DEPTH) -> DataFrame:
    """One row per input row: ``id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; of equal texts the
    largest id stays (rows that repeat that id all stay)."""
    return probe(docs, build_index(docs, id_col, text_col, capacity, max_depth), id_col, text_col)


def keep_one(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one per distinct text."""
    index = build_index(docs, "doc_id", "text", capacity)
    text = lower_az(F.col("text"))
    # the row travels as one struct, so no column name of its own can clash
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.xxhash64(text).alias("key"),
                       F.sha2(text, 256).alias("digest"))
    winners = index.select("key", "digest", F.col("keep_id").alias("id"))
    on = ((rows["key"] == winners["key"]) & (rows["digest"] == winners["digest"]) & rows["id"].eqNullSafe(winners["id"]))
    return rows.join(winners, on, "left_semi").select("row.*")
