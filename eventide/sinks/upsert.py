"""Keyed upsert (SNK4, SNK6): the last row per key in arrival order wins.

Batch: :func:`latest_per_key`. Stream: :func:`stream_upsert` keeps a
versioned, hash-bucketed parquet snapshot under a shared path. Each
micro-batch rewrites only the buckets its keys fall in, as a new version
directory, and is idempotent by batch id (a replayed batch whose version is
already committed is skipped), so an executor or driver restart never loses or
doubles an update.

Layout: ``<root>/v=<batch id>/_b=<bucket>/part-*.parquet`` holds the buckets a
batch rewrote; ``<root>/_manifest/v=<batch id>`` maps every bucket to the
directory of its newest version and its row count after that batch. A batch is
committed once its manifest is written; a reader looks for the newest
committed one from the top. When a bucket outgrows ``keys_per_bucket`` the next
batch doubles their number and rewrites all. Versions that none of the newest
``RETAIN`` manifests points to are removed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

BUCKET = "_b"
BUCKETS = 16                  # of a new snapshot
KEYS_PER_BUCKET = 2_000_000   # rows at which the number of buckets doubles
RETAIN = 5                    # committed versions that stay readable


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key by ``order`` (``row_number() = 1`` on the reversed
    order: a partial WindowGroupLimit keeps one row per key per map task)."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(o).desc() for o in order])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


# the batch form under its inventory name (SNK4)
upsert_latest = latest_per_key


def _fs(spark: SparkSession, root: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the manifests, newest first."""
    fs, path = _fs(spark, f"{root}/_manifest")
    if not fs.exists(path):
        return []
    return sorted((int(st.getPath().getName()[2:]) for st in fs.listStatus(path)
                   if st.getPath().getName().startswith("v=")), reverse=True)


def _latest_manifest(spark: SparkSession, root: str) -> int | None:
    for v in _versions(spark, root):     # the first is committed unless its batch is under way
        fs, path = _fs(spark, f"{root}/_manifest/v={v}/_SUCCESS")
        if fs.exists(path):
            return v
    return None


def _manifest(spark: SparkSession, root: str) -> dict[int, tuple[str, int]]:
    """bucket -> (path of its newest committed version, rows)."""
    v = _latest_manifest(spark, root)
    if v is None:
        return {}
    rows = spark.read.parquet(f"{root}/_manifest/v={v}").collect()  # one row per bucket
    return {r["bucket"]: (r["path"], r["rows"]) for r in rows}


def _bucket_count(current: dict[int, tuple[str, int]], asked: int | None, keys_per_bucket: int) -> int:
    """Every manifest lists all its buckets, so their number is the map's size."""
    n = len(current) or asked or BUCKETS
    return n * 2 if current and max(rows for _, rows in current.values()) > keys_per_bucket else n


def _committed(spark: SparkSession, root: str) -> dict[int, str]:
    return {b: path for b, (path, _) in _manifest(spark, root).items() if path}


def read_snapshot(spark: SparkSession, root: str, schema=None) -> DataFrame | None:
    """The current snapshot (newest committed version of every bucket)."""
    paths = sorted(_committed(spark, root).values())
    if not paths:
        return None
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(*paths)


def upsert_batch(batch: DataFrame, batch_id: int, keys: Sequence[str], order: Sequence[str],
                 root: str, buckets: int | None = None, keys_per_bucket: int = KEYS_PER_BUCKET,
                 retain: int = RETAIN) -> None:
    """Merge one batch into the snapshot at ``root`` (the ``foreachBatch`` body).

    ``buckets`` is their number in a new snapshot (it grows by doubling). The
    batch is first reduced to its last row per key, with a partial limit on the
    map side; those rows and the touched buckets then shuffle once, by bucket,
    and are ranked inside (bucket, key)."""
    spark = batch.sparkSession
    fs, path = _fs(spark, f"{root}/_manifest/v={batch_id}")
    if fs.exists(path.suffix("/_SUCCESS")):
        return  # replay of a committed batch
    current = _manifest(spark, root)
    n = _bucket_count(current, buckets, keys_per_bucket)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")
    new = latest_per_key(batch, keys, order).withColumn(BUCKET, bucket).persist()
    try:
        touched = [r[0] for r in new.select(BUCKET).distinct().collect()]    # at most n numbers
        grown = bool(current) and n != len(current)
        old_paths = [p for b, (p, _) in current.items() if p and (grown or b in touched)]
        merged = new
        if old_paths:
            old = spark.read.schema(batch.schema).parquet(*old_paths).withColumn(BUCKET, bucket)
            merged = old.unionByName(new)
        w = Window.partitionBy(BUCKET, *keys).orderBy(*[F.col(o).desc() for o in order])
        (merged.repartition(BUCKET).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
               .write.mode("overwrite").partitionBy(BUCKET).parquet(f"{root}/v={batch_id}"))
    finally:
        new.unpersist()
    # commit: the new bucket map, written after the data (row counts from the files' footers)
    rows = {}
    if touched or grown:
        written = spark.read.schema(f"{BUCKET} int").parquet(f"{root}/v={batch_id}")
        rows = {r[BUCKET]: r["count"] for r in written.groupBy(BUCKET).count().collect()}
    mapping = []
    for b in range(n):
        path_rows = (f"{root}/v={batch_id}/{BUCKET}={b}", rows[b]) if b in rows else current.get(b, (None, 0)) if not grown else (None, 0)
        mapping.append((b, *path_rows))
    (spark.createDataFrame(mapping, "bucket int, path string, rows long").coalesce(1)
          .write.mode("overwrite").parquet(f"{root}/_manifest/v={batch_id}"))
    _expire(spark, root, retain)


def _expire(spark: SparkSession, root: str, retain: int) -> None:
    """Remove versions behind the newest ``retain`` manifests."""
    versions = _versions(spark, root)
    kept = versions[:max(1, retain)]
    if len(kept) == len(versions):
        return
    used = {int(p.split("/v=")[-1].split("/")[0]) for v in kept
            for p, in spark.read.parquet(f"{root}/_manifest/v={v}").where("path IS NOT NULL").select("path").collect()}
    fs, path = _fs(spark, root)
    old = [int(st.getPath().getName()[2:]) for st in fs.listStatus(path) if st.getPath().getName().startswith("v=")]
    for folder in [*(f"{root}/_manifest/v={v}" for v in versions[len(kept):]),
                   *(f"{root}/v={v}" for v in old if v not in used and v < kept[-1])]:
        fs, path = _fs(spark, folder)
        fs.delete(path, True)


def stream_upsert(df: DataFrame, keys: Sequence[str], order: Sequence[str], root: str,
                  checkpoint: str, buckets: int | None = None, trigger: dict | None = None,
                  keys_per_bucket: int = KEYS_PER_BUCKET, retain: int = RETAIN):
    """Start a streaming query that upserts every micro-batch into ``root``."""
    w = (df.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda b, i: upsert_batch(b, i, keys, order, root, buckets, keys_per_bucket, retain)))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
