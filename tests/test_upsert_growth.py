"""The keyed snapshot grows with its keys, whatever the first batch was."""

import os

from eventide.session import scratch_path
from eventide.sinks.upsert import _manifest, _versions, read_snapshot, upsert_batch


def _batch(spark, lo, hi, t):
    return spark.createDataFrame([(k, t, f"v{t}") for k in range(lo, hi)], "k long, t long, v string")


def test_buckets_grow_after_a_one_key_first_batch(spark):
    root = scratch_path(spark, "grow")
    upsert_batch(_batch(spark, 0, 1, 0), 0, ["k"], ["t"], root, buckets=1, keys_per_bucket=10)
    for i in range(1, 8):
        upsert_batch(_batch(spark, 0, 30 * i, i), i, ["k"], ["t"], root, keys_per_bucket=10)
    upsert_batch(_batch(spark, 0, 1, 8), 8, ["k"], ["t"], root, keys_per_bucket=10)
    current = _manifest(spark, root)
    assert len(current) >= 16 and sum(n for _, n in current.values()) == 210
    got = {r.k: (r.t, r.v) for r in read_snapshot(spark, root).collect()}
    assert got == {0: (8, "v8"), **{k: (7, "v7") for k in range(1, 210)}}


def test_old_versions_go_and_replays_change_nothing(spark):
    root = scratch_path(spark, "expire")
    for i in range(8):
        upsert_batch(_batch(spark, i, i + 5, i), i, ["k"], ["t"], root, buckets=4, retain=2)
    assert _versions(spark, root) == [7, 6]
    path = root.removeprefix("file:")
    used = {int(p.split("/v=")[1].split("/")[0]) for v in (7, 6) for p, in
            spark.read.parquet(f"{root}/_manifest/v={v}").where("path is not null").select("path").collect()}
    assert {int(d[2:]) for d in os.listdir(path) if d.startswith("v=")} == used
    before = sorted(map(tuple, read_snapshot(spark, root).collect()))
    upsert_batch(_batch(spark, 0, 100, 99), 7, ["k"], ["t"], root)      # replay of a committed batch
    assert sorted(map(tuple, read_snapshot(spark, root).collect())) == before and len(before) == 12


def test_empty_batch_and_first_version(spark):
    root = scratch_path(spark, "empty")
    upsert_batch(_batch(spark, 0, 0, 0), 0, ["k"], ["t"], root)
    assert read_snapshot(spark, root) is None
    upsert_batch(_batch(spark, 0, 3, 1), 1, ["k"], ["t"], root)
    assert read_snapshot(spark, root).count() == 3
