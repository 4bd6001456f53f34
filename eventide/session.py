"""Session construction and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings every operator assumes. The time zone matters only for
# LTZ conversions (streams); batch operators work on TIMESTAMP_NTZ.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Python state processors need the RocksDB provider.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "eventide", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the defaults above.

    ``master`` and ``shuffle_partitions`` are for local runs; on a cluster
    leave them ``None`` so the submit-time settings stay in force.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (the cluster names it). Only when it is
    unset and the master is local, as in tests, a fresh local folder is created
    and registered; on a cluster that is an error, since executors do not share
    local folders.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not (spark.sparkContext.master or "").startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="eventide-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under :func:`shared_dir` for one intermediate output."""
    return f"{shared_dir(spark)}/eventide/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure ``DataFrame.checkpoint()`` has a shared target; return it."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    root = shared_dir(spark)
    spark.sparkContext.setCheckpointDir(os.path.join(root, "rdd"))
    return spark.sparkContext.getCheckpointDir()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``eventide`` code usable in the Python workers without installing
    it there: PySpark's cloudpickle serialises this package's classes and
    functions *by value* (the stream state processors are classes that would
    otherwise be pickled by reference and imported on the worker). On a
    cluster ``--py-files`` or an installed package works as well."""
    from pyspark import cloudpickle

    import eventide

    key = "by-value"
    if key not in _SHIPPED:
        cloudpickle.register_pickle_by_value(eventide)
        _SHIPPED.add(key)
