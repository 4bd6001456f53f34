"""Tables in the shared folder that the session names (``spark.checkpoint.dir``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventide.session import scratch_path, ship_package


def saved(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it again:
    cuts the lineage, so a lost executor costs a reread and no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    w = df.write
    if by:
        w = w.partitionBy(*by)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_saved(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete tables made by :func:`saved` that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for df in frames:
        for f in {p.rsplit("/", 1)[0] for p in df.inputFiles()}:
            if "/eventide/llm-" in f:
                path = jvm.org.apache.hadoop.fs.Path(f)
                path.getFileSystem(conf).delete(path, True)


def ship(spark: SparkSession) -> None:
    """Python workers get this package's code with the tasks that need it."""
    ship_package(spark)
