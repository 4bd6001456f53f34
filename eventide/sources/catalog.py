"""Session / external catalog tables (SRC7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def use_catalog(spark: SparkSession, database: str, create: bool = True) -> None:
    """Switch the current database (Hive metastore when the session was built
    with ``enableHiveSupport()``, else the session catalog)."""
    if create:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.catalog.setCurrentDatabase(database)


def save_table(df: DataFrame, name: str, path: str | None = None, fmt: str = "parquet",
               mode: str = "overwrite") -> None:
    """Write ``df`` as catalog table ``name``; with ``path`` it is external (files on shared storage)."""
    w = df.write.format(fmt).mode(mode)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
