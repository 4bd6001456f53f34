"""Relational sink and table by DDL over JDBC (SNK5, relational binding of SNK4).

Thin option-taking functions: the database is external to Spark. No query is
registered for them because no database may be started in this environment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register_jdbc_table(spark: SparkSession, name: str, url: str, dbtable: str, **options) -> DataFrame:
    """``CREATE TEMPORARY VIEW name USING jdbc`` equivalent."""
    opts = ", ".join(f"{k} '{v}'" for k, v in {"url": url, "dbtable": dbtable, **options}.items())
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} USING org.apache.spark.sql.jdbc OPTIONS ({opts})")
    return spark.table(name)


def write_jdbc(df: DataFrame, url: str, dbtable: str, mode: str = "append", **options) -> None:
    w = df.write.format("jdbc").option("url", url).option("dbtable", dbtable).mode(mode)
    for k, v in options.items():
        w = w.option(k, v)
    w.save()
