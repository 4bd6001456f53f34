"""File scans: delimited text with a declared schema (SRC1, SRC2, SRC4) and web access logs (SRC3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from eventide.functions.timefn import parse_dmy_time

# Timestamps in text files keep microseconds (the reader/writer default drops them).
TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def scan_csv(spark: SparkSession, path: str, schema: StructType | str, *, trim: bool = True,
             streaming: bool = False, bad_rows: str = "fail", sep: str = ",",
             max_files_per_trigger: int | None = None,
             ts_format: str = TS_FORMAT) -> DataFrame:
    """Delimited text with a fixed schema (no inference). ``bad_rows='fail'``
    stops the job on a row that does not cast (the reference throws);
    ``'null'`` keeps it with NULLs, ``'drop'`` drops it. Blank lines are
    skipped by the CSV reader (SRC2)."""
    mode = {"fail": "FAILFAST", "null": "PERMISSIVE", "drop": "DROPMALFORMED"}[bad_rows]
    r = spark.readStream if streaming else spark.read
    r = (r.schema(schema).option("sep", sep).option("mode", mode)
         .option("timestampNTZFormat", ts_format).option("timestampFormat", ts_format)
         .option("ignoreLeadingWhiteSpace", trim).option("ignoreTrailingWhiteSpace", trim))
    if streaming and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(path)


def register_csv_table(spark: SparkSession, name: str, path: str, schema: StructType | str) -> DataFrame:
    """A file table with a declared schema, usable from SQL as ``name`` (SRC4)."""
    df = scan_csv(spark, path, schema)
    df.createOrReplaceTempView(name)
    return df


def parse_access_log(lines: DataFrame, col: str = "value", tz: str = "UTC") -> DataFrame:
    """Split space-separated access-log lines: fields 0 ip, 2 user, 3 time
    ``dd/MM/yyyy:HH:mm:ss``, 5 method, 6 url (SRC3, FUN1, FUN3). The time is a
    wall clock in ``tz``; ``event_time`` is the same instant as a UTC wall
    clock (TIMESTAMP_NTZ)."""
    parts = F.split(F.trim(F.col(col)), " ")
    local = parse_dmy_time(parts.getItem(3))
    when = local if tz == "UTC" else F.convert_timezone(F.lit(tz), F.lit("UTC"), local)
    return (lines.where(F.length(F.trim(F.col(col))) > 0)
                 .select(parts.getItem(0).alias("ip"), parts.getItem(2).alias("user_id"),
                         when.alias("event_time"),
                         parts.getItem(5).alias("method"), parts.getItem(6).alias("url")))


def scan_access_log(spark: SparkSession, path: str, streaming: bool = False, tz: str = "UTC") -> DataFrame:
    r = spark.readStream if streaming else spark.read
    return parse_access_log(r.text(path), tz=tz)
