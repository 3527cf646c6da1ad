"""Weekly stores and state tables on a shared file system."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.schemas import REPORT


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p, jvm


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


# -- weekly tables: one partition per week, rewritten as a whole ---------------------------------------------------

def write_week(df: DataFrame, path: str, week: str | None = None) -> None:
    """Replace the weeks present in ``df`` and no others. A named ``week`` that has no rows any more is emptied."""
    if week is not None and df.isEmpty():
        fs, p, jvm = _fs(df.sparkSession, path)
        fs.delete(jvm.org.apache.hadoop.fs.Path(p, f"week={week}"), True)
        return
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("week").parquet(path)


def read_weeks(spark: SparkSession, path: str, schema: str, *weeks: str) -> DataFrame:
    """Stored rows; given weeks prune partitions. An empty table where nothing is stored yet."""
    full = spark.createDataFrame([], schema if " week " in f" {schema} " else schema + ", week string").schema
    if not path_exists(spark, path):
        return spark.createDataFrame([], full)
    df = spark.read.schema(full).parquet(path)
    return df.where(F.col("week").isin(*weeks)) if weeks else df


def write_media_week(df: DataFrame, path: str) -> None:
    """Media articles of a week, ordered by date and id inside each file."""
    ordered = df.sortWithinPartitions("week", F.coalesce("published_at", "first_seen"), "id")
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("week").parquet(path)


# -- state tables: a new version per write, the newest complete one is read -----------------------------------------

def save_state(df: DataFrame, path: str) -> str:
    """Write a new version beside the current one, so that reading and replacing the same table is safe."""
    target = f"{path}/version={int(time.time() * 1e6):020d}"
    df.write.parquet(target)
    return target


def load_state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    fs, p, jvm = _fs(spark, path)
    if fs.exists(p):
        done = sorted(str(s.getPath()) for s in fs.listStatus(p)
                      if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")))
        if done:
            return spark.read.schema(schema).parquet(done[-1])
    return spark.createDataFrame([], schema)


# -- reports ----------------------------------------------------------------------------------------------------

def read_reports(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(readable reports, newest first; unreadable rows). One JSON document per file."""
    raw = (spark.read.schema(REPORT + ", _corrupt_record string").option("multiLine", "true")
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
           .withColumn("file", F.input_file_name()))
    bad = raw.where("_corrupt_record is not null or week is null").select("file")
    good = raw.where("_corrupt_record is null and week is not null").drop("_corrupt_record", "file")
    return good.orderBy(F.desc("week")), bad


# -- coder sheets --------------------------------------------------------------------------------------------------

BOM = "﻿"


def write_sheet(df: DataFrame, path: str) -> None:
    """A semicolon-separated sheet that spreadsheet programs read as UTF-8; a sample of some hundred rows, one file."""
    first, rest = df.columns[0], df.columns[1:]
    marked = df.select(F.col(first).alias(BOM + first), *rest)
    marked.coalesce(1).write.mode("overwrite").option("sep", ";").option("header", True).option(
        "emptyValue", "").option("encoding", "UTF-8").csv(path)


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.option("sep", ";").option("header", True).option("encoding", "UTF-8").option(
        "nullValue", "\u0000").csv(path)
    return df.toDF(*[c.replace(BOM, "") for c in df.columns])
