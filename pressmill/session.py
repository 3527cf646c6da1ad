"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # grouped tasks of the similarity search are cut to about this many rows
    "spark.sql.execution.arrow.maxRecordsPerBatch": "20000",
}


#: Spark's setting by which an action removes its shuffle files at its end
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str | None = None, shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """A session with the settings every job of this package expects.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: the submitting side sets them.
    """
    builder = SparkSession.builder.appName("pressmill")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineages: the session's own, else (local mode only) a temporary one."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="pressmill-checkpoint-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Actions in here remove their shuffle files as they end; else these stay until the JVM collects what refers to them."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the written table; shuffle files of the write go at once.

    The table outlives lost executors (a local checkpoint would not), and its true size replaces the estimate that a
    long plan, or a checkpoint of one, carries along: loops would otherwise multiply estimates round after round.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_table(df: DataFrame) -> None:
    """Remove the files of a table that ``cut_lineage`` wrote, once nothing reads it any more."""
    sc = df.sparkSession.sparkContext
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        if not folder.rsplit("/", 1)[-1].startswith("table-"):
            raise ValueError(f"{folder} is no table of cut_lineage")
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
