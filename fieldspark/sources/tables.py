"""Tables and folders in the cluster's shared folder, and broadcasts behind a count."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a narrow table may be broadcast (16 MB of values at two longs a row).
BROADCAST_ROWS = 1_000_000


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, read from spark.checkpoint.dir; a temporary one only on a local master."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        path = spark.sparkContext.getCheckpointDir()
    return path.rstrip("/")


def hadoop(spark: SparkSession, path: str):
    """(Hadoop's path, its file system)."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, files = hadoop(spark, path)
    return files.exists(hadoop_path)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one, deleted when the driver ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    hadoop_path, files = hadoop(spark, path)
    files.deleteOnExit(hadoop_path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, read back: cuts the lineage and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What runs inside loses its shuffle files as it ends, not when the driver happens to collect its garbage; for tables that are written and read back."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if was is None else spark.conf.set(key, was)


def small_side(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` marked for broadcast if its ``rows`` (counted if not given) are few; else a shuffle join follows."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= BROADCAST_ROWS else df
