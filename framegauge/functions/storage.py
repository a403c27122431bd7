"""Tables written to the folder that driver and executors share, and small files in any store that Spark knows."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Name of the attribute with the folder of a table that ``written`` returned.
_PATH = "_framegauge_path"


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder only where driver and workers are one process on one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="framegauge-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def written(df: DataFrame, name: str, per_core: int | None = None) -> DataFrame:
    """``df`` as a Parquet table: cuts the lineage and survives lost executors. ``discard`` deletes it.

    ``per_core``: so many files a core at most, instead of one a shuffle partition, for tables of short rows: each file costs
    several calls of the store, whatever is in it. Partitions that come together stream through one task."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    if per_core:
        df = df.coalesce(per_core * df.sparkSession.sparkContext.defaultParallelism)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    setattr(out, _PATH, path)
    return out


def _file_system(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def discard(*tables: DataFrame | None) -> None:
    """Deletes written tables that nothing reads any more; what ``written`` didn't return is left alone."""
    for t in tables:
        path = getattr(t, _PATH, None)
        if path:
            fs, where = _file_system(t.sparkSession, path)
            fs.delete(where, True)


def write_file(spark: SparkSession, path: str, data: bytes) -> None:
    """One small file with these bytes, through Spark's file systems."""
    fs, where = _file_system(spark, path)
    stream = fs.create(where, True)
    try:
        stream.write(bytearray(data))
    finally:
        stream.close()


def dealt(spark: SparkSession) -> int:
    """Number of tasks for short rows that make much work: as many as a shuffle has, four a core at least. Given as a number it
    stays; partitions by size would put all into one task."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)


def planned_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of a plan's size; no job runs."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
