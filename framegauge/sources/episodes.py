"""Datasets of episodes: one Parquet file per episode, JSON metadata, images inside rows.

Listing and metadata go through Spark's own file systems, so any store works; nothing is opened from the driver's disk."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framegauge.functions.taxonomy import VIEWS

#: The tasks of up to so many files go to the rows by broadcast (16 bytes each).
BROADCAST_FILES = 2_000_000
TASKS = "task_index long, task string"
EPISODES = "episode_index long, tasks array<string>, length long"
_IMAGE = T.StructType([T.StructField("bytes", T.BinaryType()), T.StructField("path", T.StringType())])
FRAMES = T.StructType(
    [*(T.StructField(v, _IMAGE) for v in VIEWS), T.StructField("state", T.ArrayType(T.FloatType())), T.StructField("actions", T.ArrayType(T.FloatType())), T.StructField("timestamp", T.FloatType())]
    + [T.StructField(c, T.LongType()) for c in ("frame_index", "episode_index", "index", "task_index")]
)


def real_path(path: Column) -> Column:
    """S3: no hidden resource files, no archive leftovers, no outputs."""
    name = F.element_at(F.split(path, "/"), -1)
    return ~name.startswith("._") & ~path.contains("__MACOSX") & ~path.rlike("/outputs/")


def episode_of(path: Column) -> Column:
    """The number after the last underscore of the file's stem, or that of a folder ``episode=…``, or null."""
    return F.coalesce(F.regexp_extract(path, r"_(\d+)\.[^./]+$", 1).try_cast("long"), F.regexp_extract(path, r"/episode=(\d+)/[^/]*$", 1).try_cast("long"))


def relative_path(path: Column, root: str) -> Column:
    """S11."""
    return F.regexp_replace(path, "^.*?" + root.rstrip("/").rpartition(":")[2].lstrip("/").replace(".", r"\.") + "/", "")


def find_meta_root(spark: SparkSession, root: str) -> str:
    """The folder of the one ``info.json`` under the root; an error if there is none or more than one."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "info.json").load(root).select("path").where(real_path(F.col("path"))).limit(2).collect()
    if len(found) != 1:
        raise ValueError(f"{len(found)} info.json under {root}; exactly one is needed")
    return found[0].path.rpartition("/")[0]


def read_info(spark: SparkSession, meta: str) -> dict:
    return json.loads(spark.read.text(f"{meta}/info.json", wholetext=True).first().value)


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """An object per line that isn't blank."""
    return spark.read.schema(schema).json(path).where(" or ".join(f"{c.split()[0]} is not null" for c in schema.split(", ")))


@dataclass
class Dataset:
    info: dict
    tasks: DataFrame
    episodes: DataFrame
    frames: DataFrame
    files: DataFrame

    @property
    def views(self) -> list[str]:
        """Features declared as images (§1.3); the usual three where nothing is declared."""
        found = [k for k, f in self.info.get("features", {}).items() if f.get("dtype") == "image"]
        return found or VIEWS

    @property
    def expected_columns(self) -> list[str]:
        return list(self.info.get("features", {})) or FRAMES.names

    def width(self, column: str, default: int = 20) -> int:
        return int((self.info.get("features", {}).get(column, {}).get("shape") or [default])[0])


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """path, length, episode of every episode file, without its content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(root)
    return files.select(F.col("_metadata.file_path").alias("path"), "length").where(real_path(F.col("path"))).withColumn("episode", episode_of(F.col("path")))


def read_frames(spark: SparkSession, root: str, schema: T.StructType = FRAMES, columns: list[str] | None = None) -> DataFrame:
    """All rows of all episode files with episode (of the file name), task, seq (the physical row) and frame.

    Files that can't be read are left out; ``unread_files`` names them. Only the wanted columns are read."""
    raw = spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").option("ignoreCorruptFiles", True).parquet(root)
    wanted = [c for c in (columns or schema.names) if c in schema.names]
    file, row = F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("seq")
    keys = [c for c in ("task_index", "frame_index", "episode_index") if c not in wanted and c in schema.names]
    # a file's task is its first row's: read from one narrow column and joined back, so no image is shuffled
    tasks = raw.select(file, row, "task_index").where("seq = 0").select(F.xxhash64("file").alias("_file"), F.col("task_index").alias("task"))
    tasks = F.broadcast(tasks) if tasks.count() <= BROADCAST_FILES else tasks
    d = raw.select(*wanted, *keys, file, row).where(real_path(F.col("file"))).withColumn("_file", F.xxhash64("file")).join(tasks, "_file", "left").drop("_file")
    return d.withColumns({"episode": F.coalesce(episode_of(F.col("file")), F.col("episode_index")), "frame": F.coalesce("frame_index", "seq")})


def unread_files(files: DataFrame, frames: DataFrame) -> DataFrame:
    """Listed files of which no row was read: (episode, task, file, error). An empty file is reported by its length."""
    d = files.join(frames.select(F.col("file").alias("path")).distinct(), "path", "left_anti")
    return d.select("episode", F.lit(None).cast("long").alias("task"), F.col("path").alias("file"), F.lit("no row could be read").alias("error"))


def load_dataset(spark: SparkSession, root: str, schema: T.StructType = FRAMES) -> Dataset:
    """Metadata and rows under a root; an error if there is no episode file."""
    meta = find_meta_root(spark, root)
    files = list_files(spark, root)
    if files.isEmpty():
        raise ValueError(f"no episode files under {root}")
    return Dataset(read_info(spark, meta), read_jsonl(spark, f"{meta}/tasks.jsonl", TASKS), read_jsonl(spark, f"{meta}/episodes.jsonl", EPISODES), read_frames(spark, root, schema), files)


def column_names(spark: SparkSession, path: str) -> list[str]:
    """The schema in a file's footer."""
    return spark.read.parquet(path).columns


def summary(files: DataFrame) -> DataFrame:
    """Files, bytes, largest; no row is read."""
    return files.agg(F.count("*").alias("files"), F.sum("length").alias("bytes"), F.max("length").alias("largest"))


def first_with_rows(frames: DataFrame, least: int = 80) -> DataFrame:
    """The first episode in file order that has enough rows."""
    return frames.groupBy("file", "episode").agg(F.count("*").alias("rows")).where(F.col("rows") >= least).orderBy("file").limit(1)


def with_metadata(rows: DataFrame, episodes: DataFrame) -> DataFrame:
    """Row counts beside the declared length and tasks."""
    return rows.join(episodes.withColumnRenamed("episode_index", "episode"), "episode", "left")
