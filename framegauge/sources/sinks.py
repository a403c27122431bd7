"""Sinks: JSON, CSV, Parquet, Markdown reports, packages with checksums, and the text of slide files."""

from __future__ import annotations

import io
import json
import re
import zipfile
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framegauge.functions.storage import write_file


def run_root(root: str, run_id: str) -> str:
    """A folder of its own for each run."""
    return f"{root.rstrip('/')}/{re.sub(r'[^A-Za-z0-9_.-]', '_', run_id)}"


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines; in as many files as there are partitions."""
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; nested columns as JSON."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    flat = [F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema]
    df.select(*flat).write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Keeps the schema; a folder per case or task where asked."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*by) if by else w).parquet(path)


def write_episodes(frames: DataFrame, root: str, info: dict, tasks: list[str]) -> None:
    """A dataset of episodes that ``sources.episodes`` reads: rows by ``episode`` in folders of their own, in order of
    ``seq``, and the metadata. Everything but the small metadata files is written by the workers."""
    spark = frames.sparkSession
    rows = frames.repartition("episode").sortWithinPartitions("episode", "seq")
    rows.drop("seq").write.partitionBy("episode").parquet(f"{root}/data")
    lengths = frames.groupBy(F.col("episode").alias("episode_index")).agg(F.array(F.lit(tasks[0])).alias("tasks"), F.count("*").alias("length"))
    lengths.write.json(f"{root}/meta/episodes.jsonl")
    write_file(spark, f"{root}/meta/tasks.jsonl", "".join(json.dumps({"task_index": i, "task": t}) + "\n" for i, t in enumerate(tasks)).encode())
    write_file(spark, f"{root}/meta/info.json", json.dumps(info).encode())


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A small report as one file in the folder ``path``, through Spark's file systems."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def markdown(title: str, facts: dict, tables: dict[str, DataFrame], rows: int = 20) -> str:
    """A report of facts and of the first rows of tables."""
    out = [f"# {title}", "", *(f"- {k}: {v}" for k, v in facts.items())]
    for name, df in tables.items():
        out += ["", f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
        out += ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in df.limit(rows).collect()]
    return "\n".join(out) + "\n"


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """Name, bytes and SHA-256 of every file under a path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def package(spark: SparkSession, path: str, limit: int = 200 << 20) -> bytes:
    """A ZIP of the reports under a path with a manifest of checksums; refused beyond ``limit`` bytes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).where(~F.col("path").rlike(r"\.parquet$|__pycache__"))
    if (files.agg(F.sum("length")).first()[0] or 0) > limit:
        raise ValueError("the package would be too large")
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        manifest = []
        for r in files.select("path", "content", F.sha2("content", 256).alias("sha256")).orderBy("path").toLocalIterator():
            name = r.path.rpartition(path.rstrip("/").rpartition("/")[2] + "/")[2]
            z.writestr(name, bytes(r.content))
            manifest.append(f"{r.sha256}  {name}")
        z.writestr("SHA256SUMS", "\n".join(manifest) + "\n")
    return out.getvalue()


def slide_text(data: bytes) -> str:
    """The texts of all slides of a presentation, in order."""
    tag = "{http://schemas.openxmlformats.org/drawingml/2006/main}t"
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = sorted((n for n in z.namelist() if re.fullmatch(r"ppt/slides/slide\d+\.xml", n)), key=lambda n: int(re.findall(r"\d+", n)[-1]))
        return "\n".join(t.text or "" for n in names for t in ElementTree.fromstring(z.read(n)).iter(tag))
