"""Adapters: general tables as episodes of ordered rows (episode, task, seq, frame and values)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framegauge.operators.signals import numbered


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user is an episode; its event type is the task; event_id orders the rows."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("episode"), F.lit(None).cast("long").alias("task"), F.col("event_id").alias("frame"), "event_type", "value", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("timestamp"))
    return numbered(e, ["episode"], "frame")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label is an episode; the first twenty numbers are the state."""
    e = table(spark, sf_dir, "embeddings").select(F.col("label").cast("long").alias("episode"), F.lit(None).cast("long").alias("task"), F.col("vec_id").alias("frame"), F.slice(F.col("embedding").cast("array<double>"), 1, 20).alias("state"))
    return numbered(e, ["episode"], "frame")


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order is an episode; the line number is the frame index. The key isn't unique, so all columns break ties."""
    t = table(spark, sf_dir, "lineitem")
    cols = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    e = t.select(F.col("l_orderkey").alias("episode"), F.lit(None).cast("long").alias("task"), F.col("l_linenumber").cast("long").alias("frame"), F.col("l_linenumber").cast("long").alias("frame_index"), *cols)
    return numbered(e, ["episode"], "frame", *cols)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer is an episode; orders are rows by key."""
    t = table(spark, sf_dir, "orders")
    e = t.select(F.col("o_custkey").alias("episode"), F.lit(None).cast("long").alias("task"), F.col("o_orderkey").alias("frame"), "o_orderstatus", "o_totalprice", (F.unix_micros(F.col("o_orderdate").cast("timestamp")) / 86_400_000_000.0).alias("day"))
    return numbered(e, ["episode"], "frame")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation is an episode; turns are frames."""
    t = table(spark, sf_dir, "conversations")
    e = t.select(F.col("conv_id").alias("episode"), F.lit(None).cast("long").alias("task"), F.col("turn").alias("frame"), F.col("turn").alias("frame_index"), "role", "text")
    return numbered(e, ["episode"], "frame", "role", "text")
