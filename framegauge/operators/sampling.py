"""Sampling and assignment by position: declarative, deterministic, without collecting."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def even_sample(df: DataFrame, keys: list[str], k: int = 8, seq: str = "seq") -> DataFrame:
    """K7: the rows at the truncated places of k even steps from first to last, each once."""
    n = F.count("*").over(Window.partitionBy(*keys))
    places = F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.floor(i * (F.col("_n") - 1) / (k - 1))))
    return df.withColumn("_n", n).where(F.array_contains(places, F.col(seq).cast("long"))).drop("_n")


def stride_sample(df: DataFrame, keys: list[str], parts: int = 30, seq: str = "seq") -> DataFrame:
    """K8: every max(1, n // parts)-th row."""
    n = F.count("*").over(Window.partitionBy(*keys))
    return df.withColumn("_n", n).where(F.col(seq) % F.greatest(F.lit(1), F.floor(F.col("_n") / parts)) == 0).drop("_n")


def first_rows(df: DataFrame, most: int | None, seq: str = "seq") -> DataFrame:
    """K9."""
    return df if most is None else df.where(F.col(seq) < most)


def top_per_key(df: DataFrame, keys: list[str], k: int, *by) -> DataFrame:
    """K5: the k first rows of each key in a total order; a partial top-k runs before the shuffle."""
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(*by))).where(F.col("_k") <= k).drop("_k")


def round_robin(df: DataFrame, number: str, names: list[str], column: str = "assigned") -> DataFrame:
    """Row i gets name i modulo their number."""
    return df.withColumn(column, F.element_at(F.array(*map(F.lit, names)), (F.pmod(F.col(number), F.lit(len(names))) + 1).cast("int")))
