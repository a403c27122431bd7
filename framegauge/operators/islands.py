"""Gaps and islands, equal runs, interval merging and interval overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(df: DataFrame, keys: list[str], idx: str, gap: float = 1, *aggs: Column) -> DataFrame:
    """Runs of index values no more than ``gap`` apart: keys, start, end, n and the aggregates, a row per run.

    Repeated values count once as a place (U4). One shuffle on the keys serves the window and the aggregation. Null indices are left out."""
    w = Window.partitionBy(*keys).orderBy(idx)
    step = F.col(idx) - F.lag(idx).over(w)
    flagged = df.where(F.col(idx).isNotNull()).withColumn("_new", F.when(step <= gap, 0).otherwise(1))
    runs = flagged.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(*keys, "_island").agg(F.min(idx).alias("start"), F.max(idx).alias("end"), F.count("*").alias("n"), *aggs).drop("_island")


def equal_runs(df: DataFrame, keys: list[str], seq: str, value: str, *aggs: Column) -> DataFrame:
    """Maximal runs of rows in order with one value: keys, value, start, end, n and the aggregates (W11). Null values end a run."""
    w = Window.partitionBy(*keys).orderBy(seq)
    flagged = df.withColumn("_new", F.when(F.col(value) == F.lag(value).over(w), 0).otherwise(1))
    runs = flagged.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).where(F.col(value).isNotNull())
    return runs.groupBy(*keys, "_island", value).agg(F.min(seq).alias("start"), F.max(seq).alias("end"), F.count("*").alias("n"), *aggs).drop("_island")


def merge_findings(findings: DataFrame, keys: list[str], points: Column, slack: int = 2, share: float = 0.35) -> DataFrame:
    """Joins findings of one key whose spans touch within ``slack`` frames.

    Needs frame_start, frame_end, finding_id, severity, penalty, confidence, merged_count. The span grows, the severity is the
    largest, a share of each later penalty is added and rounded in order up to ``points``; other columns come from the
    first finding. Findings without a start are never joined; a missing end counts as the start."""
    order = [F.coalesce(F.col("frame_start"), F.lit(-1)), F.col("finding_id")]
    w = Window.partitionBy(*keys).orderBy(*order)
    before = F.max(F.coalesce("frame_end", "frame_start")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col("frame_start").isNull() | before.isNull() | (F.col("frame_start") > before + slack), 1).otherwise(0)
    marked = findings.withColumn("_points", points).withColumn("_new", fresh)
    marked = marked.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_nth", F.row_number().over(w))
    rest = [c for c in findings.columns if c not in (*keys, "frame_start", "frame_end", "severity", "penalty", "confidence", "merged_count")]
    items = F.sort_array(F.collect_list(F.struct("_nth", "penalty")))
    g = marked.groupBy(*keys, "_island").agg(
        F.min("frame_start").alias("frame_start"),
        F.max(F.coalesce("frame_end", "frame_start")).alias("frame_end"),
        F.max("severity").alias("severity"),
        items.alias("_items"),
        F.max("_points").alias("_points"),
        F.min_by("confidence", "_nth").alias("_confidence"),
        F.max(F.col("confidence") == "高置信异常").alias("_high"),
        F.sum("merged_count").alias("merged_count"),
        *(F.min_by(c, "_nth").alias(c) for c in rest),
    )
    fold = F.aggregate(F.slice("_items", 2, 1_000_000_000), F.element_at("_items", 1)["penalty"], lambda a, x: F.round(F.least(F.col("_points"), a + share * x["penalty"]), 3))
    label = F.when((F.col("_confidence") != "确定异常") & F.col("_high"), "高置信异常").otherwise(F.col("_confidence"))
    return g.withColumn("penalty", fold).withColumn("confidence", label).select(*findings.columns)


def span_iou(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Overlap of two inclusive spans; 1 if both are missing, 0 if one is."""
    none_a, none_b = a0.isNull() | a1.isNull(), b0.isNull() | b1.isNull()
    both = F.greatest(F.lit(0), F.least(a1, b1) - F.greatest(a0, b0) + 1)
    union = (a1 - a0 + 1) + (b1 - b0 + 1) - both
    return F.when(none_a & none_b, 1.0).when(none_a | none_b, 0.0).otherwise(both / F.greatest(union, F.lit(1)))
