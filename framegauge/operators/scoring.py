"""Scores of episodes and datasets from findings (second and first generation)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framegauge.functions.scalars import label_penalty, score_with_findings, status_penalty
from framegauge.functions.taxonomy import CONFIDENCE, DIMENSION_POINTS, OFFICIAL_POINTS, SOFT_CAPS
from framegauge.operators.statistics import soft_penalty


def soft_penalties(pressures: DataFrame, keys: list[str]) -> DataFrame:
    """A22 from rows of (keys, dimension, pressure): keys, dimension, soft."""
    g = pressures.groupBy(*keys, "dimension").agg(F.collect_list("pressure").alias("_p"))
    soft = F.lit(None).cast("double")
    for name, cap in SOFT_CAPS.items():
        soft = F.when(F.col("dimension") == name, soft_penalty(F.col("_p"), cap)).otherwise(soft)
    return g.withColumn("soft", soft).drop("_p").where("soft is not null")


def dimension_scores(episodes: DataFrame, findings: DataFrame, soft: DataFrame | None = None, key: str = "episode") -> DataFrame:
    """key, dimension, points, lost, soft, score: a row per episode and dimension; without findings the full points."""
    dims = F.explode(F.array(*(F.struct(F.lit(k).alias("dimension"), F.lit(p).alias("points")) for k, p in DIMENSION_POINTS.items())))
    grid = episodes.select(key).distinct().select(key, dims.alias("_d")).select(key, "_d.*")
    # summed as decimals: penalties have three places, and a sum of doubles would round by the order of its rows
    lost = findings.groupBy(key, "dimension").agg(F.sum(F.col("penalty").cast("decimal(18,3)")).alias("lost"))
    d = grid.join(lost, [key, "dimension"], "left")
    d = d.join(soft.select(key, "dimension", "soft"), [key, "dimension"], "left") if soft is not None else d.withColumn("soft", F.lit(0.0))
    d = d.withColumns({"lost": F.coalesce("lost", F.lit(0).cast("decimal(18,3)")), "soft": F.coalesce("soft", F.lit(0.0))})
    left = F.col("points").cast("decimal(18,3)") - F.col("lost") - F.col("soft").cast("decimal(18,3)")
    return d.withColumns({"score": F.greatest(F.lit(0.0), F.round(left, 2).cast("double")), "lost": F.col("lost").cast("double")})


def data_value(c: dict[str, Column]) -> Column:
    """The data-value score (20 points) from an episode's facts; see ``EPISODE_FACTS``."""
    lost = (
        F.when(c["length"] < 32, 3.0).otherwise(0.0)
        + F.when(c["task"].isNull(), 2.0).otherwise(0.0)
        + F.least(F.lit(5.0), 2.5 * c["missing_state"])
        + F.least(F.lit(4.0), 1.5 * c["missing_views"])
        + F.when(c["phase_status"] != "ok", 2.5).when(c["segments"] < 3, 1.0).otherwise(0.0)
        + F.least(F.lit(4.0), 0.75 * c["geometry_unavailable"] + 1.25 * c["geometry_fail"])
        + F.least(F.lit(3.0), 0.25 * c["severe"])
    )
    return F.when(F.coalesce(c["length"], F.lit(0)) == 0, 0.0).otherwise(F.round(F.greatest(F.lit(0.0), OFFICIAL_POINTS["data_value"] - lost), 2))


def reliability(c: dict[str, Column]) -> Column:
    """The engineering-reliability score (10 points)."""
    modules = F.aggregate(F.coalesce(c["module_statuses"], F.array().cast("array<string>")), F.lit(0.0), lambda a, s: a + status_penalty(s))
    lost = status_penalty(c["geometry_status"], 3.0, 2.0, 1.0) + F.least(F.lit(4.0), modules) + F.least(F.lit(2.0), 0.35 * c["illegal"]) + F.when(c["phase_status"] != "ok", 1.0).otherwise(0.0) + F.least(F.lit(1.5), 0.25 * c["soft"])
    return F.round(F.greatest(F.lit(0.0), OFFICIAL_POINTS["engineering_reliability"] - lost), 2)


#: Columns that ``episode_scores`` reads from its episodes, with what stands in for missing ones.
EPISODE_FACTS = {"length": "0L", "task": "cast(null as long)", "missing_state": "0L", "missing_views": "0L", "phase_status": "'unavailable'", "segments": "0L", "geometry_unavailable": "0L", "geometry_fail": "0L", "geometry_status": "'ok'", "module_statuses": "cast(array() as array<string>)"}


def severe(label: Column | str = "confidence") -> Column:
    """Whether a finding is certain or of high confidence: every illegal one, of the others those from a severity of 50 on
    that don't just lie outside the reference's distribution."""
    return (F.col(label) if isinstance(label, str) else label).isin(CONFIDENCE["illegal"], CONFIDENCE["high"])


def episode_scores(episodes: DataFrame, findings: DataFrame, soft: DataFrame | None = None) -> DataFrame:
    """A row per episode with the dimension scores, the legacy total, and the official 70 / 20 / 10 score."""
    d = dimension_scores(episodes, findings, soft)
    wide = d.groupBy("episode").agg(*(F.max(F.when(F.col("dimension") == k, F.col("score"))).alias(f"score_{k}") for k in DIMENSION_POINTS), F.round(F.sum("score"), 2).alias("legacy_score"), F.sum("soft").alias("soft_penalty"))
    counts = findings.groupBy("episode").agg(F.count("*").alias("findings"), F.count(F.when(F.col("illegal"), 1)).alias("illegal"), F.count(F.when(severe(), 1)).alias("severe"))
    e = episodes.select("episode", *((F.col(k) if k in episodes.columns else F.expr(v)).alias(k) for k, v in EPISODE_FACTS.items()))
    e = e.join(wide, "episode").join(counts, "episode", "left").na.fill(0, ["findings", "illegal", "severe"])
    c = {k: F.col(k) for k in [*EPISODE_FACTS, "severe", "illegal"]} | {"soft": F.col("soft_penalty")}
    e = e.withColumns({"detection_quality": F.round(F.lit(Decimal(OFFICIAL_POINTS["detection_quality"]) / 100) * F.col("legacy_score").cast("decimal(10,2)"), 2).cast("double"), "data_value": data_value(c), "engineering_reliability": reliability(c)})
    return e.withColumn("official_score", F.round(F.col("detection_quality") + F.col("data_value") + F.col("engineering_reliability"), 2))


def dataset_score(scores: DataFrame) -> DataFrame:
    """One row of means, extremes and counts."""
    mean = lambda c: F.round(F.avg(c), 2).alias(c)
    return scores.agg(F.count("*").alias("episodes"), F.sum("findings").cast("long").alias("findings"), *(mean(c) for c in ("official_score", "legacy_score", "detection_quality", "data_value", "engineering_reliability", *(f"score_{k}" for k in DIMENSION_POINTS))), F.min("official_score").alias("min_score"), F.max("official_score").alias("max_score"))


def v1_scores(episodes: DataFrame, structural: DataFrame, images: DataFrame, sync: DataFrame) -> DataFrame:
    """Time 20, numeric 25, image 20 and sync 20 per episode; structural findings have issue_type and a severity label."""
    from framegauge.functions.scalars import issue_group

    s = structural.withColumns({"g": issue_group("issue_type"), "p": label_penalty("severity")}).groupBy("episode").agg(F.sum(F.when(F.col("g") == "time", F.col("p")).otherwise(0.0)).alias("_time"), F.sum(F.when(F.col("g") == "numeric", F.col("p")).otherwise(0.0)).alias("_numeric"), F.count("*").alias("structural_findings"))
    i = images.withColumn("p", label_penalty("severity")).groupBy("episode").agg(F.sum("p").alias("_image"), F.count("*").alias("image_findings"))
    d = episodes.join(s, "episode", "left").join(i, "episode", "left").join(sync.select("episode", "sync_score"), "episode", "left").na.fill(0, ["_time", "_numeric", "_image", "structural_findings", "image_findings"])
    d = d.withColumns({"time_score": F.round(score_with_findings(20.0, "_time"), 2), "numeric_score": F.round(score_with_findings(25.0, "_numeric"), 2), "image_score": F.round(score_with_findings(20.0, "_image"), 2), "sync_score": F.coalesce("sync_score", F.lit(15.0))}).drop("_time", "_numeric", "_image")
    return d.withColumn("quality_score_without_value", F.round(F.col("time_score") + F.col("numeric_score") + F.col("image_score") + F.col("sync_score"), 2))


def task_balance(episodes: DataFrame, task: str = "task") -> DataFrame:
    """Tasks, balance and value_score (15 points)."""
    c = episodes.groupBy(task).agg(F.count("*").alias("n"))
    g = c.agg(F.count("*").alias("tasks"), (F.min("n") / F.max("n")).alias("balance"))
    return g.withColumn("value_score", F.when(F.col("tasks") >= 2, F.round(15 * (0.7 + 0.3 * F.col("balance")), 2)).otherwise(10.5))


def detection_metrics(cases: DataFrame) -> DataFrame:
    """A26, I19 from rows of (expected, hit, false_positives, iou): precision, recall, f1 and mean IoU over the hits."""
    g = cases.agg(F.count(F.when(F.col("expected") & F.col("hit"), 1)).alias("tp"), F.count(F.when(F.col("expected") & ~F.col("hit"), 1)).alias("fn"), F.coalesce(F.sum("false_positives"), F.lit(0)).cast("long").alias("fp"), F.avg(F.when(F.col("hit"), F.col("iou"))).alias("mean_iou"))
    p, r = F.col("tp") / F.greatest(F.col("tp") + F.col("fp"), F.lit(1)), F.col("tp") / F.greatest(F.col("tp") + F.col("fn"), F.lit(1))
    g = g.withColumns({"precision": p, "recall": r})
    return g.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0, 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0))


def benchmark_summary(runs: DataFrame) -> DataFrame:
    """A27 from rows of (status, seconds)."""
    return runs.agg(F.count("*").alias("cases"), F.count(F.when(F.col("status") == "ok", 1)).alias("success"), F.count(F.when(F.col("status") != "ok", 1)).alias("failed"), F.sum("seconds").alias("total_seconds"), F.avg("seconds").alias("mean_seconds"), (F.count("*") / F.greatest(F.sum("seconds"), F.lit(1e-9))).alias("throughput"))


def repair_summary(before: DataFrame, after: DataFrame, key: str = "episode") -> DataFrame:
    """Mean gain in score and change in findings of repaired episodes."""
    b = before.select(key, F.col("official_score").alias("_b"), F.col("findings").alias("_bf"))
    d = after.select(key, "official_score", "findings").join(b, key)
    return d.agg(F.count("*").alias("cases"), F.round(F.avg((F.col("official_score") - F.col("_b")).cast("decimal(18,2)")), 3).cast("double").alias("mean_gain"), F.round(F.avg(F.col("findings") - F.col("_bf")), 3).alias("mean_findings_delta"))
