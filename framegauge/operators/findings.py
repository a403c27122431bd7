"""The findings schema: one long table for every detector, with penalties, ids and summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framegauge.functions.scalars import confidence, penalty
from framegauge.functions.taxonomy import DIMENSION_POINTS, FAMILIES
from framegauge.operators.islands import merge_findings

#: Name and type of each column; ``episode`` and ``frame`` columns are numbers of the source.
SCHEMA = {
    "episode": "long", "task": "long", "family": "string", "category_id": "string", "dimension": "string", "issue_type": "string", "level": "string", "modality": "string",
    "view": "string", "column": "string", "frame_start": "long", "frame_end": "long", "severity": "double", "illegal": "boolean", "ood": "boolean", "confidence": "string",
    "penalty": "double", "evidence": "string", "merged_count": "long",
}
MERGE_KEYS = ["episode", "category_id", "issue_type", "modality", "view", "column"]


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def finding(df: DataFrame, family: str, issue, severity, start=None, end=None, *, level: str = "segment", modality: str = "state", view=None, column=None, illegal: bool = False, ood: Column | bool = False, evidence: dict[str, Column] | None = None) -> DataFrame:
    """A finding per row of ``df``, which has ``episode`` and ``task``; evidence becomes a JSON string."""
    number, _, dimension = FAMILIES[family]
    a, b = _lit(start).cast("long"), _lit(end if end is not None else start).cast("long")
    sev = _lit(severity).cast("double")
    cells = {
        "episode": F.col("episode"), "task": F.col("task"), "family": F.lit(family), "category_id": F.lit(number), "dimension": F.lit(dimension), "issue_type": _lit(issue), "level": F.lit(level),
        "modality": F.lit(modality), "view": _lit(view), "column": _lit(column), "frame_start": a, "frame_end": b, "severity": F.round(sev, 2), "illegal": F.lit(illegal), "ood": _lit(ood),
        "confidence": confidence(sev, F.lit(illegal), _lit(ood)), "penalty": penalty(sev, F.lit(DIMENSION_POINTS[dimension]), F.lit(illegal), a, b),
        "evidence": F.to_json(F.struct(*(v.alias(k) for k, v in evidence.items()))) if evidence else F.lit("{}"), "merged_count": F.lit(1),
    }
    return df.select(*(cells[k].cast(t).alias(k) for k, t in SCHEMA.items()))


def union_findings(parts: list[DataFrame]) -> DataFrame:
    """All findings of all detectors, repeats included."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def with_ids(findings: DataFrame, prefix: str = "V2F") -> DataFrame:
    """Ids by content, the same in any partitioning; a global sequence would need all rows in one task."""
    key = F.sha1(F.to_json(F.struct(*[c for c in SCHEMA if c in findings.columns])))
    return findings.withColumn("finding_id", F.concat(F.lit(f"{prefix}-"), F.substring(key, 1, 12)))


def merged(findings: DataFrame, slack: int = 2) -> DataFrame:
    """W30 over the schema: the points of the finding's dimension cap the folded penalty."""
    points = F.lit(10.0)
    for name, p in DIMENSION_POINTS.items():
        points = F.when(F.col("dimension") == name, p).otherwise(points)
    return merge_findings(findings if "finding_id" in findings.columns else with_ids(findings), MERGE_KEYS, points, slack)


def counts_by(findings: DataFrame, column: str) -> DataFrame:
    """A13."""
    return findings.groupBy(column).agg(F.count("*").alias("n"))


def top_issues(findings: DataFrame, k: int = 10) -> DataFrame:
    """K3: the most frequent issue types, ties by name."""
    return counts_by(findings, "issue_type").orderBy(F.desc("n"), "issue_type").limit(k)


def report_order() -> list[Column]:
    """K1: by episode (null first as -1), category, start (0 and null as -1), id."""
    start = F.when(F.coalesce("frame_start", F.lit(0)) == 0, -1).otherwise(F.col("frame_start"))
    return [F.coalesce("episode", F.lit(-1)), F.col("category_id"), start, F.col("finding_id")]


def in_order(findings: DataFrame) -> DataFrame:
    """K1."""
    return findings.orderBy(*report_order())


def of_types(findings: DataFrame, *types: str) -> DataFrame:
    """P13."""
    return findings.where(F.col("issue_type").isin(*types))


def by_episode(episodes: DataFrame, findings: DataFrame, most: int = 100) -> DataFrame:
    """Each episode with its number of findings and the first ``most`` of them by start; a report, not a table to compute on."""
    w = Window.partitionBy("episode").orderBy("frame_start", "issue_type")
    early = findings.withColumn("_nth", F.row_number().over(w)).where(F.col("_nth") <= most)
    cells = early.groupBy("episode").agg(F.sort_array(F.collect_list(F.struct("frame_start", "issue_type"))).alias("first"))
    g = findings.groupBy("episode").agg(F.count("*").alias("n")).join(cells, "episode")
    return episodes.select("episode").distinct().join(g, "episode", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def first_cases(cases: DataFrame, k: int, *by) -> DataFrame:
    """K6: the first k cases in a total order."""
    return cases.orderBy(*by).limit(k)
