"""Gates: readiness of a finished run, preflight of an input, consistency of a presentation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def invariants(findings: DataFrame, scores: DataFrame) -> DataFrame:
    """One row per rule with ok: counts of the summary are those of the findings, scores lie in range, no orphan."""
    per = findings.groupBy("episode").agg(F.count("*").alias("n"))
    both = scores.select("episode", "findings").join(per, "episode", "left")
    rules = [
        both.agg(F.lit("findings_match").alias("rule"), (F.sum(F.when(F.col("findings") != F.coalesce("n", F.lit(0)), 1).otherwise(0)) == 0).alias("ok")),
        scores.agg(F.lit("scores_in_range"), (F.sum(F.when(F.col("official_score").between(0, 100), 0).otherwise(1)) == 0)),
        scores.agg(F.lit("parts_add_up"), (F.sum(F.when(F.abs(F.col("official_score") - F.col("detection_quality") - F.col("data_value") - F.col("engineering_reliability")) > 0.011, 1).otherwise(0)) == 0)),
        scores.agg(F.lit("episodes_unique"), (F.count("*") == F.count_distinct("episode"))),
        findings.join(scores.select("episode"), "episode", "left_anti").agg(F.lit("no_orphans"), (F.count("*") == 0)),
    ]
    out = rules[0]
    for r in rules[1:]:
        out = out.union(r)
    return out.select("rule", F.coalesce("ok", F.lit(True)).alias("ok"))


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Equal as multisets."""
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def preflight(summary: DataFrame) -> DataFrame:
    """What a run should have: disk max(2 x bytes, 2 GiB), memory max(6 x largest, 2 GiB), in GiB."""
    gib = float(1 << 30)
    return summary.select("*", F.round(F.greatest(2 * F.col("bytes") / gib, F.lit(2.0)), 2).alias("disk_gib"), F.round(F.greatest(6 * F.col("largest") / gib, F.lit(2.0)), 2).alias("memory_gib"))


def isolated(df: DataFrame, key: str, work, seconds: bool = False) -> DataFrame:
    """``work(pandas rows)`` for every case of ``key``; a case that fails is a row with its error and stops no other:
    ``(key, status, error)``, and the time with ``seconds``. A case's rows are one task's memory."""
    import time

    kind = df.schema[key].dataType.simpleString()

    def run(k, rows):
        import pandas as pd

        start, error = time.perf_counter(), None
        try:
            work(rows)
        except Exception as e:  # noqa: BLE001 - whatever goes wrong with a case is its result
            error = f"{type(e).__name__}: {e}"
        out = {key: [k[0]], "status": ["ok" if error is None else "failed"], "error": [error]}
        return pd.DataFrame(out | ({"seconds": [time.perf_counter() - start]} if seconds else {}))

    return df.groupBy(key).applyInPandas(run, f"{key} {kind}, status string, error string" + ", seconds double" * seconds)


def text_problems(text: str, forbidden: list[str], required: list[str]) -> list[str]:
    """Stale strings that a text has, and facts that it lacks."""
    return [f"has {x}" for x in forbidden if x in text] + [f"lacks {x}" for x in required if x not in text]


def ranked_findings(findings: DataFrame, k: int = 1) -> DataFrame:
    """The k worst findings: illegal, severity, penalty."""
    return findings.orderBy(F.desc("illegal"), F.desc("severity"), F.desc("penalty"), "finding_id").limit(k)


def missing_files(files: DataFrame, expected: DataFrame) -> DataFrame:
    """The ``name`` of every expected file that no ``path`` ends with."""
    have = files.select(F.element_at(F.split("path", "/"), -1).alias("name")).distinct()
    return expected.select("name").join(have, "name", "left_anti")


def abnormal_episodes(findings: DataFrame) -> DataFrame:
    """Every episode with findings and their number; a table, as there may be as many as episodes."""
    return findings.groupBy("episode").agg(F.count("*").alias("findings"))


def metrics(findings: DataFrame, scores: DataFrame) -> DataFrame:
    """One row: score, findings, abnormal episodes."""
    f = findings.agg(F.count("*").alias("findings"), F.count_distinct("episode").alias("abnormal_episodes"))
    s = scores.agg(F.round(F.avg("official_score"), 2).alias("score"), F.count("*").alias("episodes"))
    return s.crossJoin(F.broadcast(f))  # one row each
