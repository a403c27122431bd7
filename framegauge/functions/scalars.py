"""Scalar functions as Column expressions. ``s`` is a struct column of statistics (see operators.statistics)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from framegauge.functions.taxonomy import CONFIDENCE, FAMILIES, LABEL_PENALTY, STATUSES

EPS = 1e-9
Number = Column | float | int


def col(x: Number | str) -> Column:
    return F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(float(x))


def finite(x: Column | str) -> Column:
    """Neither null, NaN nor infinite; never null itself."""
    return F.coalesce(F.abs(col(x).cast("double")) < float("inf"), F.lit(False))


def stat_value(x: Column | str, default: float = 0.0) -> Column:
    """The value, or the default where it is null or not finite."""
    return F.when(finite(x), col(x)).otherwise(F.lit(default))


def normalized_score(v: Column | str, weak: Number, strong: Number) -> Column:
    """0 up to weak, 1 from strong, linear between; 0 for non-finite values (F1)."""
    v, weak, strong = col(v), col(weak), col(strong)
    return F.when(~finite(v) | (v <= weak), 0.0).when(v >= strong, 1.0).otherwise((v - weak) / (strong - weak))


def robust_z(v: Column | str, s: Column) -> Column:
    """Distance to the median in units of the larger of scaled MAD and deviation (F2)."""
    return F.abs(col(v) - s["median"]) / F.greatest(1.4826 * s["mad"], s["std"], F.lit(EPS))


def enough(s: Column, least: int = 5) -> Column:
    return F.coalesce(s["count"], F.lit(0)) >= least


def guarded_z(v: Column | str, s: Column, least: int = 5) -> Column:
    """F2, and 0 where the statistics rest on too few values."""
    return F.when(enough(s, least), robust_z(v, s)).otherwise(0.0)


def lower_outlier_score(v: Column | str, s: Column, weak: float = 4.0, strong: float = 8.0) -> Column:
    """F4."""
    return F.when(enough(s) & (col(v) < s["median"]), normalized_score(robust_z(v, s), weak, strong)).otherwise(0.0)


def upper_outlier_score(v: Column | str, s: Column, weak: float = 4.0, strong: float = 8.0) -> Column:
    """F5."""
    return F.when(enough(s) & (col(v) > s["median"]), normalized_score(robust_z(v, s), weak, strong)).otherwise(0.0)


def two_sided_outlier_score(v: Column | str, s: Column, weak: float = 4.0, strong: float = 8.0) -> Column:
    """F6."""
    return F.when(enough(s), normalized_score(robust_z(v, s), weak, strong)).otherwise(0.0)


def upper_tail_pressure(v: Column | str, s: Column, start: str = "p95") -> Column:
    """How far between the quantile and the maximum, in [0, 1]."""
    v = col(v)
    return F.when(enough(s) & finite(v) & (v > s[start]), F.least(F.lit(1.0), (v - s[start]) / F.greatest(s["max"] - s[start], F.lit(EPS)))).otherwise(0.0)


def lower_tail_pressure(v: Column | str, s: Column, start: str = "p05") -> Column:
    """How far between the quantile and the minimum, in [0, 1] (F8)."""
    v = col(v)
    return F.when(enough(s) & finite(v) & (v < s[start]), F.least(F.lit(1.0), (s[start] - v) / F.greatest(s[start] - s["min"], F.lit(EPS)))).otherwise(0.0)


def two_sided_tail_pressure(v: Column | str, s: Column) -> Column:
    """F9."""
    return F.greatest(upper_tail_pressure(v, s), lower_tail_pressure(v, s))


def score_from_z(z: Column | str, weak: float = 4.0, strong: float = 8.0) -> Column:
    """0 to 100."""
    return 100.0 * normalized_score(z, weak, strong)


def lower_threshold(s: Column, key: str = "p05", times: float = 0.5, floor: float = 1e-8, least: int = 5) -> Column:
    """null where there are too few reference values."""
    return F.when(enough(s, least), F.greatest(F.lit(floor), s[key] * times))


def upper_threshold(s: Column, key: str = "p99", times: float = 1.5, mads: float = 8.0, margin: float = 1.05, least: int = 5) -> Column:
    """the largest of quantile, median plus deviations, and maximum with a margin; null for too few values."""
    return F.when(enough(s, least), F.greatest(s[key] * times, s["median"] + mads * s["mad"], s["max"] * margin))


def freeze_severity(run: Column | str, exact: bool = False) -> Column:
    """piecewise linear in the run's length."""
    a, b, c, d = (30.0, 55.0, 85.0, 100.0) if exact else (20.0, 45.0, 80.0, 95.0)
    r = col(run).cast("double")
    return F.when(r <= 10, 0.0).when(r <= 50, a + (r - 10) / 40 * (b - a)).when(r <= 100, b + (r - 50) / 50 * (c - b)).otherwise(c + F.least(F.lit(1.0), (r - 100) / 100) * (d - c))


def confidence(severity: Column | str, illegal: Column, ood: Column) -> Column:
    """F15."""
    return F.when(illegal, CONFIDENCE["illegal"]).when(ood, CONFIDENCE["ood"]).when(col(severity) >= 50, CONFIDENCE["high"]).otherwise(CONFIDENCE["suspect"])


def penalty(severity: Column | str, points: Column, illegal: Column, start: Column | None = None, end: Column | None = None) -> Column:
    """F16: share of the dimension's points by severity and coverage; an illegal finding costs 65 % at least."""
    span = F.lit(1.0) if start is None else F.when(start.isNotNull() & end.isNotNull(), F.least(F.lit(1.5), 1 + F.greatest(F.lit(0.0), end - start) / 200)).otherwise(1.0)
    base = points * col(severity) / 100 * span
    return F.round(F.least(points, F.when(illegal, F.greatest(base, 0.65 * points)).otherwise(base)), 3)


def label_penalty(label: Column | str) -> Column:
    """points of a severity label, 2 for unknown ones."""
    out = F.lit(2.0)
    for k, v in LABEL_PENALTY.items():
        out = F.when(col(label) == k, v).otherwise(out)
    return out


def score_with_findings(base: Number, lost: Column | str) -> Column:
    """base less the penalties, within [0, base]."""
    b = col(base)
    return F.greatest(F.lit(0.0), F.least(b, b - col(lost)))


def status_penalty(status: Column | str, fail: float = 1.5, unavailable: float = 1.0, warning: float = 0.4) -> Column:
    """F19."""
    s = col(status)
    return F.when(s == "fail", fail).when(s == "unavailable", unavailable).when(s == "warning", warning).otherwise(0.0)


def normalize_status(status: Column | str, empty: str = "ok") -> Column:
    """names outside the enum are failures, nothing is the default."""
    s = col(status)
    return F.when(s.isNull() | (s == ""), empty).when(s.isin(STATUSES), s).otherwise("fail")


def aggregate_status(core: Column, others: Column) -> Column:
    """of arrays of statuses; a failed or unavailable core decides, then any failure, then any doubt of the others."""
    has = lambda a, *names: F.exists(a, lambda x: x.isin(*names))
    return F.when(has(core, "fail"), "fail").when(has(core, "unavailable"), "unavailable").when(has(others, "fail"), "fail").when(has(others, "warning", "unavailable"), "warning").otherwise("ok")


def clamp01(v: Column | str, lo: Number, hi: Number) -> Column:
    """F29."""
    v, lo, hi = col(v), col(lo), col(hi)
    return F.when(hi > lo, F.greatest(F.lit(0.0), F.least(F.lit(1.0), (v - lo) / (hi - lo)))).otherwise(0.0)


def safe_name(x: Column | str) -> Column:
    """characters that file systems refuse become underscores."""
    return F.translate(col(x), '<>:"/\\|?*', "_" * 9)


def gib(size: Column | str) -> Column:
    """F32."""
    return F.round(col(size) / float(1 << 30), 2)


def finding_family(category_id: Column | str) -> Column:
    """the family of a category id."""
    out = F.lit(None).cast("string")
    for family, (number, _, _) in FAMILIES.items():
        out = F.when(col(category_id) == number, family).otherwise(out)
    return out


def score_reasons(reasons: Column, soft: Column) -> Column:
    """the reasons, or what an empty list means."""
    return F.when(F.size(reasons) > 0, reasons).otherwise(F.array(F.when(soft > 0, "minor_reference_penalties").otherwise("full_credit")))


def shortest(x: Column | str) -> Column:
    """six decimals at most, without trailing zeros."""
    return F.regexp_replace(F.round(col(x), 6).cast("decimal(28,6)").cast("string"), r"\.?0+$", "")


def bucket_key(*parts: Column | str | None) -> Column:
    """the parts joined by a bar; null parts are left out."""
    return F.concat_ws("|", *(F.lit(None).cast("string") if p is None else F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def issue_group(issue: Column | str) -> Column:
    """Routes first-generation issue names to time, numeric or other."""
    i = col(issue)
    return F.when(i.rlike("timestamp|frame_index|index_gap|length"), "time").when(i.rlike("state|actions|finite|shape"), "numeric").otherwise("other")


def absolute_path(path: Column | str) -> Column:
    """P14."""
    return col(path).rlike(r"^([A-Za-z]:[\\/]|/)")
