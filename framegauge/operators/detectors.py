"""Detectors: each takes a DataFrame of rows or signals and returns findings.

Row tables have ``episode``, ``task``, ``seq`` (0-based place) and ``frame`` (frame id). A detector is a predicate or a
threshold from reference statistics, folded into islands, with a severity expression. Every constant is a parameter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framegauge.functions import vectors as V
from framegauge.functions.scalars import enough, finite, freeze_severity, lower_outlier_score, lower_threshold, normalized_score, score_from_z, stat_value, two_sided_outlier_score, upper_outlier_score, upper_threshold, guarded_z
from framegauge.functions.taxonomy import INDEX_COLUMNS, VIEWS
from framegauge.operators.findings import finding
from framegauge.operators.islands import equal_runs, islands
from framegauge.operators.signals import ordered
from framegauge.operators.statistics import null_safe

KEYS = ["episode", "task"]


# ---- files, columns and metadata -------------------------------------------------------------------------------------


def unreadable_files(files: DataFrame) -> DataFrame:
    """Rows of (episode, task, file, error)."""
    return finding(files, "state_illegal", "parquet_read_error", 100.0, level="episode", illegal=True, evidence={"file": F.col("file"), "error": F.col("error")})


def missing_columns(episodes: DataFrame, present: list[str], expected: list[str], views: list[str] = VIEWS) -> list[DataFrame]:
    """A finding per missing column and episode; missing index columns count twice, as in the rules."""
    out = []
    for c in sorted(set(expected) - set(present)):
        family, modality = ("vision_illegal", "vision") if c in views else ("state_illegal", "state")
        out.append(finding(episodes, family, "missing_required_column", 100.0, level="episode", modality=modality, view=c if c in views else None, column=c, illegal=True))
        if c in INDEX_COLUMNS:
            out.append(finding(episodes, "temporal_illegal", "missing_temporal_column", 100.0, level="episode", modality="temporal", column=c, illegal=True))
    return out


def unexpected_columns(present: list[str], expected: list[str]) -> list[str]:
    """U2."""
    return sorted(set(present) - set(expected))


def length_mismatch(episodes: DataFrame) -> DataFrame:
    """Rows of (episode, task, rows, length); an episode without rows is empty, whatever its metadata say."""
    e = episodes.where(F.col("length").isNotNull() & (F.coalesce("rows", F.lit(0)) != F.col("length")) | (F.coalesce("rows", F.lit(0)) == 0))
    issue = F.when(F.coalesce("rows", F.lit(0)) == 0, "empty_episode").otherwise("metadata_length_mismatch")
    return finding(e, "temporal_illegal", issue, 100.0, level="episode", modality="temporal", illegal=True, evidence={"rows": F.col("rows"), "length": F.col("length")})


def missing_rows(expected: DataFrame, found: DataFrame, on: list[str]) -> DataFrame:
    """What is expected and not there."""
    return expected.join(found, on, "left_anti")


# ---- indices ---------------------------------------------------------------------------------------------------------


def non_finite(df: DataFrame, column: str, gap: int = 1) -> DataFrame:
    """Islands of frames whose value is null, NaN or infinite."""
    runs = islands(df.where(~finite(column)).select(*KEYS, "frame"), KEYS, "frame", gap)
    return finding(runs, "temporal_illegal", f"non_finite_{column}", 100.0, F.col("start"), F.col("end"), modality="temporal", column=column, illegal=True)


def _next(df: DataFrame, column: str) -> DataFrame:
    w = ordered(KEYS, "seq")
    return df.withColumns({"_diff": F.lead(column).over(w) - F.col(column), "_to": F.lead("frame").over(w)})


def index_steps(df: DataFrame, column: str = "frame_index") -> DataFrame:
    """Steps other than one; zero is a duplicate."""
    bad = _next(df, column).where(finite("_diff") & (F.col("_diff") != 1))
    issue = F.when(F.col("_diff") == 0, "duplicate_frame_index").otherwise("frame_index_gap_or_reorder")
    return finding(bad, "temporal_illegal", issue, 100.0, F.col("frame"), F.col("_to"), modality="temporal", column=column, illegal=True, evidence={"diff": F.col("_diff")})


def global_index_steps(df: DataFrame, column: str = "index") -> DataFrame:
    """D8."""
    bad = _next(df, column).where(finite("_diff") & (F.col("_diff") != 1))
    return finding(bad, "temporal_illegal", "global_index_gap_or_reorder", 100.0, F.col("frame"), F.col("_to"), modality="temporal", column=column, illegal=True, evidence={"diff": F.col("_diff")})


def timestamp_steps(df: DataFrame, column: str = "timestamp", fps: float | None = None, floor: float = 0.02, share: float = 0.35) -> DataFrame:
    """Steps that go back or differ from the period by more than the larger of ``floor`` and ``share`` of it.

    Without ``fps`` the period is the episode's median step."""
    d = _next(df, column)
    period = F.lit(1.0 / fps) if fps else F.percentile("_diff", F.lit(0.5)).over(Window.partitionBy(*KEYS))
    d = d.withColumn("_period", period)
    bad = d.where(finite("_diff") & ((F.col("_diff") <= 0) | (F.abs(F.col("_diff") - F.col("_period")) > F.greatest(F.lit(floor), share * F.col("_period")))))
    return finding(bad, "temporal_illegal", "timestamp_gap_or_reorder", 100.0, F.col("frame"), F.col("_to"), modality="temporal", column=column, illegal=True, evidence={"diff": F.round("_diff", 6), "expected": F.round("_period", 6)})


def inconsistent(df: DataFrame, column: str, issue: str) -> DataFrame:
    """An episode with more than one value of a column that is constant by rule; null counts as a value."""
    n = df.groupBy(*KEYS).agg((F.count_distinct(column) + F.max(F.when(F.col(column).isNull(), 1).otherwise(0))).alias("n"))
    return finding(n.where("n > 1"), "temporal_illegal", issue, 100.0, level="episode", modality="temporal", column=column, illegal=True, evidence={"values": F.col("n")})


# ---- images ----------------------------------------------------------------------------------------------------------


def image_legality(images: DataFrame, height: int, width: int, channels: int = 3) -> DataFrame:
    """Images that can't be decoded or have another shape than declared."""
    bad = images.where(~F.col("decoded") | (F.col("height") != height) | (F.col("width") != width) | (F.col("channels") != channels))
    issue = F.when(F.col("decoded"), "invalid_image_shape").otherwise("image_decode_error")
    return finding(bad, "vision_illegal", issue, 100.0, F.col("frame"), level="frame", modality="vision", view=F.col("view"), illegal=True)


def is_black() -> Column:
    return (F.col("black_fraction") > 0.98) | ((F.col("mean") < 5) & (F.col("std") < 5))


def is_white() -> Column:
    return (F.col("white_fraction") > 0.98) | ((F.col("mean") > 250) & (F.col("std") < 5))


def quality_components(s: dict[str, Column]) -> Column:
    """Array of (score, order, name): how black, white, dark, bright, flat, blurred and empty an image is."""
    one = lambda name, order, x: F.struct(x.cast("double").alias("score"), F.lit(-order).alias("order"), F.lit(name).alias("name"))
    flag = lambda c: F.when(c, 1.0).otherwise(0.0)
    low = lambda m: lower_outlier_score(m, s[m])
    up = lambda m: upper_outlier_score(m, s[m])
    return F.array(
        one("black", 0, flag(is_black())),
        one("white", 1, flag(is_white())),
        one("under_exposed", 2, F.greatest(normalized_score(20 - F.col("mean"), 0, 15), low("mean"))),
        one("over_exposed", 3, F.greatest(normalized_score(F.col("mean") - 235, 0, 15), up("mean"))),
        one("low_contrast", 4, F.greatest(normalized_score(12 - F.col("std"), 0, 10), low("std"))),
        one("blur", 5, F.greatest(normalized_score(50 - F.col("sharpness"), 0, 40), low("sharpness"))),
        one("low_entropy", 6, F.greatest(normalized_score(2.5 - F.col("entropy"), 0, 1.5), low("entropy"))),
    )


def image_quality(images: DataFrame, s: dict[str, Column], least: float = 30.0) -> DataFrame:
    """The worst component of each image, the first in order of ties; ``s`` has statistics by metric."""
    d = images.where("decoded").withColumn("_worst", F.array_max(quality_components(s)))
    d = d.withColumn("_severity", 100 * F.col("_worst.score")).where(F.col("_severity") >= least)
    return finding(d, "vision_single", F.col("_worst.name"), F.col("_severity"), F.col("frame"), level="frame", modality="vision", view=F.col("view"), evidence={"score": F.round(F.col("_worst.score"), 6)})


def first_quality_issue(min_sharpness: float = 50.0) -> Column:
    """Black, then white, then blurred; null for good images."""
    return F.when(is_black(), "black_frame").when(is_white(), "white_frame").when(F.col("sharpness") < min_sharpness, "severe_blur")


def exact_repeats(df: DataFrame, value: str, parts: list[str], min_run: int = 11, min_severity: float = 55.0, family: str = "vision_temporal", issue: str = "exact_frozen_image_run", modality: str = "vision", exact: bool = True) -> DataFrame:
    """Runs of one value (an image's hash)."""
    frames = F.min_by("frame", "seq").alias("from"), F.max_by("frame", "seq").alias("to")
    runs = equal_runs(df, [*KEYS, *parts], "seq", value, *frames).where(F.col("n") >= min_run).withColumn("_sev", freeze_severity("n", exact)).where(F.col("_sev") >= min_severity)
    return finding(runs, family, issue, F.col("_sev"), F.col("from"), F.col("to"), modality=modality, view=F.col("view") if "view" in parts else None, column=F.col("column") if "column" in parts else None, evidence={"run_length": F.col("n")})


# ---- signals against reference statistics ----------------------------------------------------------------------------


def _spans(df: DataFrame, parts: list[str], gap: int, *aggs: Column) -> DataFrame:
    """Islands of hit transitions with the frames they join: transition seq lies between rows seq - 1 and seq."""
    ends = F.min_by("frame_before", "seq").alias("from"), F.max_by("frame", "seq").alias("to"), F.min_by("frame", "seq").alias("first_frame")
    return islands(df, [*KEYS, *parts], "seq", gap, *ends, *aggs)


def with_before(df: DataFrame, parts: list[str]) -> DataFrame:
    """Adds the frame before each row, unless it is there; phases are parts of one series, so they don't cut it."""
    if "frame_before" in df.columns:
        return df
    w = ordered([*KEYS, *(p for p in parts if p != "phase")], "seq")
    return df.withColumn("frame_before", F.coalesce(F.lag("frame").over(w), F.col("frame")))


def _where(parts: list[str]) -> dict:
    return {"view": F.col("view") if "view" in parts else None, "column": F.col("column") if "column" in parts else None}


def _named(issue: str, parts: list[str]) -> Column:
    return F.concat(F.lit(issue + "_"), F.col("phase")) if "phase" in parts else F.lit(issue)


def freeze_runs(df: DataFrame, value: str, threshold: Column, parts: list[str], family: str = "state_temporal", issue: str = "low_dim_freeze_run", modality: str = "state", min_run: int = 11, min_severity: float = 55.0) -> DataFrame:
    """Long runs of transitions at or under a threshold."""
    d = with_before(df, parts).where(finite(value) & (F.col(value) <= threshold))
    runs = _spans(d, parts, 1, F.percentile(value, F.lit(0.5)).alias("mid")).where(F.col("n") >= min_run).withColumn("_sev", freeze_severity("n")).where(F.col("_sev") >= min_severity)
    return finding(runs, family, _named(issue, parts), F.col("_sev"), F.col("from"), F.col("to"), modality=modality, **_where(parts), evidence={"run_length": F.col("n"), "median": F.round("mid", 6)})


def static_threshold(s: Column, key: str = "p01", floor: float = 0.2) -> Column:
    """The threshold of near-static image motion: half the reference's 1 % quantile, ``floor`` at least."""
    return F.greatest(F.lit(floor), stat_value(s[key], floor) * 0.5)


def low_dim_low_threshold(phase_s: Column, s: Column) -> Column:
    """Half the 5 % quantile of the phase, else half the 1 % quantile without phase, else 1e-8."""
    return F.coalesce(lower_threshold(phase_s, "p05"), lower_threshold(s, "p01"), F.lit(1e-8))


def fast_jumps(df: DataFrame, value: str, s: str, parts: list[str], family: str = "state_temporal", issue: str = "low_dim_fast_jump", modality: str = "state", threshold: Column | None = None, weak: float = 4.0, strong: float = 10.0) -> DataFrame:
    """Transitions at or over the reference's upper threshold; no reference, no finding."""
    high = upper_threshold(F.col(s)) if threshold is None else threshold
    d = with_before(df, parts).withColumn("_high", high).where(finite(value) & (F.col(value) >= F.col("_high")))
    runs = _spans(d, parts, 1, F.max(value).alias("most"), F.first(s).alias("s"), F.max("_high").alias("limit"))
    sev = 100 * F.greatest(F.lit(0.35), upper_outlier_score("most", F.col("s"), weak, strong))
    return finding(runs, family, _named(issue, parts), sev, F.col("from"), F.col("to"), modality=modality, **_where(parts), evidence={"max": F.round("most", 6), "threshold": F.round("limit", 6)})


def jitter_clusters(df: DataFrame, value: str, s: str, parts: list[str], family: str = "state_temporal", issue: str = "low_dim_jitter_or_spike", modality: str = "state", threshold: Column | None = None, gap: int = 2, min_length: int = 2, single_score: float = 95.0, vision: bool = False) -> DataFrame:
    """Clusters of second differences at or over the threshold, by index span; a single spike needs ``single_score``.

    Vision takes clusters only, with a severity by their length."""
    high = threshold if threshold is not None else upper_threshold(F.col(s), "p99", 2.0, 10.0) if vision else upper_threshold(F.col(s))
    d = with_before(df, parts).withColumn("_high", high).where(finite(value) & (F.col(value) >= F.col("_high")))
    runs = _spans(d, parts, gap, F.max(value).alias("most"), F.first(s).alias("s")).withColumn("len", F.col("end") - F.col("start") + 1)
    score = F.least(F.lit(85.0), 35 + 10.0 * F.col("len")) if vision else F.greatest(F.lit(35.0), 100 * upper_outlier_score("most", F.col("s"), 4.0, 10.0))
    runs = runs.withColumn("_sev", score).where((F.col("len") >= min_length) | (F.lit(not vision) & (F.col("_sev") >= single_score)))
    return finding(runs, family, _named(issue, parts), F.col("_sev"), F.col("from"), F.col("to"), modality=modality, **_where(parts), evidence={"max": F.round("most", 6), "cluster_len": F.col("len")})


def value_outliers(df: DataFrame, vector: str, value_s: str = "s", abs_s: str | None = None, weak: float = 6.0, strong: float = 12.0, least: float = 35.0, ood_below: float = 55.0) -> DataFrame:
    """Rows whose median (and, with statistics for it, largest absolute) element lies outside the reference."""
    d = df.withColumn("_max", V.largest(vector)).where(finite("_max"))
    score = 100 * two_sided_outlier_score(V.median(F.col(vector)), F.col(value_s), weak, strong)
    if abs_s:
        score = F.greatest(score, 100 * upper_outlier_score("_max", F.col(abs_s), weak, strong))
    d = d.withColumn("_sev", score).where(F.col("_sev") >= least)
    return finding(d, "state_vision_state", "low_dim_value_reference_outlier", F.col("_sev"), F.col("frame"), level="frame", column=F.col("column") if "column" in df.columns else None, ood=F.col("_sev") < ood_below, evidence={"row_abs_max": F.round("_max", 6)})


# ---- low-dimensional legality ----------------------------------------------------------------------------------------


def vector_widths(df: DataFrame, vector: str, width: int, column: str) -> DataFrame:
    """An episode whose vectors differ in width, or have another width than declared."""
    g = df.groupBy(*KEYS).agg(F.min(F.size(vector)).alias("lo"), F.max(F.size(vector)).alias("hi"))
    issue = F.when(F.col("lo") != F.col("hi"), "inconsistent_low_dim_shape").otherwise("invalid_low_dim_shape")
    return finding(g.where((F.col("lo") != F.col("hi")) | (F.col("hi") != width)), "state_illegal", issue, 100.0, level="episode", column=column, illegal=True, evidence={"least": F.col("lo"), "most": F.col("hi"), "declared": F.lit(width)})


def non_finite_vectors(df: DataFrame, vector: str, column: str) -> DataFrame:
    """D21."""
    runs = islands(df.where(~V.all_finite(vector)).select(*KEYS, "frame"), KEYS, "frame", 1)
    return finding(runs, "state_illegal", "non_finite_low_dim_value", 100.0, F.col("start"), F.col("end"), column=column, illegal=True)


def impossible_magnitudes(df: DataFrame, vector: str, column: str, limit: float = 1e6) -> DataFrame:
    """Finite vectors with an element beyond the limit."""
    runs = islands(df.where(V.all_finite(vector) & (V.largest(vector) > limit)).select(*KEYS, "frame"), KEYS, "frame", 1)
    return finding(runs, "state_illegal", "impossible_low_dim_magnitude", 100.0, F.col("start"), F.col("end"), column=column, illegal=True, evidence={"limit": F.lit(limit)})


# ---- geometry --------------------------------------------------------------------------------------------------------


def degenerate_rotations(arms: DataFrame) -> DataFrame:
    """Islands of frames whose 6-D rotation has no matrix."""
    runs = islands(arms.where(~F.col("check.legal")).select(*KEYS, "arm", "frame"), [*KEYS, "arm"], "frame", 1)
    return finding(runs, "state_illegal", "geometry_rotation6d_degenerate", 100.0, F.col("start"), F.col("end"), modality="state-geometry", column=F.concat(F.lit("state."), F.col("arm"), F.lit(".rotation6d")), illegal=True)


def oscillations(windows: DataFrame, rows: DataFrame, window: int = 11, reversals: int = 3, gap: int = 2, ood_below: float = 70.0) -> DataFrame:
    """Islands of oscillating windows; spans are row positions. ``rows``: keys and n, the rows of each episode."""
    k = [*KEYS, "arm"]
    best = F.max(F.struct("direction_reversals", "path_length", "path_efficiency")).alias("best")
    runs = null_safe(islands(windows, k, "start", gap, best), rows, KEYS)
    sev = F.least(F.lit(100.0), 55 + 8.0 * F.greatest(F.lit(0), F.col("best.direction_reversals") - reversals))
    issue = F.concat(F.lit("geometry_"), F.col("arm"), F.lit("_oscillatory_jitter"))
    evidence = {"direction_reversals": F.col("best.direction_reversals"), "path_length": F.round("best.path_length", 6), "path_efficiency": F.round("best.path_efficiency", 6)}
    return finding(runs, "state_temporal", issue, sev, F.col("start"), F.least(F.col("rows") - 1, F.col("end") + window - 1), modality="state-geometry", column=F.concat(F.lit("state."), F.col("arm"), F.lit(".position")), ood=sev < ood_below, evidence=evidence)


def hardware_limits(arms: DataFrame, metric: str, limit: float) -> DataFrame:
    """Islands of transitions beyond a limit that the user sets."""
    d = with_before(arms, ["arm"]).where(finite(metric) & (F.col(metric) > limit))
    runs = _spans(d, ["arm"], 1, F.max(metric).alias("most"))
    sev = F.greatest(F.lit(60.0), F.least(F.lit(100.0), 60 + 40 * (F.col("most") / limit - 1)))
    issue = F.concat(F.lit("geometry_"), F.col("arm"), F.lit(f"_{metric}_hardware_limit_exceeded"))
    return finding(runs, "state_temporal", issue, sev, F.col("from"), F.col("to"), modality="state-geometry", column=F.concat(F.lit("state."), F.col("arm")), evidence={"max": F.round("most", 6), "limit": F.lit(limit)})


def distance_drifts(df: DataFrame, s: str = "s", times: float = 1.4, mads: float = 8.0, gap: int = 2, min_run: int = 1, floor: float = 40.0, issue: str = "geometry_bimanual_relative_distance_drift") -> DataFrame:
    """D30, and D33 with ``min_run`` 11 and ``floor`` 45: drift of the arms' distance beyond the reference."""
    high = F.greatest(F.col(s)["p99"] * times, F.col(s)["median"] + mads * F.col(s)["mad"])
    d = df.where(finite("drift") & enough(F.col(s)) & (F.col("drift") > high))
    ends = F.min_by("frame", "seq").alias("from"), F.max_by("frame", "seq").alias("to")
    runs = islands(d, KEYS, "seq", gap, *ends, F.max("drift").alias("most"), F.first(s).alias("s")).where(F.col("end") - F.col("start") + 1 >= min_run)
    sev = F.greatest(F.lit(floor), score_from_z(guarded_z("most", F.col("s"))))
    return finding(runs, "state_vision_state", issue, sev, F.col("from"), F.col("to"), modality="state-geometry", column="state", evidence={"max_drift": F.round("most", 6)})


def coincidences(df: DataFrame, active: str, still: str, parts: list[str], family: str, issue: Column | str, high: float = 0.9, low: float = 0.1, min_run: int = 11) -> DataFrame:
    """One signal in its upper tenth while the other is in its lower tenth, by episode. Columns lag_gate and
    lag, where there are any, go into the evidence."""
    w = Window.partitionBy(*KEYS, *parts)
    q = lambda x, p: F.percentile(F.when(finite(x), F.col(x)), F.lit(p)).over(w)
    d = with_before(df, parts).withColumns({"_hi": q(active, high), "_lo": q(still, low)})
    hit = d.where(finite(active) & finite(still) & (F.col(active) >= F.col("_hi")) & (F.col(still) <= F.col("_lo")))
    gate = [c for c in ("lag_gate", "lag") if c in df.columns]
    runs = _spans(hit, parts, 1, *(F.first(c).alias(c) for c in gate)).where(F.col("n") >= min_run)
    sev = F.least(F.lit(85.0), 40 + 5.0 * F.col("n"))
    return finding(runs, family, issue, sev, F.col("from"), F.col("to"), modality="state-vision", view=F.col("view") if "view" in parts else None, column=F.col("column") if "column" in parts else None, ood=True, evidence={"run_length": F.col("n")} | {c: F.col(c) for c in gate})


# ---- weak spatial checks ---------------------------------------------------------------------------------------------


def decoupled(couplings: DataFrame, s: str = "s", floor: float = 0.2, share: float = 0.65) -> DataFrame:
    """An episode whose best absolute correlation is far under the reference's."""
    d = couplings.where(enough(F.col(s)) & (F.col("best_abs_correlation") < F.greatest(F.lit(floor), F.col(s)["p05"] * share)))
    sev = F.greatest(F.lit(35.0), score_from_z(guarded_z("best_abs_correlation", F.col(s)), 2.5, 5.0))
    return finding(d, "vision_state_temporal", "p1_state_visual_motion_decoupling_candidate", sev, level="episode", modality="state-vision", ood=True)


def activity_mismatch(couplings: DataFrame, fraction: str, s: str = "s", floor: float = 0.12, times: float = 1.5, mads: float = 5.0) -> DataFrame:
    """How often one signal is active while the other is quiet, against the reference."""
    high = F.greatest(F.lit(floor), F.col(s)["p95"] * times, F.col(s)["median"] + mads * F.col(s)["mad"])
    d = couplings.withColumn("_high", high).where(enough(F.col(s)) & (F.col(fraction) > F.col("_high")))
    sev = F.least(F.lit(80.0), 40 + 250 * (F.col(fraction) - F.col("_high")))
    return finding(d, "vision_state_temporal", "p1_state_visual_activity_mismatch_candidate", sev, level="episode", modality="state-vision", ood=True, evidence={"fraction": F.round(fraction, 6)})


def camera_freeze(df: DataFrame, speed: str, motion: str, speed_high: Column, motion_low: Column, min_run: int = 11) -> DataFrame:
    """The main camera hardly changes while an arm is fast."""
    d = with_before(df, []).where(finite(speed) & finite(motion) & (F.col(speed) >= speed_high) & (F.col(motion) <= motion_low))
    runs = _spans(d, [], 1).where(F.col("n") >= min_run)
    return finding(runs, "vision_state_vision", "p1_main_camera_freeze_candidate", F.least(F.lit(92.0), 55 + 4.0 * F.col("n")), F.col("from"), F.col("to"), modality="state-vision", evidence={"run_length": F.col("n")})


def panel_unstable(df: DataFrame, area: str, area_low: Column, valid: str, valid_low: Column, min_run: int = 11) -> DataFrame:
    """A panel that is seen often enough and suddenly covers little; the span ends one frame after the last hit."""
    after = F.coalesce(F.lead("frame").over(ordered([*KEYS, "view"], "seq")), F.col("frame"))
    d = df.withColumn("_after", after).where(finite(area) & (F.col(area) <= area_low) & (F.col(valid) >= F.greatest(F.lit(0.10), valid_low)))
    ends = F.min_by("frame", "seq").alias("from"), F.max_by("_after", "seq").alias("to")
    runs = islands(d, [*KEYS, "view"], "seq", 1, *ends).where(F.col("n") >= min_run)
    return finding(runs, "vision_state_vision", "p1_panel_proxy_unstable_candidate", F.least(F.lit(78.0), 45 + 2.5 * F.col("n")), F.col("from"), F.col("to"), modality="vision", view=F.col("view"), ood=True, evidence={"run_length": F.col("n")})


# ---- first generation ------------------------------------------------------------------------------------------------


def v1_timestamps(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """(episode, frame, diff, expected, severity) of steps off the median by more than max(0.02, a quarter of it)."""
    d = _next(df, column).withColumn("expected", F.percentile("_diff", F.lit(0.5)).over(Window.partitionBy(*KEYS)))
    off = F.abs(F.col("_diff") - F.col("expected"))
    bad = d.where(finite("_diff") & ((F.col("_diff") <= 0) | (off > F.greatest(F.lit(0.02), 0.25 * F.col("expected")))))
    label = F.when((F.col("_diff") <= 0) | (off > F.col("expected")), "high").otherwise("medium")
    return bad.select(*KEYS, F.lit("timestamp_interval").alias("issue_type"), label.alias("severity"), F.col("frame").alias("frame_start"), F.col("_to").alias("frame_end"), F.col("_diff").alias("diff"), "expected")


def v1_spikes(df: DataFrame, value: str, floor: float = 0.25, mads: float = 12.0, column: str = "state") -> DataFrame:
    """Second differences over max(median + 12 deviations, floor), located at the middle row."""
    w = Window.partitionBy(*KEYS)
    mid = lambda x: F.percentile(F.when(finite(x), F.col(x)), F.lit(0.5)).over(w)
    d = df.withColumn("_m", mid(value)).withColumn("_dev", F.abs(F.col(value) - F.col("_m"))).withColumn("_mad", mid("_dev"))
    before = F.lag("frame").over(ordered(KEYS, "seq"))
    d = d.withColumn("_limit", F.greatest(F.col("_m") + mads * F.col("_mad"), F.lit(floor))).withColumn("_at", before)
    return d.where(finite(value) & (F.col(value) > F.col("_limit"))).select(*KEYS, F.lit(f"{column}_continuity_spike").alias("issue_type"), F.lit("medium").alias("severity"), F.col("_at").alias("frame_start"), F.col("_at").alias("frame_end"), F.col(value).alias("value"), F.col("_limit").alias("threshold"))


def v1_sync(lags: DataFrame, least: float = 0.75) -> DataFrame:
    """(episode, sync_score): 20 less 5 for a weak correlation and 5 for a lag other than -1 or 0."""
    weak = F.when(F.coalesce(F.col("best_correlation") < least, F.lit(True)), 5.0).otherwise(0.0)
    late = F.when(F.col("best_lag").isNotNull() & ~F.col("best_lag").isin(-1, 0), 5.0).otherwise(0.0)
    return lags.withColumn("sync_score", 20.0 - weak - late)


def v1_images(images: DataFrame, height: int, width: int, min_run: int = 8) -> DataFrame:
    """(episode, task, view, issue_type, severity, frame_start, frame_end) of the first generation's image rules."""
    shape = (F.col("height") != height) | (F.col("width") != width)
    issue = F.when(~F.col("decoded"), "image_decode_error").when(shape, "invalid_image_shape").otherwise(first_quality_issue())
    label = F.when(F.col("issue_type").isin("image_decode_error", "invalid_image_shape"), "critical").when(F.col("issue_type") == "severe_blur", "medium").otherwise("high")
    one = images.withColumn("issue_type", issue).where("issue_type is not null").select(*KEYS, "view", "issue_type", label.alias("severity"), F.col("frame").alias("frame_start"), F.col("frame").alias("frame_end"))
    ends = F.min_by("frame", "seq").alias("frame_start"), F.max_by("frame", "seq").alias("frame_end")
    runs = equal_runs(images.where("decoded"), [*KEYS, "view"], "seq", "pixel_hash", *ends).where(F.col("n") >= min_run)
    return one.unionByName(runs.select(*KEYS, "view", F.lit("frozen_frame_run").alias("issue_type"), F.lit("medium").alias("severity"), "frame_start", "frame_end"))
