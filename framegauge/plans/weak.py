"""Weak spatial checks (P1): how an episode's arms and its main view move together, against reference buckets.

``moves`` has a row per transition: episode, task, seq, frame, left, right (the arms' speeds), state (the larger of both)
and visual (the main view's motion). Buckets are named by ``bucket_key``; their statistics are one small table, from
which a threshold is looked up with a default of the episode's own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framegauge.functions import vectors as V
from framegauge.functions.scalars import bucket_key, finite
from framegauge.functions.storage import written
from framegauge.operators import detectors as D
from framegauge.operators import geometry, lag, signals, vision
from framegauge.operators.findings import union_findings, with_ids
from framegauge.operators.statistics import FIELDS, robust_stats, threshold_or
from framegauge.plans.pipeline import KEYS, Config, Features, features

COUPLING = ["best_abs_correlation", "state_active_visual_quiet_fraction", "visual_active_state_quiet_fraction"]
DRIFT, MOTION, AREA, VALID = ("global|" + x for x in ("bimanual|distance_drift", "main_camera|background_motion", "main_camera|panel_area", "main_camera|panel_valid_fraction"))


def moves(f: Features, main: str) -> DataFrame:
    """Both arms' speeds beside the main view's motion, by place."""
    by = f.arms.groupBy(*KEYS, "seq").agg(F.max("frame").alias("frame"), *(F.max(F.when(F.col("arm") == a, F.col(c))).alias(n) for a in ("left", "right") for c, n in (("speed", a), ("omega", f"{a}_omega"))))
    by = by.withColumn("state", F.greatest("left", "right"))
    return by.join(f.images.where(F.col("view") == main).select("episode", "seq", F.col("motion").alias("visual")), ["episode", "seq"]).where("state is not null or visual is not null")


def coupled(m: DataFrame, max_lag: int = 5) -> DataFrame:
    """W22 by episode."""
    return lag.coupling(m, KEYS, max_lag=max_lag)


def buckets(m: DataFrame, couplings: DataFrame, panel: DataFrame | None = None, panels: DataFrame | None = None, repeats: DataFrame | None = None, overlaps: DataFrame | None = None, drift: DataFrame | None = None) -> DataFrame:
    """``(bucket, value)`` of everything that a reference is made of; parts that aren't there have no bucket."""
    long = lambda d, first, names: d.select(F.explode(F.array(*(F.struct(bucket_key("global", first, n).alias("bucket"), F.col(c).cast("double").alias("value")) for c, n in names.items()))).alias("_b")).select("_b.*")
    out = [long(m, "main_camera", {"visual": "background_motion"}), long(couplings.where("status = 'ok'"), "state_visual_motion_coupling", {c: c for c in COUPLING})]
    for a in ("left", "right"):
        out.append(long(m, a, {a: "speed"} | ({f"{a}_omega": "omega"} if f"{a}_omega" in m.columns else {})))
    if panel is not None:
        out.append(long(panel, "main_camera", {c: c for c in ("panel_area", "panel_center_delta") if c in panel.columns}))
    if panels is not None:
        out.append(long(panels.where("status = 'ok'"), "main_camera", {"valid_fraction": "panel_valid_fraction"}))
    if repeats is not None:
        out.append(long(repeats, "main_camera", {"duplicate_fraction": "duplicate_frame_fraction"}))
    if overlaps is not None:
        pair = F.concat_ws("->", "view_a", "view_b")
        out.append(overlaps.where("status = 'ok'").select(bucket_key("global", pair, "ok_fraction").alias("bucket"), F.col("ok_fraction").alias("value")))
    if drift is not None:
        out.append(long(drift, "bimanual", {"drift": "distance_drift"}))
    all_ = out[0]
    for d in out[1:]:
        all_ = all_.union(d)
    return all_


def bucket_stats(values: DataFrame) -> DataFrame:
    """``(bucket, FIELDS)``; a handful of rows."""
    return robust_stats(values, ["bucket"], "value")


def beside(df: DataFrame, stats: DataFrame, **names: str) -> DataFrame:
    """``df`` with a struct of statistics per name: one row of looked-up buckets, null where a bucket is missing."""
    row = stats.agg(*(F.max(F.when(F.col("bucket") == b, F.struct(*FIELDS))).alias(n) for n, b in names.items()))
    return df.crossJoin(F.broadcast(row))  # a single row


def own_quantile(value: str, p: float) -> Column:
    return F.percentile(F.when(finite(value), F.col(value)), F.lit(p)).over(Window.partitionBy(*KEYS))


def freezes(m: DataFrame, stats: DataFrame, min_run: int = 11) -> DataFrame:
    """Speed over the reference's 95 % quantile (of the arm with more values) while motion is under its 5 % one; a
    missing bucket gives way to the episode's own 90 % and 10 % quantiles."""
    d = beside(m, stats, _left="global|left|speed", _right="global|right|speed", _motion=MOTION)
    d = d.withColumn("_arm", F.when(F.coalesce(F.col("_left.count"), F.lit(0)) >= F.coalesce(F.col("_right.count"), F.lit(0)), F.col("_left")).otherwise(F.col("_right")))
    d = d.withColumns({"_hi": threshold_or(F.col("_arm"), F.col("_arm.p95"), own_quantile("state", 0.9)), "_lo": threshold_or(F.col("_motion"), F.col("_motion.p05"), own_quantile("visual", 0.1))})
    return D.camera_freeze(d, "state", "visual", F.col("_hi"), F.col("_lo"), min_run)


def unstable_panels(panel: DataFrame, panels: DataFrame, stats: DataFrame, min_run: int = 11) -> DataFrame:
    """A panel that is valid often enough, over rows where its area is under the reference's 5 % quantile."""
    d = beside(panel.join(panels.select("episode", "view", "valid_fraction"), ["episode", "view"]), stats, _area=AREA, _valid=VALID)
    return D.panel_unstable(d, "panel_area", threshold_or(F.col("_area"), F.col("_area.p05"), F.lit(None)), "valid_fraction", threshold_or(F.col("_valid"), F.col("_valid.p05"), F.lit(0.0)), min_run)


def candidates(m: DataFrame, couplings: DataFrame, stats: DataFrame, min_run: int = 11, panel: DataFrame | None = None, panels: DataFrame | None = None, drift: DataFrame | None = None) -> DataFrame:
    """Every weak finding, D33 to D37; its confidence is weak, of frozen cameras supported."""
    ok = couplings.where("status = 'ok'")
    out = [D.decoupled(beside(ok, stats, s=bucket_name("state_visual_motion_coupling", COUPLING[0]))), freezes(m, stats, min_run)]
    out += [D.activity_mismatch(beside(ok, stats, s=bucket_name("state_visual_motion_coupling", c)), c) for c in COUPLING[1:]]
    if panel is not None and panels is not None:
        out.append(unstable_panels(panel, panels, stats, min_run))
    if drift is not None:
        out.append(D.distance_drifts(beside(drift, stats, s=DRIFT), min_run=min_run, floor=45.0, issue="p1_bimanual_rigidity_drift_candidate"))
    found = union_findings(out)
    found = found.withColumn("confidence", F.when(F.col("issue_type") == "p1_main_camera_freeze_candidate", "supported").otherwise("weak"))
    return with_ids(found, "P1F")


def bucket_name(*parts: str) -> str:
    return "|".join(("global", *parts))


def episode_summary(episodes: DataFrame, found: DataFrame, couplings: DataFrame, panels: DataFrame | None = None, overlaps: DataFrame | None = None) -> DataFrame:
    """A row per episode: findings, comparable pairs of views, panel and coupling; without a core (``core_status``) unavailable."""
    n = found.groupBy("episode").agg(F.count("*").alias("finding_count"))
    d = episodes.join(n, "episode", "left").join(couplings.select("episode", F.col("status").alias("motion_coupling_status"), "best_lag", *COUPLING), "episode", "left")
    if panels is not None:
        d = d.join(panels.groupBy("episode").agg(F.max("valid_fraction").alias("panel_valid_fraction")), "episode", "left")
    if overlaps is not None:
        d = d.join(overlaps.groupBy("episode").agg(F.count(F.when(F.col("status") == "ok", 1)).alias("comparable_pair_count")), "episode", "left")
    return d.withColumns({"finding_count": F.coalesce("finding_count", F.lit(0)), "motion_coupling_status": F.coalesce("motion_coupling_status", F.lit("unavailable")), "status": F.when(F.col("core_status") == "ok", "ok").otherwise("unavailable")})


def signals_of(frames: DataFrame, cfg: Config) -> dict[str, DataFrame | None]:
    """Everything that both the reference and the inspection read, by the names of ``buckets``."""
    main = cfg.views[0]
    f = features(frames, cfg)
    m = written(moves(f, main), "moves")
    images = f.images.where(F.col("view") == main)
    drift = None
    if cfg.state_frame_mode == "common_world":
        wide = frames.select(*KEYS, "seq", "frame", V.doubles("state").alias("state")).where(F.size("state") >= 20)
        drift = written(signals.bimanual(wide, KEYS, layout=cfg.rotation_layout), "drift")
    return {
        "m": m, "couplings": written(coupled(m, cfg.max_lag), "couplings"), "panel": vision.panel_jumps(images), "panels": written(vision.panel_summary(images), "panels"),
        "repeats": vision.duplicate_fraction(images), "overlaps": written(vision.overlap_gates(f.images), "overlaps") if len(cfg.views) > 1 else None, "drift": drift,
    }


def fit(frames: DataFrame, cfg: Config) -> DataFrame:
    """The reference's buckets; episodes whose states can't be read or aren't finite don't count."""
    unfit = written(geometry.unfit_for_reference(frames), "unfit")
    return written(bucket_stats(buckets(**signals_of(frames.join(unfit, "episode", "left_anti"), cfg))), "weak-reference")


def readable(frames: DataFrame) -> DataFrame:
    """The rows of episodes with a usable core (see ``core_statuses``). The list of the others is written first, so that the
    engine knows its size; as a rule it is empty, and no image is shuffled."""
    unusable = written(geometry.core_statuses(frames).where("core_status <> 'ok'").select("episode"), "unusable")
    return frames.join(unusable, "episode", "left_anti")


def inspect(frames: DataFrame, stats: DataFrame, cfg: Config) -> tuple[DataFrame, DataFrame]:
    """The weak findings and a row per episode."""
    s = signals_of(readable(frames), cfg)
    found = written(candidates(s["m"], s["couplings"], stats, cfg.min_run, s["panel"], s["panels"], s["drift"]), "weak-findings")
    return found, episode_summary(geometry.core_statuses(frames), found, s["couplings"], s["panels"], s["overlaps"])


def run(target: DataFrame, reference: DataFrame, cfg: Config) -> tuple[DataFrame, DataFrame]:
    """Calibrates on one set of frames and inspects another."""
    cfg = cfg.checked()
    return inspect(target, fit(reference, cfg), cfg)
