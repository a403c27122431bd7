"""The whole quality run: calibrate on reference episodes, inspect target episodes, merge, score.

Everything is one lazy plan over all episodes; there is no loop over files. Features that several detectors read
(decoded images above all) are written once to the shared folder."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framegauge.functions import vectors as V
from framegauge.functions.scalars import finite, freeze_severity, lower_tail_pressure, two_sided_tail_pressure, upper_tail_pressure
from framegauge.functions.storage import written
from framegauge.functions.taxonomy import INDEX_COLUMNS, LOW_DIM, VIEWS
from framegauge.operators import detectors as D
from framegauge.operators import geometry, lag, scoring, signals, vision
from framegauge.operators.findings import merged, union_findings, with_ids
from framegauge.operators.islands import islands
from framegauge.operators.statistics import scoped_stats, with_baseline, with_baselines, with_phase_baseline

METRICS = ["mean", "std", "sharpness", "black_fraction", "white_fraction", "entropy"]
#: What a reference knows about each arm: name -> column of ``signals.arm_features``.
ARM_METRICS = {"position_step": "step", "linear_speed": "speed", "linear_accel": "accel", "angular_speed": "omega", "rot6d_n1": "check.n1", "rot6d_n2": "check.n2", "rot6d_sin_angle": "check.sin_angle"}
KEYS = ["episode", "task"]


@dataclass(frozen=True)
class Config:
    """Settings of a run; ``checked`` clamps numbers and refuses names outside their enum."""

    fps: float = 10.0
    views: tuple[str, ...] = tuple(VIEWS)
    height: int = 224
    width: int = 224
    low_dim_width: int = 20
    state_frame_mode: str = "unknown"
    rotation_layout: str = "unknown"
    min_norm: float = 1e-4
    min_sin: float = 1e-3
    jitter_window: int = 11
    jitter_reversals: int = 3
    jitter_efficiency: float = 0.35
    jitter_path_factor: float = 4.0
    max_lag: int = 5
    lag_window: int = 21
    lag_step: int = 5
    active_margin: float = 1.05
    min_run: int = 11
    min_severity: float = 55.0
    hardware_limits: dict[str, float] = field(default_factory=dict)

    def checked(self) -> Config:
        if self.state_frame_mode not in ("unknown", "common_world", "per_arm_base"):
            raise ValueError(f"state_frame_mode {self.state_frame_mode}")
        if self.rotation_layout not in ("unknown", "columns", "rows"):
            raise ValueError(f"rotation_layout {self.rotation_layout}")
        if any(v <= 0 for v in self.hardware_limits.values()):
            raise ValueError("hardware limits must be positive")
        return replace(self, jitter_window=max(11, self.jitter_window), lag_window=max(11, self.lag_window), lag_step=max(1, self.lag_step), jitter_efficiency=min(0.95, max(0.05, self.jitter_efficiency)), jitter_path_factor=max(1.0, self.jitter_path_factor))


@dataclass
class Features:
    """What detectors read: images, low-dimensional signals by column, arms."""

    images: DataFrame | None
    low: DataFrame
    arms: DataFrame | None


def low_dim(frames: DataFrame, columns: list[str]) -> DataFrame:
    """A row per row and low-dimensional column: vec, delta, accel."""
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), V.doubles(c).alias("vec")) for c in columns)))
    d = frames.select(*KEYS, "seq", "frame", cells.alias("_c")).select(*KEYS, "seq", "frame", "_c.*")
    k = [*KEYS, "column"]
    d = D.with_before(d, ["column"])
    return signals.vector_accel(signals.vector_delta(d, k, "vec"), k, "vec")


def features(frames: DataFrame, cfg: Config) -> Features:
    views = [v for v in cfg.views if v in frames.columns]
    images = None
    if views:
        images = vision.visual_motion(written(vision.image_features(frames, views), "features"))
        images = written(signals.scalar_delta(images, [*KEYS, "view"], "motion", "motion_accel"), "motions")
    columns = [c for c in LOW_DIM if c in frames.columns]
    arms = None
    if "state" in columns:
        wide = frames.select(*KEYS, "seq", "frame", V.doubles("state").alias("state")).where(F.size("state") >= 20)
        arms = written(signals.arm_features(wide, KEYS, "state", fps=cfg.fps, layout=cfg.rotation_layout, min_norm=cfg.min_norm, min_sin=cfg.min_sin), "arms")
    return Features(images, written(low_dim(frames, columns), "low"), arms)


def fit_reference(frames: DataFrame, cfg: Config) -> dict[str, DataFrame]:
    """Two-level statistics of every signal; a table per section. Images of another shape than declared don't count."""
    f = features(frames, cfg)
    out = {}
    if f.images is not None:
        good = f.images.where(F.col("decoded") & (F.col("height") == cfg.height) & (F.col("width") == cfg.width))
        long = good.select(*KEYS, "view", F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRICS))).alias("_m")).select(*KEYS, "view", "_m.*")
        out["image_metrics"] = scoped_stats(long, ["view", "metric"], "task", "value")
        out["image_motion"] = scoped_stats(f.images, ["view"], "task", "motion")
        out["image_accel"] = scoped_stats(f.images, ["view"], "task", "motion_accel")
    out["delta"] = scoped_stats(f.low, ["column"], "task", "delta")
    out["accel"] = scoped_stats(f.low, ["column"], "task", "accel")
    values = f.low.where("column = 'state'").select(*KEYS, "column", F.explode("vec").alias("value"))
    out["values"] = scoped_stats(values, ["column"], "task", "value")
    out = {k: written(v, k) for k, v in out.items()}
    phased = with_phases(f.low, out["delta"], cfg)
    out["phase_delta"] = written(scoped_stats(phased, ["column", "phase"], "task", "delta"), "phase_delta")
    out["phase_accel"] = written(scoped_stats(phased, ["column", "phase"], "task", "accel"), "phase_accel")
    if f.arms is None:
        return out
    unfit = written(geometry.unfit_for_reference(frames), "unfit")
    out["arms"] = written(scoped_stats(arm_values(f.arms.join(unfit, "episode", "left_anti")), ["arm", "metric"], "task", "value"), "arm-statistics")
    if cfg.state_frame_mode == "common_world":
        wide = frames.select(*KEYS, "seq", "frame", V.doubles("state").alias("state")).where(F.size("state") >= 20).join(unfit, "episode", "left_anti")
        both = signals.bimanual(wide, KEYS, layout=cfg.rotation_layout)
        out["drift"] = written(scoped_stats(both, [], "task", "drift"), "drift")
        out["distance"] = written(scoped_stats(both, [], "task", "distance"), "distance")
    return out


def arm_values(arms: DataFrame) -> DataFrame:
    """A row per row, arm and metric with a finite value."""
    long = arms.select(*KEYS, "arm", F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(c).alias("value")) for m, c in ARM_METRICS.items()))).alias("_m"))
    return long.select(*KEYS, "arm", "_m.*").where(finite("value"))


def with_phases(low: DataFrame, delta_stats: DataFrame, cfg: Config) -> DataFrame:
    """The state's transitions with their phase."""
    d = with_baseline(low.where("column = 'state' and delta is not null"), delta_stats, ["column"], "task")
    return signals.phase_labels(d, KEYS, margin=cfg.active_margin).drop("s")


def inspect_indices(frames: DataFrame, cfg: Config) -> list[DataFrame]:
    """X3."""
    have = [c for c in INDEX_COLUMNS if c in frames.columns]
    d = frames.select(*KEYS, "seq", "frame", *(F.col(c).cast("double").alias(c) for c in have))
    out = [D.non_finite(d, c) for c in have]
    if "frame_index" in have:
        out.append(D.index_steps(d))
    if "index" in have:
        out.append(D.global_index_steps(d))
    if "timestamp" in have:
        out.append(D.timestamp_steps(d, fps=cfg.fps))
    return out + [D.inconsistent(d, c, f"{c}_inconsistent") for c in ("episode_index", "task_index") if c in have]


def inspect_images(f: Features, base: dict[str, DataFrame], cfg: Config) -> list[DataFrame]:
    """X4, X5."""
    images = f.images
    names = {m: f"s_{m}" for m in [*METRICS[:3], "entropy"]}
    d = with_baselines(images.where("decoded"), base["image_metrics"], ["view"], "task", "metric", names)
    stats = {m: F.col(n) for m, n in names.items()}
    t = with_baseline(with_baseline(images, base["image_motion"], ["view"], "task", "sm"), base["image_accel"], ["view"], "task", "sa")
    low = D.static_threshold(F.col("sm"))
    v = ["view"]
    return [
        D.image_legality(images, cfg.height, cfg.width),
        D.image_quality(d, stats),
        D.exact_repeats(images.where("decoded"), "pixel_hash", v, cfg.min_run, cfg.min_severity),
        D.freeze_runs(t.where("sm is not null"), "motion", low, v, "vision_temporal", "low_motion_freeze_run", "vision", cfg.min_run, cfg.min_severity),
        D.fast_jumps(t, "motion", "sm", v, "vision_temporal", "visual_fast_jump", "vision"),
        D.jitter_clusters(t, "motion_accel", "sa", v, "vision_temporal", "visual_high_frequency_jitter", "vision", vision=True),
    ]


def inspect_low_dim(frames: DataFrame, f: Features, base: dict[str, DataFrame], cfg: Config) -> list[DataFrame]:
    """X6, X7."""
    out = []
    for c in (c for c in LOW_DIM if c in frames.columns):
        d = frames.select(*KEYS, "seq", "frame", V.doubles(c).alias("vec"))
        out += [D.vector_widths(d, "vec", cfg.low_dim_width, c), D.non_finite_vectors(d, "vec", c), D.impossible_magnitudes(d, "vec", c)]
    state = f.low.where("column = 'state'")
    out.append(D.value_outliers(with_baseline(state, base["values"], ["column"], "task"), "vec"))
    phased = with_phases(f.low, base["delta"], cfg).withColumn("phase", F.when(F.col("phase") == "unknown", "active").otherwise(F.col("phase")))
    actions = f.low.where("column <> 'state' and delta is not null").withColumns({"phase": F.lit("active"), "phase_status": F.lit("ok")})
    both = phased.unionByName(actions.select(phased.columns))
    d = with_phase_baseline(both, base["phase_delta"], base["delta"], ["column"], "task", name="sd")
    d = with_phase_baseline(with_baseline(d, base["delta"], ["column"], "task", "su"), base["phase_accel"], base["accel"], ["column"], "task", name="sa")
    parts = ["column", "phase"]
    out.append(D.freeze_runs(d, "delta", D.low_dim_low_threshold(F.col("sd"), F.col("su")), parts, min_run=cfg.min_run, min_severity=cfg.min_severity))
    out.append(D.fast_jumps(d, "delta", "sd", parts))
    out.append(D.jitter_clusters(d, "accel", "sa", parts))
    return out


def inspect_geometry(frames: DataFrame, f: Features, base: dict[str, DataFrame], cfg: Config) -> list[DataFrame]:
    """The distance of the arms needs a common world frame, wrist views few equal frames."""
    if f.arms is None:
        return []
    rows = frames.groupBy(*KEYS).agg(F.count("*").alias("rows"))
    k = [*KEYS, "arm"]
    windows = signals.oscillation_windows(f.arms, k, window=cfg.jitter_window, reversals=cfg.jitter_reversals, efficiency=cfg.jitter_efficiency, factor=cfg.jitter_path_factor)
    out = [D.degenerate_rotations(f.arms), D.oscillations(windows, rows, cfg.jitter_window, cfg.jitter_reversals)]
    out += [D.hardware_limits(f.arms, m, v) for m, v in cfg.hardware_limits.items()]
    if "drift" in base:
        wide = frames.select(*KEYS, "seq", "frame", V.doubles("state").alias("state")).where(F.size("state") >= 20)
        drift = signals.bimanual(wide, KEYS, layout=cfg.rotation_layout)
        out.append(D.distance_drifts(with_baseline(drift, base["drift"], [], "task")))
    if f.images is not None:
        moves = wrist_moves(f, cfg)
        out.append(D.coincidences(moves, "speed", "motion", ["view"], "vision_state_vision", "geometry_wrist_state_moves_visual_static", min_run=cfg.min_run))
        out.append(D.coincidences(moves, "motion", "speed", ["view"], "state_vision_state", "geometry_wrist_visual_moves_state_static", min_run=cfg.min_run))
    return out


def wrist_moves(f: Features, cfg: Config) -> DataFrame:
    """An arm's speed beside its wrist view's motion, where the view is usable and both have enough values, with the
    answer of the lag gate (W21), which is evidence and rejects nothing."""
    view = F.when(F.col("arm") == "left", geometry.WRIST_VIEWS["left"]).otherwise(geometry.WRIST_VIEWS["right"])
    moves = f.arms.select(*KEYS, "seq", "frame", "speed", view.alias("view")).join(f.images.select("episode", "view", "seq", "motion"), ["episode", "view", "seq"])
    usable = geometry.view_statuses(f.images).where("status = 'ok'").select("episode", "view")
    moves = written(moves.where("speed is not null and motion is not null").join(usable, ["episode", "view"], "left_semi"), "moves")
    many = moves.groupBy("episode", "view").agg(F.count(F.when(finite("speed"), 1)).alias("_s"), F.count(F.when(finite("motion"), 1)).alias("_m"))
    gate = lag.identifiable_lag(moves, ["episode", "view"], cfg.max_lag, cfg.lag_window, cfg.lag_step, a="motion", b="speed")
    many = many.where((F.col("_s") >= cfg.min_run) & (F.col("_m") >= cfg.min_run)).join(gate.select("episode", "view", F.col("identifiable").alias("lag_gate"), F.col("best_lag").alias("lag")), ["episode", "view"], "left")
    return moves.join(many.drop("_s", "_m"), ["episode", "view"])


def pressures(f: Features, base: dict[str, DataFrame]) -> DataFrame:
    """Soft pressures of an episode against the reference: (episode, dimension, pressure)."""
    out = []

    def longest_static(d: DataFrame, parts: list[str]) -> DataFrame:
        runs = islands(d.where(finite("_v") & (F.col("_v") <= F.col("_low"))), ["episode", *parts], "seq", 1).groupBy("episode", *parts).agg(F.max(F.col("end") - F.col("start") + 1).alias("run"))
        return runs.select("episode", F.lit("temporal").alias("dimension"), F.least(F.lit(1.0), freeze_severity("run") / 55).alias("pressure"))

    def peak(d: DataFrame, value: str, s: str, parts: list[str], weight: float) -> DataFrame:
        g = d.groupBy("episode", *parts).agg(F.max(F.when(finite(value), F.col(value))).alias("v"), F.first(s).alias("s"))
        return g.select("episode", F.lit("temporal").alias("dimension"), (weight * upper_tail_pressure("v", F.col("s"), "p99")).alias("pressure"))

    if f.images is not None:
        points, tests = [], []
        for m in METRICS:
            q = {"mean": 0.5, "black_fraction": 0.95, "white_fraction": 0.95}.get(m, 0.05)
            test = {"mean": two_sided_tail_pressure, "black_fraction": upper_tail_pressure, "white_fraction": upper_tail_pressure}.get(m, lower_tail_pressure)
            points.append(F.percentile(m, F.lit(q)).alias(f"v_{m}"))
            tests.append(F.struct(test(f"v_{m}", F.col(f"s_{m}")).alias("pressure")))
        g = f.images.where("decoded").groupBy(*KEYS, "view").agg(*points)
        g = with_baselines(g, base["image_metrics"], ["view"], "task", "metric", {m: f"s_{m}" for m in METRICS})
        out.append(g.select("episode", F.lit("vision_single").alias("dimension"), F.explode(F.array(*tests)).alias("_t")).select("episode", "dimension", "_t.pressure"))
        t = with_baseline(with_baseline(f.images, base["image_motion"], ["view"], "task", "sm"), base["image_accel"], ["view"], "task", "sa")
        out += [peak(t, "motion", "sm", ["view"], 0.5), peak(t, "motion_accel", "sa", ["view"], 0.75), longest_static(t.withColumns({"_v": F.col("motion"), "_low": D.static_threshold(F.col("sm"))}), ["view"])]
    d = with_baseline(with_baseline(f.low.where("column = 'state'"), base["delta"], ["column"], "task", "sd"), base["accel"], ["column"], "task", "sa")
    out += [peak(d, "delta", "sd", ["column"], 0.5), peak(d, "accel", "sa", ["column"], 0.75), longest_static(d.withColumns({"_v": F.col("delta"), "_low": D.static_threshold(F.col("sd"), "p01", 1e-8)}), ["column"])]
    return union_findings(out)


@dataclass
class Result:
    findings: DataFrame
    scores: DataFrame
    dataset: DataFrame


def inspect(frames: DataFrame, base: dict[str, DataFrame], cfg: Config, episodes: DataFrame | None = None, expected: list[str] | None = None, unread: DataFrame | None = None) -> Result:
    """All findings of all episodes, merged, and the scores."""
    cfg = cfg.checked()
    f = features(frames, cfg)
    rows = frames.groupBy(*KEYS).agg(F.count("*").alias("rows"))
    parts = inspect_indices(frames, cfg) + inspect_low_dim(frames, f, base, cfg) + inspect_geometry(frames, f, base, cfg)
    if f.images is not None:
        parts += inspect_images(f, base, cfg)
    expected = expected if expected is not None else [*cfg.views, *LOW_DIM, *INDEX_COLUMNS]
    parts += D.missing_columns(rows, frames.columns, expected, list(cfg.views))
    known = rows.withColumn("length", F.lit(None).cast("long"))
    if episodes is not None:
        known = rows.join(episodes.select(F.col("episode_index").alias("episode"), "length"), "episode", "full")
        parts.append(D.length_mismatch(known))
    if unread is not None:
        parts.append(D.unreadable_files(unread))
        known = known.join(unread.select("episode").where("episode is not null").distinct(), "episode", "full")
    found = written(merged(with_ids(union_findings(parts))), "findings")
    phases = with_phases(f.low, base["delta"], cfg)
    seg = phases.groupBy("episode").agg(F.first("phase_status").alias("phase_status"), F.count_distinct(F.when(F.col("phase") != "unknown", F.col("phase"))).alias("segments"))
    facts = known.select("episode", "task", F.coalesce("rows", F.lit(0)).alias("length")).join(seg, "episode", "left").withColumn("phase_status", F.coalesce("phase_status", F.lit("unavailable")))
    missing = set(expected) - set(frames.columns)
    statuses = geometry.geometry_statuses(geometry.core_statuses(frames), geometry.view_statuses(f.images) if f.images is not None else None, cfg.state_frame_mode == "common_world")
    facts = facts.withColumns({"missing_state": F.lit(len(missing & set(LOW_DIM))), "missing_views": F.lit(len(missing & set(cfg.views)))}).join(statuses.drop("core_status"), "episode", "left")
    # an episode without rows never came to the geometry: no module is judged
    facts = facts.withColumns({"geometry_status": F.coalesce("geometry_status", F.lit("ok")), "module_statuses": F.coalesce("module_statuses", F.array().cast("array<string>")), "geometry_unavailable": F.coalesce("geometry_unavailable", F.lit(0)), "geometry_fail": F.coalesce("geometry_fail", F.lit(0))})
    soft = scoring.soft_penalties(pressures(f, base), ["episode"])
    scores = written(scoring.episode_scores(facts, found, soft), "scores")
    return Result(found, scores, scoring.dataset_score(scores))


def run(target: str, reference: str, spark, cfg: Config | None = None, allow_same: bool = False) -> Result:
    """Two dataset folders; calibrating and inspecting the same one must be asked for."""
    from framegauge.sources.episodes import load_dataset, unread_files

    if target == reference and not allow_same:
        raise ValueError("target and reference are the same dataset")
    ref, tgt = load_dataset(spark, reference), load_dataset(spark, target)
    shape = tgt.info.get("features", {}).get(tgt.views[0], {}).get("shape") or [224, 224, 3]
    cfg = (cfg or Config(fps=float(tgt.info.get("fps") or 10), views=tuple(tgt.views), height=shape[0], width=shape[1], low_dim_width=tgt.width("state"))).checked()
    base = fit_reference(ref.frames, cfg)
    return inspect(tgt.frames, base, cfg, tgt.episodes, tgt.expected_columns, unread_files(tgt.files, tgt.frames))
