"""Signals of ordered rows: differences, phases, arm motion, oscillation, distance drift.

Rows are ordered by a dense 0-based ``seq`` within ``keys`` (see ``numbered``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framegauge.functions import vectors as V
from framegauge.functions.scalars import EPS, finite, lower_threshold, upper_threshold
from framegauge.functions.taxonomy import ARMS


def ordered(keys: list[str], *by: str | Column):
    return Window.partitionBy(*keys).orderBy(*by)


def numbered(df: DataFrame, keys: list[str], *by: str | Column, name: str = "seq") -> DataFrame:
    """``df`` with the 0-based place of each row; ``by`` must be a total order."""
    return df.withColumn(name, (F.row_number().over(ordered(keys, *by)) - 1).cast("long"))


def scalar_delta(df: DataFrame, keys: list[str], value: str, name: str = "delta", seq: str = "seq") -> DataFrame:
    """|x[t] - x[t-1]|, null in the first row."""
    return df.withColumn(name, F.abs(F.col(value) - F.lag(value).over(ordered(keys, seq))))


def scalar_accel(df: DataFrame, keys: list[str], value: str, name: str = "accel", seq: str = "seq") -> DataFrame:
    """|x[t] - 2 x[t-1] + x[t-2]|, null in the first two rows."""
    w = ordered(keys, seq)
    return df.withColumn(name, F.abs(F.col(value) - 2 * F.lag(value).over(w) + F.lag(value, 2).over(w)))


def vector_delta(df: DataFrame, keys: list[str], vector: str, name: str = "delta", seq: str = "seq") -> DataFrame:
    """Norm of the first difference, null in the first row."""
    before = F.lag(vector).over(ordered(keys, seq))
    return df.withColumn("_before", before).withColumn(name, F.when(F.col("_before").isNotNull(), V.norm(V.minus(F.col(vector), F.col("_before"))))).drop("_before")


def vector_accel(df: DataFrame, keys: list[str], vector: str, name: str = "accel", seq: str = "seq") -> DataFrame:
    """Norm of the second difference, null in the first two rows."""
    w = ordered(keys, seq)
    d = df.withColumns({"_b1": F.lag(vector).over(w), "_b2": F.lag(vector, 2).over(w)})
    second = V.minus(V.minus(F.col(vector), F.col("_b1")), V.minus(F.col("_b1"), F.col("_b2")))
    return d.withColumn(name, F.when(F.col("_b2").isNotNull(), V.norm(second))).drop("_b1", "_b2")


def phase_labels(df: DataFrame, keys: list[str], value: str = "delta", s: str = "s", seq: str = "seq", quiet: tuple[str, float] = ("p05", 0.5), active: tuple[str, float, float] = ("p95", 0.65, 2.5), margin: float = 1.05, least: int = 8) -> DataFrame:
    """Adds phase (start, active, end or unknown) and phase_status.

    The active phase runs from the first to the last transition at or above the active threshold of the statistics
    in the struct column ``s``; it takes ``least`` such transitions and that many rows."""
    w = Window.partitionBy(*keys)
    low, high = lower_threshold(F.col(s), *quiet), upper_threshold(F.col(s), *active, margin)
    d = df.withColumns({"_low": low, "_high": high})
    hit = finite(value) & (F.col(value) >= F.col("_high"))
    d = d.withColumns({"_first": F.min(F.when(hit, F.col(seq))).over(w), "_last": F.max(F.when(hit, F.col(seq))).over(w), "_hits": F.count(F.when(hit, 1)).over(w)})
    status = F.when(F.col("_low").isNull() | F.col("_high").isNull() | (F.col("_high") <= F.col("_low")), "reference_phase_baseline_missing")
    status = status.when(F.col("_hits") < least, "reference_active_window_missing").when(F.col("_last") - F.col("_first") + 1 < least, "active_window_too_short").otherwise("ok")
    d = d.withColumn("phase_status", status)
    phase = F.when(F.col("phase_status") != "ok", "unknown").when(F.col(seq) < F.col("_first"), "start").when(F.col(seq) <= F.col("_last"), "active").otherwise("end")
    return d.withColumn("phase", phase).drop("_low", "_high", "_first", "_last", "_hits")


def phase_segments(df: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """First and last transition and their number per phase."""
    return df.where("phase <> 'unknown'").groupBy(*keys, "phase").agg(F.min(seq).alias("transition_start"), F.max(seq).alias("transition_end"), F.count("*").alias("transition_count"))


def arm_features(df: DataFrame, keys: list[str], state: str = "state", seq: str = "seq", fps: float = 10.0, layout: str = "columns", min_norm: float = 1e-4, min_sin: float = 1e-3) -> DataFrame:
    """A row per row and arm: position, rotation check and matrix, step, speed, accel, omega, grip.

    Transition values stand in the later row; the state is an array of 20 doubles."""
    arms = F.explode(F.array(*(F.struct(F.lit(a).alias("arm"), V.part(state, *p["pos"]).alias("pos"), V.part(state, *p["rot"]).alias("rot"), F.element_at(state, p["grip"][0]).alias("grip")) for a, p in ARMS.items())))
    d = df.select(*keys, seq, *(c for c in df.columns if c not in (*keys, seq, state)), arms.alias("_a")).select("*", "_a.*").drop("_a")
    d = d.withColumn("check", V.rotation_check(F.col("rot"), min_norm, min_sin)).withColumn("matrix", F.when(F.col("check")["legal"], V.rotation_matrix(F.col("rot"), layout)))
    k = [*keys, "arm"]
    d = vector_accel(vector_delta(d, k, "pos", "step", seq), k, "pos", "_second", seq)
    d = d.withColumn("_turn", F.lag("matrix").over(ordered(k, seq)))
    return d.withColumns({"speed": F.col("step") * fps, "accel": F.col("_second") * fps * fps, "omega": F.when(F.col("matrix").isNotNull() & F.col("_turn").isNotNull(), V.rotation_distance(F.col("_turn"), F.col("matrix")) * fps)}).drop("_second", "_turn")


def bimanual(df: DataFrame, keys: list[str], state: str = "state", seq: str = "seq", layout: str = "columns") -> DataFrame:
    """Distance between the arms, the right arm's pose in the left one's frame, and the distance's drift."""
    part = lambda arm, what: V.part(state, *ARMS[arm][what])
    d = df.withColumn("distance", V.norm(V.minus(part("right", "pos"), part("left", "pos"))))
    left, right = V.rotation_matrix(part("left", "rot"), layout), V.rotation_matrix(part("right", "rot"), layout)
    d = d.withColumns({"_l": left, "_r": right}).withColumn("relative", F.when(F.col("_l").isNotNull() & F.col("_r").isNotNull(), V.relative_pose(part("left", "pos"), F.col("_l"), part("right", "pos"), F.col("_r")))).drop("_l", "_r")
    return distance_drift(d, keys)


def distance_drift(df: DataFrame, keys: list[str], value: str = "distance", name: str = "drift") -> DataFrame:
    """|x - median of x| within the keys."""
    mid = F.percentile(F.when(finite(value), F.col(value)), F.lit(0.5)).over(Window.partitionBy(*keys))
    return df.withColumn(name, F.abs(F.col(value) - mid))


def oscillation_windows(df: DataFrame, keys: list[str], pos: str = "pos", seq: str = "seq", window: int = 11, reversals: int = 3, efficiency: float = 0.35, min_path: str | Column | None = None, factor: float = 4.0) -> DataFrame:
    """Windows of rows that move back and forth (W18): keys, start, path_length, net_displacement, path_efficiency, direction_reversals.

    A reversal is a turn with a cosine under -0.25. Without ``min_path`` it is the median step times window and factor."""
    window = max(11, window)
    w = ordered(keys, seq)
    d = df.withColumn("_d", V.minus(F.col(pos), F.lag(pos).over(w))).withColumn("_step", V.norm(F.col("_d")))
    cos = V.dot(F.col("_d"), F.col("_d0")) / (F.greatest(F.col("_step"), F.lit(EPS)) * F.greatest(F.col("_s0"), F.lit(EPS)))
    d = d.withColumns({"_d0": F.lag("_d").over(w), "_s0": F.lag("_step").over(w)}).withColumn("_turn", F.when(cos < -0.25, 1).otherwise(0))
    if min_path is None:
        typical = F.percentile(F.when(finite("_step"), F.col("_step")), F.lit(0.5)).over(Window.partitionBy(*keys))
        d, min_path = d.withColumn("_least", F.greatest(F.lit(EPS), F.coalesce(typical, F.lit(0.0)) * window * factor)), F.col("_least")
    steps, turns = w.rowsBetween(-(window - 2), 0), w.rowsBetween(-(window - 3), 0)
    d = d.withColumns({"_n": F.count(F.when(finite("_step"), 1)).over(steps), "path_length": F.sum("_step").over(steps), "direction_reversals": F.sum("_turn").over(turns), "_from": F.lag(pos, window - 1).over(w), "min_path_length": F.lit(min_path) if isinstance(min_path, (int, float)) else F.col(min_path) if isinstance(min_path, str) else min_path})
    d = d.where(F.col("_from").isNotNull() & (F.col("_n") == window - 1))
    d = d.withColumn("net_displacement", V.norm(V.minus(F.col(pos), F.col("_from")))).withColumn("path_efficiency", F.col("net_displacement") / F.greatest(F.col("path_length"), F.lit(EPS)))
    ok = (F.col("path_length") >= F.col("min_path_length")) & (F.col("direction_reversals") >= reversals) & (F.col("path_efficiency") <= efficiency)
    return d.where(ok).select(*keys, (F.col(seq) - (window - 1)).alias("start"), "path_length", "net_displacement", "path_efficiency", "direction_reversals", "min_path_length")


def positional_zip(a: DataFrame, b: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """Two series side by side by place; the longer one's rest is cut off."""
    return a.join(b, [*keys, seq])


def non_finite_counts(df: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """How many elements are NaN and how many infinite."""
    n = lambda test: F.sum(V.count_where(vector, test)).cast("long")
    return df.groupBy(*keys).agg(n(F.isnan).alias("nan_count"), n(lambda x: F.abs(x) == float("inf")).alias("inf_count"))
