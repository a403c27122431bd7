"""Lagged correlation of two signals ``a`` and ``b`` in rows ordered by ``seq``. A positive lag: ``a`` comes later than ``b``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framegauge.functions.scalars import EPS, finite
from framegauge.operators.statistics import null_safe


def lag_pairs(df: DataFrame, keys: list[str], max_lag: int = 5, a: str = "a", b: str = "b", seq: str = "seq") -> DataFrame:
    """keys, lag, a, b: the value of ``a`` lag rows after each value of ``b``, finite pairs only (J8); one window, no self-join."""
    w = Window.partitionBy(*keys).orderBy(seq)
    shifted = F.array(*(F.struct(F.lit(k).alias("lag"), F.lead(a, k).over(w).alias("a")) for k in range(-max_lag, max_lag + 1)))
    d = df.select(*keys, F.col(b).alias("b"), shifted.alias("_s")).select(*keys, "b", F.explode("_s").alias("_s")).select(*keys, "_s.lag", "_s.a", "b")
    return d.where(finite("a") & finite("b"))


def lag_correlations(df: DataFrame, keys: list[str], max_lag: int = 5, least: int = 8, eps: float = EPS, **cols: str) -> DataFrame:
    """keys, lag, n, r; r only where there are ``least`` pairs and both sides vary."""
    g = lag_pairs(df, keys, max_lag, **cols).groupBy(*keys, "lag").agg(F.count("*").alias("n"), F.covar_pop("a", "b").alias("_ab"), F.stddev_pop("a").alias("_sa"), F.stddev_pop("b").alias("_sb"))
    r = F.when((F.col("n") >= least) & (F.col("_sa") >= eps) & (F.col("_sb") >= eps), F.col("_ab") / (F.col("_sa") * F.col("_sb")))
    return g.withColumn("r", r).where(finite("r")).drop("_ab", "_sa", "_sb")


def excitation(df: DataFrame, keys: list[str], a: str = "a", b: str = "b") -> DataFrame:
    """keys, n_rows, n_valid, and the spread from the 10 % to the 90 % quantile of both signals."""
    spread = lambda x: F.percentile(F.when(finite(x), F.col(x)), F.array(F.lit(0.1), F.lit(0.9)))
    g = df.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.count(F.when(finite(a) & finite(b), 1)).alias("n_valid"), spread(a).alias("_a"), spread(b).alias("_b"))
    return g.select(*keys, "n_rows", "n_valid", (F.col("_a")[1] - F.col("_a")[0]).alias("a_excitation"), (F.col("_b")[1] - F.col("_b")[0]).alias("b_excitation"))


def lag_profile(df: DataFrame, keys: list[str], max_lag: int = 5, least_corr: float = 0.35, least_margin: float = 0.08, **cols: str) -> DataFrame:
    """The lag with the largest correlation, its lead over the second, and whether it can be identified."""
    r = lag_correlations(df, keys, max_lag, **cols)
    ranked = F.sort_array(F.collect_list(F.struct((-F.col("r")).alias("m"), "lag")))
    best = r.groupBy(*keys).agg(ranked.alias("_r")).select(*keys, F.col("_r")[0]["lag"].alias("best_lag"), (-F.col("_r")[0]["m"]).alias("best_corr"), (-F.get("_r", F.lit(1))["m"]).alias("second_best_corr"))
    ab = {k: v for k, v in cols.items() if k in ("a", "b")}
    d = null_safe(excitation(df, keys, **ab), best, keys, "left").withColumn("peak_margin", F.col("best_corr") - F.col("second_best_corr"))
    good = (F.col("best_corr") >= least_corr) & (F.coalesce("peak_margin", F.lit(float("inf"))) >= least_margin)
    reason = F.when(F.col("n_valid") < 12, "too_few_valid_samples").when((F.col("a_excitation") <= EPS) | (F.col("b_excitation") <= EPS), "low_motion_excitation").when(F.col("best_lag").isNull(), "correlation_unavailable").when(good, "identifiable_peak").otherwise("ambiguous_or_weak_peak")
    d = d.withColumn("reason", reason).withColumn("status", F.when(F.col("reason") == "identifiable_peak", "ok").otherwise("unavailable"))
    told = F.col("reason").isin("identifiable_peak", "ambiguous_or_weak_peak")
    return d.select(*keys, "status", "reason", "n_valid", *(F.when(told, F.col(c)).alias(c) for c in ("best_lag", "best_corr", "second_best_corr", "peak_margin")))


def lag_stability(df: DataFrame, keys: list[str], max_lag: int = 5, window: int = 21, step: int = 5, seq: str = "seq", **cols: str) -> DataFrame:
    """``lag_profile`` in sliding windows; stable if three windows or more agree."""
    n = F.count("*").over(Window.partitionBy(*keys))
    size = F.greatest(F.lit(11), F.least(F.lit(window), F.col("_n")))
    d = df.withColumn("_n", n).where("_n >= 11").withColumn("_w", size)
    first = F.greatest(F.lit(0), F.ceil((F.col(seq) - F.col("_w") + 1) / step)).cast("long")
    last = F.least(F.floor(F.col(seq) / step), F.floor((F.col("_n") - F.col("_w")) / step)).cast("long")
    d = d.withColumn("_a", first).withColumn("_b", last).where("_a <= _b").withColumn("window_start", F.explode(F.transform(F.sequence("_a", "_b"), lambda x: x * step)))
    p = lag_profile(d.drop("_a", "_b", "_n", "_w"), [*keys, "window_start"], max_lag, seq=seq, **cols)
    mid = lambda x: F.percentile(F.when(F.col("status") == "ok", F.col(x)), F.lit(0.5))
    g = p.groupBy(*keys).agg(F.count("*").alias("window_count"), F.count(F.when(F.col("status") == "ok", 1)).alias("valid_window_count"), mid("best_lag").alias("lag_median"), mid("best_corr").alias("corr_median"), F.collect_list(F.when(F.col("status") == "ok", F.col("best_lag"))).alias("_lags"))
    dev = F.array_sort(F.transform("_lags", lambda x: F.abs(x - F.col("lag_median"))))
    k = F.size("_lags")
    mad = (F.element_at(dev, F.greatest(F.lit(1), F.floor((k + 1) / 2)).cast("int")) + F.element_at(dev, F.greatest(F.lit(1), F.floor((k + 2) / 2)).cast("int"))) / 2
    g = g.withColumn("lag_mad", F.when(k > 0, mad)).drop("_lags")
    few = F.col("valid_window_count") < 3
    reason = F.when(few, "too_few_stable_windows").when((F.col("lag_mad") <= 1) & (F.col("corr_median") >= 0.35), "stable_peak").otherwise("unstable_peak")
    g = g.withColumn("reason", reason).withColumn("status", F.when(F.col("reason") == "stable_peak", "ok").otherwise("unavailable"))
    return g.select(*keys, "status", "reason", "window_count", "valid_window_count", *(F.when(~few, F.col(c)).alias(c) for c in ("lag_median", "lag_mad", "corr_median")))


def identifiable_lag(df: DataFrame, keys: list[str], max_lag: int = 5, window: int = 21, step: int = 5, seq: str = "seq", **cols: str) -> DataFrame:
    """The profile's answer with the stability of its lag."""
    whole = lag_profile(df, keys, max_lag, seq=seq, **cols)
    steady = lag_stability(df, keys, max_lag, window, step, seq, **cols).select(*keys, F.col("status").alias("stability_status"), F.col("reason").alias("stability_reason"), "window_count", "valid_window_count", "lag_median", "lag_mad", "corr_median")
    d = null_safe(whole, steady, keys, "left")
    both = F.when((F.col("status") == "ok") & (F.col("stability_status") == "ok"), "ok").otherwise("unavailable")
    return d.withColumn("identifiable", both)


def best_lag(df: DataFrame, keys: list[str], max_lag: int = 5, least: int = 8, **cols: str) -> DataFrame:
    """The lag with the largest signed correlation, the smallest of equals."""
    r = lag_correlations(df, keys, max_lag, least, 1e-12, **cols)
    return r.groupBy(*keys).agg(F.max(F.struct("r", (-F.col("lag")).alias("m"))).alias("_b")).select(*keys, (-F.col("_b.m")).alias("best_lag"), F.col("_b.r").alias("best_correlation"))


def coupling(df: DataFrame, keys: list[str], state: str = "state", visual: str = "visual", max_lag: int = 5, seq: str = "seq", least: int = 11) -> DataFrame:
    """The lag with the largest absolute correlation, and how often one signal is active while the other is quiet."""
    r = lag_correlations(df, keys, max_lag, least, a=visual, b=state, seq=seq)
    best = r.groupBy(*keys).agg(F.max(F.struct(F.abs("r").alias("x"), (-F.col("lag")).alias("m"), "r")).alias("_b"), F.max(F.when(F.col("lag") == 0, F.col("r"))).alias("zero_lag_correlation"))
    q = lambda x: F.percentile(F.when(finite(x), F.col(x)), F.array(F.lit(0.25), F.lit(0.75)))
    g = df.groupBy(*keys).agg(F.count("*").alias("sample_count"), F.count(F.when(finite(state), 1)).alias("_ns"), F.count(F.when(finite(visual), 1)).alias("_nv"), q(state).alias("_qs"), q(visual).alias("_qv"))
    d = null_safe(df.select(*keys, F.col(state).alias("_s"), F.col(visual).alias("_v")), g, keys)
    both = finite("_s") & finite("_v")
    still = F.avg(F.when(both & (F.col("_s") >= F.col("_qs")[1]) & (F.col("_v") <= F.col("_qv")[0]), 1.0).otherwise(0.0))
    moves = F.avg(F.when(both & (F.col("_v") >= F.col("_qv")[1]) & (F.col("_s") <= F.col("_qs")[0]), 1.0).otherwise(0.0))
    f = d.where((F.col("sample_count") >= 11) & (F.col("_ns") >= 11) & (F.col("_nv") >= 11)).groupBy(*keys, "sample_count").agg(still.alias("state_active_visual_quiet_fraction"), moves.alias("visual_active_state_quiet_fraction"))
    out = null_safe(f, best, keys, "left")
    return out.select(*keys, "sample_count", F.when(F.col("_b").isNull(), "unavailable").otherwise("ok").alias("status"), (-F.col("_b.m")).alias("best_lag"), F.col("_b.x").alias("best_abs_correlation"), F.col("_b.r").alias("best_signed_correlation"), "zero_lag_correlation", "state_active_visual_quiet_fraction", "visual_active_state_quiet_fraction")
