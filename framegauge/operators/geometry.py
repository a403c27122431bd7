"""Which geometry modules could work on an episode, and what follows for its status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framegauge.functions.scalars import aggregate_status, finite
from framegauge.functions.taxonomy import ARMS
from framegauge.functions.vectors import all_finite
from framegauge.operators.vision import duplicate_fraction

#: The modules in the order of ``module_statuses``.
MODULES = [*(f"arms.{a}" for a in ARMS), "bimanual", *(f"state_vision.{a}" for a in ARMS)]
WRIST_VIEWS = {a: f"{a}_wrist_image" for a in ARMS}


def core_statuses(frames: DataFrame, state: str = "state", width: int = 20, keys: str = "episode") -> DataFrame:
    """``(episode, core_status)``: unavailable without states, with states of several widths or of less than ``width``."""
    if state not in frames.columns:
        return frames.select(keys).distinct().withColumn("core_status", F.lit("unavailable"))
    size = F.coalesce(F.size(state), F.lit(-1))
    g = frames.groupBy(keys).agg(F.min(size).alias("_lo"), F.max(size).alias("_hi"))
    return g.select(keys, F.when((F.col("_lo") != F.col("_hi")) | (F.col("_lo") < width), "unavailable").otherwise("ok").alias("core_status"))


def unfit_for_reference(frames: DataFrame, state: str = "state") -> DataFrame:
    """``(episode)`` of what a reference leaves out: episodes without a usable core or with a number that isn't finite."""
    d = frames.select("episode", state) if state in frames.columns else frames.select("episode")
    out = core_statuses(d, state).where("core_status <> 'ok'").select("episode")
    if state in frames.columns:
        out = out.union(d.where(~all_finite(F.col(state))).select("episode"))
    return out.distinct()


def view_statuses(images: DataFrame, least: int = 8, most_repeats: float = 0.35) -> DataFrame:
    """``(episode, view, status)``: ok with ``least`` finite changes between images and fewer repeats than ``most_repeats``."""
    moved = images.groupBy("episode", "view").agg(F.count(F.when(finite("motion"), 1)).alias("_n"))
    d = moved.join(duplicate_fraction(images).select("episode", "view", "duplicate_fraction"), ["episode", "view"], "left")
    good = (F.col("_n") >= least) & (F.coalesce("duplicate_fraction", F.lit(0.0)) < most_repeats)
    return d.select("episode", "view", F.when(good, "ok").otherwise("unavailable").alias("status"))


def module_statuses(core: Column, bimanual: Column, left: Column, right: Column) -> Column:
    """The statuses of ``MODULES``; without a core none of them is available."""
    usable = ~core.isin("fail", "unavailable")
    return F.when(usable, F.array(F.lit("ok"), F.lit("ok"), bimanual, left, right)).otherwise(F.array(*[F.lit("unavailable")] * len(MODULES)))


def geometry_statuses(cores: DataFrame, views: DataFrame | None, common_world: bool) -> DataFrame:
    """``(episode, core_status, module_statuses, geometry_status, geometry_unavailable, geometry_fail)`` from the core's
    status, the statuses of views (``view_statuses``) and whether the arms share a frame."""
    d = cores
    if views is None:
        d = d.withColumns({f"_{a}": F.lit("unavailable") for a in ARMS})
    else:
        g = views.groupBy("episode").agg(*(F.max(F.when(F.col("view") == v, F.col("status"))).alias(f"_{a}") for a, v in WRIST_VIEWS.items()))
        d = d.join(g, "episode", "left").withColumns({f"_{a}": F.coalesce(f"_{a}", F.lit("unavailable")) for a in ARMS})
    modules = module_statuses(F.col("core_status"), F.lit("ok" if common_world else "unavailable"), *(F.col(f"_{a}") for a in ARMS))
    d = d.withColumn("module_statuses", modules).withColumn("geometry_status", aggregate_status(F.array("core_status"), F.col("module_statuses")))
    count = lambda s: F.size(F.filter("module_statuses", lambda x: x == s))
    return d.select("episode", "core_status", "module_statuses", "geometry_status", count("unavailable").alias("geometry_unavailable"), count("fail").alias("geometry_fail"))
