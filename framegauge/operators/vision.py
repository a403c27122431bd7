"""Image columns to features: one Arrow pass per view decodes each image once; all further work is on small columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framegauge.functions import images as I
from framegauge.functions import tracks
from framegauge.functions.storage import dealt
from framegauge.operators.signals import ordered
from framegauge.operators.statistics import null_safe

#: The row counts of up to so many episodes go to the frames by broadcast (16 bytes each).
BROADCAST_EPISODES = 2_000_000
_FEATURES = "episode long, task long, seq long, frame long, view string, decoded boolean, height int, width int, channels int, mean double, std double, sharpness double, black_fraction double, white_fraction double, entropy double, pixel_hash string, grid array<float>, luma_grid array<float>, panel_area double, panel_aspect double, panel_x double, panel_y double"


def image_features(frames: DataFrame, views: list[str], density: bool = False) -> DataFrame:
    """A row per frame and view.

    ``frames`` has episode, task, seq, frame and the views as structs with ``bytes``. A null, empty or unreadable image
    has decoded = false and null features. Images are decoded in batches of rows; nothing is shuffled."""
    cell = lambda v: F.struct(F.lit(v).alias("view"), F.col(f"{v}.bytes").alias("bytes"))
    rows = frames.select("episode", "task", "seq", "frame", F.explode(F.array(*map(cell, views))).alias("_v")).select("episode", "task", "seq", "frame", "_v.*")

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                row = {k: r[k] for k in ("episode", "task", "seq", "frame", "view")} | {"decoded": False}
                try:
                    x = I.decode(r["bytes"])
                except Exception:  # noqa: BLE001 - whatever is wrong with an image is a finding
                    out.append(row)
                    continue
                stride = max(1, int(max(x.shape[:2]) / 80))
                p = I.panel_proxy(x) or {}
                out.append(row | I.metrics(x, density) | {"decoded": True, "height": x.shape[0], "width": x.shape[1], "channels": x.shape[2], "pixel_hash": I.pixel_hash(x), "grid": I.gray_grid(x).ravel().tolist(), "luma_grid": I.luma(x)[::stride, ::stride].astype(np.float32).ravel().tolist(), "panel_area": p.get("area"), "panel_aspect": p.get("aspect"), "panel_x": p.get("cx"), "panel_y": p.get("cy")})
            yield pa.RecordBatch.from_pylist(out, pa.schema([(k, kinds[t]) for k, t in (c.split() for c in _FEATURES.split(", "))]))

    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(), "array<float>": pa.list_(pa.float32())}
    return rows.mapInArrow(run, _FEATURES)


def _mean_abs(a, b):
    d = F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double")))
    return F.when((F.size(a) == F.size(b)) & (F.size(a) > 0), F.aggregate(d, F.lit(0.0), lambda s, x: s + x) / F.size(d))


def visual_motion(features: DataFrame, grid: str = "grid", name: str = "motion") -> DataFrame:
    """Mean absolute change of the grid from the row before; null after an unreadable image."""
    before = F.lag(grid).over(ordered(["episode", "task", "view"], "seq"))
    d = features.withColumn("_before", before)
    return d.withColumn(name, F.when(F.col("_before").isNotNull() & F.col(grid).isNotNull(), _mean_abs(F.col(grid), F.col("_before")))).drop("_before")


def duplicate_fraction(features: DataFrame) -> DataFrame:
    """Share of transitions between equal images, by episode and view."""
    same = F.col("pixel_hash") == F.lag("pixel_hash").over(ordered(["episode", "task", "view"], "seq"))
    return features.withColumn("_same", same).groupBy("episode", "task", "view").agg(F.avg(F.col("_same").cast("double")).alias("duplicate_fraction"), F.avg(F.col("decoded").cast("double")).alias("valid_fraction"))


def fallback_motion(features: DataFrame) -> DataFrame:
    """What the plain change of images says where feature tracks are needed: ``(episode, view, status, reason, valid_fraction)``."""
    g = features.where("seq > 0").groupBy("episode", "view").agg(F.avg(F.coalesce(F.abs("motion") < float("inf"), F.lit(False)).cast("double")).alias("valid_fraction"))
    all_ = features.select("episode", "view").distinct().join(g, ["episode", "view"], "left")
    return all_.select("episode", "view", F.lit("unavailable").alias("status"), F.when(F.col("valid_fraction").isNull(), "visual_motion_unavailable").otherwise("feature_tracks_required").alias("reason"), "valid_fraction")


def panel_jumps(features: DataFrame) -> DataFrame:
    """Rows with panel_center_delta: how far the panel's center is from where it was last seen."""
    w = ordered(["episode", "task", "view"], "seq")
    last = lambda c: F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    d = features.withColumns({"_x": last("panel_x"), "_y": last("panel_y")})
    return d.withColumn("panel_center_delta", F.sqrt(F.pow(F.col("panel_x") - F.col("_x"), 2) + F.pow(F.col("panel_y") - F.col("_y"), 2))).drop("_x", "_y")


def panel_summary(features: DataFrame) -> DataFrame:
    """C4 by episode and view: valid fraction, medians of area and aspect, median jump of the center, status."""
    mid = lambda c: F.percentile(c, F.lit(0.5))
    g = panel_jumps(features).groupBy("episode", "task", "view").agg(F.count("panel_area").alias("valid"), F.avg(F.col("panel_area").isNotNull().cast("double")).alias("valid_fraction"), mid("panel_area").alias("median_area"), mid("panel_aspect").alias("median_aspect_ratio"), mid("panel_center_delta").alias("median_center_delta"))
    return g.withColumn("status", F.when(F.col("valid") >= 5, "ok").otherwise("unavailable"))


def view_pairs(df: DataFrame, keys: list[str], view: str = "view", value: str = "value") -> DataFrame:
    """All pairs of views of a row, each once: keys, view_a, view_b, a, b. A row has a handful of views."""
    cells = F.sort_array(F.collect_list(F.struct(F.col(view).alias("view"), F.col(value).alias("value"))))
    g = df.groupBy(*keys).agg(cells.alias("_v"))
    return g.select(*keys, F.posexplode("_v").alias("_i", "_a"), "_v").select(*keys, "_a", F.explode(F.slice("_v", F.col("_i") + 2, F.size("_v"))).alias("_b")).select(*keys, F.col("_a.view").alias("view_a"), F.col("_b.view").alias("view_b"), F.col("_a.value").alias("a"), F.col("_b.value").alias("b"))


def overlap_gates(features: DataFrame, parts: int = 30, least_corr: float = 0.75, least_frames: int = 3, least_share: float = 0.2) -> DataFrame:
    """Pairs of views whose sampled lumas correlate often enough, by episode."""
    n = F.count("*").over(Window.partitionBy("episode", "view"))
    d = features.withColumn("_n", n).where((F.col("seq") % F.greatest(F.lit(1), F.floor(F.col("_n") / parts)) == 0) & (F.col("_n") >= 4))
    pairs = view_pairs(d, ["episode", "task", "seq"], "view", "luma_grid")
    cells = F.explode(F.arrays_zip(F.col("a").alias("x"), F.col("b").alias("y")))
    dense = pairs.where(F.size("a") == F.size("b")).select("episode", "task", "seq", "view_a", "view_b", cells.alias("_c"))
    r = dense.groupBy("episode", "task", "seq", "view_a", "view_b").agg(F.covar_pop("_c.x", "_c.y").alias("_xy"), F.stddev_pop("_c.x").alias("_sx"), F.stddev_pop("_c.y").alias("_sy"))
    r = r.withColumn("r", F.when((F.col("_sx") >= 1e-6) & (F.col("_sy") >= 1e-6), F.col("_xy") / (F.col("_sx") * F.col("_sy")))).drop("_xy", "_sx", "_sy")
    sampled = null_safe(pairs.select("episode", "task", "seq", "view_a", "view_b"), r, ["episode", "task", "seq", "view_a", "view_b"], "left")
    g = sampled.groupBy("episode", "task", "view_a", "view_b").agg(F.count("*").alias("sampled_frames"), F.count(F.when(F.col("r") >= least_corr, 1)).alias("ok_frames"), F.percentile(F.when(~F.isnan("r"), F.col("r")), F.lit(0.5)).alias("median_correlation"))
    g = g.withColumn("ok_fraction", F.col("ok_frames") / F.col("sampled_frames"))
    return g.withColumn("status", F.when((F.col("ok_frames") >= least_frames) & (F.col("ok_fraction") >= least_share), "ok").otherwise("unavailable"))


def grid_coverage(points: DataFrame, keys: list[str], x: str, y: str, width: float, height: float, cells: int = 4) -> DataFrame:
    """Share of the cells of a grid that hold a point."""
    cell = lambda v, size: F.least(F.lit(cells - 1), F.floor(F.col(v) / size * cells))
    return points.groupBy(*keys).agg((F.count_distinct(F.struct(cell(x, width), cell(y, height))) / (cells * cells)).alias("coverage"))


# ---- features of the image itself, without small grids ---------------------------------------------------------------

_KEYS = "episode long, task long, seq long, frame long"

#: Pairs of images whose points are followed in the same steps.
_AT_ONCE = 16


def _gray_images(batch: pa.RecordBatch, column: int):
    """The luma of each image, None for what can't be read."""
    for data in batch.column(column).to_pylist():
        try:
            yield I.luma(I.decode(data))
        except Exception:  # noqa: BLE001 - whatever is wrong with an image
            yield None


def track_motion(frames: DataFrame, view: str, block: int = 64) -> DataFrame:
    """``(episode, task, seq, frame, view, motion, tracks, inliers, same)``: how far tracked corners moved from the image
    before; null after an unreadable image. Images are shuffled by blocks of ``block`` numbers of an episode and stream in
    order, one before the other in memory. A block passes on its first and its last image; from these the first rows get
    theirs by episode. The grid's motion (``visual_motion``) needs no such shuffle."""
    spark = frames.sparkSession
    names, keys = ["episode", "task", "seq", "frame"], ["episode", "task", "_block"]
    rows = frames.select(*names, F.floor(F.col("seq") / block).alias("_block"), F.col(f"{view}.bytes").alias("bytes"))
    kinds = {"motion": pa.float64(), "tracks": pa.int64(), "inliers": pa.int64(), "same": pa.bool_()}
    none = dict.fromkeys(kinds)

    def moved(pairs: list[tuple]) -> list[dict]:
        known = [(a, b) for a, b in pairs if a is not None and b is not None]
        found = iter([r | {"same": bool(a.shape == b.shape and (a == b).all())} for r, (a, b) in zip(tracks.track_motions(known), known, strict=True)])
        return [none if a is None or b is None else next(found) for a, b in pairs]

    def batch_of(names: list[str], cells: list, found: list[dict], more: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*cells, *(pa.array([r[k] for r in found], t) for k, t in kinds.items()), *more.values()], [*names, *kinds, *more])

    def within(batches):
        """The rows of each block; a row is given out when the one after it is known, the image with it if it is the first or the last."""
        key, before, held = None, None, None

        def out(rows: list[tuple]) -> pa.RecordBatch:
            cells = [pa.array([r[0][i] for r in rows], pa.int64()) for i in range(4)]
            return batch_of(names, cells, [r[1] for r in rows], {"first": pa.array([r[2] for r in rows], pa.bool_()), "last": pa.array([r[3] for r in rows], pa.bool_()), "bytes": pa.array([r[4] if r[2] or r[3] else None for r in rows], pa.binary())})

        for batch in batches:
            ready = []
            for at in range(0, batch.num_rows, _AT_ONCE):
                part = batch.slice(at, _AT_ONCE)
                cells, grays = [part.column(i).to_pylist() for i in range(6)], list(_gray_images(part, 5))
                places = list(zip(cells[0], cells[1], cells[4], strict=True))
                firsts = [now != last for now, last in zip(places, [key, *places], strict=False)]
                found = moved([(None if f else a, b) for f, a, b in zip(firsts, [before, *grays], grays, strict=False)])
                for i, (row, first) in enumerate(zip(zip(*cells[:4], strict=True), firsts, strict=True)):
                    if held is not None:
                        ready.append((*held[:3], first, held[3]))
                    held = row, found[i], first, cells[5][i]
                key, before = places[-1], grays[-1]
            if ready:
                yield out(ready)
        if held is not None:
            yield out([(*held[:3], True, held[3])])

    def across(batches):
        """The first rows of blocks, from the last image of the block before."""
        key, before = None, None
        for batch in batches:
            cells = [batch.column(i).to_pylist() for i in range(11)]
            found = [{k: c[i] for k, c in zip(kinds, cells[4:8], strict=True)} for i in range(batch.num_rows)]
            ends = [i for i in range(batch.num_rows) if cells[8][i] or cells[9][i]]
            for i, gray in zip(ends, _gray_images(batch.take(pa.array(ends, pa.int64())), 10), strict=True):
                now = cells[0][i], cells[1][i]
                if cells[8][i]:
                    found[i] = moved([(before if now == key else None, gray)])[0]
                if cells[9][i]:
                    before, key = gray, now
            yield batch_of(names, [batch.column(i) for i in range(4)], found, {})

    by = rows.repartition(dealt(spark), *keys).sortWithinPartitions(*keys, "seq")
    parts = by.mapInArrow(within, f"{_KEYS}, motion double, tracks long, inliers long, same boolean, first boolean, last boolean, bytes binary")
    whole = parts.repartition("episode").sortWithinPartitions("episode", "task", "seq")
    return whole.mapInArrow(across, f"{_KEYS}, motion double, tracks long, inliers long, same boolean").withColumn("view", F.lit(view))


def track_summary(moves: DataFrame, least: int = 8) -> DataFrame:
    """C1 by episode and view: status, share of transitions with a motion, medians, repeated images."""
    t = moves.where("tracks is not null")
    mid = lambda c: F.percentile(c, F.lit(0.5))
    g = t.groupBy("episode", "view").agg(F.count("motion").alias("valid"), F.avg(F.col("motion").isNotNull().cast("double")).alias("valid_fraction"), mid("tracks").alias("median_track_count"), mid("inliers").alias("median_inlier_count"), F.avg(F.col("same").cast("double")).alias("duplicate_fraction"))
    return g.withColumn("status", F.when(F.col("valid") >= least, "ok").otherwise("unavailable")).withColumn("reason", F.when(F.col("valid") >= least, "feature_tracks").otherwise("too_few_feature_tracks"))


def panels(frames: DataFrame, view: str) -> DataFrame:
    """``(episode, task, seq, frame, view, panel_area, panel_aspect, panel_x, panel_y, panel_angle)``; nulls where no panel is seen."""
    rows = frames.select("episode", "task", "seq", "frame", F.col(f"{view}.bytes").alias("bytes"))
    names = {"panel_area": "area", "panel_aspect": "aspect", "panel_x": "cx", "panel_y": "cy", "panel_angle": "angle"}

    def run(batches):
        for batch in batches:
            found = [None if g is None else tracks.panel(g) for g in _gray_images(batch, 4)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), *(pa.array([p and p[k] for p in found], pa.float64()) for k in names.values())], ["episode", "task", "seq", "frame", *names])

    return rows.mapInArrow(run, f"{_KEYS}, " + ", ".join(f"{n} double" for n in names)).withColumn("view", F.lit(view))


def sampled_rows(frames: DataFrame, parts: int = 30) -> DataFrame:
    """About ``parts`` rows of each episode of at least four, evenly; only episode and seq are read to find them."""
    n = frames.groupBy("episode").agg(F.count("*").alias("_n"))
    d = frames.join(F.broadcast(n) if n.count() <= BROADCAST_EPISODES else n, "episode")
    return d.where((F.col("_n") >= 4) & (F.col("seq") % F.greatest(F.lit(1), F.floor(F.col("_n") / parts)) == 0)).select(*frames.columns)


def feature_overlaps(frames: DataFrame, views: list[str], parts: int = 30, least_frames: int = 3, least_share: float = 0.2) -> DataFrame:
    """Pairs of views whose descriptors match on enough sampled rows, by episode. Only sampled rows are decoded; views
    of a row stand in it, so no image is shuffled. Where images are made, not read, take ``sampled_rows`` before and
    ``sample_overlaps`` after that."""
    return sample_overlaps(sampled_rows(frames, parts), views, least_frames, least_share)


def sample_overlaps(frames: DataFrame, views: list[str], least_frames: int = 3, least_share: float = 0.2) -> DataFrame:
    """C5, C7 of rows that are sampled."""
    d = frames.select("episode", "task", "seq", "frame", *(F.col(f"{v}.bytes").alias(v) for v in views))
    pairs = [(i, j) for i in range(len(views)) for j in range(i + 1, len(views))]

    def run(batches):
        for batch in batches:
            grays = [list(_gray_images(batch, 4 + k)) for k in range(len(views))]
            rows = []
            for r, e in enumerate(batch.column(0).to_pylist()):
                for i, j in pairs:
                    a, b = grays[i][r], grays[j][r]
                    x = {"matches": 0, "inliers": 0, "coverage": 0.0} if a is None or b is None else tracks.overlap(a, b)
                    rows.append({"episode": e, "view_a": views[i], "view_b": views[j]} | x)
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("episode", pa.int64()), ("view_a", pa.string()), ("view_b", pa.string()), ("matches", pa.int64()), ("inliers", pa.int64()), ("coverage", pa.float64())]))

    r = d.mapInArrow(run, "episode long, view_a string, view_b string, matches long, inliers long, coverage double")
    good = (F.col("inliers") >= 8) & (F.col("inliers") >= 0.5 * F.col("matches")) & (F.col("coverage") >= 0.2)
    mid = lambda c: F.percentile(F.when(F.col("inliers") > 0, F.col(c)), F.lit(0.5))
    g = r.groupBy("episode", "view_a", "view_b").agg(F.count("*").alias("sampled_frames"), F.count(F.when(good, 1)).alias("ok_frames"), mid("matches").alias("median_matches"), mid("inliers").alias("median_inliers"), mid("coverage").alias("median_coverage"))
    g = g.withColumn("ok_fraction", F.col("ok_frames") / F.col("sampled_frames"))
    return g.withColumn("status", F.when((F.col("ok_frames") >= least_frames) & (F.col("ok_fraction") >= least_share), "ok").otherwise("unavailable"))
