"""Queries over pictures made of the driver's vectors, with SQL that computes the same from the vectors' numbers.

A vector's 64 numbers are the gray cells of an image of 8 x 8 cells; each cell has 4 x 4 pixels. Pixel sums are sums over
cells; only at the borders of cells do neighbours differ."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framegauge.functions import images as I
from framegauge.functions.storage import dealt, written
from framegauge.operators import clips, geometry, vision
from framegauge.operators import detectors as D
from framegauge.operators.statistics import scoped_stats, with_baselines
from framegauge.plans.catalog import _MS, _PARTS, KEYS, query, r6
from framegauge.plans.pipeline import METRICS
from framegauge.sources import tables as T

VIEW = "image"
_IMAGE = "struct<bytes:binary,path:string>"

# Cells of the images in SQL, from 1; ``cell`` is the cell of pixel (y, x).
PX = "px as (select cast(label as bigint) as episode, vec_id as frame, row_number() over (partition by label order by vec_id) - 1 as seq, list_transform(embedding, lambda e: cast(least(255, greatest(0, floor((cast(e as double) + 0.5) * 256))) as bigint)) as c from embeddings)"
CELL = "c[(({y}) // 4) * 8 + ({x}) // 4 + 1]"
GRID = "list_transform(range(0, 16), lambda i: c[(i // 4) * 16 + (i % 4) * 2 + 1])"
ENT = "(-list_sum(list_transform(list_filter(list_transform(range(0, 32), lambda b: len(list_filter({c}, lambda v: least(31, v * 32 // 255) = b)) / 64.0), lambda p: p > 0), lambda p: p * log2(p))))"
LAP = " + ".join(CELL.format(y=y, x=x) for y, x in (("i // 30", "i % 30 + 1"), ("i // 30 + 2", "i % 30 + 1"), ("i // 30 + 1", "i % 30"), ("i // 30 + 1", "i % 30 + 2"))) + " - 4 * " + CELL.format(y="i // 30 + 1", x="i % 30 + 1")
MT = f"""{PX}, mt as (select episode, frame, seq, c, list_avg(c) as mean, list_aggregate(c, 'stddev_pop') as std, list_aggregate(list_transform(range(0, 900), lambda i: {LAP}), 'var_pop') as sharpness,
 len(list_filter(c, lambda v: v < 5)) / 64.0 as black_fraction, len(list_filter(c, lambda v: v > 250)) / 64.0 as white_fraction, {ENT.format(c="c")} as entropy from px)"""


def pictures(vectors: DataFrame, recolor=None, views: tuple[str, ...] = (VIEW,)) -> DataFrame:
    """Episode rows with PNG images of 32 x 32 from column ``cells``; ``recolor(cells, view number, frame)`` gives the pixels' cells.

    The rows are short and the images made of them cost much, so they are dealt to as many tasks as there are to be."""
    names = ["episode", "task", "seq", "frame"]

    def run(batches):
        for batch in batches:
            cells = batch.column(4).to_pylist()
            frames = batch.column(3).to_pylist()
            out = [batch.column(i) for i in range(4)]
            for v in range(len(views)):
                made = []
                for c, f in zip(cells, frames, strict=True):
                    g = np.array(c, np.int64).reshape(8, 8)
                    x = np.repeat(np.repeat(g, 4, axis=0), 4, axis=1)
                    pixels = np.stack([x, x, x], axis=2) if recolor is None else recolor(x, v, f)
                    made.append(None if pixels is None else {"bytes": pixels if isinstance(pixels, bytes) else I.encode_png(pixels.astype(np.uint8)), "path": None})
                out.append(pa.array(made, pa.struct([("bytes", pa.binary()), ("path", pa.string())])))
            yield pa.RecordBatch.from_arrays(out, [*names, *views])

    return vectors.select(*names, "cells").repartition(dealt(vectors.sparkSession), "frame").mapInArrow(run, "episode long, task long, seq long, frame long, " + ", ".join(f"{v} {_IMAGE}" for v in views))


def vectors(spark, sf) -> DataFrame:
    """The vectors' cells, 0 to 255."""
    e = T.table(spark, sf, "embeddings").select(F.col("label").cast("long").alias("episode"), F.lit(None).cast("long").alias("task"), F.col("vec_id").alias("frame"), F.transform("embedding", lambda x: F.least(F.lit(255), F.greatest(F.lit(0), F.floor((x.cast("double") + 0.5) * 256)))).alias("cells"))
    return T.numbered(e, ["episode"], "frame")


def _features(spark, sf, **how) -> DataFrame:
    return vision.image_features(pictures(vectors(spark, sf), **how), [VIEW])


def _odd(x: np.ndarray, view: int, frame: int):
    """Every seventh image is half as wide, every eleventh is cut off, every thirteenth is missing."""
    rgb = np.stack([x, x, x], axis=2)
    if frame % 13 == 0:
        return None
    if frame % 11 == 0:
        return I.encode_png(rgb.astype(np.uint8))[:60]
    return rgb[:, :16] if frame % 7 == 0 else rgb


def _color(x: np.ndarray, view: int, frame: int):
    return np.stack([x, x * 7 % 256, x * 13 % 256], axis=2)


@query(f"with {MT} select frame, round(mean, 6) as mean, round(std, 6) as std, round(sharpness, 4) as sharpness, black_fraction, white_fraction, round(entropy, 6) as entropy from mt")
def picture_metrics(spark, sf):
    """Measures of decoded images."""
    f = _features(spark, sf)
    return f.select("frame", r6("mean"), r6("std"), F.round("sharpness", 4).alias("sharpness"), "black_fraction", "white_fraction", r6("entropy"))


@query(f"with {MT}, h as (select frame, list_filter(list_transform(range(0, 32), lambda b: len(list_filter(c, lambda v: least(31, v * 32 // 255) = b)) / 64.0 / 7.96875), lambda p: p > 0) as p from mt) select frame, round(-list_sum(list_transform(p, lambda d: d * log2(d))), 6) as entropy from h")
def picture_density_entropy(spark, sf):
    """A10: the first generation's entropy, over densities."""
    f = vision.image_features(pictures(vectors(spark, sf)), [VIEW], density=True)
    return f.select("frame", r6("entropy"))


@query(f"with {PX} select frame, list_sum(list_transform(c, lambda v: (v * 19595 + (v * 7 % 256) * 38470 + (v * 13 % 256) * 7471 + 32768) // 65536)) * 16 as luma_sum, round(list_avg(list_transform(c, lambda v: (v + v * 7 % 256 + v * 13 % 256) / 3.0)), 6) as mean from px".replace("list_sum(list_transform(c, lambda v: (v", "cast(list_sum(list_transform(c, lambda v: (v").replace("// 65536)) * 16 as", "// 65536)) * 16 as bigint) as"))
def picture_luma(spark, sf):
    """The weighted gray of colored images."""
    f = _features(spark, sf, recolor=_color)
    return f.select("frame", F.aggregate("luma_grid", F.lit(0.0), lambda a, x: a + x).cast("long").alias("luma_sum"), r6("mean"))


@query(f"with {PX}, g as (select frame, seq, episode, {GRID} as g from px), m as (select *, lag(g) over (partition by episode order by seq) as b from g) select frame, g[1] as first_cell, round(case when b is not null then list_avg(list_transform(list_zip(g, b), lambda p: abs(p[1] - p[2]))) end, 6) as motion from m")
def picture_motion(spark, sf):
    """The grid of every eighth pixel and its change."""
    d = vision.visual_motion(_features(spark, sf))
    return d.select("frame", F.col("grid")[0].cast("long").alias("first_cell"), r6("motion"))


@query("with p as (select cast(label as bigint) as episode, vec_id as frame from embeddings) select frame, case when frame % 13 = 0 or frame % 11 = 0 then 'image_decode_error' else 'invalid_image_shape' end as issue_type, 'vision_illegal' as family, 25.0 * 0.65 >= 0 as illegal from p where frame % 13 = 0 or frame % 11 = 0 or frame % 7 = 0")
def picture_legality(spark, sf):
    """Images that are missing, cut off or of another shape."""
    f = D.image_legality(_features(spark, sf, recolor=_odd), 32, 32)
    return f.select(F.col("frame_start").alias("frame"), "issue_type", "family", "illegal")


_ST = "s as (select " + _MS + " from (select * from mt where frame % 13 <> 0 and frame % 11 <> 0 and frame % 7 <> 0))"
_UNNEST = ", ".join(f"{{'n': '{n}', 'o': {i}, 'x': cast({x} as double)}}" for i, (n, x) in enumerate(_PARTS))


@query(f"""with {MT}, {_ST}, w as (select frame, unnest([{_UNNEST}]) as u from mt, s where frame % 13 <> 0 and frame % 11 <> 0 and frame % 7 <> 0), k as (select frame, u.n as n, u.x as x, row_number() over (partition by frame order by u.x desc, u.o) as k from w)
select frame, n as issue_type, round(100 * x, 2) as severity from k where k = 1 and 100 * x >= 5""")
def picture_quality(spark, sf):
    """The worst component of each image; images of another shape don't count for the reference."""
    f = written(_features(spark, sf, recolor=_odd), "features").where("decoded and width = 32")
    long = f.select(*KEYS, "view", F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRICS))).alias("_m")).select(*KEYS, "view", "_m.*")
    names = {m: f"s_{m}" for m in ("mean", "std", "sharpness", "entropy")}
    d = with_baselines(f, scoped_stats(long, ["view", "metric"], "task", "value"), ["view"], "task", "metric", names)
    return D.image_quality(d, {m: F.col(n) for m, n in names.items()}, least=5.0).select(F.col("frame_start").alias("frame"), "issue_type", "severity")


# every even episode holds an image for twelve rows
HOLD = f"{PX}, ho as (select episode, frame, seq, case when episode % 2 = 0 then first_value(c) over (partition by episode, seq // 12 order by seq) else c end as c from px)"


def _held(spark, sf) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("episode", F.floor(F.col("seq") / 12)).orderBy("seq")
    v = vectors(spark, sf)
    return v.withColumn("cells", F.when(F.col("episode") % 2 == 0, F.first("cells").over(w)).otherwise(F.col("cells")))


RUNS = """x as (select *, case when c = lag(c) over (partition by episode order by seq) then 0 else 1 end as fresh from ho), y as (select *, sum(fresh) over (partition by episode order by seq rows unbounded preceding) as i from x),
rn as (select episode, min(seq) as a, max(seq) as b, arg_min(frame, seq) as frame_start, arg_max(frame, seq) as frame_end, count(*) as n from y group by episode, i)"""


@query(f"with {HOLD}, {RUNS} select episode, frame_start, frame_end, round(case when n <= 10 then 0.0 when n <= 50 then 30 + (n - 10) / 40.0 * 25 else 55.0 + (n - 50) / 50.0 * 30 end, 2) as severity from rn where n >= 11")
def picture_freezes(spark, sf):
    """Runs of equal images."""
    f = vision.image_features(pictures(_held(spark, sf)), [VIEW])
    return D.exact_repeats(f, "pixel_hash", ["view"], min_severity=30.0).select("episode", "frame_start", "frame_end", "severity")


@query(f"""with {HOLD.replace("ho as", "h0 as")}, ho as (select * from h0), {RUNS}, mh as (select episode, frame, seq, list_avg(c) as mean, list_aggregate(c, 'stddev_pop') as std, list_aggregate(list_transform(range(0, 900), lambda i: {LAP}), 'var_pop') as sharpness, len(list_filter(c, lambda v: v < 5)) / 64.0 as bf, len(list_filter(c, lambda v: v > 250)) / 64.0 as wf from ho),
f as (select episode, frame as frame_start, frame as frame_end, case when bf > 0.98 or (mean < 5 and std < 5) then 'black_frame' when wf > 0.98 or (mean > 250 and std < 5) then 'white_frame' when sharpness < 50 then 'severe_blur' end as issue_type from mh)
select episode, frame_start, frame_end, issue_type, case when issue_type = 'severe_blur' then 'medium' else 'high' end as severity from f where issue_type is not null union all select episode, frame_start, frame_end, 'frozen_frame_run', 'medium' from rn where n >= 8""")
def picture_rules_v1(spark, sf):
    """The first generation's rules; the first that fits."""
    f = vision.image_features(pictures(_held(spark, sf)), [VIEW])
    return D.v1_images(f, 32, 32).select("episode", "frame_start", "frame_end", "issue_type", "severity")


@query(f"""with {HOLD}, l as (select *, c = lag(c) over (partition by episode order by seq) as same, lag(c) over (partition by episode order by seq) as b from ho)
select episode, round(avg(case when seq > 0 then case when same then 1.0 else 0.0 end end), 6) as duplicate_fraction, case when count(*) - 1 >= 8 and coalesce(avg(case when seq > 0 then case when same then 1.0 else 0.0 end end), 0) < 0.35 then 'ok' else 'unavailable' end as status, 'feature_tracks_required' as reason from l group by 1""")
def picture_repeats(spark, sf):
    """How often an image repeats, whether the view is usable, and what plain change says."""
    f = vision.visual_motion(vision.image_features(pictures(_held(spark, sf)), [VIEW]))
    d = vision.duplicate_fraction(f).select("episode", r6("duplicate_fraction"))
    return d.join(geometry.view_statuses(f).select("episode", "status"), "episode").join(vision.fallback_motion(f).select("episode", "reason"), "episode")


PB = f"""{PX}, th as (select *, (list_sort(c)[7] + list_sort(c)[58]) * 0.5 as t from px), bx as (select *, list_filter(range(0, 64), lambda i: c[i + 1] <= t) as d from th),
bb as (select *, 4 * list_min(list_transform(d, lambda i: i % 8)) as x0, 4 * list_max(list_transform(d, lambda i: i % 8)) + 3 as x1, 4 * list_min(list_transform(d, lambda i: i // 8)) as y0, 4 * list_max(list_transform(d, lambda i: i // 8)) + 3 as y1 from bx),
wh as (select *, x1 - x0 + 1 as w, y1 - y0 + 1 as h from bb), pp as (select *, w * h between 0.03 * 1024 and 0.95 * 1024 and greatest(w, h) / least(w, h) between 1.05 and 12 and 16 * len(d) / (w * h) >= 0.15 as ok from wh)"""


@query(f"with {PB} select frame, case when ok then cast(w * h as double) end as area, round(case when ok then greatest(w, h) / least(w, h) end, 6) as aspect, case when ok then (x0 + x1) / 2 end as cx, case when ok then (y0 + y1) / 2 end as cy from pp")
def picture_panels(spark, sf):
    """C4, C3 without OpenCV: the box around what is dark."""
    f = _features(spark, sf)
    return f.select("frame", F.col("panel_area").alias("area"), r6("panel_aspect", "aspect"), F.col("panel_x").alias("cx"), F.col("panel_y").alias("cy"))


VIEWS3 = (VIEW, "left_wrist_image", "right_wrist_image")


def _views(x: np.ndarray, view: int, frame: int):
    """The second view is the first with some lines brighter, the third its negative; in the last third of frames all are flat."""
    if view == 1:
        x = np.minimum(255, x + 20 * (np.arange(32)[:, None] // 4 % 3))
    if view == 2:
        x = 255 - x
    return np.stack([x, x, x], axis=2)


@query(f"""with {PX}, n as (select *, count(*) over (partition by episode) as n from px), s as (select * from n where n >= 4 and seq % greatest(1, n // 30) = 0), v as (select episode, seq, c as a, list_transform(range(0, 64), lambda i: least(255, c[i + 1] + 20 * (i // 8 % 3))) as b, list_transform(c, lambda x: 255 - x) as d from s),
p as (select episode, seq, 'image' as view_a, 'left_wrist_image' as view_b, a as x, b as y from v union all select episode, seq, 'image', 'right_wrist_image', a, d from v union all select episode, seq, 'left_wrist_image', 'right_wrist_image', b, d from v),
u as (select episode, seq, view_a, view_b, unnest(x) as x, unnest(y) as y from p), r as (select episode, seq, view_a, view_b, corr(x, y) as r from u group by 1, 2, 3, 4)
select episode, view_a, view_b, count(*) as sampled_frames, count(*) filter (r >= 0.75) as ok_frames, round(quantile_cont(r, 0.5), 5) as median_correlation, case when count(*) filter (r >= 0.75) >= 3 and count(*) filter (r >= 0.75) / count(*) >= 0.2 then 'ok' else 'unavailable' end as status from r group by 1, 2, 3""")
def picture_overlaps(spark, sf):
    """C6, C7, J11, C5 without OpenCV: pairs of views that show the same."""
    f = vision.image_features(pictures(vectors(spark, sf), recolor=_views, views=VIEWS3), list(VIEWS3))
    return vision.overlap_gates(f).select("episode", "view_a", "view_b", "sampled_frames", "ok_frames", F.round("median_correlation", 5).alias("median_correlation"), "status")


@query(f"with {PX} select frame, cast(list_sum(list_transform(range(0, 16), lambda i: floor((c[(i // 4) * 16 + (i % 4) * 2 + 1] + c[(i // 4) * 16 + (i % 4) * 2 + 2] + c[(i // 4) * 16 + (i % 4) * 2 + 9] + c[(i // 4) * 16 + (i % 4) * 2 + 10]) / 4.0 + 0.5) * (i + 1))) as bigint) as weighted from px")
def picture_resized(spark, sf):
    """images of 8 x 8 shrunk to 4 x 4; the sum weighs each pixel by its place."""

    def run(batches):
        for batch in batches:
            small = [I.resize_gray(np.array(c, np.uint8).reshape(8, 8), 4).astype(np.int64).ravel() for c in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([int((s * np.arange(1, 17)).sum()) for s in small], pa.int64())], ["frame", "weighted"])

    return vectors(spark, sf).select("frame", "cells").mapInArrow(run, "frame long, weighted long")


def _texture(seed: int, size: int = 96) -> np.ndarray:
    """Smooth random gray, so that points can be followed and told apart."""
    g = np.random.default_rng(seed).integers(0, 256, (size // 4, size // 4)).astype(np.float64)
    x = np.kron(g, np.ones((4, 4)))
    for axis in (0, 1):
        x = (np.roll(x, 1, axis) + 2 * x + np.roll(x, -1, axis)) / 4
    return x


def _scene(x: np.ndarray, view: int, frame: int):
    """A picture that depends on the row's number and its episode's: ``x`` holds both in its cells."""
    episode, seq = int(x[0, 0]), int(x[0, 4])  # of cells that hold them instead of gray
    shift = 2 * (seq % 3)
    own = np.roll(_texture(episode + (100 * seq if view and episode % 2 else 0)), shift if view == 0 else -5, axis=1)
    return np.stack([own] * 3, axis=2)


def _scenes(rows: DataFrame, views: tuple[str, ...] = (VIEW,), scene=None) -> DataFrame:
    return pictures(rows.withColumn("cells", F.concat(F.array("episode", "seq"), F.array_repeat(F.lit(0).cast("long"), 62))), recolor=scene or _scene, views=views)


PE = "pe as (select cast(label as bigint) as episode, vec_id as frame, row_number() over (partition by label order by vec_id) - 1 as seq from embeddings), ps as (select *, 2 * (seq % 3) as shift from pe)"


@query(f"with {PE}, m as (select episode, seq, abs(shift - lag(shift) over (partition by episode order by seq)) as motion from ps) select episode, seq, cast(motion as double) as motion, true as followed from m where motion is not null")
def picture_tracks(spark, sf):
    """Textures that move by two pixels, and back by four, as their tracked points tell; to the pixel."""
    d = vision.track_motion(_scenes(vectors(spark, sf)), VIEW).where("tracks is not null")
    return d.select("episode", "seq", F.round("motion").alias("motion"), ((F.col("tracks") >= 12) & (F.col("inliers") >= 6)).alias("followed"))


@query(f"with {PE} select episode, 'ok' as status, 'feature_tracks' as reason, count(*) - 1 as valid, 0.0::double as duplicate_fraction from ps group by 1 having count(*) >= 9")
def picture_track_status(spark, sf):
    """Episodes whose tracks suffice."""
    return vision.track_summary(vision.track_motion(_scenes(vectors(spark, sf)), VIEW)).select("episode", "status", "reason", "valid", "duplicate_fraction")


def _box(x: np.ndarray, view: int, frame: int):
    """A dark box on a bright ground, larger with the row's number; every seventh is missing."""
    out = np.full((96, 128, 3), 225)
    w, h, at = 70 + frame % 11, 84 - frame % 5, frame % 13
    if frame % 7:
        out[6 : 6 + h, 20 + at : 20 + at + w] = 35
    return out


@query(f"""with {PE}, b as (select frame, 70 + frame % 11 as w, 84 - frame % 5 as h, 20 + frame % 13 as x from ps), a as (select *, greatest(w - 5, h - 5) / least(w - 5, h - 5)::double as aspect from b), k as (select *, frame % 7 > 0 and aspect >= 1.1 as ok from a)
select frame, case when ok then cast((w - 4) * (h - 4) as double) end as area, round(case when ok then aspect end, 6) as aspect, case when ok then x + (w - 1) / 2.0 end as cx, case when ok then 6 + (h - 1) / 2.0 end as cy from k""")
def picture_boxes(spark, sf):
    """The dark box, less two pixels a side that the smoothing takes; nothing on a plain ground, and nothing that is nearly square."""
    d = vision.panels(_scenes(vectors(spark, sf), scene=_box), VIEW)
    return d.select("frame", F.col("panel_area").alias("area"), r6("panel_aspect", "aspect"), r6("panel_x", "cx"), r6("panel_y", "cy"))


@query(f"with {PE}, n as (select *, count(*) over (partition by episode) as n from pe) select episode, count(*) as sampled_frames, case when episode % 2 = 0 then 'ok' else 'unavailable' end as status from n where n >= 4 and seq % greatest(1, n // 30) = 0 group by 1")
def picture_feature_overlaps(spark, sf):
    """Two views of one texture in even episodes, of different ones in odd ones; made of sampled rows only, as no other is looked at."""
    views = VIEW, "left_wrist_image"
    rows = _scenes(vision.sampled_rows(vectors(spark, sf)), views=views)
    return vision.sample_overlaps(rows, list(views)).select("episode", "sampled_frames", "status")


def _clips(spark, sf, kind: str) -> DataFrame:
    """A clip around every image that moved more than nine tenths of its episode's: up to 15 frame numbers to each side."""
    from pyspark.sql import Window

    rows = pictures(vectors(spark, sf))
    spans = rows.groupBy("episode").agg(F.min("frame").alias("first_frame"), F.max("frame").alias("last_frame"))
    d = vision.visual_motion(vision.image_features(rows, [VIEW])).withColumn("high", F.percentile("motion", F.lit(0.9)).over(Window.partitionBy("episode")))
    found = d.where("motion > high").select("episode", F.col("frame").alias("frame_start"), F.col("frame").alias("frame_end"))
    return clips.clip_files(clips.clip_windows(found, spans, 15), rows, VIEW, kind)


CL = f"""{PX}, gm as (select episode, frame, list_avg(list_transform(list_zip(g, b), lambda p: abs(p[1] - p[2]))) as motion from (select *, lag(g) over (partition by episode order by seq) as b from (select *, {GRID} as g from px)) where b is not null), hm as (select *, quantile_cont(motion, 0.9) over (partition by episode) as high from gm),
cl as (select p.episode, p.frame as frame_start, q.frame, q.c from (select * from hm where motion > high) p join px q on q.episode = p.episode and q.frame between p.frame - 15 and p.frame + 15)"""


@query(f"with {CL} select episode, frame_start, count(*) as frames, cast(sum(list_sum(c)) * 16 as bigint) as total from cl group by 1, 2")
def clip_videos(spark, sf):
    """AVI clips around images, read back frame by frame."""

    def run(batches):
        for batch in batches:
            read = [I.avi_frames(d) for d in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(r) for r in read], pa.int64()), pa.array([int(sum(x[:, :, 0].astype(np.int64).sum() for x in r)) for r in read], pa.int64())], ["episode", "frame_start", "frames", "total"])

    return _clips(spark, sf, "avi").select("episode", "frame_start", "data").mapInArrow(run, "episode long, frame_start long, frames long, total long")


@query(f"with {CL} select episode, frame_start, count(*) as frames, least(4, count(*)) * 36 as width, ((count(*) + 3) // 4) * 36 as height, cast(sum(list_sum(c)) * 16 as bigint) + 255 * (least(4, count(*)) * ((count(*) + 3) // 4) * 1296 - count(*) * 1024) as total from cl group by 1, 2")
def clip_boards(spark, sf):
    """Boards of four images a row, the finding's own with a red frame (255 in the first channel, as the white around the others)."""

    def run(batches):
        for batch in batches:
            read = [I.decode(d) for d in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), *(pa.array([f(x) for x in read], pa.int64()) for f in (lambda x: x.shape[1], lambda x: x.shape[0], lambda x: int(x[:, :, 0].astype(np.int64).sum())))], ["episode", "frame_start", "frames", "width", "height", "total"])

    return _clips(spark, sf, "board").mapInArrow(run, "episode long, frame_start long, frames long, width long, height long, total long")


@query(f"with {CL} select episode, frame_start, count(*) as frames, 32 as width, 32 as height from cl group by 1, 2")
def clip_gifs(spark, sf):
    """GIF clips; the number of their image blocks and their size."""

    def run(batches):
        for batch in batches:
            data = batch.column(2).to_pylist()
            size = [(int.from_bytes(d[6:8], "little"), int.from_bytes(d[8:10], "little")) for d in data]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([d.count(b"\x21\xf9\x04\0") for d in data], pa.int64()), pa.array([w for w, _ in size], pa.int32()), pa.array([h for _, h in size], pa.int32())], ["episode", "frame_start", "frames", "width", "height"])

    return _clips(spark, sf, "gif").select("episode", "frame_start", "data").mapInArrow(run, "episode long, frame_start long, frames long, width int, height int")
