"""Windows around findings and what they hold; focus summaries of episodes; image summaries by view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framegauge.functions import images as I
from framegauge.operators.signals import ordered


def clip_windows(findings: DataFrame, spans: DataFrame, margin: int, key: str = "episode") -> DataFrame:
    """Each finding with clip_start and clip_end, ``margin`` frames wider and within the episode's first and last frame."""
    d = findings.join(spans.select(key, "first_frame", "last_frame"), key)
    return d.withColumns({"clip_start": F.greatest(F.col("first_frame"), F.col("frame_start") - margin), "clip_end": F.least(F.col("last_frame"), F.col("frame_end") + margin)}).drop("first_frame", "last_frame")


def clip_files(clips: DataFrame, frames: DataFrame, view: str, kind: str = "avi", fps: float = 10.0, columns: int = 4, key: str = "episode") -> DataFrame:
    """``(episode, frame_start, frames, data)``: the images of each clip as an AVI, a GIF or a PNG board on which the
    finding's own frames are marked. Images that can't be read or differ in size are left out; a clip without images has
    no file. A clip's images are one task's memory; ``clip_windows`` bounds their number."""
    r = frames.select(F.col(key).alias("_e"), F.col("frame").alias("_f"), F.col(f"{view}.bytes").alias("_bytes"))
    d = clips.select(key, "frame_start", "frame_end", "clip_start", "clip_end").distinct()
    d = d.join(r, (F.col(key) == F.col("_e")) & F.col("_f").between(F.col("clip_start"), F.col("clip_end"))).select(key, "frame_start", "frame_end", "_f", "_bytes")

    def run(k, rows):
        import pandas as pd

        images, marked = [], []
        for r in rows.sort_values("_f").itertuples(index=False):
            try:
                x = I.decode(r[4])
            except Exception:  # noqa: BLE001 - whatever is wrong with an image
                continue
            if not images or x.shape == images[0].shape:
                images.append(x)
                marked.append(r[1] <= r[3] <= r[2])
        if not images:
            return pd.DataFrame({key: [], "frame_start": [], "frames": [], "data": []})
        data = I.avi(images, fps) if kind == "avi" else I.gif(images, fps) if kind == "gif" else I.encode_png(I.board(images, columns, marked=marked))
        return pd.DataFrame({key: [k[0]], "frame_start": [k[1]], "frames": [len(images)], "data": [data]})

    return d.groupBy(key, "frame_start").applyInPandas(run, f"{key} long, frame_start long, frames long, data binary")


def clip_summary(clips: DataFrame, rows: DataFrame, value: str, key: str = "episode") -> DataFrame:
    """Frames, largest and median value in each clip. The episode is the join's key, the span a condition on top."""
    r = rows.select(F.col(key).alias("_e"), F.col("frame").alias("_f"), F.col(value).alias("_v"))
    d = clips.join(r, (F.col(key) == F.col("_e")) & F.col("_f").between(F.col("clip_start"), F.col("clip_end")))
    return d.groupBy(key, "frame_start", "clip_start", "clip_end").agg(F.count("*").alias("frames"), F.max("_v").alias("most"), F.percentile("_v", F.lit(0.5)).alias("median"))


def focus_summary(df: DataFrame, keys: list[str], signals: list[Column], action: str, seq: str = "seq") -> DataFrame:
    """Rows, mean and 95 % quantile of the mean of some signals, and how often an action repeats the one before."""
    combined = sum(signals[1:], signals[0]) / len(signals)
    d = df.withColumns({"_c": combined, "_same": F.col(action) == F.lag(action).over(ordered(keys, seq))})
    return d.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.avg("_c").alias("combined_mean"), F.percentile("_c", F.lit(0.95)).alias("combined_p95"), F.count(F.when(F.col("_same"), 1)).alias("repeated_actions"))


def view_summary(features: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """Median, least and largest of each metric."""
    return features.groupBy(*keys).agg(*(f(m).alias(f"{m}_{n}") for m in metrics for n, f in (("median", lambda c: F.percentile(c, F.lit(0.5))), ("min", F.min), ("max", F.max))))


def clip_stats(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """A3: 5 % and 95 % quantiles and median of the values, 0 where there are none."""
    q = F.percentile(value, F.array(F.lit(0.05), F.lit(0.5), F.lit(0.95)))
    g = df.groupBy(*keys).agg(q.alias("_q"))
    return g.select(*keys, *(F.coalesce(F.col("_q")[i], F.lit(0.0)).alias(n) for i, n in enumerate(("p05", "median", "p95"))))
