"""Detection on streams: frozen reference statistics joined to live rows, session runs, and stateful jump detection."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from framegauge.functions.scalars import upper_outlier_score


def outliers(stream: DataFrame, stats: DataFrame, keys: list[str], value: str, least: float = 0.35) -> DataFrame:
    """Rows whose value lies above the reference: a stream-static join; ``stats`` has keys and the struct ``s``."""
    d = stream.join(stats, keys, "left").withColumn("score", upper_outlier_score(value, F.col("s")))
    return d.where(F.col("score") >= least).drop("s")


def session_runs(stream: DataFrame, keys: list[str], time: str, gap: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Runs of rows no more than ``gap`` apart: islands with a fixed gap as session windows; late rows within the watermark join their run."""
    g = stream.withWatermark(time, late).groupBy(*keys, F.session_window(time, gap).alias("w")).agg(F.count("*").alias("n"))
    return g.select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def rolling_stats(stream: DataFrame, keys: list[str], time: str, value: str, window: str = "10 minutes", slide: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Count, mean and extremes in sliding windows."""
    g = stream.withWatermark(time, late).groupBy(*keys, F.window(time, window, slide).alias("w"))
    return g.agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max")).select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "mean", "min", "max")


def index_faults(stream: DataFrame, key: str, index: str, idle: int | None = None) -> DataFrame:
    """Repeated, skipped and late indices as they arrive, by key: (key, previous, current, issue_type).

    The state is one number per key. With ``idle`` it is given up when a key was idle for so many milliseconds, and its next
    row begins anew; such a stream never ends by itself, also where it is to read what is there and stop. A row older than what was seen is a finding of its own, not dropped."""

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = state.get[0] if state.exists else None
        out = []
        for pdf in batches:
            for i in pdf[index]:
                if last is not None and i != last + 1:
                    out.append((k[0], last, int(i), "duplicate_frame_index" if i == last else "frame_index_gap_or_reorder"))
                last = int(i)
        if last is not None:
            state.update((last,))
            if idle:
                state.setTimeoutDuration(idle)
        yield pd.DataFrame(out, columns=["key", "previous", "current", "issue_type"])

    kind = stream.schema[key].dataType.simpleString()
    return stream.groupBy(key).applyInPandasWithState(step, f"key {kind}, previous long, current long, issue_type string", "last long", "append", GroupStateTimeout.ProcessingTimeTimeout if idle else GroupStateTimeout.NoTimeout)
