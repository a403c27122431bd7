"""Fault injection as transforms of ordered rows, each with the span it touched.

Every mutator takes a DataFrame with ``keys`` and ``seq`` (0-based) and returns the same columns. Where a value is
replaced the rows don't move; spans start at ``segment_start``. ``REGISTRY`` names the 23 single issues."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framegauge.operators.signals import ordered


def segment_start(n: Column, length: int, anchor: float = 0.35) -> Column:
    """min(max(1, floor(n * anchor)), n - length - 1)."""
    return F.least(F.greatest(F.lit(1), F.floor(n * anchor)), n - length - 1).cast("long")


def with_segment(df: DataFrame, keys: list[str], length: int, anchor: float = 0.35) -> DataFrame:
    """Adds ``_n``, ``_from`` and ``_hit`` (the row lies in the segment)."""
    d = df.withColumn("_n", F.count("*").over(Window.partitionBy(*keys)))
    d = d.withColumn("_from", segment_start(F.col("_n"), length, anchor))
    return d.withColumn("_hit", F.col("seq").between(F.col("_from"), F.col("_from") + length - 1))


def _done(d: DataFrame, df: DataFrame) -> DataFrame:
    return d.select(*df.columns)


def replace_value(df: DataFrame, keys: list[str], column: str, value: Column, length: int = 4) -> DataFrame:
    """A value over a segment."""
    return _done(with_segment(df, keys, length).withColumn(column, F.when(F.col("_hit"), value).otherwise(F.col(column))), df)


def replace_element(df: DataFrame, keys: list[str], column: str, value: Column, length: int = 4, place: int = 0) -> DataFrame:
    """One element of a vector over a segment."""
    new = F.transform(F.col(column), lambda x, i: F.when(i == place, value).otherwise(x))
    return replace_value(df, keys, column, new.cast(df.schema[column].dataType), length)


def drop_last_element(df: DataFrame, keys: list[str], column: str, length: int = 1) -> DataFrame:
    """I7."""
    return replace_value(df, keys, column, F.slice(F.col(column), 1, F.greatest(F.size(column) - 1, F.lit(0))), length)


def step_back(df: DataFrame, keys: list[str], column: str = "timestamp", by: float = 0.1) -> DataFrame:
    """I8: one value lies before its predecessor."""
    d = with_segment(df, keys, 1)
    back = (F.lag(column).over(ordered(keys, "seq")) - by).cast(df.schema[column].dataType)
    return _done(d.withColumn(column, F.when(F.col("_hit"), back).otherwise(F.col(column))), df)


def duplicate_index(df: DataFrame, keys: list[str], column: str = "frame_index") -> DataFrame:
    """I9."""
    d = with_segment(df, keys, 1)
    return _done(d.withColumn(column, F.when(F.col("_hit"), F.lag(column).over(ordered(keys, "seq"))).otherwise(F.col(column))), df)


def skip_index(df: DataFrame, keys: list[str], column: str = "frame_index", by: int = 3) -> DataFrame:
    """Everything from the segment on is shifted."""
    d = with_segment(df, keys, 1)
    return _done(d.withColumn(column, F.when(F.col("seq") >= F.col("_from"), F.col(column) + by).otherwise(F.col(column))), df)


def swap_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Two neighbours change places."""
    d = with_segment(df, keys, 2)
    seq = F.when(F.col("seq") == F.col("_from"), F.col("seq") + 1).when(F.col("seq") == F.col("_from") + 1, F.col("seq") - 1).otherwise(F.col("seq"))
    return _done(d.withColumn("seq", seq), df)


def repeat_previous(df: DataFrame, keys: list[str], column: str, length: int) -> DataFrame:
    """The value before the segment fills it."""
    d = with_segment(df, keys, length)
    held = F.max_by(F.when(F.col("seq") == F.col("_from") - 1, F.col(column)), F.when(F.col("seq") == F.col("_from") - 1, F.col("seq"))).over(Window.partitionBy(*keys))
    return _done(d.withColumn(column, F.when(F.col("_hit"), held).otherwise(F.col(column))), df)


def jump_ahead(df: DataFrame, keys: list[str], column: str, length: int, ahead: int) -> DataFrame:
    """The segment shows what comes ``ahead`` rows later; at the end, the last row."""
    d = with_segment(df, keys, length, 0.25)
    later = F.coalesce(F.lead(column, ahead).over(ordered(keys, "seq")), F.last(column).over(ordered(keys, "seq").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return _done(d.withColumn(column, F.when(F.col("_hit"), later).otherwise(F.col(column))), df)


def delay(df: DataFrame, keys: list[str], columns: list[str], by: int) -> DataFrame:
    """Columns come ``by`` rows late; the head holds the first value."""
    w = ordered(keys, "seq")
    first = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumns({c: F.when(F.col("seq") >= by, F.lag(c, by).over(w)).otherwise(F.first(c).over(first)) for c in columns}).select(*df.columns)


def jitter(df: DataFrame, keys: list[str], column: str, length: int = 60, share: float = 0.22) -> DataFrame:
    """An alternating offset; amplitude max(share * (p95 - p05), 2 share * deviation, 0.02) of the column or of each element."""
    vector = df.schema[column].dataType.typeName() == "array"
    w = Window.partitionBy(*keys)
    d = with_segment(df, keys, length, 0.3)
    sign = F.when((F.col("seq") - F.col("_from")) % 2 == 0, 1.0).otherwise(-1.0)
    amp = lambda x: F.greatest(share * (F.percentile(x, F.lit(0.95)).over(w) - F.percentile(x, F.lit(0.05)).over(w)), 2 * share * F.stddev_pop(x).over(w), F.lit(0.02))
    if not vector:
        return _done(d.withColumn("_amp", amp(F.col(column))).withColumn(column, F.when(F.col("_hit"), F.col(column) + sign * F.col("_amp")).otherwise(F.col(column))), df)
    first = F.element_at(F.col(column).cast("array<double>"), 1)
    d = d.withColumn("_amp", amp(first))
    new = F.transform(F.col(column), lambda x: x + sign * F.col("_amp")).cast(df.schema[column].dataType)
    return _done(d.withColumn(column, F.when(F.col("_hit"), new).otherwise(F.col(column))), df)


@dataclass(frozen=True)
class Issue:
    """A single issue: its mutator, the family that should report it, and how it is classed."""

    name: str
    target: str
    family: str
    apply: Callable[[DataFrame, list[str]], DataFrame]
    temporal: bool = False
    hard: bool = True


def registry(black: bytes, white: bytes, noise: bytes, images: tuple[str, ...] = ("image", "left_wrist_image", "right_wrist_image"), fps: float = 10.0) -> list[Issue]:
    """The 23 single issues; the images to show come from the caller, encoded."""
    view = images[0]
    shown = lambda b: F.struct(F.lit(b).alias("bytes"), F.lit(None).cast("string").alias("path"))
    put = lambda b, n=12: lambda d, k: replace_value(d, k, view, shown(b).cast(d.schema[view].dataType), n)
    nan, inf = F.lit(float("nan")), F.lit(float("inf"))
    return [
        Issue("black_screen", view, "vision_single", put(black)),
        Issue("white_screen", view, "vision_single", put(white)),
        Issue("flower_screen", view, "vision_single", put(noise)),
        Issue("invalid_image_bytes", view, "vision_illegal", put(b"not an image", 4)),
        Issue("state_nan", "state", "state_illegal", lambda d, k: replace_element(d, k, "state", nan)),
        Issue("state_inf", "state", "state_illegal", lambda d, k: replace_element(d, k, "state", inf)),
        Issue("action_nan", "actions", "state_illegal", lambda d, k: replace_element(d, k, "actions", nan)),
        Issue("state_wrong_dim", "state", "state_illegal", lambda d, k: drop_last_element(d, k, "state")),
        Issue("timestamp_non_monotonic", "timestamp", "temporal_illegal", lambda d, k: step_back(d, k, by=1 / fps), True),
        Issue("frame_index_duplicate", "frame_index", "temporal_illegal", duplicate_index, True),
        Issue("frame_index_skip", "frame_index", "temporal_illegal", skip_index, True),
        Issue("row_reorder", "row", "temporal_illegal", swap_rows, True),
        Issue("vision_drop_small", view, "vision_temporal", lambda d, k: repeat_previous(d, k, view, 4), True, False),
        Issue("vision_drop_large", view, "vision_temporal", lambda d, k: repeat_previous(d, k, view, 30), True, False),
        Issue("vision_jump_small", view, "vision_temporal", lambda d, k: jump_ahead(d, k, view, 4, 12), True, False),
        Issue("vision_jump_large", view, "vision_temporal", lambda d, k: jump_ahead(d, k, view, 30, 24), True, False),
        Issue("state_sensor_delay_small", "state", "vision_state_temporal", lambda d, k: delay(d, k, ["state"], 3), True, False),
        Issue("state_sensor_delay_large", "state", "vision_state_temporal", lambda d, k: delay(d, k, ["state"], 10), True, False),
        Issue("video_signal_delay_small", "image", "vision_state_temporal", lambda d, k: delay(d, k, list(images), 3), True, False),
        Issue("video_signal_delay_large", "image", "vision_state_temporal", lambda d, k: delay(d, k, list(images), 10), True, False),
        Issue("action_response_delay", "actions", "state_temporal", lambda d, k: delay(d, k, ["actions"], 5), True, False),
        Issue("state_high_freq_jitter", "state", "state_temporal", lambda d, k: jitter(d, k, "state"), True, False),
        Issue("action_high_freq_jitter", "actions", "state_temporal", lambda d, k: jitter(d, k, "actions"), True, False),
    ]


def generate_cases(df: DataFrame, keys: list[str], issues: list[Issue], episode: str = "episode") -> DataFrame:
    """Every issue applied to the rows, one case each, with ``case`` and a renumbered episode."""
    out = None
    for i, issue in enumerate(issues):
        case = issue.apply(df, keys).withColumn("case", F.lit(issue.name)).withColumn(episode, F.lit(i).cast(df.schema[episode].dataType))
        out = case if out is None else out.unionByName(case)
    return out


def changed_spans(before: DataFrame, after: DataFrame, keys: list[str], column: str) -> DataFrame:
    """keys, start, end: the rows whose value differs, as evidence of an injection."""
    b = before.select(*keys, "seq", F.col(column).alias("_was"))
    d = after.select(*keys, "seq", column).join(b, [*keys, "seq"], "full").where(~F.col(column).eqNullSafe(F.col("_was")))
    return d.groupBy(*keys).agg(F.min("seq").alias("start"), F.max("seq").alias("end"), F.count("*").alias("n"))


def repair(case: DataFrame, source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows of a case get the source's values back where the source has them."""
    s = source.select(*keys, "seq", *(F.col(c).alias(f"_s_{c}") for c in columns))
    d = case.join(s.withColumn("_there", F.lit(True)), [*keys, "seq"], "left")
    return d.withColumns({c: F.when(F.col("_there"), F.col(f"_s_{c}")).otherwise(F.col(c)) for c in columns}).select(*case.columns)


def four_defects(df: DataFrame, image: str, shown, timestamp: str = "timestamp", state: str = "state") -> DataFrame:
    """A late timestamp at row 50, a jump of the first state element at 80, an image at 100, images held from 120 to 129."""
    w = ordered([c for c in ("episode",) if c in df.columns], "seq")
    late = (F.lag(timestamp).over(w) + 0.8).cast(df.schema[timestamp].dataType)
    moved = F.transform(F.col(state), lambda x, i: F.when(i == 0, x + 5).otherwise(x)).cast(df.schema[state].dataType)
    held = F.last(F.when(F.col("seq") < 120, F.col(image)), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    images = F.when(F.col("seq") == 100, shown).when(F.col("seq").between(120, 129), held).otherwise(F.col(image))
    return df.withColumns({timestamp: F.when(F.col("seq") == 50, late).otherwise(F.col(timestamp)), state: F.when(F.col("seq") == 80, moved).otherwise(F.col(state)), image: images})
