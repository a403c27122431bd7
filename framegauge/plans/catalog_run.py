"""Queries of injections and of the run's parts, on vector episodes: 20 numbers are the state, 64 the picture."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framegauge.functions import images as I
from framegauge.functions.storage import written
from framegauge.operators import injection as J
from framegauge.operators import vision
from framegauge.operators.findings import counts_by, of_types
from framegauge.plans import pipeline
from framegauge.plans.catalog import DV, EM, EV, NO, PROFILE, SEG, _inj, query
from framegauge.plans.catalog_images import GRID, PX, pictures, vectors
from framegauge.sources import tables as T

VIEWS3 = ("image", "left_wrist_image", "right_wrist_image")


@lru_cache
def _shown() -> tuple[bytes, bytes, bytes]:
    return tuple(I.encode_png(x) for x in (I.solid(0), I.solid(255), I.flower(1)))


def frames(spark, sf) -> DataFrame:
    """Whole episodes: pictures in three views, states, actions, timestamps and indices."""
    p = pictures(vectors(spark, sf), views=VIEWS3)
    e = T.embeddings(spark, sf).select("frame", F.col("state").cast("array<float>").alias("state"))
    d = p.join(e, "frame").withColumn("actions", F.transform("state", lambda x: (x * 2).cast("float")))
    return d.withColumns({"timestamp": (F.col("seq") / 10).cast("float"), "frame_index": F.col("seq"), "episode_index": F.col("episode"), "index": F.col("frame"), "task_index": F.lit(0).cast("long")}).withColumn("task", F.col("task_index"))


# ---- injections ------------------------------------------------------------------------------------------------------


@query(f"with {EV}, n as (select episode, count(*) as n from ev group by 1), l as (select unnest([1, 4, 12, 30, 60]) as len) select episode, len, least(greatest(1, cast(floor(n * 0.35) as bigint)), n - len - 1) as middle, least(greatest(1, cast(floor(n * 0.25) as bigint)), n - len - 1) as early from n, l")
def injection_segments(spark, sf):
    """I2."""
    n = T.events(spark, sf).groupBy("episode").agg(F.count("*").alias("n")).withColumn("len", F.explode(F.array(*map(F.lit, (1, 4, 12, 30, 60)))))
    start = lambda anchor: F.least(F.greatest(F.lit(1), F.floor(F.col("n") * anchor)), F.col("n") - F.col("len") - 1)
    own = F.lit(None).cast("long")
    for k in (1, 4, 12, 30, 60):
        own = F.when(F.col("len") == k, J.segment_start(F.col("n"), k)).otherwise(own)
    return n.select("episode", "len", own.alias("middle"), start(0.25).cast("long").alias("early"))


def _seg(length: int, anchor: str = "0.35") -> str:
    return SEG.format(len=length).replace("0.35", anchor)


# name -> target, first and last changed row, by the rules of the mutators
_CASES = {
    **{k: ("image", _seg(12), f"{_seg(12)} + 11") for k in ("black_screen", "white_screen", "flower_screen")},
    "invalid_image_bytes": ("image", _seg(4), f"{_seg(4)} + 3"), **{k: (c, _seg(4), f"{_seg(4)} + 3") for k, c in (("state_nan", "state"), ("state_inf", "state"), ("action_nan", "actions"))},
    "state_wrong_dim": ("state", _seg(1), _seg(1)), "timestamp_non_monotonic": ("timestamp", _seg(1), _seg(1)), "frame_index_duplicate": ("frame_index", _seg(1), _seg(1)), "frame_index_skip": ("frame_index", _seg(1), "n - 1"),
    "row_reorder": ("frame_index", _seg(2), f"{_seg(2)} + 1"), "vision_drop_small": ("image", _seg(4), f"{_seg(4)} + 3"), "vision_drop_large": ("image", f"greatest(0, {_seg(30)})", f"{_seg(30)} + 29"),
    "vision_jump_small": ("image", _seg(4, "0.25"), f"{_seg(4, '0.25')} + 3"), "vision_jump_large": ("image", f"greatest(0, {_seg(30, '0.25')})", f"least(n - 2, {_seg(30, '0.25')} + 29)"),
    **{k: (c, "1", "n - 1") for k, c in (("state_sensor_delay_small", "state"), ("state_sensor_delay_large", "state"), ("video_signal_delay_small", "image"), ("video_signal_delay_large", "image"), ("action_response_delay", "actions"))},
    **{k: (c, f"greatest(0, {_seg(60, '0.3')})", f"{_seg(60, '0.3')} + 59") for k, c in (("state_high_freq_jitter", "state"), ("action_high_freq_jitter", "actions"))},
}


@query("with c as (select label, count(*) as n from embeddings group by 1), e as (select arg_min(n, label) as n from c where n >= 5) " + " union all ".join(f"""select '{k}' as name, {a} as "start", {b} as "end" from e""" for k, (_, a, b) in _CASES.items()))
def injected_cases(spark, sf):
    """Every issue of the registry as a case of one source episode, the first with five rows or more, and the rows that it changed."""
    all_ = frames(spark, sf)
    first = all_.groupBy("episode").agg(F.count("*").alias("n")).where("n >= 5").agg(F.min("episode").alias("first"))
    e = written(all_.join(F.broadcast(first), F.col("episode") == F.col("first"), "left_semi"), "source")  # a single row
    cases = written(J.generate_cases(e, ["episode"], J.registry(*_shown(), VIEWS3)), "cases")
    out = None
    for column in sorted({c for c, *_ in _CASES.values()}):
        own = cases.where(F.col("case").isin([k for k, (c, *_) in _CASES.items() if c == column]))
        value = F.col(f"{column}.bytes") if column == "image" else F.col(column).cast("string")
        was = e.select("seq", value.alias("was"))
        d = own.select("case", "seq", value.alias("now")).join(was, "seq").where(~F.col("now").eqNullSafe(F.col("was")))
        d = d.groupBy(F.col("case").alias("name")).agg(F.min("seq").alias("start"), F.max("seq").alias("end"))
        out = d if out is None else out.union(d)
    return out


@query(f"with {PX}, n as (select episode, count(*) as n from px group by 1) select episode, 12 as black, 12 as white, 12 as flowers, 4 as unread, {_seg(12)} as first_black from n")
def injected_images(spark, sf):
    """Solid and flower frames and bytes that are no image, as the decoder sees them, in every episode."""
    p = pictures(vectors(spark, sf))
    black, white, noise = _shown()
    own = I.pixel_hash(I.decode(noise))
    shown = lambda b: F.struct(F.lit(b).alias("bytes"), F.lit(None).cast("string").alias("path"))
    out = None
    for name, data, n, test in (("black", black, 12, "black_fraction = 1"), ("white", white, 12, "white_fraction = 1"), ("flowers", noise, 12, f"pixel_hash = '{own}'"), ("unread", b"not an image", 4, "not decoded")):
        f = vision.image_features(J.replace_value(p, ["episode"], "image", shown(data), n), ["image"]).where(test)
        g = f.groupBy("episode").agg(F.count("*").cast("int").alias(name), *([F.min("seq").alias("first_black")] if name == "black" else []))
        out = g if out is None else out.join(g, "episode")
    return out


# ---- the run ---------------------------------------------------------------------------------------------------------


@query("select n_nationkey, greatest(11, n_nationkey) as jitter_window, greatest(1, n_nationkey - 3) as lag_step, greatest(11, n_nationkey * 2) as lag_window, least(0.95, greatest(0.05, n_nationkey / 10.0)) as jitter_efficiency, greatest(1.0, n_nationkey / 4.0) as jitter_path_factor, n_nationkey % 3 = 1 as refused from nation".replace("n_nationkey / 10.0", "n_nationkey / 10.0::double").replace("n_nationkey / 4.0", "n_nationkey / 4.0::double"))
def config_clamps(spark, sf):
    """Numbers are clamped, names outside their enum refused."""
    rows = []
    for r in T.table(spark, sf, "nation").collect():
        k = r.n_nationkey
        c = pipeline.Config(jitter_window=k, lag_step=k - 3, lag_window=2 * k, jitter_efficiency=k / 10, jitter_path_factor=k / 4).checked()
        try:
            pipeline.Config(rotation_layout="sideways" if k % 3 == 1 else "rows").checked()
            refused = False
        except ValueError:
            refused = True
        rows.append((k, c.jitter_window, c.lag_step, c.lag_window, float(c.jitter_efficiency), float(c.jitter_path_factor), refused))
    return spark.createDataFrame(rows, "n_nationkey int, jitter_window int, lag_step int, lag_window int, jitter_efficiency double, jitter_path_factor double, refused boolean")


@query("select * from (values ('same', true), ('missing', true)) t(target, refused)")
def run_guards(spark, sf):
    """A run on its own reference, and one on a folder without metadata."""
    rows = []
    for name, target, reference in (("same", "file:/x", "file:/x"), ("missing", sf, "file:/x")):
        try:
            pipeline.run(target, reference, spark)
            rows.append((name, False))
        except Exception:  # noqa: BLE001 - whatever refuses
            rows.append((name, True))
    return spark.createDataFrame(rows, "target string, refused boolean")


# every second episode: a repeated index, a step back in time
IX = f"{_inj(1)}, ix as (select episode, seq, frame, case when episode % 2 = 0 and seq = s then seq - 1 else seq end as fi, case when episode % 2 = 0 and seq = s then (seq - 1) / 10.0 - 0.1 else seq / 10.0 end as ts, case when seq = 3 and episode % 3 = 0 then 1 else 0 end as task from es), st as (select *, lead(fi) over w - fi as di, lead(frame) over w - frame as dg, lead(ts) over w - ts as dt from ix window w as (partition by episode order by seq))"


@query(f"""with {IX} select episode, issue_type, count(*) as n from (select episode, 'duplicate_frame_index' as issue_type from st where di = 0 union all select episode, 'frame_index_gap_or_reorder' from st where di not in (0, 1) union all select episode, 'global_index_gap_or_reorder' from st where dg <> 1
 union all select episode, 'timestamp_gap_or_reorder' from st where dt <= 0.01 or abs(dt - 0.1) > 0.036 union all select episode, 'task_index_inconsistent' from (select episode from st group by 1 having count(distinct task) > 1)) group by 1, 2""")
def inspected_indices(spark, sf):
    """X3, D6 to D11 together: index faults of events with a repeated index, a step back and a foreign task."""
    e = T.events(spark, sf).withColumns({"task": F.lit(0).cast("long"), "frame_index": F.col("seq"), "index": F.col("frame"), "timestamp": F.col("seq") / 10, "episode_index": F.col("episode"), "task_index": F.when((F.col("seq") == 3) & (F.col("episode") % 3 == 0), 1).otherwise(0)})
    even, odd = e.where("episode % 2 = 0"), e.where("episode % 2 <> 0")
    broken = J.duplicate_index(J.step_back(even, ["episode"]), ["episode"], "frame_index").unionByName(odd)
    parts = pipeline.inspect_indices(broken, pipeline.Config(fps=10.0))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("episode", "issue_type").agg(F.count("*").alias("n"))


def _low_dim(spark, sf) -> tuple[DataFrame, DataFrame]:
    """States, and the same with a jump of 50 in one row, a NaN and a huge number in others, by the episode's number."""
    e = T.embeddings(spark, sf).withColumn("task", F.lit(0).cast("long")).select("episode", "task", "seq", "frame", "state")
    kind = F.col("episode") % 4
    at = (F.col("seq") == 20)
    first = lambda x: F.transform("state", lambda v, i: F.when(i == 0, x(v)).otherwise(v))
    state = F.when(at & (kind == 0), first(lambda v: v + 50)).when(at & (kind == 1), first(lambda v: F.lit(float("nan")))).when(at & (kind == 2), first(lambda v: F.lit(3e6))).otherwise(F.col("state"))
    return e, e.withColumn("state", state)


@query(f"""with {EM}, k as (select distinct episode, episode % 4 as k from em) select episode, 'low_dim_fast_jump_active' as issue_type, 1 as n from k where k in (0, 2) union all select episode, 'low_dim_jitter_or_spike_active', 1 from k where k in (0, 2)
 union all select episode, 'non_finite_low_dim_value', 1 from k where k = 1 union all select episode, 'impossible_low_dim_magnitude', 1 from k where k = 2""")
def inspected_low_dim(spark, sf):
    """What the run says of a jump, a NaN and a huge number, against the untouched states."""
    plain, broken = _low_dim(spark, sf)
    cfg = pipeline.Config(views=())
    base = pipeline.fit_reference(plain, cfg)
    parts = pipeline.inspect_low_dim(broken, pipeline.features(broken, cfg), base, cfg)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("episode", "issue_type").agg(F.count("*").cast("int").alias("n"))


@query(f"""with {EM}, k as (select distinct episode, episode % 4 as k from em) select issue_type, count(*) as n from (select 'low_dim_fast_jump_active' as issue_type from k where k in (0, 2) union all select 'low_dim_jitter_or_spike_active' from k where k in (0, 2)
 union all select 'non_finite_low_dim_value' from k where k = 1 union all select 'impossible_low_dim_magnitude' from k where k = 2 union all select 'missing_required_column' from k, range(9) union all select 'missing_temporal_column' from k, range(5)) group by 1""")
def inspected_run(spark, sf):
    """The whole inspection of states without images and indices: merged findings by issue, those of the geometry left out."""
    plain, broken = _low_dim(spark, sf)
    cfg = pipeline.Config()
    base = pipeline.fit_reference(plain, cfg)
    names = ["low_dim_fast_jump_active", "low_dim_jitter_or_spike_active", "non_finite_low_dim_value", "impossible_low_dim_magnitude", "missing_required_column", "missing_temporal_column"]
    return counts_by(of_types(pipeline.inspect(broken, base, cfg).findings, *names), "issue_type")


WM = f"""{PX}, em as (select vec_id as frame, list_transform(embedding[1:20], lambda x: cast(x as double)) as state from embeddings), jo as (select px.*, state from px join em using (frame)),
gr as (select episode, frame, seq, {GRID} as g, state[1:3] as pos from jo), mo as (select episode, frame, seq, list_avg(list_transform(list_zip(g, lag(g) over v), lambda p: abs(p[1] - p[2]))) as a, 10 * {NO(DV('pos', 'lag(pos) over v'))} as b from gr window v as (partition by episode order by seq)),
sg as (select * from mo where seq > 0), lg as (select range - 5 as lag from range(11)), w as (select n.*, s.range * 5 as ws from (select *, count(*) over (partition by episode) as n, row_number() over (partition by episode order by seq) - 1 as place from sg) n, range(0, 200) s where n >= 11 and s.range * 5 <= seq and seq < s.range * 5 + greatest(11, least(21, n)) and s.range * 5 + greatest(11, least(21, n)) <= n),
w0 as (select *, 0 as ws from sg), {PROFILE.format(i=1, w="w")}, {PROFILE.format(i=0, w="w0")}, gs as (select episode, count(*) filter (ok) as valid, quantile_cont(lag, 0.5) filter (ok) as lm, mad(lag) filter (ok) as ld, quantile_cont(c1, 0.5) filter (ok) as cm from pf1 group by 1)"""


@query(f"""with {WM} select sg.episode, count(*) as n, round(sum(a), 4) as motion, round(sum(b), 4) as speed, any_value(case when pf0.ok and valid >= 3 and ld <= 1 and cm >= 0.35 then 'ok' else 'unavailable' end) as lag_gate, any_value(case when told then pf0.lag end) as lag
 from sg left join pf0 on pf0.episode = sg.episode left join gs on gs.episode = sg.episode group by 1 having count(*) >= 11""")
def wrist_moves(spark, sf):
    """The left arm's speed beside its wrist view's motion, and the lag gate that goes into the evidence."""
    v = pictures(vectors(spark, sf), views=("left_wrist_image",))
    d = v.join(T.embeddings(spark, sf).select("frame", "state"), "frame").withColumn("task", F.lit(0).cast("long"))
    cfg = pipeline.Config(views=("left_wrist_image",), height=32, width=32)
    m = pipeline.wrist_moves(pipeline.features(d, cfg), cfg)
    return m.groupBy("episode").agg(F.count("*").alias("n"), F.round(F.sum("motion"), 4).alias("motion"), F.round(F.sum("speed"), 4).alias("speed"), F.first("lag_gate").alias("lag_gate"), F.first("lag").alias("lag"))


