import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from framegauge.operators import injection as J
from framegauge.operators import lag, sampling, signals, vision
from framegauge.operators.islands import equal_runs, islands, merge_findings, span_iou
from framegauge.operators.statistics import FIELDS, ordered_quantiles, robust_stats, scoped_stats, with_baseline


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.integers(0, 60), min_size=1), st.integers(1, 3), st.integers(1, 5))
def test_islands_do_not_depend_on_partitions(spark, values, gap, parts):
    want, run = [], None
    for v in sorted(values):
        if run and v - run[1] <= gap:
            run[1], run[2] = v, run[2] + 1
        else:
            run = [v, v, 1]
            want.append(run)
    df = spark.createDataFrame([("k", v) for v in values], "k string, i long").repartition(parts)
    got = islands(df, ["k"], "i", gap).collect()
    assert sorted([r.start, r.end, r.n] for r in got) == want


def test_equal_runs(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(["a", "a", None, None, "b", "a", "a", "a"])], "seq long, v string").withColumn("k", F.lit(1))
    assert sorted((r.start, r.end, r.v) for r in equal_runs(df, ["k"], "seq", "v").collect()) == [(0, 1, "a"), (4, 4, "b"), (5, 7, "a")]


def test_merging_folds_penalties_in_order(spark):
    rows = [("a", "1", 0, 4, 50.0, 5.0, "疑似异常", 1, "x"), ("a", "2", 6, 7, 70.0, 4.0, "高置信异常", 1, "y"), ("a", "3", 20, 22, 10.0, 1.0, "疑似异常", 1, "z"), ("a", "4", None, None, 10.0, 1.0, "确定异常", 1, "w"), ("b", "5", 7, 3, 10.0, 14.9, "确定异常", 1, "v"), ("b", "6", 8, 8, 10.0, 9.0, "高置信异常", 1, "u")]
    df = spark.createDataFrame(rows, "k string, finding_id string, frame_start long, frame_end long, severity double, penalty double, confidence string, merged_count long, evidence string")
    got = sorted((r.k, -1 if r.frame_start is None else r.frame_start, -1 if r.frame_end is None else r.frame_end, r.severity, r.penalty, r.confidence, r.merged_count, r.evidence) for r in merge_findings(df, ["k"], F.lit(15.0)).collect())
    assert got == [("a", -1, -1, 10.0, 1.0, "确定异常", 1, "w"), ("a", 0, 7, 70.0, 6.4, "高置信异常", 2, "x"), ("a", 20, 22, 10.0, 1.0, "疑似异常", 1, "z"), ("b", 7, 3, 10.0, 14.9, "确定异常", 1, "v"), ("b", 8, 8, 10.0, 9.0, "高置信异常", 1, "u")]


@pytest.mark.parametrize(("a", "b", "want"), [((0, 9), (5, 14), 1 / 3), ((None, None), (None, None), 1.0), ((1, 2), (None, None), 0.0), ((3, 3), (3, 3), 1.0)])
def test_iou(spark, a, b, want):
    lit = lambda x: F.lit(x).cast("long")
    assert abs(spark.range(1).select(span_iou(lit(a[0]), lit(a[1]), lit(b[0]), lit(b[1])).alias("x")).first().x - want) < 1e-12


@pytest.mark.parametrize("gather", [1 << 40, 0])
def test_robust_stats_like_numpy(spark, gather):
    rng = np.random.default_rng(5)
    data = {"a": rng.normal(size=101), "b": np.array([3.0, 3.0, 4.0]), None: np.array([7.0])}
    rows = [(k, float(v)) for k, x in data.items() for v in x] + [("a", float("nan")), ("a", float("inf")), ("b", None)]
    got = {r.k: r for r in robust_stats(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", gather).collect()}
    for k, x in data.items():
        want = dict(count=len(x), median=np.median(x), mad=np.median(abs(x - np.median(x))), mean=x.mean(), std=x.std(), min=x.min(), max=x.max(), **{f"p{q:02d}": np.quantile(x, q / 100) for q in (1, 5, 25, 75, 95, 99)})
        assert all(math.isclose(got[k][f], want[f], abs_tol=1e-12) for f in FIELDS), k
    assert ordered_quantiles(spark.createDataFrame([(float(i),) for i in range(11)], "v double"), [], "v", {"q": 0.25}).first().q == 2.5


def test_lookup_falls_back(spark):
    rows = [(1, "c", float(i)) for i in range(6)] + [(2, "c", 100.0), (None, "c", 3.0)]
    stats = scoped_stats(spark.createDataFrame(rows, "task long, part string, v double"), ["part"], "task", "v")
    asked = spark.createDataFrame([(1, "c"), (2, "c"), (9, "c"), (None, "c"), (1, "new")], "task long, part string")
    got = {(r.task, r.part): r.s["count"] if r.s else None for r in with_baseline(asked, stats, ["part"], "task").collect()}
    assert got == {(1, "c"): 6, (2, "c"): 8, (9, "c"): 8, (None, "c"): 8, (1, "new"): None}


def series(spark, a, b):
    return spark.createDataFrame([(1, i, float(x), float(y)) for i, (x, y) in enumerate(zip(a, b, strict=True))], "episode long, seq long, a double, b double")


def test_lag_is_found(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=60)
    df = series(spark, np.roll(x, 2), x)
    r = lag.lag_profile(df, ["episode"]).first()
    assert (r.status, r.best_lag) == ("ok", 2) and r.best_corr > 0.9
    s = lag.lag_stability(df, ["episode"]).first()
    assert (s.status, s.window_count, s.lag_median) == ("ok", 8, 2.0)
    assert lag.identifiable_lag(df, ["episode"]).first().identifiable == "ok"
    assert lag.best_lag(df, ["episode"]).first().best_lag == 2
    flat = lag.lag_profile(series(spark, np.ones(20), x[:20]), ["episode"]).first()
    assert (flat.status, flat.reason, flat.best_lag) == ("unavailable", "low_motion_excitation", None)


def test_coupling_of_a_square_with_itself(spark):
    x = [i * i for i in range(32)]
    r = lag.coupling(series(spark, x, x), ["episode"], "a", "b", 3).first()
    assert r.status == "ok" and r.best_lag == 0 and r.best_abs_correlation > 0.99 and r.sample_count == 32
    assert lag.coupling(series(spark, x[:8], x[:8]), ["episode"], "a", "b", 3).count() == 0


def test_oscillation_and_ramp(spark):
    ramp = [(1, i, [i * 0.0025, 0.0, 0.0]) for i in range(40)]
    shake = [(2, i, [0.02 if i % 2 else -0.02, 0.0, 0.0]) for i in range(40)]
    d = signals.oscillation_windows(spark.createDataFrame(ramp + shake, "episode long, seq long, pos array<double>"), ["episode"], min_path=1e-6)
    got = d.collect()
    assert {r.episode for r in got} == {2} and len(got) == 30 and {r.direction_reversals for r in got} == {9}


def test_phases(spark):
    v = [0.01] * 10 + [5.0] * 12 + [0.02] * 8
    s = "named_struct('count', 50L, 'median', 1.0D, 'mad', 0.1D, 'p05', 0.1D, 'p95', 3.0D, 'max', 2.0D)"
    df = spark.createDataFrame([(1, i, x) for i, x in enumerate(v)], "episode long, seq long, delta double").withColumn("s", F.expr(s))
    got = signals.phase_segments(signals.phase_labels(df, ["episode"]), ["episode"]).collect()
    assert sorted((r.phase, r.transition_start, r.transition_end) for r in got) == [("active", 10, 21), ("end", 22, 29), ("start", 0, 9)]
    strict = signals.phase_labels(df, ["episode"], margin=3.0)
    assert {r.phase_status for r in strict.collect()} == {"reference_active_window_missing"}


def test_mutators_keep_rows_and_report_spans(spark):
    df = spark.createDataFrame([(e, i, float(i + 1), [float(i), 1.0]) for e in (1, 2) for i in range(100)], "episode long, seq long, x double, state array<double>")
    k = ["episode"]
    span = lambda d, c="x": sorted((r.episode, r.start, r.end, r.n) for r in J.changed_spans(df, d, k, c).collect())
    assert span(J.replace_value(df, k, "x", F.lit(-1.0))) == [(1, 35, 38, 4), (2, 35, 38, 4)]
    assert span(J.repeat_previous(df, k, "x", 30)) == [(1, 35, 64, 30), (2, 35, 64, 30)]
    assert span(J.delay(df, k, ["x"], 3)) == [(1, 1, 99, 99), (2, 1, 99, 99)]
    assert span(J.skip_index(df, k, "x"))[0] == (1, 35, 99, 65)
    assert span(J.jitter(df, k, "state", 20), "state")[0][3] == 20
    assert span(J.drop_last_element(df, k, "state"), "state")[0] == (1, 35, 35, 1)
    broken = J.replace_element(df, k, "state", F.lit(float("nan")))
    assert span(J.repair(broken, df, k, ["state"]), "state") == [] and span(broken, "state")[0] == (1, 35, 38, 4)
    assert J.swap_rows(df, k).count() == 200


def test_samples(spark):
    df = spark.createDataFrame([(1, i) for i in range(20)], "episode long, seq long")
    assert sorted(r.seq for r in sampling.even_sample(df, ["episode"], 8).collect()) == [0, 2, 5, 8, 10, 13, 16, 19]
    assert sampling.stride_sample(df, ["episode"], 30).count() == 20 and sampling.first_rows(df, 3).count() == 3


def test_bimanual_drift(spark):
    rng = random.Random(1)
    rows = [(1, i, [0.0] * 3 + [1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0] + [0.4 + (0.3 if i == 20 else 0.0), 0.0, 0.0] + [1.0, 0.0, 0.0, 0.0, 1.0, 0.0] + [rng.random()]) for i in range(32)]
    d = signals.bimanual(spark.createDataFrame(rows, "episode long, seq long, state array<double>"), ["episode"]).collect()
    assert all(abs(r.distance - 0.4) < 1e-9 and abs(r.drift) < 1e-9 for r in d if r.seq != 20) and abs(d[20].drift - 0.3) < 1e-9


def test_view_pairs_of_many_views(spark):
    """Every pair of a row with more than 1001 views."""
    df = spark.range(1003).select(F.lit(1).alias("episode"), F.col("id").alias("view"), F.col("id").alias("value"))
    r = vision.view_pairs(df, ["episode"]).agg(F.count("*").alias("n"), F.count_distinct("view_a", "view_b").alias("d"), F.max(F.col("view_b") - F.col("view_a")).alias("far")).first()
    assert (r.n, r.d, r.far) == (1003 * 1002 // 2, 1003 * 1002 // 2, 1002)


def test_written_tables_can_be_discarded(spark):
    from framegauge.functions import storage

    t = storage.written(spark.range(100).repartition(50), "some", per_core=2)
    files = spark.read.format("binaryFile").load(t._framegauge_path).count()
    assert t.count() == 100 and files <= 2 * spark.sparkContext.defaultParallelism + 1
    storage.discard(t, None, spark.range(3))
    fs, where = storage._file_system(spark, t._framegauge_path)
    assert not fs.exists(where)
    path = f"{storage.shared_dir(spark)}/one/small.bin"
    storage.write_file(spark, path, bytes(range(256)))
    assert bytes(spark.read.format("binaryFile").load(path).first().content) == bytes(range(256))


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from framegauge.functions import storage

    class Bare:
        conf = SimpleNamespace(get=lambda *a: None)
        sparkContext = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)

    with pytest.raises(ValueError):
        storage.shared_dir(Bare())


def test_statistics_leave_unfit_episodes_out(spark):
    from framegauge.operators import geometry

    good, odd = [1.0] * 20, [1.0] * 19 + [float("nan")]
    rows = [(0, good), (0, good), (1, good), (1, good[:19]), (2, good), (2, odd), (3, None), (3, good)]
    d = spark.createDataFrame(rows, "episode long, state array<double>")
    assert sorted(r.episode for r in geometry.unfit_for_reference(d).collect()) == [1, 2, 3]
    assert sorted(r.episode for r in geometry.unfit_for_reference(d.select("episode")).collect()) == [0, 1, 2, 3]


def test_made_pictures_are_dealt_out(spark):
    """One episode of short rows isn't one task of images."""
    from framegauge.plans.catalog_images import pictures

    rows = spark.range(300).select(F.lit(1).cast("long").alias("episode"), F.lit(None).cast("long").alias("task"), F.col("id").alias("seq"), F.col("id").alias("frame"), F.array_repeat(F.col("id") % 256, 64).alias("cells"))
    counts = [r["count"] for r in pictures(signals.numbered(rows.drop("seq"), ["episode"], "frame")).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(counts) == 300 and len(counts) > 8 and max(counts) < 60


def test_overlaps_make_sampled_rows_only(spark):
    from framegauge.plans.catalog_images import _scenes

    def scene(x, view, frame):
        if frame % 4:
            raise AssertionError("a picture that nothing looks at")
        return np.full((48, 48, 3), frame)

    rows = spark.range(120).select(F.lit(1).cast("long").alias("episode"), F.lit(None).cast("long").alias("task"), F.col("id").alias("seq"), F.col("id").alias("frame")).union(spark.sql("select 2L, null, id, 4 * id from range(3)"))
    got = vision.sample_overlaps(_scenes(vision.sampled_rows(rows), views=("image", "wrist"), scene=scene), ["image", "wrist"]).collect()
    assert [(r.episode, r.sampled_frames, r.status) for r in got] == [(1, 30, "unavailable")]


@pytest.mark.parametrize("block", [1, 3, 64])
def test_tracks_go_on_across_blocks(spark, block):
    """Numbers that miss some, two tasks and unreadable images: as one pass over each in order."""
    from framegauge.functions import tracks
    from framegauge.functions.images import encode_png
    from framegauge.plans.catalog_images import _texture

    image = lambda s: np.stack([np.roll(_texture(1), s, 1).astype(np.uint8)] * 3, axis=2)
    rows, want, before = [], {}, {}
    for n, (task, seq) in enumerate([(0, 0), (0, 1), (0, 2), (0, 5), (0, 6), (0, 7), (0, 130), (0, 131), (1, 0), (1, 1), (1, 4)]):
        x = None if seq == 6 else image(n * n % 5)
        rows.append((7, task, seq, n, (None if x is None else bytearray(encode_png(x)),)))
        pair = before.get(task) is not None and x is not None
        want[task, seq] = tracks.track_motion(before[task][:, :, 0], x[:, :, 0])["motion"] if pair else None
        before = {task: x}
    df = spark.createDataFrame(rows, "episode long, task long, seq long, frame long, image struct<bytes:binary>").repartition(3)
    got = {(r.task, r.seq): r.motion for r in vision.track_motion(df, "image", block).collect()}
    assert got.keys() == want.keys() and all((got[k] is None) == (want[k] is None) and (want[k] is None or abs(got[k] - want[k]) < 1e-6) for k in want)
