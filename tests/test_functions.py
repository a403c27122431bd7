import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from framegauge.functions import images as I
from framegauge.functions import scalars as S
from framegauge.functions import vectors as V


def one(spark, **cols):
    return spark.range(1).select(*(c.alias(k) for k, c in cols.items())).first()


def stats(count=10, median=1.0, mad=0.1, std=0.2, p01=0.2, p05=0.5, p95=2.0, p99=3.0, low=0.1, high=4.0):
    vals = dict(count=count, median=median, mad=mad, mean=median, std=std, p01=p01, p05=p05, p95=p95, p99=p99, min=low, max=high)
    return F.struct(*(F.lit(v).alias(k) for k, v in vals.items()))


def test_scores(spark):
    s, few = stats(), stats(count=4)
    r = one(spark, a=S.normalized_score(F.lit(3.0), 2, 4), b=S.normalized_score(F.lit(float("nan")), 2, 4), c=S.normalized_score(F.lit(9.0), 2, 4), z=S.robust_z(F.lit(2.0), s), up=S.upper_outlier_score(F.lit(2.2), s), low=S.lower_outlier_score(F.lit(2.2), s), none=S.upper_outlier_score(F.lit(99.0), few), g=S.guarded_z(F.lit(9.0), few), p=S.upper_tail_pressure(F.lit(3.0), s), q=S.lower_tail_pressure(F.lit(0.3), s), t=S.two_sided_tail_pressure(F.lit(9.0), s))
    assert (r.a, r.b, r.c) == (0.5, 0.0, 1.0) and abs(r.z - 5.0) < 1e-9 and abs(r.up - 0.5) < 1e-9 and r.low == 0.0
    assert r.none == r.g == 0.0 and abs(r.p - 0.5) < 1e-9 and abs(r.q - 0.5) < 1e-9 and r.t == 1.0


def test_thresholds(spark):
    r = one(spark, lo=S.lower_threshold(stats()), few=S.lower_threshold(stats(count=4)), hi=S.upper_threshold(stats()), v=S.stat_value(F.lit(float("inf")), 7.0))
    assert r.lo == 0.25 and r.few is None and r.hi == 4.5 and r.v == 7.0


@pytest.mark.parametrize(("run", "plain", "exact"), [(10, 0.0, 0.0), (30, 32.5, 42.5), (50, 45.0, 55.0), (75, 62.5, 70.0), (100, 80.0, 85.0), (150, 87.5, 92.5), (900, 95.0, 100.0)])
def test_freeze_severity(spark, run, plain, exact):
    r = one(spark, a=S.freeze_severity(F.lit(run)), b=S.freeze_severity(F.lit(run), True))
    assert (r.a, r.b) == (plain, exact)


def test_penalty(spark):
    p = lambda sev, ill, a, b: S.penalty(F.lit(sev), F.lit(20.0), F.lit(ill), F.lit(a), F.lit(b))
    none = F.lit(None).cast("long")
    r = one(spark, a=p(50.0, False, 0, 100), b=p(1.0, True, 0, 0), c=p(100.0, False, 0, 999), d=S.penalty(F.lit(50.0), F.lit(20.0), F.lit(False), none, none), e=p(50.0, False, 9, 3))
    assert (r.a, r.b, r.c, r.d, r.e) == (15.0, 13.0, 20.0, 10.0, 10.0)


@pytest.mark.parametrize(("core", "others", "want"), [(["ok"], ["ok"], "ok"), (["ok"], ["unavailable"], "warning"), (["warning"], ["ok"], "ok"), (["ok"], ["fail"], "fail"), (["unavailable"], ["fail"], "unavailable"), (["fail", "unavailable"], ["ok"], "fail")])
def test_status_table(spark, core, others, want):
    lit = lambda x: F.array(*map(F.lit, x))
    assert one(spark, s=S.aggregate_status(lit(core), lit(others))).s == want


def test_small_functions(spark):
    r = one(spark, a=S.safe_name(F.lit('a<b>:"c/d')), b=S.gib(F.lit(3 << 29)), c=S.shortest(F.lit(2.50)), d=S.shortest(F.lit(100.0)), e=S.issue_group(F.lit("state_spike")), f=S.absolute_path(F.lit("C:\\x")), g=S.absolute_path(F.lit("x/y")), h=S.normalize_status(F.lit("odd")), i=S.confidence(F.lit(60.0), F.lit(False), F.lit(False)), j=S.finding_family(F.lit("1.2.1")), k=S.score_with_findings(20.0, F.lit(25.0)), l=S.label_penalty(F.lit("new")), m=S.clamp01(F.lit(5.0), 0, 4))
    assert (r.a, r.b, r.c, r.d, r.e, r.f, r.g) == ("a_b___c_d", 1.5, "2.5", "100", "numeric", True, False)
    assert (r.h, r.i, r.j, r.k, r.l, r.m) == ("fail", "高置信异常", "temporal_illegal", 0.0, 2.0, 1.0)


def test_rotations(spark):
    arr = lambda v: F.array(*map(F.lit, map(float, v)))
    c, s = math.cos(0.3), math.sin(0.3)
    r = one(spark, ok=V.rotation_check(arr([1, 0, 0, 0, 1, 0])), bad=V.rotation_check(arr([1, 0, 0, 2, 0, 0])), m=V.rotation_matrix(arr([1, 0, 0, 0.5, 1, 0])), d=V.rotation_distance(arr([1, 0, 0, 0, 1, 0, 0, 0, 1]), arr([c, -s, 0, s, c, 0, 0, 0, 1])), n=V.rotation_matrix(arr([0, 0, 0, 0, 1, 0])), u=V.rotation_matrix(arr([1, 0, 0, 0, 1, 0]), "unknown"), p=V.relative_pose(arr([1, 2, 3]), arr([0, -1, 0, 1, 0, 0, 0, 0, 1]), arr([2, 4, 6]), arr([1, 0, 0, 0, 1, 0, 0, 0, 1])))
    assert r.ok.legal and not r.bad.legal and np.allclose(r.m, np.eye(3).ravel()) and abs(r.d - 0.3) < 1e-9 and r.n is None and r.u is None
    rot = np.array([[0, -1, 0], [1, 0, 0], [0, 0, 1]])
    assert np.allclose(r.p.position, rot.T @ [1, 2, 3]) and np.allclose(np.reshape(r.p.rotation, (3, 3)), rot.T)


def test_png_round_trip_and_metrics():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 256, (17, 23, 3), dtype=np.uint8)
    assert (I.decode(I.encode_png(x)) == x).all()
    g = rng.integers(0, 256, (9, 5), dtype=np.uint8)
    assert (I.decode(I.encode_png(g)) == g[:, :, None]).all()
    black, white = I.metrics(I.solid(0)), I.metrics(I.solid(255))
    assert black["black_fraction"] == white["white_fraction"] == 1.0 and black["entropy"] == white["std"] == black["sharpness"] == 0.0
    assert abs(I.metrics(I.solid(0), density=True)["entropy"] - 0.3758) < 1e-3
    for bad in (None, b"", b"no image", I.encode_png(x)[:60]):
        with pytest.raises(Exception):
            I.decode(bad)


def test_png_filters():
    import struct
    import zlib

    rng = np.random.default_rng(2)
    x = rng.integers(0, 256, (5, 4, 3), dtype=np.uint8)
    rows, before = [], np.zeros(12, int)
    for y, kind in enumerate([0, 1, 2, 3, 4]):
        cur = x[y].ravel().astype(int)
        left, corner = np.concatenate([[0] * 3, cur[:-3]]), np.concatenate([[0] * 3, before[:-3]])
        p = left + before - corner
        near = np.stack([abs(p - left), abs(p - before), abs(p - corner)]).argmin(axis=0)
        guess = [0 * cur, left, before, (left + before) // 2, np.choose(near, [left, before, corner])][kind]
        rows.append(bytes([kind]) + ((cur - guess) % 256).astype(np.uint8).tobytes())
        before = cur
    png = b"\x89PNG\r\n\x1a\n" + I._chunk(b"IHDR", struct.pack(">IIBBBBB", 4, 5, 8, 2, 0, 0, 0)) + I._chunk(b"IDAT", zlib.compress(b"".join(rows))) + I._chunk(b"IEND", b"")
    assert (I.decode(png) == x).all()


def test_resized_gray():
    g = np.arange(64, dtype=np.uint8).reshape(8, 8)
    assert (I.resize_gray(g, 8) == g).all() and (I.resize_gray(g, 4)[0] == [5, 7, 9, 11]).all()
    half = I.resize_gray(np.repeat(np.repeat(g, 3, 0), 3, 1), 8)
    assert (half == g).all() and I.resize_gray(np.zeros((10, 40), np.uint8), 7).shape == (2, 7)


def test_clips_read_back():
    rng = np.random.default_rng(3)
    frames = [rng.integers(0, 256, (9, 14, 3), dtype=np.uint8) for _ in range(5)]
    assert all((a == b).all() for a, b in zip(I.avi_frames(I.avi(frames)), frames, strict=True))
    b = I.board(frames, 2, 1, [False, True, False, False, False])
    assert b.shape == (33, 32, 3) and (b[1:10, 1:15] == frames[0]).all() and (b[0, 16] == [255, 0, 0]).all() and (b[0, 0] == 255).all()
    with pytest.raises(ValueError):
        I.avi([frames[0], frames[1][:5]])


def unpacked_gif(data):
    """The pixels of each image of a GIF with a full palette, by the plain rules of its codes."""
    w, h = int.from_bytes(data[6:8], "little"), int.from_bytes(data[8:10], "little")
    palette = np.frombuffer(data[13 : 13 + 768], np.uint8).reshape(256, 3)
    at, out = data.index(b"\x2c", 13 + 768 + 19), []
    while data[at : at + 1] == b"\x2c":
        at += 11
        body = b""
        while data[at]:
            body, at = body + data[at + 1 : at + 1 + data[at]], at + 1 + data[at]
        bits, table, width, before, pixels, held, n = 0, {}, 9, None, bytearray(), 0, 0
        table = {i: bytes([i]) for i in range(256)}
        size = 258
        for byte in body:
            held |= byte << n
            n += 8
            while n >= width:
                code, held, n = held & ((1 << width) - 1), held >> width, n - width
                if code == 256:
                    table, size, width, before = {i: bytes([i]) for i in range(256)}, 258, 9, None
                    continue
                if code == 257:
                    break
                run = table[code] if code in table else before + before[:1]
                pixels += run
                if before is not None and size < 4096:
                    table[size] = before + run[:1]
                    size += 1
                    if size == 1 << width and width < 12:
                        width += 1
                before = run
        out.append(palette[np.frombuffer(bytes(pixels), np.uint8)].reshape(h, w, 3))
        at += 1 + 8
        if data[at - 8 : at - 7] == b"\x3b":
            break
    return out


def test_gif_reads_back():
    rng = np.random.default_rng(4)
    frames = [(rng.integers(0, 6, (70, 90, 3)) * 51).astype(np.uint8) for _ in range(3)]
    got = unpacked_gif(I.gif(frames))
    assert len(got) == 3 and all((a == b).all() for a, b in zip(got, frames, strict=True))


def test_tracks_panels_overlaps():
    from framegauge.functions import tracks as K
    from framegauge.plans.catalog_images import _texture

    a = _texture(1)
    for shift in (1, 3, 6):
        r = K.track_motion(a.astype(np.uint8), np.roll(a, shift, 0).astype(np.uint8))
        assert abs(r["motion"] - shift) < 0.1 and r["inliers"] >= 20
    assert K.track_motion(np.zeros((40, 40), np.uint8), np.zeros((40, 40), np.uint8))["motion"] is None
    assert K.track_motion(a.astype(np.uint8), a[:50].astype(np.uint8))["motion"] is None
    box = np.full((96, 128), 225, np.uint8)
    assert K.panel(box) is None
    box[10:80, 20:120] = 30
    p = K.panel(box)
    assert abs(p["cx"] - 69.5) < 1 and abs(p["cy"] - 44.5) < 1 and abs(p["aspect"] - 100 / 70) < 0.05
    same, other = K.overlap(a.astype(np.uint8), np.roll(a, 4, 1).astype(np.uint8)), K.overlap(a.astype(np.uint8), _texture(9).astype(np.uint8))
    assert same["inliers"] >= 0.8 * same["matches"] >= 8 and same["coverage"] > 0.5 and other["inliers"] == 0
    label = K.regions(np.array([[1, 0, 1], [0, 1, 0], [0, 0, 0], [1, 1, 0]], bool))
    assert label[0, 0] == label[0, 2] == label[1, 1] != label[3, 0] == label[3, 1]
    (cx, cy), sides, _ = K.least_box(np.array([[0, 0], [4, 0], [4, 2], [0, 2], [2, 1]]))
    assert (cx, cy) == (2, 1) and sorted(sides) == [2, 4]


def test_hull_takes_ends_of_rows_only():
    """A full box of 700 x 900 points has four corners; its points aren't walked one by one."""
    import time

    from framegauge.functions import tracks as K

    y, x = np.mgrid[0:700, 0:900]
    began = time.process_time()
    (cx, cy), sides, _ = K.least_box(np.stack([x.ravel(), y.ravel()], axis=1))
    assert (cx, cy) == (449.5, 349.5) and sorted(sides) == [699, 899] and time.process_time() - began < 1
