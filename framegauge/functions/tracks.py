"""Feature tracks, panels and overlaps of images with NumPy only: corners, pyramidal flow, robust similarity, regions,
binary descriptors. Gray images are arrays of height x width."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from framegauge.functions.images import resize_gray


def _padded(x: np.ndarray, by: int) -> np.ndarray:
    return np.pad(x, [(0, 0)] * (x.ndim - 2) + [(by, by)] * 2, mode="edge")


def _filtered(x: np.ndarray, rows: list[float], columns: list[float]) -> np.ndarray:
    """A separable filter of odd length, of one image or several; the border repeats."""
    a, b = len(rows) // 2, len(columns) // 2
    p = np.pad(x, [(0, 0)] * (x.ndim - 2) + [(a, a), (b, b)], mode="edge")
    p = sum(w * p[..., i : i + x.shape[-2], :] for i, w in enumerate(rows))
    return sum(w * p[..., i : i + x.shape[-1]] for i, w in enumerate(columns))


def _gradients(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return _filtered(x, [1, 2, 1], [-1, 0, 1]) / 8, _filtered(x, [-1, 0, 1], [1, 2, 1]) / 8


def corners(gray: np.ndarray, most: int = 160, quality: float = 0.01, distance: float = 7.0) -> np.ndarray:
    """Points (x, y) where the smaller eigenvalue of the gradients' 3 x 3 moment matrix peaks, the strongest first, none
    within ``distance`` of a stronger one (Shi and Tomasi, 1994)."""
    gx, gy = _gradients(gray.astype(np.float64))
    a, b, c = (_filtered(v, [1, 1, 1], [1, 1, 1]) for v in (gx * gx, gx * gy, gy * gy))
    least = (a + c) / 2 - np.sqrt(((a - c) / 2) ** 2 + b * b)
    around = _padded(least, 1)
    peak = np.max([around[i : i + least.shape[0], j : j + least.shape[1]] for i in range(3) for j in range(3)], axis=0)
    y, x = np.nonzero((least >= peak) & (least > quality * max(least.max(), 0.0)))
    order = np.lexsort((x, y, -least[y, x]))
    r = int(np.ceil(distance))
    dy, dx = np.mgrid[-r : r + 1, -r : r + 1]
    near = dx * dx + dy * dy < distance**2
    free = np.ones((least.shape[0] + 2 * r, least.shape[1] + 2 * r), bool)
    kept: list[tuple[int, int]] = []
    for i, j in zip(y[order].tolist(), x[order].tolist(), strict=True):
        if free[i + r, j + r]:
            free[i : i + 2 * r + 1, j : j + 2 * r + 1] &= ~near
            kept.append((j, i))
            if len(kept) == most:
                break
    return np.array(kept, np.float64).reshape(-1, 2)


def _sampled(x: np.ndarray, px: np.ndarray, py: np.ndarray) -> np.ndarray:
    """Values between pixels, linear; outside, the border's."""
    px, py = np.clip(px, 0, x.shape[1] - 1.001), np.clip(py, 0, x.shape[0] - 1.001)
    i, j = py.astype(np.intp), px.astype(np.intp)
    fy, fx = py - i, px - j
    i1, j1 = np.minimum(i + 1, x.shape[0] - 1), np.minimum(j + 1, x.shape[1] - 1)
    return (x[i, j] * (1 - fx) + x[i, j1] * fx) * (1 - fy) + (x[i1, j] * (1 - fx) + x[i1, j1] * fx) * fy


def _halved(x: np.ndarray) -> np.ndarray:
    return _filtered(x, [1 / 16, 4 / 16, 6 / 16, 4 / 16, 1 / 16], [1 / 16, 4 / 16, 6 / 16, 4 / 16, 1 / 16])[..., ::2, ::2]


#: Points whose patches are taken at once, so that they stay in a core's cache.
_FEW = 32


def _patches(x: np.ndarray, size: int) -> np.ndarray:
    """Views of all patches of images, from ``size`` above and left of each on; outside lies the border."""
    return np.lib.stride_tricks.sliding_window_view(_padded(x, size), (size, size), axis=(-2, -1))


def _corner(points: np.ndarray, half: int, shape: tuple[int, int], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The whole pixel (x, y) at which the patch around each point begins, and the parts of a pixel beyond it. A patch that
    lies outside is moved to the border, where it holds the same."""
    at = points - half
    whole = np.floor(at)
    return np.minimum(np.maximum(whole, -size), shape[::-1]).astype(np.intp), at - whole


def _mixed(p: np.ndarray, part: np.ndarray, out: np.ndarray) -> None:
    """Patches between pixels, linear; one pixel smaller."""
    rows = p[:, :, 1:] - p[:, :, :-1]
    rows *= part[:, 0, None, None]
    rows += p[:, :, :-1]
    np.subtract(rows[:, 1:], rows[:, :-1], out)
    out *= part[:, 1, None, None]
    out += rows[:, :-1]


def flow(before: np.ndarray, after: np.ndarray, points: np.ndarray, window: int = 21, levels: int = 3, steps: int = 30, eps: float = 0.01) -> tuple[np.ndarray, np.ndarray]:
    """Where points went, and whether they could be followed: pyramidal least squares (Lucas and Kanade, 1981; Bouguet, 2001)."""
    return flows(before[None], after[None], points, np.zeros(len(points), np.intp), window, levels, steps, eps)


def flows(before: np.ndarray, after: np.ndarray, points: np.ndarray, of: np.ndarray, window: int = 21, levels: int = 3, steps: int = 30, eps: float = 0.01) -> tuple[np.ndarray, np.ndarray]:
    """``flow`` of several pairs of images of one size; a point is one of pair ``of``.

    A value between pixels is a mean of four, so the sums of a step are means of four sums over whole pixels; these are made
    anew only for points that come to other pixels."""
    pyramid = [(before.astype(np.float64), after.astype(np.float64))]
    while len(pyramid) <= levels and min(pyramid[-1][0].shape[1:]) >= 2 * window:
        pyramid.append(tuple(_halved(v) for v in pyramid[-1]))
    half, size = window // 2, window + 1
    moved, found = np.zeros_like(points), np.ones(len(points), bool)
    old, ix, iy = windows = np.empty((3, len(points), window, window))
    few = lambda n: (slice(i, i + _FEW) for i in range(0, n, _FEW))
    for level in range(len(pyramid) - 1, -1, -1):
        a, b = pyramid[level]
        at = points / 2**level
        corner, part = _corner(at, half, a.shape[1:], size)
        for out, v in zip(windows, (a, *_gradients(a)), strict=True):
            patches = _patches(v, size)
            for i in few(len(points)):
                _mixed(patches[of[i], corner[i, 1] + size, corner[i, 0] + size], part[i], out[i])
        total = lambda p, q: np.einsum("nij,nij->n", p, q)
        xx, xy, yy = total(ix, ix), total(ix, iy), total(iy, iy)
        det = xx * yy - xy * xy
        good = ((xx + yy) / 2 - np.sqrt(((xx - yy) / 2) ** 2 + xy * xy)) / window**2 > 1e-4
        found &= good
        det = np.where(good, det, 1.0)
        solve = np.stack([yy / det, -xy / det, -xy / det, xx / det], axis=1).reshape(-1, 2, 2)
        own = (solve @ np.stack([total(ix, old), total(iy, old)], axis=1)[:, :, None])[:, :, 0]
        shift = moved * 2 if level < len(pyramid) - 1 else moved
        patches, held, sums = _patches(b, size), np.full((len(points), 2), -(2**40), np.intp), np.zeros((len(points), 2, 4))
        alive = np.flatnonzero(good)
        for _ in range(steps):
            if not len(alive):
                break
            corner, part = _corner(at[alive] + shift[alive], half, b.shape[1:], size)
            other = (corner != held[alive]).any(1)
            if other.any():
                k, c = alive[other], corner[other]
                q = np.empty((len(k), 2, 4))
                for i in few(len(k)):
                    p, gx, gy = patches[of[k[i]], c[i, 1] + size, c[i, 0] + size], ix[k[i]], iy[k[i]]
                    for j in range(4):
                        four = p[:, j // 2 : j // 2 + window, j % 2 : j % 2 + window]
                        q[i, 0, j], q[i, 1, j] = total(gx, four), total(gy, four)
                held[k], sums[k] = c, solve[k] @ q
            share = np.empty((len(alive), 1, 2, 2))
            share[:, 0, 1], share[:, 0, 0] = part[:, 1:], 1 - part[:, 1:]
            share[..., 1] *= part[:, :1, None]
            share[..., 0] *= 1 - part[:, :1, None]
            step = own[alive] - (sums[alive] * share.reshape(-1, 1, 4)).sum(2)
            shift[alive] += step
            alive = alive[(step * step).sum(1) > eps**2]
        moved = shift
    to = points + moved
    inside = (to > -1e-6).all(1) & (to[:, 0] < before.shape[2]) & (to[:, 1] < before.shape[1])
    return to, found & inside


def _similarity(src: np.ndarray, dst: np.ndarray) -> np.ndarray:
    """Turn, scale and shift (a, b, tx, ty) by least squares."""
    s, d = src - src.mean(0), dst - dst.mean(0)
    norm = max((s * s).sum(), 1e-12)
    a, b = (s * d).sum() / norm, (s[:, 0] * d[:, 1] - s[:, 1] * d[:, 0]).sum() / norm
    c = src.mean(0)
    return np.array([a, b, *(dst.mean(0) - [a * c[0] - b * c[1], b * c[0] + a * c[1]])])


def _mapped(m: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.stack([m[0] * p[:, 0] - m[1] * p[:, 1] + m[2], m[1] * p[:, 0] + m[0] * p[:, 1] + m[3]], axis=1)


@lru_cache(1024)
def _draws(n: int, tries: int, seed: int) -> np.ndarray:
    """Seeded pairs of different numbers below n."""
    rng = np.random.default_rng(seed)
    return np.array([rng.choice(n, 2, replace=False) for _ in range(tries)])


def inliers(src: np.ndarray, dst: np.ndarray, within: float = 3.0, tries: int = 200, seed: int = 1) -> np.ndarray:
    """Which pairs of points agree with the similarity that most of them share; none if there is none. Draws are seeded."""
    best = np.zeros(len(src), bool)
    if len(src) < 2:
        return best
    i, j = _draws(len(src), tries, seed).T
    apart = ((src[i] - src[j]) ** 2).sum(1) >= 1
    i, j = i[apart], j[apart]
    if len(i):  # as complex numbers a similarity is a product and a sum
        s, d = src[:, 0] + 1j * src[:, 1], dst[:, 0] + 1j * dst[:, 1]
        turn = (d[i] - d[j]) / (s[i] - s[j])
        off = (d[i] + d[j] - turn * (s[i] + s[j])) / 2
        far = turn[:, None] * s + (off[:, None] - d)
        ok = far.real**2 + far.imag**2 <= within**2
        best = ok[ok.sum(1).argmax()]
    if best.sum() >= 2:
        best = ((_mapped(_similarity(src[best], dst[best]), src) - dst) ** 2).sum(1) <= within**2
    return best


def track_motion(before: np.ndarray, after: np.ndarray, least_points: int = 12, least_tracks: int = 8, least_inliers: int = 6) -> dict[str, float | int | None]:
    """C1 for two images: the median displacement of the tracks that share a movement, and their numbers; no motion where
    there are too few corners or tracks."""
    return track_motions([(before, after)], least_points, least_tracks, least_inliers)[0]


def track_motions(pairs: list[tuple[np.ndarray, np.ndarray]], least_points: int = 12, least_tracks: int = 8, least_inliers: int = 6) -> list[dict[str, float | int | None]]:
    """``track_motion`` of several pairs; those of one size share the steps of the flow."""
    out: list[dict[str, float | int | None]] = [{"motion": None, "tracks": 0, "inliers": 0} for _ in pairs]
    by_size: dict[tuple[int, ...], list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]] = {}
    for n, pair in enumerate(pairs):
        before, after = map(resize_gray, pair)
        if before.shape == after.shape and len(src := corners(before)) >= least_points:
            by_size.setdefault(before.shape, []).append((n, before, after, src))
    for group in by_size.values():
        of = np.repeat(np.arange(len(group)), [len(g[3]) for g in group])
        every = np.concatenate([g[3] for g in group])
        to, found = flows(np.stack([g[1] for g in group]), np.stack([g[2] for g in group]), every, of)
        for i, (n, *_) in enumerate(group):
            own = found & (of == i)
            src, dst = every[own], to[own]
            out[n]["tracks"] = len(src)
            if len(src) >= least_tracks:
                ok = inliers(src, dst)
                used = ok if ok.sum() >= least_inliers else np.ones(len(src), bool)
                far = np.sqrt(((dst - src)[used] ** 2).sum(1))
                out[n] |= {"motion": float(np.median(far)), "inliers": int(ok.sum()) if ok.sum() >= least_inliers else 0}
    return out


# ---- panels ----------------------------------------------------------------------------------------------------------


def _grown(mask: np.ndarray, size: int = 5) -> np.ndarray:
    r = size // 2
    p = np.pad(mask, r)
    rows = np.any([p[i : i + mask.shape[0]] for i in range(size)], axis=0)
    return np.any([rows[:, i : i + mask.shape[1]] for i in range(size)], axis=0)


def _shrunk(mask: np.ndarray, size: int = 5) -> np.ndarray:
    """What lies outside the image is no hole."""
    return ~_grown(~mask, size)


def regions(mask: np.ndarray) -> np.ndarray:
    """Numbers from 1 for the 8-connected regions of a mask: row runs, joined where they touch."""
    parent = [0]

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    step = np.diff(np.pad(mask.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    (row, first), (_, end) = np.nonzero(step == 1), np.nonzero(step == -1)
    above: list[tuple[int, int, int]] = []
    here: list[tuple[int, int, int]] = []
    at = -1
    for y, a, b in zip(row.tolist(), first.tolist(), end.tolist(), strict=True):
        if y != at:
            above, here, at = here if y == at + 1 else [], [], y
        own = len(parent)
        parent.append(own)
        for c, d, other in above:
            if c <= b and a <= d:
                p, q = sorted((root(own), root(other)))
                parent[q] = p
        here.append((a, b, own))
    label = np.zeros(mask.shape, np.int64)
    label[mask] = np.repeat(np.array([root(i) for i in range(1, len(parent))], np.int64), end - first)
    return label


def _hull(points: np.ndarray) -> np.ndarray:
    """The corners of the convex hull in order (Andrew, 1979); only the ends of a row can be corners."""
    p = points[np.lexsort((points[:, 0], points[:, 1]))]
    new = p[1:, 1] != p[:-1, 1]
    p = p[np.concatenate([[True], new]) | np.concatenate([new, [True]])] if len(p) else p
    p = p[np.lexsort((p[:, 1], p[:, 0]))]
    if len(p) < 3:
        return p

    def half(rows):
        out: list[np.ndarray] = []
        for r in rows:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (r[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (r[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(r)
        return out[:-1]

    return np.array(half(p) + half(p[::-1]))


def least_box(points: np.ndarray) -> tuple[tuple[float, float], tuple[float, float], float]:
    """Center, sides and angle in degrees of the smallest box around points; one side lies on the hull."""
    hull = _hull(points.astype(np.float64))
    best = None
    for a, b in zip(hull, np.roll(hull, -1, axis=0), strict=True):
        angle = np.arctan2(b[1] - a[1], b[0] - a[0])
        c, s = np.cos(angle), np.sin(angle)
        u, v = hull @ [c, s], hull @ [-s, c]
        w, h = np.ptp(u), np.ptp(v)
        if best is None or w * h < best[0]:
            mu, mv = (u.min() + u.max()) / 2, (v.min() + v.max()) / 2
            best = (w * h, (float(mu * c - mv * s), float(mu * s + mv * c)), (float(w), float(h)), float(np.degrees(angle)))
    return best[1:]


def _edges(x: np.ndarray, low: float = 40.0, high: float = 120.0) -> np.ndarray:
    """Thin edges by two thresholds (Canny, 1986): strong ones, and weak ones in a region with a strong one."""
    gx, gy = (8 * g for g in _gradients(x))
    size = np.abs(gx) + np.abs(gy)
    p = _padded(size, 1)
    side = np.round(np.degrees(np.arctan2(gy, gx)) / 45).astype(int) % 4
    at = lambda dy, dx: p[1 + dy : p.shape[0] - 1 + dy, 1 + dx : p.shape[1] - 1 + dx]
    keep = np.zeros(x.shape, bool)
    for k, (dy, dx) in enumerate([(0, 1), (1, 1), (1, 0), (1, -1)]):
        keep |= (side == k) & (size >= at(dy, dx)) & (size >= at(-dy, -dx))
    weak = keep & (size > low)
    label = regions(weak)
    strong = np.unique(label[weak & (size > high)])
    return np.isin(label, strong[strong > 0])


def panel(gray: np.ndarray) -> dict[str, float] | None:
    """The largest region of dark pixels, or else of edges, that looks like a panel: area, aspect, cx, cy, angle."""
    gray = resize_gray(gray)
    w = [1 / 16, 4 / 16, 6 / 16, 4 / 16, 1 / 16]
    smooth = np.floor(_filtered(gray.astype(np.float64), w, w) + 0.5)
    best = None
    for mask in (smooth <= np.quantile(smooth, 0.35), None):
        mask = _edges(smooth) if mask is None else mask
        for _ in range(2):
            mask = _grown(mask)
        for _ in range(2):
            mask = _shrunk(mask)
        label = regions(_grown(_shrunk(mask)))
        for k, n in enumerate(np.bincount(label.ravel())):
            if k == 0 or not 0.03 * gray.size <= n <= 0.95 * gray.size:
                continue
            y, x = np.nonzero(label == k)
            (cx, cy), (a, b), angle = least_box(np.stack([x, y], axis=1))
            aspect = max(a, b) / max(min(a, b), 1e-6)
            if 1.1 <= aspect <= 10.0 and (best is None or n > best["area"]):
                best = {"area": float(n), "aspect": float(aspect), "cx": cx, "cy": cy, "angle": angle}
        if best:
            return best
    return None


# ---- overlaps --------------------------------------------------------------------------------------------------------


def descriptors(gray: np.ndarray, points: np.ndarray, bits: int = 256, radius: int = 13, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The points far enough from the border, and of each the bits of seeded pairs of smoothed pixels around it, turned by the
    angle of the patch's center of mass (Rublee and others, 2011)."""
    r = radius + 2
    inside = (points >= r).all(1) & (points[:, 0] < gray.shape[1] - r) & (points[:, 1] < gray.shape[0] - r)
    points = points[inside]
    if not len(points):
        return points, np.zeros((0, bits // 8), np.uint8)
    x = _filtered(gray.astype(np.float64), [0.2] * 5, [0.2] * 5)
    dy, dx = (v.ravel() for v in np.mgrid[-radius : radius + 1, -radius : radius + 1])
    disc = dx * dx + dy * dy <= radius * radius
    around = x[points[:, 1, None].astype(int) + dy[disc], points[:, 0, None].astype(int) + dx[disc]]
    angle = np.arctan2((around * dy[disc]).sum(1), (around * dx[disc]).sum(1))
    pairs = np.clip(np.random.default_rng(seed).normal(0, radius / 2.5, (bits, 4)), -radius / 1.5, radius / 1.5)
    c, s = np.cos(angle)[:, None], np.sin(angle)[:, None]
    value = lambda k: _sampled(x, points[:, 0:1] + c * pairs[:, k] - s * pairs[:, k + 1], points[:, 1:2] + s * pairs[:, k] + c * pairs[:, k + 1])
    return points, np.packbits(value(0) < value(2), axis=1)


_ONES = np.array([bin(i).count("1") for i in range(256)], np.int64)


def matches(a: np.ndarray, b: np.ndarray, ratio: float = 0.75) -> np.ndarray:
    """Pairs (i, j) of descriptors that are each other's nearest, clearly nearer than the second."""
    if len(a) < 2 or len(b) < 2:
        return np.zeros((0, 2), int)
    far = _ONES[a[:, None, :] ^ b[None, :, :]].sum(2)
    order = np.argsort(far, axis=1, kind="stable")[:, :2]
    i = np.arange(len(a))
    near, second = far[i, order[:, 0]], far[i, order[:, 1]]
    mutual = far.argmin(axis=0)[order[:, 0]] == i
    ok = mutual & (near < ratio * np.maximum(second, 1))
    return np.stack([i[ok], order[ok, 0]], axis=1)


def overlap(a: np.ndarray, b: np.ndarray, least: int = 8) -> dict[str, float | int]:
    """C5 for two images: matches, how many share a similarity (fewer than ``least`` count as none), and the share of a 4 x 4
    grid that those cover."""
    a, b = resize_gray(a), resize_gray(b)
    (pa, da), (pb, db) = (descriptors(x, corners(x, 300, 0.01, 5.0)) for x in (a, b))
    m = matches(da, db)
    out = {"matches": len(m), "inliers": 0, "coverage": 0.0}
    if len(m) < least:
        return out
    ok = inliers(pa[m[:, 0]], pb[m[:, 1]], 4.0, 500)
    if ok.sum() < least:
        return out
    cells = {(int(min(3, x * 4 // a.shape[1])), int(min(3, y * 4 // a.shape[0]))) for x, y in pa[m[ok, 0]]}
    return out | {"inliers": int(ok.sum()), "coverage": len(cells) / 16}
