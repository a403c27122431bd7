"""Near-duplicate documents: fast similarity sketches, banding, exact verification, components.

The sketch is the one of Dahlgaard, Knudsen and Thorup ("Fast Similarity Sketching", 2017): in round i < t every
element throws one ball into a random bin; in round t + j all elements throw into bin j; a bin keeps its smallest
(round, value). All t bins are therefore full after 2t rounds at the latest, and agreeing coordinates estimate the
Jaccard similarity with the concentration of t independent minima.

Plan: (1) one pass sketches every document; documents with equal sets become one class, represented by the smallest
id. (2) A band hash is a bucket. Members are compared with two hubs of their bucket, not with one another; sketches,
then full sets decide. (3) Documents of buckets whose members fall into several components after that go
through an exact prefix filter, so no pair that shares a bucket and could still join two components stays untested,
and no bucket is expanded into all its pairs. (4) Components by alternating stars.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framegauge.llm.common import U64, bitmap, discard, marked, mix, packed, shingle_sets, written
from framegauge.llm.components import connected_components

#: Sets are sketched together up to so many shingles.
TOGETHER = 1 << 19
#: Ids up to so many are marked in a bitmap of 16 bits an id at most (32 MB), which the workers get; more are joined.
BITMAP_IDS = 1 << 24
#: Rows of one shingle above this are dealt out over several tasks.
SPLIT = 10_000


def sketches(x: np.ndarray, at: np.ndarray, t: int = 128, seed: int = 1) -> np.ndarray:
    """The t coordinates of each set of 64-bit hashes, a row per set: set i is x[at[i]:at[i + 1]]; t is a power of two of at
    most 128. An empty set's coordinates are all 2^64 - 1. Rounds run over all sets that still have empty bins."""
    shift, full, size = U64(64 - int(math.log2(t))), U64(2**64 - 1), np.diff(at)
    low = U64((1 << 48) - 1)
    out = np.full((size.size, t), full)
    owner, open_ = np.repeat(np.arange(size.size), size), size > 0
    for r in range(t):
        if not open_.all():
            x, owner = x[open_[owner]], owner[open_[owner]]
        if not x.size:
            break
        h = mix(x + mix(np.array([r + seed * 1000003], U64)))
        np.minimum.at(out.reshape(-1), owner * t + (h >> shift).astype(np.int64), (h & low) | U64(r << 48))
        open_ = (out == full).any(axis=1)
    open_ = (out == full) & (size > 0)[:, None]
    for j in np.flatnonzero(open_.any(axis=0)):
        pick = open_[owner, j]
        first = np.flatnonzero(np.diff(owner[pick], prepend=-1))
        h = mix(x[pick] + mix(np.array([t + int(j) + seed * 1000003], U64)))
        out[open_[:, j], j] = np.minimum.reduceat(h & low, first) | U64((t + int(j)) << 48)
    return out


def rows_per_band(t: int, percent: int, miss: float = 1e-6) -> int:
    """The longest band with which a pair at the threshold misses all bands with a probability of ``miss`` at most."""
    s = percent / 100
    return max(r for r in range(1, t + 1) if r == 1 or (1 - s**r) ** (t // r) <= miss)


def _sketches(docs: DataFrame, id_col: str, text_col: str, n: int, lower: bool, t: int, rows: int) -> DataFrame:
    bands = t // rows

    def rows_of(ids, sets):
        size = np.array([x.size for x in sets])
        at, some = np.concatenate([[0], np.cumsum(size)]), size > 0
        x = np.concatenate(sets)
        sums = np.zeros((2, size.size), U64)
        if some.any():
            sums[:, some] = np.add.reduceat(np.vstack([x, mix(x)]), at[:-1][some], axis=1)
        c = mix(sketches(x, at, t))
        sigs, keys = (c & U64(255)).astype(np.uint8), np.tile(np.arange(bands, dtype=U64), (size.size, 1))
        for j in range(rows):
            keys = mix(keys * U64(0x9FB21C651E98DF25) + c[:, j : bands * rows : rows])
        band = [k if good else None for k, good in zip(keys.view(np.int64), some, strict=True)]
        sig = [g.tobytes() if good else None for g, good in zip(sigs, some, strict=True)]
        return pa.RecordBatch.from_arrays([ids.cast(pa.int64()), pa.array(size, pa.int64()), pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)), pa.array(band, pa.list_(pa.int64())), pa.array(sig, pa.binary())], ["id", "n", "s1", "s2", "bands", "sig"])

    def run(batches):
        for batch in batches:
            sets, held, done = [], 0, 0
            for i, x in shingle_sets(batch.column(1), n, lower):
                sets.append(x)
                held += x.size
                if held > TOGETHER:
                    yield rows_of(batch.column(0)[done : i + 1], sets)
                    sets, held, done = [], 0, i + 1
            if sets:
                yield rows_of(batch.column(0)[done:], sets)

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "id long, n long, s1 long, s2 long, bands array<long>, sig binary")


def _sets(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, n: int, lower: bool) -> DataFrame:
    """``(id, set)`` of the documents in ``ids``, and of a few others that share a bit of a bitmap that grows with their number."""
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).where("id is not null")
    ids = ids.distinct()
    size = ids.count()
    if size > BITMAP_IDS:
        src, bits, marks = src.join(ids, "id", "left_semi"), None, None
    else:
        bits = max(1 << 15, 1 << (8 * size).bit_length())
        marks = bitmap(ids.select(F.pmod(F.xxhash64("id"), F.lit(bits)).alias("place")), bits)
        src = src.withColumn("h", F.pmod(F.xxhash64("id"), F.lit(bits)))

    def run(batches):
        for batch in batches:
            if marks is not None:
                batch = batch.filter(pa.array(marked(marks, batch.column(2).to_numpy())))
            if not batch.num_rows:
                continue
            sets = [x.view(np.int64) for _, x in shingle_sets(batch.column(1), n, lower)]
            for lo in range(0, len(sets), 500):
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo : lo + 500], pa.array(sets[lo : lo + 500], pa.list_(pa.int64()))], ["id", "set"])

    return src.mapInArrow(run, "id long, set array<long>")


def _alike(pairs: DataFrame, reps: DataFrame, percent: int, t: int) -> DataFrame:
    """The pairs that sizes and sketches allow: six standard deviations under the threshold at least."""
    s = percent / 100
    least = math.floor(t * s - 6 * math.sqrt(t * s * (1 - s)))

    def run(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, t) for k in (2, 3))
            yield batch.filter(pa.array((a == b).sum(axis=1) >= least)).select(["a", "b"])

    of = lambda k: reps.select(F.col("id").alias(k), F.col("n").alias(f"n{k}"), F.col("sig").alias(f"s{k}"))
    near = pairs.join(of("a"), "a").join(of("b"), "b").where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
    return near.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long").distinct()


def _verified(docs: DataFrame, pairs: DataFrame, percent: int, *how) -> DataFrame:
    """The pairs whose full sets reach the threshold, with ``shared``."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    sets = _sets(docs, ids, *how)
    of = lambda k: sets.select(F.col("id").alias(k), F.col("set").alias(f"s{k}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b")
    sized = both.select("a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"), F.size(F.array_intersect("sa", "sb")).alias("shared"))
    return sized.where(f"100L * shared >= {percent}L * (na + nb - shared)").select("a", "b", "shared")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80, lower: bool = True, t: int = 128) -> DataFrame:
    """``(id_col, n_shingles, component_id, kept)``, a row for every input row.

    Documents whose sets of distinct n-word shingles have a Jaccard similarity of ``percent`` / 100 or more are linked;
    component_id is the smallest id reachable and kept marks the document with that id. With the default band length
    a pair at the threshold shares no band with a probability under 1e-6. Null or empty texts and texts without words
    have no shingles and no links. Rows with one id are one document: its links are those of all its rows. A null id
    is linked with nothing, its component is null and it is kept. An empty table gives no rows; other columns are
    ignored."""
    rows = rows_per_band(t, percent)
    how = (id_col, text_col, n, lower)
    sk = written(_sketches(docs, *how, t, rows), "sketch")
    sets = sk.where("n > 0 and id is not null")
    classes = written(sets.groupBy("n", "s1", "s2").agg(F.min("id").alias("rep")), "classes", per_core=2)
    member = written(sets.join(classes, ["n", "s1", "s2"]).select("id", "rep", "n", F.expr("if(id = rep, bands, null)").alias("bands"), F.expr("if(id = rep, sig, null)").alias("sig")), "member", per_core=16)
    discard(classes)
    reps = member.where("bands is not null").select("id", "n", "bands", "sig")
    band = reps.select("id", F.explode("bands").alias("bh"))
    # written before it meets its buckets again: the engine then knows its size, and can send it or split a hot bucket
    hubs = written(band.groupBy("bh").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi"), "hubs", per_core=8)
    shared = written(band.join(hubs, "bh"), "bucket", per_core=8)
    discard(hubs)

    star = shared.select("id", F.explode(F.array("lo", "hi")).alias("hub")).where("id != hub").select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()
    sig = written(_alike(star, reps, percent, t), "pairs", per_core=2)
    links = written(_verified(docs, sig, percent, *how), "links", per_core=16)
    discard(sig)
    # one id with several sets: all of them belong to one document
    several = member.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a < z")
    same = written(member.select("id", "rep").join(several, "id").select("a", F.col("rep").alias("b")).distinct(), "same", per_core=2)
    edges = links.select("a", "b").union(same)
    found = written(connected_components(edges), "found", per_core=2)
    pairs, tables = _unsettled(docs, shared.select("bh", "id"), found, percent, *how)
    more = written(_alike(pairs, reps, percent, t), "rest", per_core=2)
    discard(shared, *tables)
    if not more.isEmpty():
        rest = written(_verified(docs, more, percent, *how), "links2", per_core=16)
        found = written(connected_components(edges.union(rest.select("a", "b"))), "found2", per_core=2)
        discard(rest)
    discard(more, links, same)

    whole = member.groupBy("id").agg(F.min("rep").alias("rep")).join(found.withColumnRenamed("id", "rep"), "rep", "left").select("id", F.coalesce("component", "rep").alias("component"))
    out = sk.select("id", "n").join(whole, "id", "left").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))


def _unsettled(docs: DataFrame, shared: DataFrame, found: DataFrame, percent: int, *how) -> tuple[DataFrame, list[DataFrame]]:
    """The pairs in different components that prefixes and positions allow, among documents of unsettled buckets; and the
    tables to delete when they have been read.

    Order all shingles: first those of a single component, then the others by rarity. Two sets that reach the threshold
    have one of the first ``n - ceil(n * percent / 100) + 1`` shingles of the larger and of the first
    ``n - ceil(2 n percent / (100 + percent)) + 1`` of the smaller in common, and behind the first common one there are
    enough left for the overlap they need. No pair is lost. Shingles of a single component link no components, so they
    fill prefixes and are compared with nothing. Of the others, the rows of a shingle's largest component meet the rest of
    its rows only, never one another; a shingle of many rows is dealt out."""
    c = shared.join(found, "id", "left").select("bh", "id", F.coalesce("component", "id").alias("c"))
    open_ = written(c.groupBy("bh").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("bh"), "open-buckets", per_core=2)
    ids = written(c.join(open_, "bh").select("id", "c").distinct(), "open", per_core=2)
    token = written(_sets(docs, ids.select("id"), *how).join(ids, "id").select("id", "c", F.size("set").alias("n"), F.explode("set").alias("sh")), "tokens", per_core=16)
    between = written(token.groupBy("sh").agg(F.count("*").alias("df"), F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("sh", "df"), "between", per_core=8)
    w = Window.partitionBy("id")
    ranked = token.join(between, "sh").withColumn("r", F.row_number().over(w.orderBy("df", "sh")) + F.col("n") - F.count("*").over(w))
    prefix = written(ranked.where(f"r <= n - ceil(n * {percent} / 100) + 1").select("id", "c", "n", "sh", "r"), "prefix", per_core=8)
    of = prefix.groupBy("sh", "c").agg(F.count("*").alias("k")).groupBy("sh").agg(F.max_by("c", "k").alias("main"), F.ceil(F.sum("k") / SPLIT).cast("int").alias("parts"), F.count("*").alias("components"))
    main = written(of.where("components > 1").drop("components"), "main", per_core=2)
    dealt = written(prefix.join(main, "sh"), "dealt", per_core=4)
    discard(open_, ids, token, between, prefix, main)
    x, y = (dealt.select("sh", "parts", (F.col("c") == F.col("main")).alias("in_main"), *(F.col(v).alias(v + k) for v in ("id", "c", "n", "r"))) for k in "xy")
    x = x.where(f"rx <= nx - ceil(2 * nx * {percent} / (100 + {percent})) + 1")
    every = lambda d: d.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts", "in_main")
    some = lambda d, key: d.withColumn("part", F.pmod(F.xxhash64(key), F.col("parts").cast("long")).cast("int")).drop("parts", "in_main")
    near = f"cx != cy and (nx < ny or nx = ny and idx < idy) and 100 * nx >= {percent} * ny and 1 + least(nx - rx, ny - ry) >= ceil((nx + ny) * {percent} / (100 + {percent}))"
    met = [every(x.where("not in_main")).join(some(y, "idy"), ["sh", "part"]), some(x.where("in_main"), "idx").join(every(y.where("not in_main")), ["sh", "part"])]
    a, b = (m.where(near).select(F.least("idx", "idy").alias("a"), F.greatest("idx", "idy").alias("b")) for m in met)
    return a.union(b).distinct(), [dealt]


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The documents that ``near_duplicates`` keeps, with all their columns; of repeated rows of one id, the one whose row hash is least.

    Rows with a null id all stay. Only rows of ids that occur repeatedly are shuffled with their texts."""
    kept = near_duplicates(docs, id_col, text_col, **how).where("kept").select(F.col(id_col).alias("_kept")).distinct()
    rows = packed(docs, [], _id=F.col(f"`{id_col}`").cast("long"), _own=F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns)))
    best = rows.groupBy("_id").agg(F.count("*").alias("_times"), F.min("_own").alias("_best")).withColumnRenamed("_id", "_kept")
    best = written(kept.join(best, "_kept"), "kept", per_core=2)
    known = rows.where("_id is not null").join(best, F.col("_id") == F.col("_kept")).where("_own = _best")
    out = rows.where("_id is null").select("_row.*").union(known.where("_times = 1").select("_row.*"))
    if best.where("_times > 1").isEmpty():
        return out
    return out.union(known.where("_times > 1").groupBy("_id").agg(F.first("_row").alias("_row")).select("_row.*"))
