"""URL filters: host rules, and a Bloom filter cascade for a list of keys.

Cascade: level 1 encodes the listed keys; level 2 encodes the other keys of the universe that level 1 lets pass; level 3
the listed keys that level 2 lets pass; and so on until a level lets none pass. Over the complete universe the depth at
which a key is first refused tells exactly whether it is listed. Keys are dealt over shards by their hash, so a cascade
is built for a bounded number of keys at a time.

A scan probes the cascade in place of a join with the list. Where all shards together exceed ``BROADCAST_BYTES``, the
distinct keys visit the shard they belong to instead."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framegauge.llm.common import U64, mix, packed, written

SHARD_KEYS = 100_000
BROADCAST_BYTES = 32 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: what follows the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; path: from there up to ``? #`` or the end."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule ``host/path`` that fits: its host or a subdomain, and the start of the path."""
    rule = verdict = F.lit(None).cast("string")
    for text, what in sorted(rules, key=lambda r: len(r[0])):
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def hashes(key: Column) -> tuple[Column, Column]:
    """128 bits of a key; a null key counts as empty."""
    k = F.coalesce(key.cast("string"), F.lit(""))
    return F.xxhash64(k), F.xxhash64(k, F.lit("second"))


def _places(h1: np.ndarray, h2: np.ndarray, level: int, probes: int, bits: int) -> np.ndarray:
    salt = mix(np.array([level + 1], U64))[0]
    a, b = mix(h1 ^ salt), mix(h2 + salt) | U64(1)
    return ((a[None, :] + np.arange(probes, dtype=U64)[:, None] * b[None, :]) % U64(bits)).astype(np.int64)


def build(listed: tuple[np.ndarray, np.ndarray], others: tuple[np.ndarray, np.ndarray]) -> list[tuple[int, int, bytes]]:
    """(probes, bits, packed bits) of each level for two sets of hashes that have none in common."""
    levels, inside, outside = [], listed, others
    while inside[0].size:
        n, m = inside[0].size, max(outside[0].size, 1)
        rate = min(0.5, n / m / math.sqrt(2)) if not levels else 0.5
        bits = max(64, math.ceil(n * math.log2(1 / rate) / math.log(2)))
        probes = max(1, round(math.log2(1 / rate)))
        table = np.zeros(bits, bool)
        table[_places(*inside, len(levels), probes, bits).ravel()] = True
        levels.append((probes, bits, np.packbits(table).tobytes()))
        passed = table[_places(*outside, len(levels) - 1, probes, bits)].all(axis=0)
        inside, outside = (outside[0][passed], outside[1][passed]), inside
        if len(levels) > 200:
            raise ValueError("two keys share 128 bits")
    return levels


def probe(levels: list, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Which keys of the universe are listed."""
    out, alive = np.zeros(h1.size, bool), np.arange(h1.size)
    for k, (probes, bits, packed) in enumerate(levels):
        at, table = _places(h1[alive], h2[alive], k, probes, bits), np.frombuffer(packed, np.uint8)
        passed = (table[at >> 3] << (at & 7).astype(np.uint8) & 128 > 0).all(axis=0)
        out[alive[~passed]] = k % 2 == 1
        alive = alive[passed]
    out[alive] = len(levels) % 2 == 1
    return out


def cascade(universe: DataFrame, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """``(shard, level, probes, bits, packed)`` for a universe ``(key, listed)``; written to the shared folder.

    A key with several rows is listed if any of them says so; a null key counts as the empty one; a null flag as not listed."""
    h1, h2 = hashes(F.col("key"))
    keys = universe.groupBy(h1.alias("h1"), h2.alias("h2")).agg(F.max(F.coalesce("listed", F.lit(False))).alias("listed"))
    keys = written(keys, "universe", per_core=8)
    shards = max(1, -(-keys.count() // shard_keys))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        h = [group[c].to_numpy(np.int64).view(U64) for c in ("h1", "h2")]
        of = group["listed"].to_numpy(bool)
        levels = build((h[0][of], h[1][of]), (h[0][~of], h[1][~of]))
        shard = int(group["shard"].iloc[0])
        return pd.DataFrame([(shard, k, *x) for k, x in enumerate(levels)] or [(shard, -1, 0, 0, b"")], columns=["shard", "level", "probes", "bits", "packed"])

    dealt = keys.withColumn("shard", F.pmod("h1", F.lit(shards)))
    return written(dealt.groupBy("shard").applyInPandas(run, "shard long, level long, probes long, bits long, packed binary"), "cascade", per_core=2)


def _by_shard(rows) -> dict[int, list]:
    out: dict[int, list] = {}
    for r in sorted(rows, key=lambda r: (r.shard, r.level)):
        levels = out.setdefault(int(r.shard), [])
        if r.level >= 0:
            levels.append((int(r.probes), int(r.bits), bytes(r.packed)))
    return out


def with_listed(df: DataFrame, key: Column, levels: DataFrame, name: str = "listed", most: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a boolean column that says whether its key is listed; exact for keys of the universe."""
    facts = levels.agg(F.max("shard").alias("top"), F.sum(F.length("packed")).alias("bytes")).first()
    shards = levels.select("shard").distinct().count()
    count = shards if facts.top is None else max(shards, facts.top + 1)
    h1, h2 = hashes(key)
    rows = df.withColumns({"_h1": h1, "_h2": h2})
    if facts.top is None:
        return df.withColumn(name, F.lit(False))
    if facts.bytes <= most:
        table = _by_shard(levels.collect())

        def run(batches):
            for batch in batches:
                a, b = (batch.column(batch.num_columns - k).to_numpy() for k in (2, 1))
                at, out = np.mod(a, count), np.zeros(a.size, bool)
                for shard in np.unique(at):
                    of = at == shard
                    out[of] = probe(table.get(int(shard), []), a[of].view(U64), b[of].view(U64))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(out)], [*batch.schema.names[:-2], name])

        return rows.mapInArrow(run, df.drop(name).withColumn(name, F.lit(True)).schema) if name not in df.columns else with_listed(df.drop(name), key, levels, name, most)
    asked = rows.select("_h1", "_h2").distinct().withColumn("shard", F.pmod("_h1", F.lit(count)))

    def visit(keys: pd.DataFrame, of: pd.DataFrame) -> pd.DataFrame:
        table = _by_shard(of.itertuples())
        h = [keys[c].to_numpy(np.int64).view(U64) for c in ("_h1", "_h2")]
        found = probe(next(iter(table.values()), []), *h)
        return pd.DataFrame({"_h1": keys["_h1"], "_h2": keys["_h2"], name: found})

    told = asked.groupBy("shard").cogroup(levels.groupBy("shard")).applyInPandas(visit, f"_h1 long, _h2 long, {name} boolean")
    return rows.drop(name).join(told, ["_h1", "_h2"], "left").drop("_h1", "_h2")


def judge(pages: DataFrame, rules: list[tuple[str, str]], levels: DataFrame, url_col: str = "url") -> DataFrame:
    """``pages`` with host, path, rule and verdict: the longest fitting rule's, else block for keys ``host || path`` that the cascade lists, else allow.

    A null url and one without ``://`` have an empty host and path. Repeated rows are judged one by one; an empty table
    gives no rows; columns of the input with the new names are replaced."""
    df = packed(pages, ["host", "path", "rule", "verdict"], _url=F.col(f"`{url_col}`").cast("string"))
    host, path = host_and_path(F.col("_url"))
    df = df.withColumns({"host": host, "path": path})
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    df = with_listed(df.withColumns({"rule": rule, "_verdict": verdict}), F.concat("host", "path"), levels, "_listed")
    final = F.coalesce("_verdict", F.when(F.col("_listed"), "block").otherwise("allow"))
    return df.select("_row.*", "host", "path", "rule", final.alias("verdict"))
