"""Benchmark decontamination: which test items are contained in which documents.

Containment search by MinHash, partitioned by size: items fall into partitions [2^p, 2^(p+1)) by their number of
distinct shingles, and the partition's upper bound sets how many of its smallest hash values an item is indexed with:
``u - ceil(u * percent / 100) + 1``. A document that holds ``percent`` / 100 of an item's shingles misses at most
``n - ceil(n * percent / 100)`` of them, so one of the indexed minima is always among the document's hashes: the
candidates are complete however long the document is. (A sketch of the document itself can't do that: 26 shingles among
20,000 have a Jaccard similarity of 0.001.) Exact shingle containment then decides.

Items of up to ``BLOCK`` hashes go to the workers: one pass over the documents, without a shuffle. More are dealt out: a
bitmap of all minima goes to the workers, the shingles that pass it meet the minima by a join, and the texts of the
candidates, each once, meet the full sets of their items."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framegauge.llm.common import U64, bitmap, hash_words, marked, mix, packed, shingle_hashes, shingle_sets, text_chunks, written

#: Up to so many hashes of items, the index goes to the workers: 16 MB on the driver and in each Python worker.
BLOCK = 1 << 21
#: The bitmap of minima has two to the power of this many bits at most (32 MB); a fuller one lets more shingles pass, and loses none.
MOST_POWER = 28
#: What tells texts apart: 96 bits of hashes, and the length.
_TEXT = ["h", "crc", "size"]


def sketch_length(n: int, percent: int) -> int:
    """How many minima an item with n distinct shingles is indexed with: those of its partition's upper bound."""
    u = (1 << n.bit_length()) - 1
    return min(n, u - math.ceil(u * percent / 100) + 1)


def minima(x: np.ndarray, percent: int) -> np.ndarray:
    return x[np.argsort(mix(x))[: sketch_length(x.size, percent)]]


def _items(benchmark: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """One row per distinct non-empty shingle set: its smallest item id, how many items have it, the set."""

    def run(batches):
        for batch in batches:
            got = [(batch.column(0)[i].as_py(), x) for i, x in shingle_sets(batch.column(1), n) if x.size]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in got], pa.int64()), pa.array([x.view(np.int64) for _, x in got], pa.list_(pa.int64()))], ["item_id", "set"])

    sets = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "item_id long, set array<long>")
    return sets.groupBy("set").agg(F.min("item_id").alias("item_id"), F.count("*").alias("n_items"))


class Index:
    """The minima of a block of items, and their full sets."""

    def __init__(self, rows: list, percent: int):
        self.percent = percent
        self.item = [r.item_id for r in rows]
        self.items = [r.n_items for r in rows]
        self.sets = [np.asarray(r.set, np.int64).view(U64) for r in rows]
        keys, owners = [np.empty(0, U64)], [np.empty(0, np.int64)]
        for k, x in enumerate(self.sets):
            keys.append(minima(x, percent))
            owners.append(np.full(keys[-1].size, k))
        keys, owners = np.concatenate(keys), np.concatenate(owners)
        order = np.argsort(keys, kind="stable")
        self.keys, self.owners = keys[order], owners[order]

    def matches(self, column: pa.Array, n: int):
        """(row, item, shared) for every item that a row of the column contains."""
        if not self.keys.size:
            return
        for lo, hi, data, offsets in text_chunks(column):
            words, at = hash_words(data, offsets)
            long = shingle_hashes(words, n) if words.size >= n else np.empty(0, U64)
            where = np.minimum(np.searchsorted(self.keys, long), self.keys.size - 1)
            hit = np.flatnonzero(self.keys[where] == long)
            rows = np.searchsorted(at, hit, "right") - 1
            rows = rows[hit + n <= at[rows + 1]]
            short = np.flatnonzero((np.diff(at) > 0) & (np.diff(at) < n))
            for i in np.union1d(rows, short):
                x = np.unique(shingle_hashes(words[at[i] : at[i + 1]], n))
                found = np.searchsorted(self.keys, x, "left"), np.searchsorted(self.keys, x, "right")
                for k in np.unique(np.concatenate([self.owners[a:b] for a, b in zip(*found, strict=True) if a < b] or [self.owners[:0]])):
                    item = self.sets[k]
                    shared = int((x[np.minimum(np.searchsorted(x, item), x.size - 1)] == item).sum())
                    if 100 * shared >= self.percent * item.size:
                        yield lo + int(i), int(k), shared


def _index(items: DataFrame, percent: int) -> Index | None:
    """The items as an index for the workers, or None where they are too many."""
    total = items.agg(F.sum(F.size("set"))).first()[0] or 0
    return Index(items.collect(), percent) if total <= BLOCK else None


def _told_apart(docs: DataFrame, text: Column) -> DataFrame:
    t = F.coalesce(text.cast("string"), F.lit(""))
    return docs.withColumns({"h": F.xxhash64(t), "crc": F.crc32(t.cast("binary")), "size": F.length(t)})


def _dealt(texts: DataFrame, items: DataFrame, n: int, percent: int) -> DataFrame:
    """``(h, crc, size, item, n_items, n_shingles, n_shared)`` of the texts (text and ``_TEXT``) that contain an item."""

    def keys_of(batches):
        for batch in batches:
            for item, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                key = minima(x.values.to_numpy().view(U64), percent)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array([item] * key.size, pa.int64())], ["key", "item"])

    keys = written(items.select("item_id", "set").mapInArrow(keys_of, "key long, item long"), "minima", per_core=8)
    power = min(MOST_POWER, max(15, (64 * keys.count()).bit_length()))
    marks = bitmap(keys.select(F.shiftrightunsigned("key", 64 - power).alias("place")), 1 << power)

    def passing(batches):
        for batch in batches:
            got = [(i, x[marked(marks, (x >> U64(64 - power)).astype(np.int64))]) for i, x in shingle_sets(batch.column(0), n)]
            rows = pa.array(np.repeat([i for i, _ in got], [x.size for _, x in got]).astype(np.int64))
            key = pa.array(np.concatenate([x for _, x in got] or [np.empty(0, U64)]).view(np.int64))
            yield pa.RecordBatch.from_arrays([key, *(batch.column(k).take(rows) for k in (1, 2, 3))], ["key", *_TEXT])

    hits = texts.select("text", *_TEXT).mapInArrow(passing, "key long, h long, crc long, size int")
    candidates = written(hits.join(keys, "key").select("item", *_TEXT).distinct(), "candidates", per_core=4)
    chosen = texts.select("text", *_TEXT).join(candidates.select(*_TEXT).distinct(), _TEXT, "left_semi").groupBy(*_TEXT).agg(F.first("text").alias("text"))
    sets = items.select(F.col("item_id").alias("item"), "n_items", "set")

    def shared(batches):
        for batch in batches:
            own = [x for _, x in shingle_sets(batch.column(0), n)]
            item = [x.values.to_numpy().view(U64) for x in batch.column(1)]
            k = pa.array([int(np.isin(b, a, assume_unique=True).sum()) for a, b in zip(own, item, strict=True)], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in range(2, batch.num_columns)), pa.array([x.size for x in item], pa.int64()), k], [*_TEXT, "item", "n_items", "n_shingles", "n_shared"])

    both = candidates.join(chosen, _TEXT).join(sets, "item").select("text", "set", *_TEXT, "item", "n_items")
    found = both.mapInArrow(shared, "h long, crc long, size int, item long, n_items long, n_shingles long, n_shared long")
    return written(found.where(f"100 * n_shared >= {percent} * n_shingles"), "contained", per_core=4)


def contained_items(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """``(doc id, item id, n_items, n_shingles, n_shared)``: each document with each item of which it contains
    ``percent`` / 100 or more of the distinct n-word shingles (of fewer words, the whole sequence as one).

    Items with equal sets are one item: the smallest id stands for all n_items. Null and empty texts contain nothing
    and are contained in nothing; repeated rows give repeated matches; an empty table on either side gives no rows."""
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").cast("string").alias("text"))
    names = ["doc", "item", "n_items", "n_shingles", "n_shared"]
    items = written(_items(benchmark, item_col, item_text_col, n), "items", per_core=2)
    index = _index(items, percent)
    if index is None:
        texts = _told_apart(src, F.col("text"))
        out = texts.drop("text").join(_dealt(texts, items, n, percent), _TEXT).select(*names)
        return out.toDF(id_col, item_col, *names[2:])

    def run(batches):
        for batch in batches:
            got = list(index.matches(batch.column(1), n))
            rows = pa.array([r for r, _, _ in got], pa.int64())
            cols = [[index.item[k] for _, k, _ in got], [index.items[k] for _, k, _ in got], [index.sets[k].size for _, k, _ in got], [s for _, _, s in got]]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), *(pa.array(c, pa.int64()) for c in cols)], names)

    return src.mapInArrow(run, ", ".join(f"{c} long" for c in names)).toDF(id_col, item_col, *names[2:])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """The documents that contain no item, with all their columns; with an index of up to ``BLOCK`` hashes filtered while they
    stream, not joined."""
    rows = packed(docs, [], text=F.col(f"`{text_col}`").cast("string"))
    items = written(_items(benchmark, item_col, item_text_col, n), "items", per_core=2)
    index = _index(items, percent)
    if index is None:
        texts = _told_apart(rows, F.col("text"))
        return texts.join(_dealt(texts, items, n, percent).select(*_TEXT).distinct(), _TEXT, "left_anti").select("_row.*")

    def run(batches):
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            keep[[r for r, _, _ in index.matches(batch.column(1), n)]] = False
            yield batch.filter(pa.array(keep))

    return rows.mapInArrow(run, rows.schema).select("_row.*")
