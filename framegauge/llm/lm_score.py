"""Language-model scores by cross-entropy difference (Moore and Lewis, 2010).

Two bigram models, of the target documents and of all documents, share one vocabulary (every word that occurs ``least``
times; all others are one unknown word), one order and one smoothing. A document's score is the mean over its tokens of
the target model's loss less the background model's: low scores are like the target. A target document is held out of
the target model that scores it: its own counts are taken away.

Every word and every bigram counts, exactly; nothing is pruned, and there is one way for every size. Documents are coded
once in blocks of ``BLOCK_BYTES`` of text, as a written table. A block asks for the totals of the words, later of the
pairs, that it holds: sorted 64-bit hashes with the block's own counts, cut by hash range, go to the tasks that own the
ranges; the totals come back in the block's order, without the hashes. No task holds more than a block or about
``DEALT`` hashes, no model is sent anywhere, and a frequent word or pair is one entry of each block."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framegauge.llm.common import U64, hash_words, mix, text_chunks, written

PRIOR = 4.0
#: Up to so many integer ids of the target are sent to the workers (32 MB); more are joined.
TARGET_IDS = 1 << 22
#: Text in a block; a longer document is a block of its own.
BLOCK_BYTES = 8 << 20
#: Hashes, summed over all blocks, in a range that one task holds at a time; several ranges follow one another.
DEALT = 1 << 20
#: Tasks of the ranges' shuffle at most.
MOST_TASKS = 1 << 14
#: Stand for the unknown word and for a text's beginning among the word hashes.
UNKNOWN, START = 0, 1
#: Known words, their counts in all texts and the target's; the unknown ones' counts, and how many of both end a text.
_SUMS = ["size", "n", "k", "un", "u_last", "uk", "uk_last"]


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers as compressed byte planes, as many as the largest needs."""
    x = np.ascontiguousarray(x, U64)
    width = (int(x.max()).bit_length() + 7) // 8 if x.size else 0
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return struct.pack("<QB", x.size, width) + pa.compress(planes, codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    size, width = struct.unpack_from("<QB", data)
    out = np.zeros((size, 8), np.uint8)
    if size * width:
        raw = pa.decompress(data[9:], decompressed_size=size * width, codec="zstd", asbytes=True)
        out[:, :width] = np.frombuffer(raw, np.uint8).reshape(width, size).T
    return out.view(U64).ravel()


def _steps(x: np.ndarray) -> np.ndarray:
    """A sorted array as its differences; ``np.cumsum`` undoes it."""
    return np.diff(x, prepend=U64(0))


def _hits(marks: pa.Array, wanted: np.ndarray | None) -> np.ndarray:
    """Which rows are in the target: the mark itself, or with ``wanted`` (sorted ids) whether it is one of them."""
    if wanted is None:
        return marks.fill_null(False).to_numpy(zero_copy_only=False).astype(bool)
    if not wanted.size:
        return np.zeros(len(marks), bool)
    ids = marks.fill_null(0).to_numpy(zero_copy_only=False)
    return (wanted[np.minimum(np.searchsorted(wanted, ids), wanted.size - 1)] == ids) & ~marks.is_null().to_numpy(zero_copy_only=False)


def _blocks(src: DataFrame, kind: str, wanted: np.ndarray | None) -> DataFrame:
    """A row per block of documents: ids, marks, numbers of words, the sorted hashes of the block's words, how often each
    occurs, and the texts as ranks of words by frequency. ``n_words`` and ``n_pairs`` bound what the block will ask for."""
    names = ["block", "n_docs", "k_docs", "n_words", "n_pairs", "ids", "marks", "sizes", "vocab", "counts", "codes"]

    def coded(block, ids, marks, sizes, words):
        marks, sizes, words = np.concatenate(marks), np.concatenate(sizes), np.concatenate(words)
        vocab, code, n = np.unique(words, return_inverse=True, return_counts=True)
        rank = np.empty(vocab.size, np.int64)
        rank[np.argsort(-n, kind="stable")] = np.arange(vocab.size)
        ids = pa.concat_arrays(ids)
        full = sizes > 0
        return pa.RecordBatch.from_arrays([
            *(pa.array([int(x)], pa.int64()) for x in (block, full.sum(), (full & marks).sum(), vocab.size, words.size)),
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            *(pa.array([_packed(x)], pa.binary()) for x in (marks, sizes, _steps(vocab), n, rank[code])),
        ], names)

    def run(batches):
        block, held, size = TaskContext.get().partitionId() << 32, ([], [], [], []), 0
        for batch in batches:
            marks = _hits(batch.column(1), wanted)
            for lo, hi, data, offsets in text_chunks(batch.column(2)):
                if size and size + data.size > BLOCK_BYTES:
                    yield coded(block, *held)
                    block, held, size = block + 1, ([], [], [], []), 0
                words, at = hash_words(data, offsets)
                for x, new in zip(held, (batch.column(0)[lo:hi], marks[lo:hi], np.diff(at), words), strict=True):
                    x.append(new)
                size += data.size
        if held[0]:
            yield coded(block, *held)

    schema = f"block long, n_docs long, k_docs long, n_words long, n_pairs long, ids array<{kind}>, marks binary, sizes binary, vocab binary, counts binary, codes binary"
    return written(src.select("id", "mark", "text").mapInArrow(run, schema), "blocks")


class _Block:
    """Documents as numbers; ``code`` is the place of each token's word in ``vocab``."""

    def __init__(self, marks, sizes, vocab, counts, codes):
        self.mark, self.size = _unpacked(marks).astype(bool), _unpacked(sizes).astype(np.int64)
        self.vocab = np.cumsum(_unpacked(vocab), dtype=U64)
        self.n = _unpacked(counts).astype(np.int64)
        self.code = np.argsort(-self.n, kind="stable").astype(np.int32)[_unpacked(codes).view(np.int64)]
        self.doc = np.repeat(np.arange(self.size.size, dtype=np.int32), self.size)
        self.full = np.flatnonzero(self.size)
        ends = np.cumsum(self.size)[self.full]
        self.first, self.last = ends - self.size[self.full], ends - 1

    def word_counts(self) -> np.ndarray:
        """Of every word: its count, how often it ends a text, and the same in the target."""
        count = lambda at: np.bincount(self.code[at], minlength=self.vocab.size)
        of = self.mark[self.doc]
        return np.vstack([self.n, count(self.last), count(of), count(self.last[of[self.last]])])

    def known(self, totals: np.ndarray, least: int) -> None:
        """Gives words under ``least`` the place behind the vocabulary; the next one is a text's beginning."""
        size = self.vocab.size
        self.word = np.where(totals[0] >= least, np.arange(size), size).astype(np.int32)[self.code]
        self.before = np.empty_like(self.word)
        self.before[1:] = self.word[:-1]
        self.before[self.first] = size + 1
        h = np.append(self.vocab, np.array([UNKNOWN, START], U64))
        slots = (h * U64(0x9FB21C651E98DF25))[self.before]
        slots ^= h[self.word]
        self.slot, pair = np.unique(mix(slots), return_inverse=True)
        self.pair = pair.astype(np.int32)

    def pair_counts(self) -> np.ndarray:
        count = lambda x: np.bincount(x, minlength=self.slot.size)
        return np.vstack([count(self.pair), count(self.pair[self.mark[self.doc]])])

    def losses(self, words: np.ndarray, pairs: np.ndarray, all_: dict, prior: float) -> np.ndarray:
        """The sum of both models' losses, background first, of every document."""
        out = np.zeros((2, self.size.size))
        if not self.code.size:
            return out
        ends = np.array([[all_["un"], 0], [all_["u_last"], -all_["n_docs"]], [all_["uk"], 0], [all_["uk_last"], -all_["k_docs"]]])
        n, last, k, k_last = np.hstack([words, ends])  # a beginning has no count, but words after it
        mass = all_["n"] + all_["un"] + all_["size"] + 1.0
        loss = np.log((n - last)[self.before] + prior) - np.log(pairs[0][self.pair] + prior * (n[self.word] + 1.0) / mass)
        out[0, self.full] = np.add.reduceat(loss, self.first)
        held = np.flatnonzero(self.mark[self.doc])
        doc = self.doc[held].astype(np.int64)

        def own(of: np.ndarray) -> np.ndarray:
            """How often a held-out document has what it has at each of its tokens."""
            _, nth, m = np.unique(doc * (int(of.max()) + 1) + of[held], return_inverse=True, return_counts=True)
            return m[nth]

        left = k[self.word] + 1.0
        left[held] -= own(self.word)
        mass = np.full(self.size.size, all_["k"] + all_["uk"] + all_["size"] + 1.0) - self.size * self.mark
        left *= prior / mass[self.doc]
        left += pairs[1][self.pair]
        left[held] -= own(self.pair)
        np.log(left, out=left)
        context = (k - k_last)[self.before] + prior
        context[held] -= own(self.before)
        out[1, self.full] = np.add.reduceat(np.log(context, out=context) - left, self.first)
        return out


_CODED = ["marks", "sizes", "vocab", "counts", "codes"]


def _ask(block: int, keys: np.ndarray, counts: np.ndarray, ranges: int) -> pa.RecordBatch:
    """A row for each hash range of which the block holds keys."""
    range_ = ((keys >> U64(32)) * U64(ranges)) >> U64(32)
    start = np.flatnonzero(np.diff(range_, prepend=U64(2**64 - 1)))
    end = np.append(start[1:], keys.size)[: start.size]
    cols = [[block] * start.size, range_[start].astype(np.int64), [_packed(_steps(keys[a:b])) for a, b in zip(start, end, strict=True)], [_packed(counts[:, a:b].ravel()) for a, b in zip(start, end, strict=True)]]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], ["block", "range", "keys", "counts"])


def _runs(batches, column: str):
    """The rows, as dictionaries, of each run of equal values of a column."""
    rows = []
    for batch in batches:
        for i in range(batch.num_rows):
            row = {k: batch.column(k)[i] for k in batch.schema.names}
            if rows and rows[-1][column] != row[column]:
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def _answered(asked: DataFrame, ranges: int, least: int | None = None) -> DataFrame:
    """``(block, range, totals, sums)``: a row for each that was asked, totals in the order of its keys; and with ``least``
    a row of ``sums`` for each range, see ``_SUMS``."""

    def run(batches):
        for rows in _runs(batches, "range"):
            keys = [np.cumsum(_unpacked(r["keys"].as_py()), dtype=U64) for r in rows]
            counts = np.hstack([_unpacked(r["counts"].as_py()).astype(np.int64).reshape(-1, x.size) for r, x in zip(rows, keys, strict=True)])
            cut, all_keys = np.cumsum([x.size for x in keys])[:-1], np.concatenate(keys)
            order = np.argsort(all_keys, kind="stable")
            new = np.flatnonzero(np.concatenate([[True], np.diff(all_keys[order]) != 0]))
            total = np.add.reduceat(counts[:, order], new, axis=1)
            nth = np.empty(all_keys.size, np.int64)
            nth[order] = np.repeat(np.arange(new.size), np.diff(np.append(new, all_keys.size)))
            block, at, sums = [r["block"].as_py() for r in rows], rows[0]["range"].as_py(), [None] * len(rows)
            totals = [_packed(total[:, x].ravel()) for x in np.split(nth, cut)]
            if least is not None:
                good = total[0] >= least
                block, totals = [*block, -1], [*totals, None]
                sums.append([int(good.sum()), *(int(x) for x in total[[0, 2]][:, good].sum(axis=1)), *(int(x) for x in total[:, ~good].sum(axis=1))])
            yield pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), pa.array([at] * len(block), pa.int64()), pa.array(totals, pa.binary()), pa.array(sums, pa.list_(pa.int64()))], ["block", "range", "totals", "sums"])

    dealt = asked.repartition(min(ranges, MOST_TASKS), "range").sortWithinPartitions("range", "block")
    return dealt.mapInArrow(run, "block long, range long, totals binary, sums array<long>")


def _at_home(blocks: DataFrame, answers: list[DataFrame], shape: tuple[int, ...], work, schema: str) -> DataFrame:
    """``work(row, block, *counts)`` for every block with its answers: an array of counts for each kind of answer. The
    blocks' shuffle is the same each time, so a plan that holds it twice runs it once."""
    dealt = answers[0].select("block", F.lit(0).alias("kind"), "range", "totals")
    for kind, answer in enumerate(answers[1:], 1):
        dealt = dealt.union(answer.select("block", F.lit(kind), "range", "totals"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.slice(0, 1).to_pylist()[0]
        block = _Block(*(row[c] for c in _CODED))
        parts = [[np.zeros((height, 0), np.int64)] for height in shape]
        for kind, _, totals in sorted(zip(*(right.column(c).to_pylist() for c in ("kind", "range", "totals")), strict=True)):
            parts[kind].append(_unpacked(totals).astype(np.int64).reshape(shape[kind], -1))
        return work(left, block, *(np.hstack(x) for x in parts))

    return blocks.select("block", "ids", *_CODED).groupBy("block").cogroup(dealt.groupBy("block")).applyInArrow(run, schema)


def score(docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 2, prior: float = PRIOR) -> DataFrame:
    """``(id_col, n_tokens, target_loss, background_loss, score)``, a row for every input row.

    The target model counts the documents whose id is in ``target_ids`` (column ``id_col``), the background model all; a
    target document's own counts are left out of the target model that scores it.
    Words are lower-cased runs outside white space. A null or empty text has no tokens; its losses and score are null.
    Repeated rows count and are scored one by one; a null id is never in the target. An empty target leaves its model
    uniform; an empty table gives no rows. Pairs are told apart by a 64-bit hash of their words' hashes."""
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    good = target_ids.select(F.col(f"`{id_col}`").alias("id")).where("id is not null").distinct()
    id_type = docs.schema[id_col].dataType
    some = good.limit(TARGET_IDS + 1).toArrow().column(0) if isinstance(id_type, (T.LongType, T.IntegerType)) else None
    if some is not None and len(some) <= TARGET_IDS:
        wanted, src = np.sort(some.to_numpy().astype(np.int64)), src.withColumn("mark", F.col("id").cast("long"))
    else:
        wanted, src = None, src.join(good.withColumn("mark", F.lit(True)), "id", "left")
    kind = id_type.simpleString()
    blocks = _blocks(src, kind, wanted)
    whole = blocks.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_docs", "k_docs", "n_words", "n_pairs"))).first().asDict()
    word_ranges, pair_ranges = 1 + whole["n_words"] // DEALT, 1 + whole["n_pairs"] // DEALT

    def ask_words(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = _Block(*(row[c] for c in _CODED))
                if block.code.size:
                    yield _ask(row["block"], block.vocab, block.word_counts(), word_ranges)

    asked = "block long, range long, keys binary, counts binary"
    words = written(_answered(blocks.select("block", *_CODED).mapInArrow(ask_words, asked), word_ranges, least), "word-totals", per_core=8)
    totals = words.where("block = -1").agg(*(F.coalesce(F.sum(F.col("sums")[i]), F.lit(0)).alias(c) for i, c in enumerate(_SUMS))).first()
    all_ = whole | totals.asDict()
    words = words.where("block >= 0")

    def ask_pairs(row, block, n):
        block.known(n, least)
        return pa.Table.from_batches([_ask(row.column("block")[0].as_py(), block.slot, block.pair_counts(), pair_ranges)])

    pairs = _answered(_at_home(blocks, [words], (4,), ask_pairs, asked), pair_ranges)

    def losses(row, block, n, m):
        block.known(n, least)
        background, target = block.losses(n, m, all_, prior)
        return pa.table([row.column("ids").combine_chunks().flatten(), *map(pa.array, (block.size, target, background))], ["id", "n", "lt", "lb"])

    out = _at_home(blocks, [words, pairs], (4, 2), losses, f"id {kind}, n long, lt double, lb double")
    lt, lb = (F.when(F.col("n") > 0, F.col(c) / F.col("n")) for c in ("lt", "lb"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_tokens"), lt.alias("target_loss"), lb.alias("background_loss"), (lt - lb).alias("score"))
