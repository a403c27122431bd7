import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from framegauge.llm import decontaminate, lm_score, mixing, quality, sharding, url_filter
from framegauge.llm.common import U64
from tests.llm.plain import LOWER, SCHEMA, awkward, components, shingles, with_clashes, words

RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block")]
URLS = ["http://a.EXAMPLE.org/en/12?x", "http://example.org/es/", "https://xexample.org/es/a", "http://example.org/en/2", "http://example.org", "http://example.org?x=http://b.org/", "mailto:x", "a://b://c/d", None, "http://É.org/ü#f", "http://h:80/p"]


def plain_url(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = rest[:end].translate(LOWER)
    path = rest[end:]
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [r for r, _ in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
    return host, path, max(fits, key=len) if fits else None


@pytest.mark.parametrize("most", [url_filter.BROADCAST_BYTES, 0])
def test_url_rules_and_cascade(spark, most, monkeypatch):
    rows = [(i, u, "x") for i, u in enumerate(URLS + [f"http://s{i % 50}.net/{i}" for i in range(3000)])]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    keys = sorted({"".join(plain_url(u)[:2]) for _, u, _ in rows})
    listed = set(keys[::7])
    levels = url_filter.cascade(spark.createDataFrame([(k, k in listed) for k in keys] + [("http", None)], "key string, listed boolean"), shard_keys=500)
    assert levels.select("shard").distinct().count() > 1 and levels.agg(F.max("level")).first()[0] >= 2
    monkeypatch.setattr(url_filter.with_listed, "__defaults__", ("listed", most))
    got = {r.page_id: r for r in url_filter.judge(pages, RULES, levels).collect()}
    assert len(got) == len(rows)
    for i, u, _ in rows:
        host, path, rule = plain_url(u)
        verdict = dict(RULES)[rule] if rule else "block" if host + path in listed else "allow"
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict), u
    assert url_filter.judge(pages.limit(0), RULES, levels).count() == 0


def test_cascade_of_arrays():
    rng = np.random.default_rng(1)
    a, b = (tuple(rng.integers(0, 2**63, 5000, dtype=np.uint64) for _ in range(2)) for _ in range(2))
    levels = url_filter.build(a, b)
    assert url_filter.probe(levels, *a).all() and not url_filter.probe(levels, *b).any()
    assert url_filter.build((np.empty(0, U64), np.empty(0, U64)), b) == [] and not url_filter.probe([], *b).any()


def items():
    docs = awkward()
    texts = [docs[7][1], " ".join(docs[8][1].split()[3:28]), "word", None, "", docs[7][1], "not in there at all my friend", " ".join(docs[9][1].split()[:20] + ["zz"] * 1)]
    return [(i, t, "x") for i, t in enumerate(texts)]


@pytest.mark.parametrize("block", [decontaminate.BLOCK, 40])
def test_contained_items(spark, block, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK", block)
    docs, bench = awkward(), items()
    sets = {}
    for i, t, _ in bench:
        if shingles(t, 5):
            sets.setdefault(frozenset(shingles(t, 5)), []).append(i)
    want = Counter()
    for d in docs:
        own = shingles(d[1], 5)
        for s, ids in sets.items():
            if 100 * len(s & own) >= 80 * len(s):
                want[d[0], min(ids), len(ids), len(s), len(s & own)] += 1
    df, b = with_clashes(spark.createDataFrame(docs, SCHEMA)), spark.createDataFrame(bench, "item_id long, text string, n_items string")
    got = Counter(tuple(r) for r in decontaminate.contained_items(df, b).collect())
    assert got == want and want
    left = decontaminate.drop_contaminated(df, b)
    assert left.columns == df.columns and left.count() == sum(1 for d in docs if not any(k[0] == d[0] and 100 * len(shingles(d[1], 5) & set(s)) >= 80 * len(s) for k in want for s in sets))
    assert decontaminate.contained_items(df, b.limit(0)).count() == 0 and decontaminate.contained_items(df.limit(0), b).count() == 0
    assert decontaminate.drop_contaminated(df, b.limit(0)).count() == len(docs)


def test_short_item_in_a_very_long_document(spark):
    docs = [(1, awkward()[-5][1], None, None, 0)]
    item = " ".join(docs[0][1].split()[20_000:20_026])
    got = decontaminate.contained_items(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame([(9, item)], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id, r.n_shared) for r in got] == [(1, 9, r.n_shingles) for r in got] and got


def test_shards(spark):
    rows = [(i % 997 if i else None, f"t{i}", "en", "hot" if i % 3 else ["a", "b", None][i % 7 % 3], i) for i in range(2003)]
    df = with_clashes(spark.createDataFrame(rows, SCHEMA))
    got = sharding.shard(df, 8).collect()
    assert len(got) == 2003 and {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    by = {s: [r for r in got if r.shard == s] for s in range(8)}
    sizes = [len(x) for x in by.values()]
    assert max(sizes) - min(sizes) <= 1
    mix = Counter(r.source for r in got)
    for x in by.values():
        assert sorted(r.slot for r in x) == list(range(len(x)))
        for source, n in Counter(r.source for r in x).items():
            assert abs(n - mix[source] / 8) <= 2
    again = sharding.shard(df.repartition(7), 8).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    assert sharding.shard(spark.createDataFrame([], SCHEMA)).count() == 0


def test_poisson_replication(spark):
    rows = [(i, "t", "en", "hot" if i % 3 == 0 else f"s{i % 11}", 0) for i in range(6000)] + [(None, None, None, None, None)]
    df = with_clashes(spark.createDataFrame(rows, SCHEMA))
    got = mixing.mix(df)
    out = got.collect()
    assert set(df.columns) <= set(got.columns) | {"rate"}
    per = Counter(r.source for r in out)
    goal = len(rows) / len(set(r[3] for r in rows))
    assert all(abs(per[s] - goal) < 6 * math.sqrt(goal) for s in per if s is not None)
    copies = Counter((r.doc_id) for r in out)
    assert all(copies[r.doc_id] == r.copies and 1 <= r.copy <= r.copies for r in out)
    assert Counter((r.doc_id, r.copy, r.shuffle_key) for r in mixing.mix(df.repartition(5)).collect()) == Counter((r.doc_id, r.copy, r.shuffle_key) for r in out)
    some = mixing.mix(df, {"hot": 3.0, "s1": 1.0}, total=400)
    assert {r.source for r in some.collect()} == {"hot", "s1"} and abs(some.count() - 400) < 120
    assert mixing.mix(df.limit(0)).count() == 0


def test_large_means(spark):
    df = spark.createDataFrame([(i, "a" if i < 4 else "b") for i in range(400)], "doc_id long, source string")
    n = Counter(r.source for r in mixing.mix(df, {"a": 1.0}, total=8000).collect())
    assert abs(n["a"] - 8000) < 600 and "b" not in n


def plain_losses(docs, good, least=2, prior=4.0):
    """Both models counted anew for every document; a target document is left out of the target's."""
    toks = [(i, words((t or "").translate(LOWER))) for i, t in docs]
    count = Counter(w for _, ws in toks for w in ws)
    vocab = {w for w, c in count.items() if c >= least}

    def counted(texts):
        pair, uni, ctx = Counter(), Counter(), Counter()
        for ws in texts:
            for p, w in zip(["<s>", *(x if x in vocab else None for x in ws)], [x if x in vocab else None for x in ws]):
                pair[p, w] += 1
                uni[w] += 1
                ctx[p] += 1
        return pair, uni, ctx

    def loss(model, own, p, w):
        (pair, uni, ctx), (pair_, uni_, ctx_) = model, own
        n = sum(model[1].values()) - sum(own[1].values())
        return math.log(ctx[p] - ctx_[p] + prior) - math.log(pair[p, w] - pair_[p, w] + prior * (uni[w] - uni_[w] + 1) / (n + len(vocab) + 1))

    bg, tg = counted([ws for _, ws in toks]), counted([ws for i, ws in toks if i in good])
    out = []
    for i, ws in toks:
        t = [x if x in vocab else None for x in ws]
        pairs, none = Counter(zip(["<s>", *t], t)), counted([])
        own = counted([ws]) if i in good else none
        mean = lambda model, left: sum(m * loss(model, left, *p) for p, m in pairs.items()) / len(ws) if ws else None  # noqa: B023, E731
        out.append((i, len(ws), mean(tg, own), mean(bg, none)))
    return out


def same_losses(got, want):
    key = lambda r: str((r[0], r[1], round(r[2], 6) if r[2] is not None else None, round(r[3], 6) if r[3] is not None else None))
    assert sorted(map(key, got)) == sorted(map(key, want))
    for r in got:
        assert (r.score is None) == (r.n_tokens == 0) and (r.score is None or abs(r.score - (r.target_loss - r.background_loss)) < 1e-12)


@pytest.mark.parametrize("ids,block,dealt", [(lm_score.TARGET_IDS, lm_score.BLOCK_BYTES, lm_score.DEALT), (0, 3000, 100), (lm_score.TARGET_IDS, 1, 50)])
def test_lm_scores_like_plain_python(spark, ids, block, dealt, monkeypatch):
    """The same scores whatever the blocks and hash ranges."""
    monkeypatch.setattr(lm_score, "TARGET_IDS", ids)
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", block)
    monkeypatch.setattr(lm_score, "DEALT", dealt)
    monkeypatch.setattr(lm_score, "MOST_TASKS", 5)
    rows = awkward()
    good = {r[0] for r in rows if r[0] is not None and r[0] % 2 == 0}
    target = spark.createDataFrame([(i,) for i in good] + [(4,), (None,)], "doc_id long")
    got = lm_score.score(with_clashes(spark.createDataFrame(rows, SCHEMA)), target).collect()
    same_losses(got, plain_losses([(r[0], r[1]) for r in rows], good))


def test_lm_counts_every_word_and_pair(spark, monkeypatch):
    """Hundreds of thousands of words and pairs, all of one frequency, in several ranges; ids that are no numbers."""
    monkeypatch.setattr(lm_score, "DEALT", 1 << 16)
    rng = np.random.default_rng(1)
    rows = [(f"d{i}", " ".join(f"w{x}" for x in rng.permutation(70_000)[:35_000]) + " the of the of" + " once%d" % i) for i in range(8)] + [(f"d{i}", f"the of w{i} w{i + 1} the of") for i in range(8, 60)]
    good = {"d0", "d3", "d9", "d10", "d11"}
    got = lm_score.score(spark.createDataFrame(rows, "doc_id string, text string"), spark.createDataFrame([(i,) for i in good], "doc_id string")).collect()
    same_losses(got, plain_losses(rows, good))


def test_lm_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert lm_score.score(empty, empty.select("doc_id")).count() == 0
    blank = spark.createDataFrame([(1, None), (2, ""), (3, " \n")], "doc_id long, text string")
    assert [tuple(r)[1:] for r in lm_score.score(blank, empty.select("doc_id")).collect()] == [(0, None, None, None)] * 3


def test_lm_packing():
    for x in (np.empty(0, U64), np.array([0, 0], U64), np.sort(np.random.default_rng(1).integers(0, 2**64 - 1, 1000, dtype=U64))):
        assert (lm_score._unpacked(lm_score._packed(x)) == x).all()
        assert (np.cumsum(lm_score._unpacked(lm_score._packed(lm_score._steps(x))), dtype=U64) == x).all()


def test_pipeline_like_brute_force(spark, tmp_path):
    bench = [(0, " ".join(awkward()[9][1].split()[2:30])), (1, "nothing of the kind in any text")]
    rows = awkward()
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = [tuple(r) for r in quality.keep_good(docs).collect()]
    sets = {r[0]: shingles(r[1], 5) for r in kept}
    comp = components(sets)
    unique = {r[0]: r for r in kept if r[0] is None or comp[r[0]] == r[0]}
    clean = {i for i, r in unique.items() if not any(s and 100 * len(s & shingles(r[1], 5)) >= 80 * len(s) for s in (shingles(t, 5) for _, t in bench))}
    assert len(clean) < len(unique) < len(kept) < len(rows)
    drawn = Counter(r.doc_id for r in mixing.mix(docs.where(F.col("doc_id").isin([i for i in clean if i is not None]) | F.lit(False)).dropDuplicates(["doc_id"])).collect()) if None not in clean else None
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} <= clean
    if drawn is not None:
        assert Counter(r.doc_id for r in out) == drawn
    for stage_name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")], stage_name
