import random

import numpy as np
import pytest

from framegauge.llm.common import U64, hash_words
from framegauge.llm.components import connected_components
from framegauge.llm.near_dedup import keep_one, near_duplicates, rows_per_band, sketches
from tests.llm.plain import SCHEMA, awkward, components, shingles, with_clashes


@pytest.mark.parametrize("n", [2, 5])
def test_same_components_as_brute_force(spark, n):
    rows = awkward()
    got = near_duplicates(with_clashes(spark.createDataFrame(rows, SCHEMA)), n=n).collect()
    assert len(got) == len(rows)
    sets = {r[0]: shingles(r[1], n) for r in rows}
    want = components(sets)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)


def test_drifting_variants_stay_whole(spark):
    """Variants of one text, many of them just over or under the threshold to one another."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(150):
        v = list(base)
        for k in rng.sample(range(120), rng.randint(0, 9)):
            v[k] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(v), "en", "s", 1))
    got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(rows, SCHEMA), n=2).collect()}
    assert got == components({r[0]: shingles(r[1], 2) for r in rows})


def test_one_id_with_two_texts_links_both(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(5, a, None, None, 0), (5, b, None, None, 0), (7, a, None, None, 0), (9, b, None, None, 0)]
    assert {r.component_id for r in near_duplicates(spark.createDataFrame(rows, SCHEMA), n=2).collect()} == {5}


def test_keep_one_keeps_columns_and_one_of_each(spark):
    df = with_clashes(spark.createDataFrame(awkward(), SCHEMA))
    out = keep_one(df, n=2)
    assert out.columns == df.columns
    ids = [r.doc_id for r in out.select("doc_id").collect()]
    want = components({r[0]: shingles(r[1], 2) for r in awkward()})
    assert sorted(i for i in ids if i is not None) == sorted(i for i, c in want.items() if i == c)
    assert ids.count(None) == 2


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert near_duplicates(empty).collect() == [] and keep_one(empty).collect() == []


def plain_sketch(x, t=128, seed=1):
    """One ball an element and round into a random bin; then all into one bin a round."""
    mask = 2**64 - 1

    def mixed(v):
        v ^= v >> 30
        v = v * 0xBF58476D1CE4E5B9 & mask
        v ^= v >> 27
        v = v * 0x94D049BB133111EB & mask
        return v ^ v >> 31

    out = [None] * t
    for r in range(2 * t):
        for e in x:
            h = mixed((int(e) + mixed(r + seed * 1000003)) & mask)
            j, v = (h >> 57, (r << 48) | (h & ((1 << 48) - 1))) if r < t else (r - t, (r << 48) | (h & ((1 << 48) - 1)))
            if out[j] is None or (out[j] >> 48 == r and v < out[j]):
                out[j] = v
    return out


def test_sketches_are_full_and_estimate():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (1, 0, 2, 7, 128, 3000, 40, 0)]
    at = np.concatenate([[0], np.cumsum([x.size for x in sets])])
    got = sketches(np.concatenate(sets), at)
    for x, s in zip(sets, got, strict=True):
        assert (s == U64(2**64 - 1)).all() if not x.size else s.tolist() == plain_sketch(x)
        assert (s == sketches(x[::-1], np.array([0, x.size]))[0]).all()
    x = sets[5]
    y = np.concatenate([x[:1500], rng.integers(0, 2**63, 1500, dtype=np.uint64)])
    assert abs((got[5] == sketches(y, np.array([0, 3000]))[0]).mean() - 1 / 3) < 0.2


def test_many_copies_beside_foreign_texts(spark):
    """A large cluster whose buckets also hold texts that are half alike: all copies are one component, the others stay apart,
    and members of the cluster don't meet each other (a pair of each two of 3,000 would be 4.5 million)."""
    rng = random.Random(9)
    base = [f"w{rng.randrange(10**6)}" for _ in range(100)]
    rows = []
    for i in range(3000):
        v = list(base)
        for k in rng.sample(range(100), 2):
            v[k] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(v), "en", "s", 1))
    for i in range(3000, 3040):
        rows.append((i, " ".join(base[:86] + [f"y{rng.randrange(10**6)}" for _ in range(14)]), "en", "s", 1))
    got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(rows, SCHEMA), n=2).collect()}
    assert {got[i] for i in range(3000)} == {0}
    sets = {i: shingles(rows[i][1], 2) for i in (*range(0, 3000, 30), *range(3000, 3040))}
    linked = {i for i in range(3000, 3040) if any(100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) for j in range(0, 3000, 30))}
    assert all(got[i] == 0 for i in linked)


def test_bands_miss_little():
    r = rows_per_band(128, 80)
    assert (1 - 0.8**r) ** (128 // r) < 1e-6


def test_words_do_not_depend_on_blocks():
    text = ("ab  cdé\tf\nLonger-word " * 300 + "y" * 9000).encode()
    data, offsets = np.frombuffer(text, np.uint8), np.array([0, 5, 5, 2000, len(text)])
    whole, at = hash_words(data, offsets)
    parts, at2 = hash_words(data, offsets, block=64)
    assert (whole == parts).all() and (at == at2).all()


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 90), (90, 95), (3, 3), (None, 4)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 90: 90, 95: 90, 100: 90}
