"""Plain versions of the operators, and documents with every awkward case."""

import random
import re

LOWER = {i: i + 32 for i in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, n):
    ws = words((text or "").translate(LOWER))
    if len(ws) < n:
        return {tuple(ws)} if ws else set()
    return {tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)}


def components(sets, percent=80):
    ids = [i for i in sets if i is not None]
    of = {i: i for i in ids}

    def root(i):
        while of[i] != i:
            i = of[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = root(a), root(b)
                of[max(p, q)] = min(p, q)
    return {i: root(i) for i in ids}


def awkward(seed=1):
    """Rows of documents: nulls, empty and blank texts, one word, copies, near copies, repeated rows, a very long text."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    base = [say(rng.randint(30, 120)) for _ in range(25)]
    texts = [None, "", " \t\n\x0b\f\r", "Word", "word", "two words", "É é\u00a0x", *base]
    for b in base[:12]:
        ws = b.split()
        texts.append(b.upper())
        for _ in range(3):
            v = list(ws)
            for _ in range(rng.randint(1, max(1, len(v) // 25))):
                v[rng.randrange(len(v))] = rng.choice(vocab)
            texts.append("  ".join(v))
    texts.append(say(30_000) + " " + base[0])
    rows = [(i, t, "en" if i % 3 else None, ["a", "b", None, "a", "a"][i % 5], len(t or "")) for i, t in enumerate(texts)]
    return rows + [rows[8], rows[8]] + [(None, base[0], None, "a", 1), (None, None, None, None, None)]


def with_clashes(df):
    """Extra columns whose names operators use themselves."""
    from pyspark.sql import functions as F

    for c in ("id", "n", "kept", "rep", "component_id", "_text", "_row", "part", "row", "slot", "mark", "rate", "copies", "_key", "set", "a.b", "n_words", "spans", "host", "verdict"):
        df = df.withColumn(c, F.lit("x"))
    return df
