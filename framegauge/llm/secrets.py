"""Secret scanning with built-in functions: base patterns, and sliding-window entropy over candidate strings.

Positions are code points. Spark has no function for the positions of matches, so they are summed from the lengths of
the matches and of the pieces between them: first in runs of about the square root of their number, then over the runs,
so that no step copies a list of all matches. Nothing is shuffled and no Python runs."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framegauge.functions.vectors import let
from framegauge.llm.common import packed

_ANY = lambda word: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
#: kind -> (pattern, group whose length counts, least length)
BASE = {
    "assign": (rf"({_ANY('password')}|{_ANY('passwd')}|{_ANY('secret')}|{_ANY('token')}|{_ANY('api')}_?{_ANY('key')})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}
#: The same matches found with less work: a run of one character class is matched whole, so the least length can stand in the pattern.
_QUICK = {"access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}
WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
#: kind -> (alphabet, least entropy in bits of some window of 20 characters)
CLASSES = {
    "hex_entropy": ("0123456789abcdef", 3.0),
    "base64_entropy": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-", 3.9),
}
#: Candidates that are never reported: words and slugs without digits, UUIDs, sample keys, counting runs.
ALLOW = [
    r"^[^0-9]*$",
    r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    r"EXAMPLE|example|xxxx|XXXX",
    r"0123456789|123456789|abcdefghij",
]
#: Candidates split at / _ - as well: each piece is judged by its own character class and against ``ALLOW`` on its own.
PIECE = r"[A-Za-z0-9+]{20,}"
#: kind -> (pattern of the whole piece, alphabet, least entropy in bits of some window); the first class that fits counts.
#: Of random strings of 20 characters 0.9 % (hex), 0.6 % (base32), 0.3 % (lower case and digits) and 0.1 % (base64) stay below.
PIECE_CLASSES = {
    "hex_piece": ("^([0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef", 2.9),
    "single_case_piece": ("^([0-9a-z]+|[0-9A-Z]+)$", "abcdefghijklmnopqrstuvwxyz0123456789", 3.3),
    "base64_piece": ("", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+", 3.5),
}
KINDS = [*BASE, *CLASSES, *PIECE_CLASSES]
#: A piece without digits that changes case like this (two inner runs of capitals) is no run of words.
_MIXED = "[a-z][A-Z]{2,}[a-z].*[A-Z]{2}"
#: A piece that matches this is never reported: the patterns of ``ALLOW`` without the one for words.
SAMPLE = "|".join(ALLOW[1:])
_SCALE = 1_000_000
#: c * log2(c), scaled to whole numbers, for every count that a window can hold.
XLOGX = [round(_SCALE * c * math.log2(c)) if c else 0 for c in range(WINDOW + 1)]


def most_repeated(bits: float) -> int:
    """The largest scaled sum of c * log2(c) with which a window still has that entropy."""
    return math.floor(_SCALE * WINDOW * (math.log2(WINDOW) - bits))


def _running(sizes: Column) -> Column:
    """Running sums of a non-empty array of whole numbers."""
    grown = lambda xs: F.aggregate(xs, F.array().cast("array<bigint>"), lambda out, x: F.concat(out, F.array(F.coalesce(F.get(out, F.size(out) - 1), F.lit(0).cast("bigint")) + x)))

    def whole(s):
        width = F.ceil(F.sqrt(F.size(s))).cast("int")
        runs = F.transform(F.sequence(F.lit(1), F.size(s), width), lambda k: grown(F.slice(s, k, width)))
        return let(runs, lambda r: let(grown(F.transform(r, lambda x: F.element_at(x, -1))), lambda ends: F.flatten(F.transform(r, lambda x, i: F.transform(x, lambda v: v + F.when(i == 0, F.lit(0).cast("bigint")).otherwise(F.get(ends, i - 1)))))))

    return let(sizes, whole)


def _spans(text: Column, pattern: str, kind: str, group: int = 0, least: int = 0) -> Column:
    """Array of (start, order, end, kind, value) of the matches whose group has the least length."""
    hits, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    counted = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
    parts = F.arrays_zip(hits.alias("hit"), between.alias("gap"), *([counted.alias("counted")] if group else []))
    size = lambda m: F.length(m["counted" if group else "hit"])
    one = lambda m, end: F.struct((end - F.length(m["hit"])).alias("start"), F.lit(KINDS.index(kind)).alias("order"), end.alias("end"), F.lit(kind).alias("kind"), m["hit"].alias("value"))
    ends = lambda p: _running(F.transform(p, lambda m: (F.length(m["gap"]) + F.coalesce(F.length(m["hit"]), F.lit(0))).cast("bigint")))
    # the last piece has no match behind it
    found = let(parts, lambda p: F.filter(F.zip_with(p, ends(p), lambda m, end: F.when(size(m) >= least, one(m, end))), lambda x: x.isNotNull()))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast("array<struct<start:bigint,order:int,end:bigint,kind:string,value:string>>"))


def _least_sum(value: Column, alphabet: str) -> Column:
    """The smallest scaled sum of c * log2(c) over all windows of the string, from counts that follow the window."""
    code = F.transform(F.split(value, ""), lambda ch: F.instr(F.lit(alphabet), ch))
    table = F.array(*(F.lit(x).cast("long") for x in XLOGX))
    f = lambda n: F.get(table, n)

    def step(a, i):
        new = F.element_at(a["code"], i)
        old = F.when(i > WINDOW, F.element_at(a["code"], F.greatest(i - WINDOW, F.lit(1)))).otherwise(0)
        n_new = F.element_at(a["n"], F.greatest(new, F.lit(1)))
        n_old = F.element_at(a["n"], F.greatest(old, F.lit(1)))
        change = F.when(new == old, 0).otherwise(f(n_new + 1) - f(n_new) + F.when(old > 0, f(n_old - 1) - f(n_old)).otherwise(0))
        s = (a["s"] + change).cast("long")
        n = F.when(new == old, a["n"]).otherwise(F.transform(a["n"], lambda c, k: c + F.when(k + 1 == new, 1).otherwise(0) - F.when(k + 1 == old, 1).otherwise(0)))
        return F.struct(a["code"].alias("code"), n.alias("n"), s.alias("s"), F.when(i >= WINDOW, F.least(a["best"], s)).otherwise(a["best"]).alias("best"))

    start = F.struct(code.alias("code"), F.array_repeat(F.lit(0), len(alphabet)).alias("n"), F.lit(0).cast("long").alias("s"), F.lit(2**62).alias("best"))
    return F.aggregate(F.sequence(F.lit(1), F.length(value)), start, step, lambda a: a["best"])


def _pieces(text: Column) -> Column:
    """Array of (start, order, end, kind, value) of the pieces that pass for their character class."""
    order = list(PIECE_CLASSES)

    def high(x):
        value, out = x["value"], F.lit(False)
        for name in reversed(order):
            pattern, alphabet, bits = PIECE_CLASSES[name]
            passes = _least_sum(F.lower(value) if pattern else value, alphabet) <= most_repeated(bits)
            out = F.when(value.rlike(pattern), passes).otherwise(out) if pattern else passes
        return out

    def named(x):
        out = F.lit(order[-1])
        for name in reversed(order[:-1]):
            out = F.when(x["value"].rlike(PIECE_CLASSES[name][0]), F.lit(name)).otherwise(out)
        place = F.array_position(F.array(*map(F.lit, KINDS)), out).cast("int") - 1
        return F.struct(x["start"].alias("start"), place.alias("order"), x["end"].alias("end"), out.alias("kind"), x["value"].alias("value"))

    judged = lambda x: (x["value"].rlike("[0-9]") | x["value"].rlike(_MIXED)) & ~x["value"].rlike(SAMPLE)
    found = F.filter(_spans(text, PIECE, "hex_entropy"), judged)
    return F.transform(F.filter(found, high), named)


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_assign, n_access, n_hex (long), base_spans and spans (arrays of start, end, kind, value).

    Beside the base kinds, spans has whole runs, joined over / _ -, judged by two classes, and the pieces between / _ -,
    each judged by its own class and against the allow-list on its own, so that the run around a key doesn't hide it.

    Spans are ordered by start, then by kind in the order of ``KINDS``; a string may be reported as several kinds. A
    null text counts as empty and has no spans. Repeated rows are scanned one by one; an empty table gives no rows;
    columns of the input with the new names are replaced."""
    names = [*(f"n_{kind}" for kind in BASE), "base_spans", "spans"]
    df = packed(docs, names, _text=F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    text = F.col("_text")
    df = df.withColumns({f"_{kind}": _spans(text, _QUICK.get(kind, pattern), kind, group, 0 if kind in _QUICK else least) for kind, (pattern, group, least) in BASE.items()} | {"_cand": _spans(text, CANDIDATE, "hex_entropy")})
    allowed = lambda x: F.coalesce(*[F.when(x["value"].rlike(p), True) for p in ALLOW], F.lit(False))
    df = df.withColumn("_cand", F.filter("_cand", lambda x: ~allowed(x)))
    (hex_kind, (hex_abc, hex_bits)), (b64_kind, (b64_abc, b64_bits)) = CLASSES.items()
    renamed = lambda x, kind: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("order"), x["end"].alias("end"), F.lit(kind).alias("kind"), x["value"].alias("value"))
    is_hex = lambda x: x["value"].rlike("^[0-9A-Fa-f]+$")
    df = df.withColumn("_hexes", F.filter("_cand", lambda x: is_hex(x) & (_least_sum(F.lower(x["value"]), hex_abc) <= most_repeated(hex_bits))))
    df = df.withColumn("_b64s", F.filter("_cand", lambda x: ~is_hex(x) & (_least_sum(x["value"], b64_abc) <= most_repeated(b64_bits))))
    df = df.withColumn("_pieces", _pieces(text))
    base = F.array_sort(F.concat("_assign", "_access", "_hex"))
    every = F.array_sort(F.concat("_assign", "_access", "_hex", "_pieces", F.transform("_hexes", lambda x: renamed(x, hex_kind)), F.transform("_b64s", lambda x: renamed(x, b64_kind))))
    plain = lambda a: F.transform(a, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"), x["value"].alias("value")))
    df = df.withColumns({f"n_{kind}": F.size(f"_{kind}").cast("long") for kind in BASE} | {"base_spans": plain(base), "spans": F.when(F.monotonically_increasing_id() >= 0, plain(every))})
    return df.select("_row.*", *names)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
