"""Quality rules: a threshold table compiled into one projection of built-in functions.

Words are ``[^\\x20\\x09-\\x0D]+``. A measure is a SQL expression over the columns of ``measures``; a rule keeps a
document whose measures satisfy it. No user functions run and nothing is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framegauge.llm.common import packed

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = ["the", "be", "to", "of", "and", "that", "have", "with", "in", "is", "it", "for", "on", "are", "le", "la", "les", "de", "des", "et", "un", "une", "du", "que", "qui", "en", "der", "die", "das", "und", "ist", "nicht", "ein", "eine", "mit", "für", "von", "zu", "den", "el", "los", "las", "y", "una", "por", "con", "para", "no", "se", "al"]
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop_words"]
#: (name, condition under which a document is kept); the first two are the base rules.
RULES = [
    ("few_words", "n_words >= 20"),
    ("repeated_words", "100 * n_repeat_words <= 30 * n_words"),
    ("symbols", "10 * n_symbols <= n_words"),
    ("short_words", "word_chars >= 2 * n_words"),
    ("long_words", "word_chars <= 16 * n_words"),
    ("stop_words", "n_stop_words >= 2 or n_words < 50"),
    ("repeated_lines", "2 * n_dup_lines <= n_lines"),
]


def _pairwise(column: str, step: int, n: Column) -> Column:
    """Hashes of twice as many words: each hash joined with the one ``step`` words on."""
    return F.transform(F.slice(column, 1, F.greatest(n, F.lit(0))), lambda h, i: F.xxhash64(h, F.get(F.col(column), i + step)))


def _repeated(column: str) -> Column:
    return F.size(F.array_distinct(column)) < F.size(column)


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words and n_stop_words (long).

    A null text counts as empty. Columns of the input with those names are replaced; all others stay."""
    df = packed(docs, MEASURES, _text=F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    df = df.withColumn("_words", F.array_remove(F.split("_text", r"[\x20\x09-\x0D]+"), ""))
    n = F.size("_words")
    stop = F.array(*map(F.lit, [*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)]))
    symbols = F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))
    df = df.withColumns({
        "n_words": n.cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": F.when(F.col("_text").rlike(f"[{SYMBOLS}]"), symbols).otherwise(0).cast("long"),
        "_lines": F.filter(F.split("_text", "\n"), lambda x: F.trim(x, F.lit(SPACES)) != ""),
        "n_stop_words": F.size(F.array_distinct(F.transform(F.array_intersect("_words", stop), lambda w: F.lower(w)))).cast("long"),
        "_w1": F.when(n >= WINDOW, F.transform("_words", lambda w: F.xxhash64(w))).otherwise(F.array().cast("array<bigint>")),
    })
    # hashes of 2, 4 and 8 words; a window that is there twice has its first half there twice
    size = F.size("_w1")
    df = df.withColumn("_w2", _pairwise("_w1", 1, size - 1)).withColumn("_w4", _pairwise("_w2", 2, size - 3))
    df = df.withColumn("_w8", F.when(_repeated("_w4"), _pairwise("_w4", 4, size - 7)))
    pairs = F.sort_array(F.transform("_w8", lambda h, i: F.struct(h.alias("h"), (i + 1).cast("int").alias("i"))))
    df = df.withColumns({"n_lines": F.size("_lines").cast("long"), "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"), "_pairs": F.when(_repeated("_w8"), pairs)})
    at = lambda a, i: F.get(F.col(a), i)
    twice = F.filter(F.transform("_pairs", lambda p, i: F.when((at("_pairs", i - 1)["h"] == p["h"]) | (at("_pairs", i + 1)["h"] == p["h"]), p["i"])), lambda x: x.isNotNull())
    df = df.withColumn("_at", F.sort_array(twice))
    covered = F.aggregate(F.transform("_at", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(at("_at", i + 1) - p, F.lit(WINDOW)))), F.lit(0).cast("long"), lambda a, x: a + x)
    # the row number is no constant, so no filter above pulls a copy of this whole chain down with it
    once = F.when(F.monotonically_increasing_id() >= 0, F.coalesce(covered, F.lit(0).cast("long"))).otherwise(0)
    return df.withColumn("n_repeat_words", once).select("_row.*", *MEASURES)


def judge(docs: DataFrame, text_col: str = "text", rules: list[tuple[str, str]] | None = None) -> DataFrame:
    """``docs`` with the measures, base_failed, failed_rules (array of names) and kept (boolean).

    A null or empty text has no words, so it fails the base rules. Repeated rows are judged one by one; an empty table
    gives no rows."""
    rules = RULES if rules is None else rules
    df = measures(docs, text_col)
    base = " and ".join(f"({c})" for _, c in RULES[:2])
    failed = F.array_compact(F.array(*(F.expr(f"if({c}, null, '{name}')") for name, c in rules))) if rules else F.array().cast("array<string>")
    return df.withColumn("base_failed", F.expr(f"not ({base})")).withColumn("failed_rules", failed).withColumn("kept", (F.size("failed_rules") == 0) & ~F.col("base_failed"))


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that pass every rule, with their own columns only."""
    return judge(packed(docs, [], _judged=F.col(f"`{text_col}`")), "_judged").where("kept").select("_row.*")
