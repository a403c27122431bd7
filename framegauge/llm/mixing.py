"""Mixing sources to target weights by Poisson replication.

A document of source s is repeated k times, k drawn from a Poisson distribution whose mean is the target repetition
rate ``total * weight / (sum of weights * rows of s)``. The draw inverts the distribution at a number made of the
seed and the document's id, so a lost executor's rows come out the same again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framegauge.llm.common import packed, written

#: Up to so many sources, the table of rates is joined by broadcast; a rate row has a few hundred bytes.
BROADCAST_SOURCES = 10_000
#: A mean above this is drawn as a sum of several draws; exp(-mean) stays far from underflow.
MAX_MEAN = 500.0


def hash_unit(*parts: Column) -> Column:
    """A number in [0, 1) with 52 bits, from the MD5 of the parts joined by ``:``."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 13), 16, 10).cast("double") / float(1 << 52)


def _cdf(mean: Column) -> Column:
    """The distribution function at 0, 1, 2, … up to where the rest is beyond a double's resolution."""
    top = F.ceil(mean + 12 * F.sqrt(mean) + 25).cast("int")
    first = F.exp(-mean)
    start = F.struct(first.alias("p"), F.array(first).alias("f"))
    step = lambda a, k: F.struct((a["p"] * mean / k).alias("p"), F.concat(a["f"], F.array(F.element_at(a["f"], -1) + a["p"] * mean / k)).alias("f"))
    return F.aggregate(F.sequence(F.lit(1), top), start, step, lambda a: a["f"])


def rates(docs: DataFrame, weights: dict[str, float] | None = None, source_col: str = "source", total: int | None = None) -> DataFrame:
    """``(source, n_rows, rate, draws, cdf)``, a row per source; sources without a weight get none of the total.

    Without weights all sources weigh the same; without a total it is the number of rows. A null source is a source of
    its own; its weight is the one of ``None``."""
    counts = written(docs.groupBy(F.col(source_col).alias("source")).agg(F.count("*").alias("n_rows")), "sources", per_core=1)
    if weights is None:
        counts = counts.withColumn("weight", F.lit(1.0))
    else:
        w = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()], "source string, weight double")
        named = F.coalesce(F.col("weight"), F.lit(0.0))
        counts = counts.join(F.broadcast(w), counts["source"].cast("string").eqNullSafe(w["source"]), "left").select(counts["source"], "n_rows", named.alias("weight"))
    whole = counts.agg(F.sum("n_rows").alias("rows"), F.sum("weight").alias("w")).first()
    goal, w = float(total if total is not None else whole.rows or 0), float(whole.w or 0) or 1.0
    df = counts.withColumn("rate", F.lit(goal) * F.col("weight") / (F.lit(w) * F.col("n_rows")))
    df = df.withColumn("draws", F.greatest(F.lit(1), F.ceil(F.col("rate") / MAX_MEAN)).cast("int"))
    return written(df.withColumn("cdf", _cdf(F.col("rate") / F.col("draws"))).drop("weight"), "rates", per_core=1)


def mix(docs: DataFrame, weights: dict[str, float] | None = None, id_col: str = "doc_id", source_col: str = "source", total: int | None = None, seed: int = 1) -> DataFrame:
    """``docs`` with rate (double), copies (long), copy (1 to copies, long) and shuffle_key (string), a row per copy, shuffled globally.

    Rows are spread by the hash of a seeded key and sorted by it in each partition, so the files hold a random order.
    Documents that draw 0 are left out; that is the method. Repeated rows of one id draw the same count; a null id draws
    as an id of its own. An empty table gives no rows. Columns of the input with the new names are replaced."""
    table = rates(docs, weights, source_col, total).select(F.col("source").alias("_source"), F.col("rate").alias("_rate"), "draws", "cdf")
    table = table.withColumnsRenamed({"draws": "_draws", "cdf": "_cdf"})
    if table.count() <= BROADCAST_SOURCES:
        table = F.broadcast(table)
    new = ["rate", "copies", "copy", "shuffle_key"]
    rows = packed(docs, new, _key=F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")), _of=F.col(f"`{source_col}`"))
    df = rows.join(table, F.col("_of").eqNullSafe(F.col("_source")))
    draws = F.transform(F.sequence(F.lit(1), "_draws"), lambda i: hash_unit(F.lit(str(seed)), F.col("_key"), i.cast("string")))
    df = df.withColumn("copies", F.aggregate(draws, F.lit(0).cast("long"), lambda a, u: a + F.size(F.filter("_cdf", lambda c: c <= u))))
    df = df.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).withColumn("rate", F.col("_rate"))
    df = df.withColumn("shuffle_key", F.md5(F.concat_ws(":", F.lit(f"{seed}:order"), F.col("_key"), F.col("copy").cast("string")).cast("binary")))
    return df.select("_row.*", *new).repartition("shuffle_key").sortWithinPartitions("shuffle_key")
