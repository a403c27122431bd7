"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash within their source and ranked; row r of a source of n gets the fractional rank
(2 r + 1) / 2 n. Sorted by it, every stretch of rows holds the sources in proportion, so equal cuts give shards that
match the mixture. The law is ``rows``: shard sizes are at most one row apart.

Ranks come from range-partitioned sorts over narrow columns and the partitions' counts. No source is gathered in one
task, and the sorted rows are written before their positions count, so a lost executor can't change them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framegauge.llm.common import written

_ROW = (1 << 33) - 1


def _placed(df: DataFrame, by: list[str]) -> DataFrame:
    """``df`` in global order, as a written table, with its range ``part`` and the ``row`` in it."""
    out = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_mid", F.monotonically_increasing_id())
    out = written(out, "sorted", per_core=8)
    return out.withColumn("part", F.shiftright("_mid", 33)).withColumn("row", F.col("_mid").bitwiseAND(F.lit(_ROW))).drop("_mid")


def shard(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 1) -> DataFrame:
    """``(id_col, source_col, size, text_crc32, law, shard, slot, grown_shard)``, a row for every input row.

    size: UTF-8 bytes of the text plus 1; slot counts from 0 without gaps in each shard; grown_shard is null, as the law
    is ``rows``. A null text counts as empty, a null source is a source of its own, a null id takes part like any other.
    Repeated rows each get a slot of their own; which of them gets which is of no effect. An empty table gives no rows."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null"))).cast("binary"))
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"), (F.length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("crc"), key.alias("key"))
    narrow = narrow.withColumn("grp", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")))
    # the texts are read once; both sorts sample and read the narrow table
    r = _placed(written(narrow, "narrow", per_core=8), ["grp", "key", "id", "crc"])
    parts = r.groupBy("grp", "part").agg(F.count("*").alias("k"), F.min("row").alias("first"))
    w = Window.partitionBy("grp")
    before = F.coalesce(F.sum("k").over(w.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("grp", "part", "first", before.alias("before"), F.sum("k").over(w).alias("n"))
    ranked = r.join(parts, ["grp", "part"]).withColumn("frac", (2 * (F.col("before") + F.col("row") - F.col("first")) + 1) / (2 * F.col("n")))
    s = _placed(ranked.select("id", "source", "size", "crc", "key", "grp", "frac"), ["frac", "grp", "key", "id", "crc"])
    counts = s.groupBy("part").count().orderBy("part").collect()  # one row per partition of the sort
    total, offsets = 0, []
    for c in counts:
        offsets.append((c["part"], total))
        total += c["count"]
    pos = F.col("row") + F.col("offset")
    n = max(total, 1)
    out = s.join(F.broadcast(spark.createDataFrame(offsets, "part long, offset long")), "part").withColumn("pos", pos)
    out = out.withColumn("shard", F.expr(f"cast(pos * {shards} div {n} as int)")).withColumn("slot", F.expr(f"pos - (shard * {n}L + {shards - 1}) div {shards}"))
    return out.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
