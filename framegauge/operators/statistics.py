"""Robust statistics, their two-level grouping, lookups with fallback, and small aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framegauge.functions.scalars import finite
from framegauge.functions.storage import planned_bytes, written

FIELDS = ["count", "median", "mad", "mean", "std", "p01", "p05", "p25", "p75", "p95", "p99", "min", "max"]
_QUANTILES = {"p01": 0.01, "p05": 0.05, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}
#: Above this estimate exact quantiles come from a distributed sort instead of from one value map per group.
GATHER_BYTES = 64 << 20


def ordered_quantiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Exact quantiles (linear interpolation) by global ranks: a range-partitioned sort and the counts of its parts.

    No group is gathered, so a group may be as large as the table. Rows with a null value are left out."""
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    s = written(rows.repartitionByRange(*keys, "_v").sortWithinPartitions(*keys, "_v").withColumn("_mid", F.monotonically_increasing_id()), "ordered")
    s = s.withColumn("_part", F.shiftright("_mid", 33))
    parts = s.groupBy(*keys, "_part").agg(F.count("*").alias("_k"), F.min("_mid").alias("_first"))
    w = Window.partitionBy(*keys)
    before = F.coalesce(F.sum("_k").over(w.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select(*keys, "_part", "_first", before.alias("_before"), F.sum("_k").over(w).alias("_n"))
    on = (s["_part"] == parts["_part"]) if not keys else None
    ranked = (s.join(parts, on).drop(parts["_part"]) if on is not None else null_safe(s, parts, [*keys, "_part"])).withColumn("_rank", F.col("_before") + F.col("_mid") - F.col("_first"))
    at = lambda p: (F.col("_n") - 1) * F.lit(p)
    wanted = lambda p: F.col("_rank").isin(F.floor(at(p)), F.ceil(at(p)))
    need = ranked.where(" or ".join(["false"]) if not probs else _any([wanted(p) for p in probs.values()]))
    pick = lambda p, f: F.max(F.when(F.col("_rank") == f(at(p)), F.col("_v")))
    out = need.groupBy(*keys).agg(F.max("_n").alias("_n"), *(F.struct(pick(p, F.floor).alias("lo"), pick(p, F.ceil).alias("hi")).alias(k) for k, p in probs.items()))
    between = lambda k, p: F.col(k)["lo"] + (F.col(k)["hi"] - F.col(k)["lo"]) * (at(p) - F.floor(at(p)))
    return out.select(*keys, *(between(k, p).alias(k) for k, p in probs.items()))


def _any(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def null_safe(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join where nulls are equal; keeps one copy of the keys."""
    b = b.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = None
    for k in keys:
        c = a[k].eqNullSafe(b[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return a.join(b, cond, how).drop(*(f"_r_{k}" for k in keys))


def robust_stats(df: DataFrame, keys: list[str], value: str, gather_bytes: int = GATHER_BYTES, times: int = 1) -> DataFrame:
    """``keys`` and FIELDS of the finite values (A1, A2, A8): exact quantiles, population deviation, median deviation.

    A group without finite values has no row; lookups give it count 0. ``times``: copies of a row that the estimate of
    the plan's size doesn't count."""
    keys = list(keys) or ["_all"]
    v = df.withColumn("_all", F.lit(0)).where(finite(value)).select(*keys, F.col(value).cast("double").alias("_v"))
    q = list(_QUANTILES)
    plain = [F.count("*").alias("count"), F.avg("_v").alias("mean"), F.stddev_pop("_v").alias("std"), F.min("_v").alias("min"), F.max("_v").alias("max")]
    if times * planned_bytes(v) > gather_bytes:
        a = null_safe(v.groupBy(*keys).agg(*plain), ordered_quantiles(v, keys, "_v", _QUANTILES), keys)
        dev = null_safe(v, a.select(*keys, "median"), keys).withColumn("_d", F.abs(F.col("_v") - F.col("median")))
        mad = ordered_quantiles(dev, keys, "_d", {"mad": 0.5})
    else:
        a = v.groupBy(*keys).agg(*plain, F.percentile("_v", F.array(*(F.lit(p) for p in _QUANTILES.values()))).alias("_q"))
        a = a.select(*keys, "count", "mean", "std", "min", "max", *(F.col("_q")[i].alias(k) for i, k in enumerate(q)))
        med = a.select(*keys, "median")
        med = F.broadcast(med) if keys == ["_all"] else med  # a single row
        mad = null_safe(v, med, keys).groupBy(*keys).agg(F.percentile(F.abs(F.col("_v") - F.col("median")), F.lit(0.5)).alias("mad"))
    return null_safe(a, mad, keys).select(*(k for k in keys if k != "_all"), *FIELDS)


def scoped_stats(df: DataFrame, keys: list[str], task: str, value: str) -> DataFrame:
    """Statistics at two levels, ``scope`` global and task; every value counts in both."""
    both = df.withColumn("scope", F.explode(F.array(F.lit("global"), F.lit("task"))))
    both = both.withColumn("task", F.when(F.col("scope") == "task", F.col(task)))
    return robust_stats(both, ["scope", "task", *keys], value, times=2)


def as_struct(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    return df.select(*keys, F.struct(*FIELDS).alias(name))


def with_baseline(df: DataFrame, stats: DataFrame, keys: list[str], task: str, name: str = "s", least: int = 5) -> DataFrame:
    """Adds the struct ``name``: the task's statistics if they count ``least`` values, else the global ones, else null.

    ``stats`` comes from ``scoped_stats``; it has a row per task and key, and the engine broadcasts it while it is small."""
    one = as_struct(stats.where("scope = 'task'"), ["task", *keys], "_t").withColumnRenamed("task", "_task")
    whole = as_struct(stats.where("scope = 'global'"), keys, "_g")
    own = df.withColumn("_task", F.col(task).cast(one.schema["_task"].dataType))
    out = null_safe(own, one, ["_task", *keys], "left")
    out = null_safe(out, whole, keys, "left") if keys else out.crossJoin(F.broadcast(whole.limit(1))) if whole else out
    return out.withColumn(name, F.when(F.col("_t")["count"] >= least, F.col("_t")).otherwise(F.col("_g"))).drop("_t", "_g", "_task")


def with_baselines(df: DataFrame, stats: DataFrame, keys: list[str], task: str, by: str, names: dict[str, str], least: int = 5) -> DataFrame:
    """``with_baseline`` for several values of the column ``by`` of the statistics at once: names maps a value to its struct's
    name; one lookup by task and one over all, whatever their number."""
    pick = lambda scope: [F.max(F.when(F.col(by) == v, F.struct(*FIELDS))).alias(f"_{scope}_{n}") for v, n in names.items()]
    one = stats.where("scope = 'task'").groupBy("task", *keys).agg(*pick("t")).withColumnRenamed("task", "_task")
    whole = stats.where("scope = 'global'").groupBy(*keys).agg(*pick("g"))
    own = df.withColumn("_task", F.col(task).cast(one.schema["_task"].dataType))
    out = null_safe(null_safe(own, one, ["_task", *keys], "left"), whole, keys, "left")
    out = out.withColumns({n: F.when(F.col(f"_t_{n}")["count"] >= least, F.col(f"_t_{n}")).otherwise(F.col(f"_g_{n}")) for n in names.values()})
    return out.drop("_task", *(f"_{x}_{n}" for x in "tg" for n in names.values()))


def with_phase_baseline(df: DataFrame, phase_stats: DataFrame, stats: DataFrame, keys: list[str], task: str, phase: str = "phase", name: str = "s", least: int = 5) -> DataFrame:
    """The phase's statistics of the task, of all, then those without phase, task before all."""
    out = with_baseline(with_baseline(df, phase_stats, [*keys, phase], task, "_p", least), stats, keys, task, "_u", least)
    return out.withColumn(name, F.when(F.col("_p")["count"] >= least, F.col("_p")).otherwise(F.col("_u"))).drop("_p", "_u")


def threshold_or(s: Column, value: Column, default: Column | float, least: int = 5) -> Column:
    """The threshold from statistics, or the default where they count too few values or are missing."""
    return F.when(F.coalesce(s["count"], F.lit(0)) >= least, value).otherwise(default)


def status_counts(df: DataFrame, keys: list[str], status: str, names: list[str]) -> DataFrame:
    """Counts for every name of the enum, 0 where there are none."""
    return df.groupBy(*keys).agg(*(F.count(F.when(F.col(status) == n, 1)).alias(n) for n in names))


def distinct_with_null(x: str) -> Column:
    """Null counts as a value."""
    return F.count_distinct(x) + F.max(F.when(F.col(x).isNull(), 1).otherwise(0))


def top_mean(values: Column, k: int = 5) -> Column:
    """Mean of the k largest positive finite values of an array, 0 if there are none."""
    top = F.slice(F.sort_array(F.filter(values, lambda x: finite(x) & (x > 0)), asc=False), 1, k)
    return F.when(F.size(top) > 0, F.aggregate(top, F.lit(0.0), lambda a, x: a + x) / F.size(top)).otherwise(0.0)


def soft_penalty(values: Column, cap: float) -> Column:
    """The mean of the five largest pressures times the cap, at most the cap."""
    return F.round(F.least(F.lit(cap), top_mean(values) * cap), 3)


def entropy(df: DataFrame, keys: list[str], bin_col: str) -> DataFrame:
    """Shannon entropy of a histogram, with ``n``."""
    counts = df.groupBy(*keys, bin_col).agg(F.count("*").alias("c"))
    g = counts.groupBy(*keys).agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.log2("c")).alias("clogc"))
    return g.select(*keys, "n", (F.log2("n") - F.col("clogc") / F.col("n")).alias("entropy"))
