"""The query catalogue over the driver tables: each entry applies library operators and has the SQL of the same rows.

Computed doubles are rounded to six decimals on both sides. Parameters are relaxed where the defaults, made for robot
episodes of hundreds of frames, would find nothing in these tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framegauge.functions import scalars as S
from framegauge.functions import vectors as V
from framegauge.functions.storage import shared_dir, written
from framegauge.functions.taxonomy import DIMENSION_POINTS, FAMILIES, STATUSES
from framegauge.operators import detectors as D
from framegauge.operators import injection as J
from framegauge.operators import clips, lag, sampling, scoring, signals, vision
from framegauge.operators.findings import by_episode, counts_by, first_cases, merged, top_issues, union_findings, with_ids
from framegauge.operators.islands import equal_runs, islands, span_iou
from framegauge.operators.statistics import FIELDS, entropy, robust_stats, scoped_stats, status_counts, top_mean, with_baseline, with_phase_baseline
from framegauge.plans import gates
from framegauge.sources import tables as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
KEYS = ["episode", "task"]


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def r6(x: Column | str, name: str | None = None) -> Column:
    c = F.col(x) if isinstance(x, str) else x
    out = F.round(c, 6)
    return out.alias(name or x) if name or isinstance(x, str) else out


def queries() -> dict[str, Query]:
    from framegauge.plans import catalog_images, catalog_run, catalog_sources, catalog_weak  # noqa: F401  they add theirs

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(SQL)


# SQL of the adapters and of signals.
EV = "ev as (select user_id as episode, event_id as frame, event_type, value, epoch_us(ts) / 1e6 as timestamp, row_number() over (partition by user_id order by event_id) - 1 as seq from events)"
DE = EV + ", de as (select *, abs(value - lag(value) over (partition by episode order by seq)) as delta, abs(value - 2 * lag(value) over (partition by episode order by seq) + lag(value, 2) over (partition by episode order by seq)) as accel, coalesce(lag(frame) over (partition by episode order by seq), frame) as frame_before from ev)"
EM = "em as (select cast(label as bigint) as episode, vec_id as frame, list_transform(embedding[1:20], lambda x: cast(x as double)) as state, row_number() over (partition by label order by vec_id) - 1 as seq from embeddings)"
LI = "li as (select l_orderkey as episode, cast(l_linenumber as bigint) as frame, l_extendedprice, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 as seq from lineitem)"


def stats_sql(source: str, value: str, keys: str = "") -> str:
    """The statistics of a value by keys."""
    k = f"{keys}, " if keys else ""
    g = f" group by {keys}" if keys else ""
    q = ", ".join(f"quantile_cont({value}, {p}) as {n}" for n, p in (("p01", 0.01), ("p05", 0.05), ("p25", 0.25), ("p75", 0.75), ("p95", 0.95), ("p99", 0.99)))
    return f"select {k}count({value}) as count, quantile_cont({value}, 0.5) as median, mad({value}) as mad, avg({value}) as mean, stddev_pop({value}) as std, {q}, min({value}) as min, max({value}) as max from {source} where {value} is not null{g}"


def islands_sql(source: str, keys: str, idx: str, gap: int, aggs: str = "") -> str:
    """Runs of index values."""
    extra = f", {aggs}" if aggs else ""
    return f"""select {keys}, min({idx}) as "start", max({idx}) as "end", count(*) as n{extra} from (select *, sum(fresh) over (partition by {keys} order by {idx} rows unbounded preceding) as island
 from (select *, case when {idx} - lag({idx}) over (partition by {keys} order by {idx}) <= {gap} then 0 else 1 end as fresh from {source})) group by {keys}, island"""


def rounded(cols: list[str], keys: list[str] = ()) -> str:
    return ", ".join([*keys, *(f"round({c}, 6) as {c}" if c != "count" else c for c in cols)])


REF = "episode % 3 = 0"


def _deltas(spark: SparkSession, sf: str) -> DataFrame:
    return signals.scalar_accel(signals.scalar_delta(D.with_before(T.events(spark, sf), []), ["episode"], "value"), ["episode"], "value")


def _reference(df: DataFrame, value: str) -> DataFrame:
    """One row with the struct ``s``: the statistics of a third of the episodes."""
    return robust_stats(df.where(F.expr(REF)), [], value).select(F.struct(*FIELDS).alias("s"))


def _judged(df: DataFrame, value: str, name: str = "s") -> DataFrame:
    """The other episodes beside the reference; the reference is a single row."""
    return df.where(~F.expr(REF)).crossJoin(F.broadcast(_reference(df, value).withColumnRenamed("s", name)))


# ---- episodes, metadata, indices -------------------------------------------------------------------------------------


@query(f"""with {EV}, g as (select *, timestamp - lag(timestamp) over (partition by episode order by seq) as gap from ev)
select episode, count(*) as n_rows, min(frame) as first_frame, max(frame) as last_frame, round(min(timestamp), 6) as first_time, round(max(timestamp), 6) as last_time, round(quantile_cont(gap, 0.5), 6) as gap_median, round(max(gap), 6) as gap_max, coalesce(min(gap) >= 0, true) as monotonic from g group by episode""")
def episode_summary(spark, sf):
    """A19, A20."""
    d = T.events(spark, sf)
    d = d.withColumn("gap", F.col("timestamp") - F.lag("timestamp").over(signals.ordered(["episode"], "seq")))
    return d.groupBy("episode").agg(F.count("*").alias("n_rows"), F.min("frame").alias("first_frame"), F.max("frame").alias("last_frame"), r6(F.min("timestamp")).alias("first_time"), r6(F.max("timestamp")).alias("last_time"), r6(F.percentile("gap", F.lit(0.5))).alias("gap_median"), r6(F.max("gap")).alias("gap_max"), F.coalesce(F.min("gap") >= 0, F.lit(True)).alias("monotonic"))


@query("""select min(n) as shortest, max(n) as longest, round(avg(n), 6) as mean, quantile_cont(n, 0.5) as median, cast(sum(n) as bigint) as total from (select o_orderkey, count(l_orderkey) as n from orders left join lineitem on l_orderkey = o_orderkey group by 1)""")
def length_stats(spark, sf):
    """A20."""
    n = T.table(spark, sf, "orders").select(F.col("o_orderkey").alias("episode")).join(T.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("episode")).count(), "episode", "left").select(F.coalesce("count", F.lit(0)).alias("n"))
    return n.agg(F.min("n").alias("shortest"), F.max("n").alias("longest"), r6(F.avg("n")).alias("mean"), F.percentile("n", F.lit(0.5)).alias("median"), F.sum("n").cast("long").alias("total"))


EXPECTED = ["event_id", "ts", "user_id", "event_type", "value", "props", "image", "state", "timestamp"]


@query("""select episode, family, issue_type, "column" from (select distinct user_id as episode from events), (values ('vision_illegal', 'missing_required_column', 'image'), ('state_illegal', 'missing_required_column', 'state'), ('state_illegal', 'missing_required_column', 'timestamp'), ('temporal_illegal', 'missing_temporal_column', 'timestamp')) t(family, issue_type, "column")""")
def schema_missing_columns(spark, sf):
    """Of every episode."""
    e = T.events(spark, sf).select("episode", "task").distinct()
    return union_findings(D.missing_columns(e, T.table(spark, sf, "events").columns, EXPECTED)).select("episode", "family", "issue_type", "column")


@query("""select o_orderkey as episode, case when coalesce(n, 0) = 0 then 'empty_episode' else 'metadata_length_mismatch' end as issue_type, coalesce(n, 0) as n_rows, m as declared
from orders left join (select l_orderkey, count(*) as n, max(l_linenumber) as m from lineitem group by 1) on l_orderkey = o_orderkey where coalesce(n, 0) = 0 or n <> m""")
def metadata_length_mismatch(spark, sf):
    """The largest line number stands for the declared length."""
    n = T.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("episode")).agg(F.count("*").alias("rows"), F.max("l_linenumber").cast("long").alias("length"))
    e = T.table(spark, sf, "orders").select(F.col("o_orderkey").alias("episode"), F.lit(None).cast("long").alias("task")).join(n, "episode", "left")
    return D.length_mismatch(e).select("episode", "issue_type", F.coalesce(F.get_json_object("evidence", "$.rows").cast("long"), F.lit(0)).alias("n_rows"), F.get_json_object("evidence", "$.length").cast("int").alias("declared"))


@query(f"""with {LI}, s as (select *, lead(frame) over (partition by episode order by seq) as nxt from li)
select episode, case when nxt = frame then 'duplicate_frame_index' else 'frame_index_gap_or_reorder' end as issue_type, frame as frame_start, nxt as frame_end from s where nxt - frame <> 1""")
def frame_index_gap_dup(spark, sf):
    """D7, W5."""
    return D.index_steps(T.lineitem(spark, sf)).select("episode", "issue_type", "frame_start", "frame_end")


@query("""select conv_id as episode, turn as frame_start, nxt as frame_end from (select *, lead(turn) over (partition by conv_id order by turn, role, text) as nxt from conversations) where nxt - turn <> 1""")
def frame_index_control(spark, sf):
    """D7 where nothing should be found."""
    return D.index_steps(T.conversations(spark, sf)).select("episode", "frame_start", "frame_end")


@query(f"""with {EV} select episode, frame as frame_start, nxt as frame_end from (select *, lead(frame) over (partition by episode order by seq) as nxt from ev) where nxt - frame <> 1""")
def global_index_gap(spark, sf):
    """D8, W6."""
    d = T.events(spark, sf)
    return D.global_index_steps(d.withColumn("index", F.col("frame"))).select("episode", "frame_start", "frame_end")


@query(f"""with {EV}, s as (select *, lead(timestamp) over (partition by episode order by seq) - timestamp as diff, lead(frame) over (partition by episode order by seq) as nxt from ev),
p as (select *, quantile_cont(diff, 0.5) over (partition by episode) as period from s)
select episode, frame as frame_start, nxt as frame_end from p where diff <= 0 or abs(diff - period) > greatest(0.02, 3.0 * period)""")
def timestamp_gap(spark, sf):
    """D9, W7."""
    return D.timestamp_steps(T.events(spark, sf), share=3.0).select("episode", "frame_start", "frame_end")


@query("""with s as (select o_custkey as episode, o_orderkey as frame, row_number() over (partition by o_custkey order by o_orderkey) - 1 as seq, epoch_us(o_orderdate) / 86400000000.0 as day from orders),
d as (select *, lead(day) over (partition by episode order by seq) - day as diff, lead(frame) over (partition by episode order by seq) as nxt from s), p as (select *, quantile_cont(diff, 0.5) over (partition by episode) as expected from d)
select episode, frame as frame_start, nxt as frame_end, case when diff <= 0 or abs(diff - expected) > expected then 'high' else 'medium' end as severity, round(diff, 6) as diff from p where diff <= 0 or abs(diff - expected) > greatest(0.02, 0.25 * expected)""")
def v1_timestamp_intervals(spark, sf):
    """W8, D38."""
    d = T.orders(spark, sf).withColumn("timestamp", F.col("day"))
    return D.v1_timestamps(d).select("episode", "frame_start", "frame_end", "severity", r6("diff"))


@query("select conv_id as episode, count(distinct role) as n from conversations group by 1 having count(distinct role) > 1")
def task_inconsistent(spark, sf):
    """D11, A16."""
    return D.inconsistent(T.conversations(spark, sf), "role", "task_index_inconsistent").select("episode", F.get_json_object("evidence", "$.values").cast("long").alias("n"))


SEG = "least(greatest(1, cast(floor(n * 0.35) as bigint)), n - {len} - 1)"
EMN = EM + ", en as (select *, count(*) over (partition by episode) as n from em), es as (select *, " + SEG.format(len=4) + " as a from en)"


@query(f"""with {EMN}, h as (select episode, frame from es where seq between a and a + 3) {islands_sql("h", "episode", "frame", 1)}""")
def non_finite_ranges(spark, sf):
    """NaN injected into four rows of each episode."""
    d = J.replace_element(T.embeddings(spark, sf), ["episode"], "state", F.lit(float("nan")))
    f = D.non_finite_vectors(d, "state", "state")
    return f.select("episode", F.col("frame_start").alias("start"), F.col("frame_end").alias("end")).join(islands(d.where(~V.all_finite("state")), ["episode"], "frame").select("episode", "start", "n"), ["episode", "start"])


@query(f"""with {LI}, h as (select episode, frame from li where l_extendedprice > 100000) select episode, "start" as frame_start, "end" as frame_end from ({islands_sql("h", "episode", "frame", 1)})""")
def impossible_magnitude(spark, sf):
    """D22, P6."""
    d = T.lineitem(spark, sf).withColumn("vec", F.array("l_extendedprice"))
    return D.impossible_magnitudes(d, "vec", "l_extendedprice", 1e5).select("episode", "frame_start", "frame_end")


@query("select cast(label as bigint) as episode, 'inconsistent_low_dim_shape' as issue_type, 19 as least, 20 as most from embeddings group by label")
def ragged_vector_width(spark, sf):
    """D19, D20, P3, P4, I7."""
    d = J.drop_last_element(T.embeddings(spark, sf), ["episode"], "state")
    return D.vector_widths(d, "state", 20, "state").select("episode", "issue_type", F.get_json_object("evidence", "$.least").cast("int").alias("least"), F.get_json_object("evidence", "$.most").cast("int").alias("most"))


@query("select source, count(*) as n from documents where doc_id not in (select doc_id from labels) group by source")
def coverage_missing(spark, sf):
    """J16, J17, U5."""
    return D.missing_rows(T.table(spark, sf, "documents").select("doc_id", "source"), T.table(spark, sf, "labels").select("doc_id"), ["doc_id"]).groupBy("source").agg(F.count("*").alias("n"))


# ---- statistics ------------------------------------------------------------------------------------------------------


@query(f"""select 'global' as scope, null as task, {rounded(FIELDS)} from ({stats_sql("events", "value")}) union all select 'task', event_type, {rounded(FIELDS)} from ({stats_sql("events", "value", "event_type")})""")
def robust_stats_scoped(spark, sf):
    """A1, A2, A4, A8."""
    d = scoped_stats(T.events(spark, sf).select("event_type", "value"), [], "event_type", "value")
    return d.select("scope", "task", *(F.col(c) if c == "count" else r6(c) for c in FIELDS))


@query(f"""select {rounded(FIELDS, ["l_returnflag"])} from ({stats_sql("lineitem", "l_extendedprice", "l_returnflag")})""")
def robust_stats_lineitem(spark, sf):
    """A1."""
    return robust_stats(T.table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice").select("l_returnflag", *(F.col(c) if c == "count" else r6(c) for c in FIELDS))


Z = "abs({v} - median) / greatest(1.4826 * mad, std, 1e-9)"


def score_sql(z: str, weak: float, strong: float) -> str:
    return f"case when {z} <= {weak} then 0.0 when {z} >= {strong} then 1.0 else ({z} - {weak}) / ({strong} - {weak}) end"


@query(f"""with {EV}, s as ({stats_sql("ev", "value", "event_type")}), t as (select ev.episode, ev.frame, ev.value, s.* from ev join s using (event_type)), z as (select *, {Z.format(v="value")} as z from t)
select frame, round(z, 6) as z, round(case when value > median then {score_sql("z", 1.5, 4.0)} else 0.0 end, 6) as upper_score, round(case when value < median then {score_sql("z", 0.6, 2.0)} else 0.0 end, 6) as lower_score, round({score_sql("z", 1.5, 4.0)}, 6) as two_sided from z where z > 1.5""")
def robust_z_outliers(spark, sf):
    """F1-F6."""
    e = T.events(spark, sf)
    s = robust_stats(e, ["event_type"], "value").select("event_type", F.struct(*FIELDS).alias("s"))
    d = e.join(s, "event_type").withColumn("z", S.robust_z("value", F.col("s"))).where("z > 1.5")
    s = F.col("s")
    return d.select("frame", r6("z"), r6(S.upper_outlier_score("value", s, 1.5, 4.0), "upper_score"), r6(S.lower_outlier_score("value", s, 0.6, 2.0), "lower_score"), r6(S.two_sided_outlier_score("value", s, 1.5, 4.0), "two_sided"))


@query(f"""with {EV}, s as ({stats_sql("ev", "value")}), p as (select episode, case when value > p95 then least(1.0, (value - p95) / greatest(max - p95, 1e-9)) else 0.0 end as up, case when value < p05 then least(1.0, (p05 - value) / greatest(p05 - min, 1e-9)) else 0.0 end as low from ev, s)
select episode, round(avg(up), 6) as upper_pressure, round(avg(low), 6) as lower_pressure, round(max(greatest(up, low)), 6) as most from p group by episode""")
def tail_pressure(spark, sf):
    """F7-F9."""
    e = T.events(spark, sf)
    d = e.crossJoin(F.broadcast(robust_stats(e, [], "value").select(F.struct(*FIELDS).alias("s"))))
    s = F.col("s")
    return d.groupBy("episode").agg(r6(F.avg(S.upper_tail_pressure("value", s))).alias("upper_pressure"), r6(F.avg(S.lower_tail_pressure("value", s))).alias("lower_pressure"), r6(F.max(S.two_sided_tail_pressure("value", s))).alias("most"))


@query(f"""with {EV}, own as (select episode, event_type, count(value) as n, quantile_cont(value, 0.5) as m, stddev_pop(value) as sd from ev group by 1, 2), g as (select event_type, count(value) as n, quantile_cont(value, 0.5) as m, stddev_pop(value) as sd from ev group by 1)
select own.episode, own.event_type, case when own.n >= 15 then own.n else g.n end as count, round(case when own.n >= 15 then own.m else g.m end, 6) as median, round(case when own.n >= 15 then own.sd else g.sd end, 6) as std from own join g using (event_type)""")
def baseline_fallback(spark, sf):
    """An episode's own statistics of a type if they count fifteen values, else the global ones."""
    e = T.events(spark, sf).withColumn("task", F.col("episode"))
    stats = scoped_stats(e, ["event_type"], "task", "value")
    d = with_baseline(e.select("episode", "task", "event_type").distinct(), stats, ["event_type"], "task", least=15)
    return d.select("episode", "event_type", F.col("s.count").alias("count"), r6(F.col("s.median"), "median"), r6(F.col("s.std"), "std"))


@query("""select median as value, coalesce(round(1.05 * median, 6), 0.0) as rounded, case when count >= 5 then greatest(1e-8, p05 * 0.5) end as lower_threshold, case when count >= 5 then round(greatest(p99 * 1.5, median + 8 * mad, max * 1.05), 6) end as upper_threshold, event_type
from (""" + stats_sql("events", "value", "event_type") + ")")
def thresholds(spark, sf):
    """F11-F13."""
    s = robust_stats(T.events(spark, sf), ["event_type"], "value").select("event_type", F.struct(*FIELDS).alias("s"))
    c = F.col("s")
    return s.select(S.stat_value("s.median").alias("value"), r6(1.05 * c["median"], "rounded"), S.lower_threshold(c).alias("lower_threshold"), r6(S.upper_threshold(c), "upper_threshold"), "event_type")


PH = f"""{DE}, r as ({stats_sql(f"(select delta from de where {REF})", "delta")}), t as (select de.*, greatest(1e-8, p05 * 0.5) as low, greatest(p75 * 0.65, median + 2.5 * mad, max * 0.3) as high from de, r where not ({REF}) and delta is not null),
x as (select *, min(case when delta >= high then seq end) over (partition by episode) as f, max(case when delta >= high then seq end) over (partition by episode) as l, count(case when delta >= high then 1 end) over (partition by episode) as k from t),
y as (select *, case when high <= low then 'reference_phase_baseline_missing' when k < 4 then 'reference_active_window_missing' when l - f + 1 < 4 then 'active_window_too_short' else 'ok' end as phase_status from x),
ph as (select *, case when phase_status <> 'ok' then 'unknown' when seq < f then 'start' when seq <= l then 'active' else 'end' end as phase from y)"""


def _phased(spark, sf):
    d = _deltas(spark, sf)
    d = _judged(d, "delta").where("delta is not null")
    return signals.phase_labels(d, KEYS, active=("p75", 0.65, 2.5), margin=0.3, least=4)


@query(f"with {PH} select episode, phase, min(seq) as transition_start, max(seq) as transition_end, count(*) as transition_count from ph where phase <> 'unknown' group by 1, 2")
def phase_segments(spark, sf):
    """W17."""
    return signals.phase_segments(_phased(spark, sf), ["episode"])


@query(f"with {PH} select phase_status, count(distinct episode) as episodes from ph group by 1")
def phase_status(spark, sf):
    """Reasons."""
    return _phased(spark, sf).groupBy("phase_status").agg(F.count_distinct("episode").alias("episodes"))


@query(f"with {PH} select {rounded(FIELDS, ['phase'])} from ({stats_sql('ph', 'delta', 'phase')})")
def phase_baselines(spark, sf):
    """A5."""
    s = scoped_stats(_phased(spark, sf), ["phase"], "task", "delta").where("scope = 'global'")
    return s.select("phase", *(F.col(c) if c == "count" else r6(c) for c in FIELDS))


@query(f"""with {PH}, p as (select phase, count(*) as n, quantile_cont(delta, 0.5) as m from ph group by 1), g as (select count(*) as n, quantile_cont(delta, 0.5) as m from ph)
select phase, case when p.n >= 200 then p.n else g.n end as count, round(case when p.n >= 200 then p.m else g.m end, 6) as median from p, g""")
def phase_fallback(spark, sf):
    """A phase with fewer than 200 values takes the statistics without phase."""
    d = _phased(spark, sf)
    named, plain = scoped_stats(d, ["phase"], "task", "delta"), scoped_stats(d.withColumn("part", F.lit("x")), ["part"], "task", "delta")
    rows = d.select("phase", F.lit(None).cast("long").alias("task"), F.lit("x").alias("part")).distinct()
    out = with_phase_baseline(rows, _keyed(named, "part", "x"), plain, ["part"], "task", least=200)
    return out.select("phase", F.col("s.count").alias("count"), r6(F.col("s.median"), "median"))


def _keyed(df: DataFrame, name: str, value: str) -> DataFrame:
    return df.withColumn(name, F.lit(value))


@query(f"""with {EV}, b as (select frame, event_type, episode, least(9, cast(floor(value / 20) as bigint)) as bin from ev), c as (select event_type, bin, count(*) as c from b group by 1, 2)
select event_type, cast(sum(c) as bigint) as n, round(log2(sum(c)) - sum(c * log2(c)) / sum(c), 6) as entropy from c group by 1""")
def value_entropy(spark, sf):
    """A11."""
    d = T.events(spark, sf).withColumn("bin", F.least(F.lit(9), F.floor(F.col("value") / 20)))
    return entropy(d, ["event_type"], "bin").select("event_type", F.col("n").cast("long").alias("n"), r6("entropy"))


@query(r"""with w as (select doc_id, unnest(list_transform(list_filter(string_split_regex(text, '[ \n]+'), lambda x: x <> ''), lambda x: length(x))) as bin from documents), c as (select doc_id, bin, count(*) as c from w group by 1, 2)
select doc_id, cast(sum(c) as bigint) as n, round(log2(sum(c)) - sum(c * log2(c)) / sum(c), 6) as entropy from c group by 1""")
def content_entropy(spark, sf):
    """A9-A11 for texts: the entropy of word lengths; a document's histogram is built before anything moves."""
    d = T.table(spark, sf, "documents").select("doc_id", F.explode(F.transform(F.array_remove(F.split("text", r"[ \n]+"), ""), lambda x: F.length(x))).alias("bin"))
    return entropy(d, ["doc_id"], "bin").select("doc_id", F.col("n").cast("long").alias("n"), r6("entropy"))


QF = f"""{DE}, h as (select episode, event_type, count(*) as c from ev group by 1, 2), he as (select episode, log2(sum(c)) - sum(c * log2(c)) / sum(c) as entropy from h group by 1),
f as (select episode, avg(value) as mean, stddev_pop(value) as std, var_pop(delta) as sharpness, avg(case when value < 5 then 1.0 else 0.0 end) as black_fraction, avg(case when value > 200 then 1.0 else 0.0 end) as white_fraction, entropy from de join he using (episode) group by episode, entropy)"""


def _quality_facts(spark, sf):
    d = _deltas(spark, sf)
    h = entropy(d, ["episode", "task"], "event_type").select("episode", "entropy")
    f = d.groupBy("episode", "task").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.var_pop("delta").alias("sharpness"), F.avg(F.when(F.col("value") < 5, 1.0).otherwise(0.0)).alias("black_fraction"), F.avg(F.when(F.col("value") > 200, 1.0).otherwise(0.0)).alias("white_fraction"))
    return f.join(h, "episode")


def _outlier(metric: str, side: str) -> str:
    z = f"abs({metric} - m_{metric}) / greatest(1.4826 * d_{metric}, s_{metric}, 1e-9)"
    return f"case when {metric} {side} m_{metric} then {score_sql(z, 4.0, 8.0)} else 0.0 end"


_NORM = lambda x, strong: f"case when {x} <= 0 then 0.0 when {x} >= {strong} then 1.0 else ({x}) / {strong}.0 end"
_PARTS = [
    ("black", "case when black_fraction > 0.98 or (mean < 5 and std < 5) then 1.0 else 0.0 end"),
    ("white", "case when white_fraction > 0.98 or (mean > 250 and std < 5) then 1.0 else 0.0 end"),
    ("under_exposed", f"greatest({_NORM('20 - mean', 15)}, {_outlier('mean', '<')})"),
    ("over_exposed", f"greatest({_NORM('mean - 235', 15)}, {_outlier('mean', '>')})"),
    ("low_contrast", f"greatest({_NORM('12 - std', 10)}, {_outlier('std', '<')})"),
    ("blur", f"greatest({_NORM('50 - sharpness', 40)}, {_outlier('sharpness', '<')})"),
    ("low_entropy", f"greatest({_NORM('2.5 - entropy', 1.5)}, {_outlier('entropy', '<')})".replace("1.5.0", "1.5")),
]
_MS = ", ".join(f"quantile_cont({m}, 0.5) as m_{m}, mad({m}) as d_{m}, stddev_pop({m}) as s_{m}" for m in ("mean", "std", "sharpness", "entropy"))


@query(f"""with {QF}, s as (select {_MS} from f), p as (select episode, {", ".join(f"{x} as {n}" for n, x in _PARTS)} from f, s)
select episode, {", ".join(f"round(cast({n} as double), 6) as {n}" for n, _ in _PARTS)} from p""")
def content_quality_components(spark, sf):
    """The seven component scores, of episodes of events."""
    f = _quality_facts(spark, sf)
    stats = {}
    for m in ("mean", "std", "sharpness", "entropy"):
        f = f.crossJoin(F.broadcast(robust_stats(_quality_facts(spark, sf), [], m).select(F.struct(*FIELDS).alias(f"s_{m}"))))
        stats[m] = F.col(f"s_{m}")
    f = f.withColumn("_q", D.quality_components(stats))
    return f.select("episode", *(r6(F.element_at("_q", i + 1)["score"], n) for i, (n, _) in enumerate(_PARTS)))


@query("select case when html like '<!DOCTYPE html>%</html>' then 'ok' else 'decode_error' end as status, count(*) as n, cast(sum(length(html)) as bigint) as chars from pages group by 1")
def decode_legality(spark, sf):
    """D13 for pages: what starts and ends as a document."""
    p = T.table(spark, sf, "pages").select(F.when(F.col("html").startswith("<!DOCTYPE html>") & F.col("html").endswith("</html>"), "ok").otherwise("decode_error").alias("status"), F.length("html").alias("k"))
    return p.groupBy("status").agg(F.count("*").alias("n"), F.sum("k").cast("long").alias("chars"))


@query("""select cast(json_extract(props, '$.k') as bigint) % 10 as k, count(*) as n, count(*) filter (json_valid(props)) as valid from events group by 1""")
def json_props(spark, sf):
    """F37, S14."""
    d = T.table(spark, sf, "events").select(F.from_json("props", "k long").alias("j"))
    return d.groupBy((F.col("j.k") % 10).alias("k")).agg(F.count("*").alias("n"), F.count("j").alias("valid"))


# ---- islands and runs ------------------------------------------------------------------------------------------------


@query(f"""with {DE}, r as ({stats_sql(f"(select delta from de where {REF})", "delta")}), h as (select episode, seq, frame, frame_before from de, r where not ({REF}) and delta <= p25)
select episode, a as frame_start, b as frame_end, n from ({islands_sql("h", "episode", "seq", 1, "arg_min(frame_before, seq) as a, arg_max(frame, seq) as b")}) where n >= 3""")
def freeze_runs_low(spark, sf):
    """D16, D24, W13."""
    d = _judged(_deltas(spark, sf), "delta")
    f = D.freeze_runs(d, "delta", F.col("s.p25"), [], min_run=3, min_severity=0.0)
    return f.select("episode", "frame_start", "frame_end", F.get_json_object("evidence", "$.run_length").cast("long").alias("n"))


@query("""with r as (select l_orderkey, l_linenumber, l_quantity * 5 as run from lineitem) select l_orderkey, l_linenumber, run, case when run <= 10 then 0.0 when run <= 50 then 20 + (run - 10) / 40.0 * 25 when run <= 100 then 45 + (run - 50) / 50.0 * 35 else 80 + least(1.0, (run - 100) / 100.0) * 15 end as approximate,
case when run <= 10 then 0.0 when run <= 50 then 30 + (run - 10) / 40.0 * 25 when run <= 100 then 55 + (run - 50) / 50.0 * 30 else 85 + least(1.0, (run - 100) / 100.0) * 15 end as exact from r""")
def freeze_severity(spark, sf):
    """five times the quantity stands for a run's length."""
    r = T.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") * 5).alias("run"))
    return r.select("*", S.freeze_severity("run").alias("approximate"), S.freeze_severity("run", True).alias("exact"))


@query(f"""with {EV}, x as (select *, case when event_type = lag(event_type) over (partition by episode order by seq) then 0 else 1 end as fresh from ev), y as (select *, sum(fresh) over (partition by episode order by seq rows unbounded preceding) as i from x)
select episode, event_type, min(seq) as "start", max(seq) as "end", count(*) as n from y group by episode, i, event_type having count(*) >= 3""")
def exact_repeat_runs(spark, sf):
    """D15, W11, W12."""
    return equal_runs(T.events(spark, sf), ["episode"], "seq", "event_type").where("n >= 3").select("episode", "event_type", "start", "end", "n")


@query("select sha1(text) as content_hash, count(*) as n, min(doc_id) as first_doc from documents group by 1 having count(*) > 1")
def content_duplicates(spark, sf):
    """A33."""
    return T.table(spark, sf, "documents").groupBy(F.sha1("text").alias("content_hash")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc")).where("n > 1")


FJ = f"""{DE}, r as ({stats_sql(f"(select delta from de where {REF})", "delta")}), h as (select episode, seq, frame, frame_before, delta, median, mad, std from de, r where not ({REF}) and delta >= p95),
fj as (select episode, a, b, z, 100 * greatest(0.35, {score_sql("z", 1.0, 4.0)}) as severity from (select *, abs(most - median) / greatest(1.4826 * mad, std, 1e-9) as z from ({islands_sql("h", "episode", "seq", 1, "arg_min(frame_before, seq) as a, arg_max(frame, seq) as b, max(delta) as most, any_value(median) as median, any_value(mad) as mad, any_value(std) as std")}))),
fp as (select episode, a as frame_start, b as frame_end, round(severity, 2) as severity, severity as raw, round(least(15.0, 15.0 * severity / 100 * least(1.5, 1 + greatest(0, b - a) / 200.0)), 3) as penalty from fj)"""


def _fast_jumps(spark, sf):
    d = _judged(_deltas(spark, sf), "delta")
    return D.fast_jumps(d, "delta", "s", [], threshold=F.col("s.p95"), weak=1.0, strong=4.0)


@query(f"with {FJ} select episode, frame_start, frame_end, severity from fp")
def fast_jump_islands(spark, sf):
    """Calibrated on a third of the episodes, detected in the others."""
    return _fast_jumps(spark, sf).select("episode", "frame_start", "frame_end", "severity")


@query(f"with {FJ} select episode, frame_start, penalty, case when raw >= 50 then '高置信异常' else '疑似异常' end as confidence from fp")
def penalty_by_finding(spark, sf):
    """F15, F16."""
    return _fast_jumps(spark, sf).select("episode", "frame_start", "penalty", "confidence")


@query(f"""with {DE}, r as ({stats_sql(f"(select accel from de where {REF})", "accel")}), h as (select episode, seq, frame, frame_before, accel from de, r where not ({REF}) and accel >= p95)
select episode, a as frame_start, b as frame_end, "end" - "start" + 1 as len from ({islands_sql("h", "episode", "seq", 2, "arg_min(frame_before, seq) as a, arg_max(frame, seq) as b")}) where "end" - "start" + 1 >= 2""")
def jitter_clusters(spark, sf):
    """D18, D26, W15."""
    d = _judged(_deltas(spark, sf), "accel")
    f = D.jitter_clusters(d, "accel", "s", [], threshold=F.col("s.p95"), vision=True)
    return f.select("episode", "frame_start", "frame_end", F.get_json_object("evidence", "$.cluster_len").cast("long").alias("len"))


@query(f"""with {DE}, m as (select *, quantile_cont(accel, 0.5) over (partition by episode) as m from de), d as (select *, quantile_cont(abs(accel - m), 0.5) over (partition by episode) as dev from m),
w as (select *, greatest(m + 3 * dev, 0.25) as lim, lag(frame) over (partition by episode order by seq) as prev from d) select episode, prev as frame, round(accel, 6) as value from w where accel > lim""")
def continuity_spikes(spark, sf):
    """W9."""
    return D.v1_spikes(_deltas(spark, sf), "accel", mads=3.0).select("episode", F.col("frame_start").alias("frame"), r6("value"))


@query(f"""with {LI}, s as (select *, lead(frame) over (partition by episode order by seq) as nxt from li), f as (select episode, case when nxt = frame then 'duplicate_frame_index' else 'frame_index_gap_or_reorder' end as issue_type, frame as a, nxt as b from s where nxt - frame <> 1),
x as (select *, max(b) over (partition by episode, issue_type order by a, b rows between unbounded preceding and 1 preceding) as before from f), y as (select *, sum(case when before is null or a > before + 2 then 1 else 0 end) over (partition by episode, issue_type order by a, b rows unbounded preceding) as i from x)
select episode, issue_type, min(a) as frame_start, max(b) as frame_end, count(*) as merged_count from y group by episode, issue_type, i""")
def merge_findings(spark, sf):
    """Spans and counts."""
    return merged(with_ids(D.index_steps(T.lineitem(spark, sf)))).select("episode", "issue_type", "frame_start", "frame_end", "merged_count")


@query(f"""with {FJ}, x as (select *, max(frame_end) over (partition by episode order by frame_start rows between unbounded preceding and 1 preceding) as before from fp),
y as (select *, sum(case when before is null or frame_start > before + 300 then 1 else 0 end) over (partition by episode order by frame_start rows unbounded preceding) as i, row_number() over (partition by episode order by frame_start) as k from x)
select episode, min(frame_start) as frame_start, max(frame_end) as frame_end, round(list_reduce(list(penalty order by k), lambda a, b: round(least(15.0, a + 0.35 * b), 3)), 3) as penalty, max(severity) as severity from y group by episode, i""")
def merge_penalties(spark, sf):
    """The ordered fold of penalties; a slack of 300 frames makes findings meet."""
    return merged(with_ids(_fast_jumps(spark, sf)), slack=300).select("episode", "frame_start", "frame_end", "penalty", "severity")


# ---- vectors and geometry --------------------------------------------------------------------------------------------

DV = lambda a, b: f"list_transform(list_zip({a}, {b}), lambda p: p[1] - p[2])"
NO = lambda v: f"sqrt(list_sum(list_transform({v}, lambda x: x * x)))"


@query(f"""with {EM}, b as (select *, lag(state) over (partition by episode order by seq) as b1, lag(state, 2) over (partition by episode order by seq) as b2 from em)
select frame, round(case when b1 is not null then {NO(DV('state', 'b1'))} end, 6) as delta, round(case when b2 is not null then {NO(DV(DV('state', 'b1'), DV('b1', 'b2')))} end, 6) as accel from b""")
def vector_motion(spark, sf):
    """W1, W2."""
    d = signals.vector_accel(signals.vector_delta(T.embeddings(spark, sf), ["episode"], "state"), ["episode"], "state")
    return d.select("frame", r6("delta"), r6("accel"))


@query(f"""with {EM}, v as (select unnest(state) as value from em), s as ({stats_sql("v", "value")}), t as (select em.frame, em.episode, list_max(list_transform(state, lambda x: abs(x))) as most, list_median(state) as mid, s.* from em, s), z as (select *, abs(mid - median) / greatest(1.4826 * mad, std, 1e-9) as z from t)
select frame, episode, round(most, 6) as most, round(100 * ({score_sql("z", 0.2, 1.0)}), 2) as severity from z where 100 * ({score_sql("z", 0.2, 1.0)}) >= 35""".replace("list_median(state)", "list_aggregate(state, 'median')"))
def value_reference_outlier(spark, sf):
    """D23, P5, P6."""
    e = T.embeddings(spark, sf)
    s = robust_stats(e.select(F.explode("state").alias("value")), [], "value").select(F.struct(*FIELDS).alias("s"))
    f = D.value_outliers(e.crossJoin(F.broadcast(s)), "state", weak=0.2, strong=1.0)
    return f.select(F.col("frame_start").alias("frame"), "episode", F.get_json_object("evidence", "$.row_abs_max").cast("double").alias("most"), "severity")


RO = f"""{EM}, ar as (select episode, frame, seq, 'left' as arm, state[1:3] as pos, state[4:6] as a1, state[7:9] as a2 from em union all select episode, frame, seq, 'right', state[11:13], state[14:16], state[17:19] from em),
n as (select *, {NO('a1')} as n1, {NO('a2')} as n2, [a1[2] * a2[3] - a1[3] * a2[2], a1[3] * a2[1] - a1[1] * a2[3], a1[1] * a2[2] - a1[2] * a2[1]] as cr from ar),
pc as (select *, {NO('cr')} / greatest(n1 * n2, 1e-9) as sin_angle, n1 > 0.1 and n2 > 0.1 and {NO('cr')} / greatest(n1 * n2, 1e-9) > 0.001 as legal from n),
g1 as (select *, list_transform(a1, lambda x: x / n1) as b1 from pc where legal), g2 as (select *, list_sum(list_transform(list_zip(b1, a2), lambda p: p[1] * p[2])) as al from g1),
g3 as (select *, list_transform(list_zip(a2, b1), lambda p: p[1] - al * p[2]) as u from g2), g4 as (select *, list_transform(u, lambda x: x / {NO('u')}) as b2 from g3),
g5 as (select *, [b1[2] * b2[3] - b1[3] * b2[2], b1[3] * b2[1] - b1[1] * b2[3], b1[1] * b2[2] - b1[2] * b2[1]] as b3 from g4),
mx as (select episode, frame, seq, arm, pos, [b1[1], b2[1], b3[1], b1[2], b2[2], b3[2], b1[3], b2[3], b3[3]] as matrix from g5)"""


def _arms(spark, sf):
    return signals.arm_features(T.embeddings(spark, sf).select("episode", "task", "seq", "frame", "state"), ["episode", "task"], min_norm=0.1)


@query(f"with {RO} select frame, arm, round(n1, 6) as n1, round(n2, 6) as n2, round(sin_angle, 6) as sin_angle, legal from pc")
def rot6d_precheck(spark, sf):
    """P11."""
    return _arms(spark, sf).select("frame", "arm", r6(F.col("check.n1"), "n1"), r6(F.col("check.n2"), "n2"), r6(F.col("check.sin_angle"), "sin_angle"), F.col("check.legal").alias("legal"))


@query(f"with {RO} select frame, arm, {', '.join(f'round(matrix[{i}], 6) as m{i}' for i in range(1, 10))} from mx")
def rot6d_to_matrix(spark, sf):
    """F22, F24."""
    return _arms(spark, sf).where("matrix is not null").select("frame", "arm", *(r6(F.element_at("matrix", i), f"m{i}") for i in range(1, 10)))


@query(f"""with {RO}, al as (select pc.episode, pc.arm, pc.seq, pc.frame, mx.matrix from pc left join mx on mx.frame = pc.frame and mx.arm = pc.arm), t as (select *, lag(matrix) over (partition by episode, arm order by seq) as b from al)
select frame, arm, round(10 * acos(greatest(-1.0, least(1.0, (list_sum(list_transform(list_zip(matrix, b), lambda p: p[1] * p[2])) - 1) / 2))), 6) as omega from t where matrix is not null and b is not null""")
def so3_angular_speed(spark, sf):
    """F23, W24, X11."""
    return _arms(spark, sf).where("omega is not null").select("frame", "arm", r6("omega"))


@query(f"with {RO}, h as (select episode, arm, frame from pc where not legal) select episode, arm, \"start\" as frame_start, \"end\" as frame_end from ({islands_sql('h', 'episode, arm', 'frame', 1)})")
def degenerate_rotations(spark, sf):
    """D27."""
    f = D.degenerate_rotations(_arms(spark, sf))
    return f.select("episode", F.regexp_extract("column", r"state\.(\w+)\.", 1).alias("arm"), "frame_start", "frame_end")


@query(f"""with {EM}, p as (select episode, seq, state[1:3] as pos from em), d as (select *, {DV('pos', 'lag(pos) over (partition by episode order by seq)')} as d from p), s as (select *, {NO('d')} as step from d),
u as (select *, lag(d) over (partition by episode order by seq) as d0, lag(step) over (partition by episode order by seq) as s0 from s),
t as (select *, case when list_sum(list_transform(list_zip(d, d0), lambda p: p[1] * p[2])) / (greatest(step, 1e-9) * greatest(s0, 1e-9)) < -0.25 then 1 else 0 end as turn from u),
w as (select *, lag(pos, 10) over (partition by episode order by seq) as p0, sum(step) over (partition by episode order by seq rows between 9 preceding and current row) as path, sum(turn) over (partition by episode order by seq rows between 8 preceding and current row) as rev from t),
x as (select *, {NO(DV('pos', 'p0'))} as net from w where p0 is not null)
select episode, seq - 10 as "start", round(path, 6) as path_length, round(net / greatest(path, 1e-9), 6) as path_efficiency, cast(rev as bigint) as direction_reversals from x where rev >= 5 and net / greatest(path, 1e-9) <= 0.1""")
def oscillation_windows(spark, sf):
    """W18, D28."""
    e = T.embeddings(spark, sf).withColumn("pos", F.slice("state", 1, 3))
    d = signals.oscillation_windows(e, ["episode"], reversals=5, efficiency=0.1, min_path=0.0)
    return d.select("episode", "start", r6("path_length"), r6("path_efficiency"), "direction_reversals")


@query(f"""with {EM}, d as (select episode, frame, {NO(DV('state[11:13]', 'state[1:3]'))} as distance from em), m as (select *, abs(distance - quantile_cont(distance, 0.5) over (partition by episode)) as drift from d) select frame, round(distance, 6) as distance, round(drift, 6) as drift from m""")
def bimanual_distance_drift(spark, sf):
    """X12, W25, J15."""
    return signals.bimanual(T.embeddings(spark, sf), ["episode"]).select("frame", r6("distance"), r6("drift"))


@query(f"""with {EM}, d as (select episode, frame, seq, {NO(DV('state[11:13]', 'state[1:3]'))} as distance from em), m as (select *, abs(distance - quantile_cont(distance, 0.5) over (partition by episode)) as drift from d), s as ({stats_sql("m", "drift")}),
h as (select m.episode, m.seq, m.frame from m, s where drift > greatest(p99 * 0.7, median + 2.0 * mad)) select episode, a as frame_start, b as frame_end from ({islands_sql("h", "episode", "seq", 2, "arg_min(frame, seq) as a, arg_max(frame, seq) as b")})""")
def distance_drift_findings(spark, sf):
    """D30, D33."""
    d = signals.bimanual(T.embeddings(spark, sf), ["episode"])
    s = robust_stats(d, [], "drift").select(F.struct(*FIELDS).alias("s"))
    return D.distance_drifts(d.crossJoin(F.broadcast(s)), times=0.7, mads=2.0).select("episode", "frame_start", "frame_end")


@query(f"""with {RO}, l as (select * from mx where arm = 'left'), r as (select * from mx where arm = 'right'), p as (select l.frame, l.matrix as m, {DV('r.pos', 'l.pos')} as d from l join r on l.frame = r.frame)
select frame, round(m[1] * d[1] + m[4] * d[2] + m[7] * d[3], 6) as x, round(m[2] * d[1] + m[5] * d[2] + m[8] * d[3], 6) as y, round(m[3] * d[1] + m[6] * d[2] + m[9] * d[3], 6) as z from p""")
def relative_pose(spark, sf):
    """F25."""
    a = _arms(spark, sf).where("matrix is not null").select("frame", "arm", "pos", "matrix")
    g = a.groupBy("frame").agg(*(F.max(F.when(F.col("arm") == s, F.col(c))).alias(f"{s}_{c}") for s in ("left", "right") for c in ("pos", "matrix"))).where("left_matrix is not null and right_matrix is not null")
    p = V.relative_pose(F.col("left_pos"), F.col("left_matrix"), F.col("right_pos"), F.col("right_matrix"))["position"]
    return g.select("frame", *(r6(F.element_at(p, i + 1), n) for i, n in enumerate("xyz")))


# ---- lags ------------------------------------------------------------------------------------------------------------

SG = f"{EV}, sg as (select episode, frame, seq, value as a, coalesce(timestamp - lag(timestamp) over (partition by episode order by seq), 0) as b from ev)"
LC = SG + ", lg as (select range - 5 as lag from range(11)), pr as (select y.episode, lag, x.a, y.b from lg, sg y join sg x on x.episode = y.episode and x.seq = y.seq + lag), lc as (select episode, lag, count(*) as n, corr(a, b) as r from pr group by 1, 2 having count(*) >= {least} and stddev_pop(a) >= 1e-9 and stddev_pop(b) >= 1e-9)"


def _two(spark, sf):
    d = T.events(spark, sf)
    gap = F.coalesce(F.col("timestamp") - F.lag("timestamp").over(signals.ordered(["episode"], "seq")), F.lit(0.0))
    return d.select("episode", "task", "frame", "seq", F.col("value").alias("a"), gap.alias("b"))


@query(f"with {LC.format(least=8)} select episode, lag, n, round(r, 6) as r from lc")
def lag_correlations(spark, sf):
    """J8, F26."""
    return lag.lag_correlations(_two(spark, sf), ["episode"]).select("episode", "lag", "n", r6("r"))


@query(f"""with {LC.format(least=8)}, k as (select *, row_number() over (partition by episode order by r desc, lag) as k from lc), b as (select episode, max(case when k = 1 then lag end) as best_lag, max(case when k = 1 then r end) as c1, max(case when k = 2 then r end) as c2 from k group by 1)
select episode, case when c1 >= 0.2 and c1 - c2 >= 0.02 then 'ok' else 'unavailable' end as status, best_lag, round(c1, 6) as best_corr, round(c2, 6) as second_best_corr, round(c1 - c2, 6) as peak_margin from b""")
def lag_profile(spark, sf):
    """W20, W21."""
    d = lag.lag_profile(_two(spark, sf), ["episode"], least_corr=0.2, least_margin=0.02)
    return d.select("episode", "status", "best_lag", r6("best_corr"), r6("second_best_corr"), r6("peak_margin"))


@query(f"with {LC.format(least=8)}, k as (select *, row_number() over (partition by episode order by r desc, lag) as k from lc) select episode, lag as best_lag, round(r, 6) as best_correlation from k where k = 1")
def best_lag_v1(spark, sf):
    """W23."""
    return lag.best_lag(_two(spark, sf), ["episode"]).select("episode", "best_lag", r6("best_correlation"))


@query(f"with {LC.format(least=8)}, k as (select *, row_number() over (partition by episode order by r desc, lag) as k from lc) select episode, cast(20.0 - case when r < 0.75 then 5.0 else 0.0 end - case when lag not in (-1, 0) then 5.0 else 0.0 end as double) as sync_score from k where k = 1")
def v1_sync_score(spark, sf):
    """D40."""
    return D.v1_sync(lag.best_lag(_two(spark, sf), ["episode"])).select("episode", "sync_score")


@query(f"""with {LC.format(least=11)}, k as (select *, row_number() over (partition by episode order by abs(r) desc, lag) as k from lc), q as (select episode, count(*) as n, quantile_cont(a, 0.25) as a1, quantile_cont(a, 0.75) as a3, quantile_cont(b, 0.25) as b1, quantile_cont(b, 0.75) as b3 from sg group by 1),
f as (select sg.episode, n, avg(case when b >= b3 and a <= a1 then 1.0 else 0.0 end) as f1, avg(case when a >= a3 and b <= b1 then 1.0 else 0.0 end) as f2 from sg join q using (episode) group by 1, 2)
select f.episode, f.n as sample_count, lag as best_lag, round(abs(r), 6) as best_abs_correlation, round(f1, 6) as state_active_visual_quiet_fraction, round(f2, 6) as visual_active_state_quiet_fraction from f join k on k.episode = f.episode and k = 1""".replace("and k = 1", "and k.k = 1"))
def motion_coupling(spark, sf):
    """W22, A32, D34, D35."""
    d = lag.coupling(_two(spark, sf), ["episode"], state="b", visual="a")
    return d.select("episode", "sample_count", "best_lag", r6("best_abs_correlation"), r6("state_active_visual_quiet_fraction"), r6("visual_active_state_quiet_fraction"))


@query(f"""with {SG}, n as (select *, count(*) over (partition by episode) as n from sg), w as (select n.*, s.range * 5 as ws from n, range(0, 40) s where s.range * 5 <= seq and seq < s.range * 5 + least(21, n) and s.range * 5 + greatest(11, least(21, n)) <= n and n >= 11)
select episode, count(distinct ws) as window_count, count(*) as n_rows from w group by 1""")
def lag_windows(spark, sf):
    """How many windows an episode has and what they hold."""
    d = lag.lag_stability(_two(spark, sf), ["episode"]).select("episode", "window_count")
    n = _two(spark, sf).groupBy("episode").agg(F.count("*").alias("n"))
    return d.join(n, "episode").select("episode", "window_count", (F.col("window_count") * F.least(F.lit(21), F.greatest(F.lit(11), F.col("n")))).alias("n_rows"))


# Windows of 21 rows every five, and the profile of each: the largest correlation and its lead over the second.
PROFILE = """pr{i} as (select y.episode, y.ws, lag, x.a, y.b from lg, {w} y join {w} x on x.episode = y.episode and x.ws = y.ws and x.seq = y.seq + lag), lc{i} as (select episode, ws, lag, corr(a, b) as r from pr{i} group by 1, 2, 3 having count(*) >= 8 and stddev_pop(a) >= 1e-9 and stddev_pop(b) >= 1e-9),
be{i} as (select episode, ws, max(case when k = 1 then lag end) as lag, max(case when k = 1 then r end) as c1, max(case when k = 2 then r end) as c2 from (select *, row_number() over (partition by episode, ws order by r desc, lag) as k from lc{i}) group by 1, 2),
pf{i} as (select e.episode, e.ws, lag, c1, n >= 12 and ea > 1e-9 and eb > 1e-9 and c1 is not null as told, coalesce(n >= 12 and ea > 1e-9 and eb > 1e-9 and c1 >= 0.35 and coalesce(c1 - c2, 1e9) >= 0.08, false) as ok from (select episode, ws, count(*) as n, quantile_cont(a, 0.9) - quantile_cont(a, 0.1) as ea, quantile_cont(b, 0.9) - quantile_cont(b, 0.1) as eb from {w} group by 1, 2) e left join be{i} on be{i}.episode = e.episode and be{i}.ws = e.ws)"""
LS = f"""{SG}, lg as (select range - 5 as lag from range(11)), w as (select n.*, s.range * 5 as ws from (select *, count(*) over (partition by episode) as n from sg) n, range(0, 200) s where n >= 11 and s.range * 5 <= seq and seq < s.range * 5 + greatest(11, least(21, n)) and s.range * 5 + greatest(11, least(21, n)) <= n),
{PROFILE.format(i=1, w="w")}, gs as (select episode, count(*) as window_count, count(*) filter (ok) as valid, quantile_cont(lag, 0.5) filter (ok) as lm, mad(lag) filter (ok) as ld, quantile_cont(c1, 0.5) filter (ok) as cm from pf1 group by 1),
st as (select *, case when valid < 3 then 'too_few_stable_windows' when ld <= 1 and cm >= 0.35 then 'stable_peak' else 'unstable_peak' end as reason from gs)"""


@query(f"with {LS} select episode, case when reason = 'stable_peak' then 'ok' else 'unavailable' end as status, reason, window_count, valid as valid_window_count, case when valid >= 3 then cast(lm as double) end as lag_median, case when valid >= 3 then cast(ld as double) end as lag_mad, case when valid >= 3 then round(cm, 6) end as corr_median from st")
def lag_stability(spark, sf):
    """W19, A24."""
    d = lag.lag_stability(_two(spark, sf), ["episode"])
    return d.select("episode", "status", "reason", "window_count", "valid_window_count", "lag_median", "lag_mad", r6("corr_median"))


@query(f"with {LS}, w0 as (select *, 0 as ws from sg), {PROFILE.format(i=0, w='w0')} select pf0.episode, case when pf0.told then pf0.lag end as best_lag, pf0.ok as peak, coalesce(st.reason = 'stable_peak', false) as stable, case when pf0.ok and coalesce(st.reason = 'stable_peak', false) then 'ok' else 'unavailable' end as identifiable from pf0 left join st on st.episode = pf0.episode")
def identifiable_lags(spark, sf):
    """A lag counts where the whole episode has a peak and its windows agree on it."""
    d = lag.identifiable_lag(_two(spark, sf), ["episode"])
    return d.select("episode", "best_lag", (F.col("status") == "ok").alias("peak"), F.coalesce(F.col("stability_reason") == "stable_peak", F.lit(False)).alias("stable"), "identifiable")


@query(f"""with {SG}, q as (select *, lag(frame) over (partition by episode order by seq) as fb, quantile_cont(a, 0.6) over (partition by episode) as hi, quantile_cont(b, 0.4) over (partition by episode) as lo from sg), h as (select episode, seq, frame, coalesce(fb, frame) as fb from q where a >= hi and b <= lo)
select episode, x as frame_start, y as frame_end, n from ({islands_sql("h", "episode", "seq", 1, "arg_min(fb, seq) as x, arg_max(frame, seq) as y")}) where n >= 2""")
def state_vision_static_moves(spark, sf):
    """D31, D32, W26."""
    f = D.coincidences(_two(spark, sf), "a", "b", [], "vision_state_vision", "geometry_wrist_state_moves_visual_static", 0.6, 0.4, 2)
    return f.select("episode", "frame_start", "frame_end", F.get_json_object("evidence", "$.run_length").cast("long").alias("n"))


# ---- scores ----------------------------------------------------------------------------------------------------------

TG = "tg as (select episode, 0.65 * 25.0 as p from (select *, quantile_cont(diff, 0.5) over (partition by episode) as period from (select *, lead(timestamp) over (partition by episode order by seq) - timestamp as diff from ev)) where diff <= 0 or abs(diff - period) > greatest(0.02, 8.0 * period))"
# Moves before a still gap: every one is outside the distribution, none is severe.
CX = f"""ca as (select *, lag(frame) over (partition by episode order by seq) as fb, quantile_cont(a, 0.6) over (partition by episode) as hi, quantile_cont(b, 0.4) over (partition by episode) as lo from (select episode, frame, seq, value as a, coalesce(timestamp - lag(timestamp) over (partition by episode order by seq), 0) as b from ev)), cb as (select episode, seq, frame, coalesce(fb, frame) as fb from ca where a >= hi and b <= lo),
cx as (select episode, round(least(15.0, 15.0 * least(85.0, 40 + 5.0 * n) / 100 * least(1.5, 1 + greatest(0, y - x) / 200.0)), 3) as penalty from ({islands_sql("cb", "episode", "seq", 1, "arg_min(fb, seq) as x, arg_max(frame, seq) as y")}) where n >= 2)"""
SC = f"""{FJ}, {TG}, {CX}, t as (select episode, sum(cast(penalty as decimal(18, 3))) as lost, count(*) as n, count(*) filter (raw >= 50) as sv from fp group by 1), g as (select episode, count(*) as n from tg group by 1), c as (select episode, sum(cast(penalty as decimal(18, 3))) as lost, count(*) as n from cx group by 1),
sc as (select e.episode, e.len, greatest(0.0, 25.0 - least(25.0, 25.0 * coalesce(g.n, 0))) as structural, cast(round(greatest(0.000, 15.000 - coalesce(t.lost, 0.000)), 2) as double) as temporal, cast(round(greatest(0.000, 15.000 - coalesce(c.lost, 0.000)), 2) as double) as cross_modal, coalesce(g.n, 0) as ill, coalesce(t.n, 0) + coalesce(g.n, 0) + coalesce(c.n, 0) as findings, coalesce(t.sv, 0) + coalesce(g.n, 0) as sv
 from (select episode, count(*) as len from ev group by 1) e left join t on t.episode = e.episode left join g on g.episode = e.episode left join c on c.episode = e.episode),
os as (select episode, findings, sv, round(structural + temporal + cross_modal + 45.0, 2) as legacy_score, structural, temporal, cross_modal, round(20.0 - least(3.0, 0.25 * sv) - 2.0 - 2.5 - case when len < 32 then 3.0 else 0.0 end, 2) as data_value, round(10.0 - least(2.0, 0.35 * ill) - 1.0, 2) as engineering_reliability from sc),
official as (select *, round(cast(round(0.7 * cast(legacy_score as decimal(10, 2)), 2) as double) + data_value + engineering_reliability, 2) as official_score from os)"""


def _episode_findings(spark, sf):
    """Illegal steps of time, jumps of high and of doubtful confidence, and moves that only lie outside the distribution."""
    moves = D.coincidences(_two(spark, sf), "a", "b", [], "vision_state_vision", "geometry_wrist_state_moves_visual_static", 0.6, 0.4, 2)
    return union_findings([_fast_jumps(spark, sf), D.timestamp_steps(T.events(spark, sf), share=8.0), moves])


def _scores(spark, sf):
    episodes = T.events(spark, sf).groupBy("episode").agg(F.count("*").alias("length"))
    return scoring.episode_scores(episodes, _episode_findings(spark, sf))


@query(f"with {SC} select episode, findings, sv as severe, cast(structural as double) as score_structural, temporal as score_temporal, cross_modal as score_cross_modal, legacy_score, cast(data_value as double) as data_value, cast(engineering_reliability as double) as engineering_reliability, cast(official_score as double) as official_score from official")
def episode_scores(spark, sf):
    """X14, A17, §2.10: severe findings are the illegal ones and jumps of 50 or more that lie within the distribution."""
    return _scores(spark, sf).select("episode", "findings", "severe", "score_structural", "score_temporal", "score_cross_modal", "legacy_score", "data_value", "engineering_reliability", "official_score")


@query(f"with {SC} select count(*) as episodes, cast(sum(findings) as bigint) as findings, round(avg(official_score), 2) as official_score, round(avg(legacy_score), 2) as legacy_score, min(official_score) as min_score, max(official_score) as max_score from official")
def dataset_score(spark, sf):
    """A14, A15."""
    return scoring.dataset_score(_scores(spark, sf)).select("episodes", "findings", "official_score", "legacy_score", "min_score", "max_score")


@query(f"""with {SC}, fs as (select episode from fp union all select episode from tg union all select episode from cx), pe as (select episode, count(*) as n from fs group by 1)
select 'findings_match' as rule, (select count(*) = 0 from official left join pe using (episode) where findings <> coalesce(n, 0)) as ok union all select 'scores_in_range', (select min(official_score) >= 0 and max(official_score) <= 100 from official)
union all select 'parts_add_up', (select max(abs(official_score - 0.7 * legacy_score - data_value - engineering_reliability)) <= 0.016 from official) union all select 'episodes_unique', (select count(*) = count(distinct episode) from official) union all select 'no_orphans', (select count(*) = 0 from fs where episode not in (select episode from official))""")
def readiness_invariants(spark, sf):
    """I21, U7."""
    f = written(_episode_findings(spark, sf), "findings")
    episodes = T.events(spark, sf).groupBy("episode").agg(F.count("*").alias("length"))
    return gates.invariants(f, written(scoring.episode_scores(episodes, f), "scores"))


@query(f"with {FJ}, {TG}, {CX} select issue_type, n from (select 'low_dim_fast_jump' as issue_type, count(*) as n from fp union all select 'timestamp_gap_or_reorder', count(*) from tg union all select 'geometry_wrist_state_moves_visual_static', count(*) from cx) order by n desc, issue_type limit 10")
def top_issue_types(spark, sf):
    """K3, A13."""
    return top_issues(_episode_findings(spark, sf))


@query(f"with {FJ}, {TG}, {CX} select confidence, count(*) as n from (select case when raw >= 50 then '高置信异常' else '疑似异常' end as confidence from fp union all select '确定异常' from tg union all select '分布外样本' from cx) group by 1")
def confidence_counts(spark, sf):
    """A13, F15."""
    return counts_by(_episode_findings(spark, sf), "confidence")


@query(f"with {FJ}, k as (select *, row_number() over (partition by episode order by penalty desc) as k from fp) select episode, round(sum(penalty) / count(*), 6) as top5_mean from k where k <= 5 group by 1")
def top5_mean_penalty(spark, sf):
    """A22, K4."""
    return _fast_jumps(spark, sf).groupBy("episode").agg(F.collect_list("penalty").alias("p")).select("episode", r6(top_mean(F.col("p")), "top5_mean"))


@query(f"with {FJ} select episode, frame_start, severity, penalty from (select *, row_number() over (partition by episode order by severity desc, penalty desc, frame_start) as k from fp) where k <= 2")
def ranked_findings(spark, sf):
    """K5, A30."""
    return sampling.top_per_key(_fast_jumps(spark, sf), ["episode"], 2, F.desc("severity"), F.desc("penalty"), "frame_start").select("episode", "frame_start", "severity", "penalty")


@query(f"""with {EV}, s as ({stats_sql("ev", "value")}), p as (select episode, case when value > p95 then least(1.0, (value - p95) / greatest(max - p95, 1e-9)) else 0.0 end as p from ev, s), k as (select *, row_number() over (partition by episode order by p desc) as k from p where p > 0)
select e.episode, 'temporal' as dimension, round(least(2.0, coalesce(m, 0.0) * 2.0), 3) as soft from (select distinct episode from ev) e left join (select episode, avg(p) as m from k where k <= 5 group by 1) k using (episode)""")
def soft_penalties(spark, sf):
    """A22."""
    e = T.events(spark, sf)
    d = e.crossJoin(F.broadcast(robust_stats(e, [], "value").select(F.struct(*FIELDS).alias("s"))))
    return scoring.soft_penalties(d.select("episode", F.lit("temporal").alias("dimension"), S.upper_tail_pressure("value", F.col("s")).alias("pressure")), ["episode"])


@query("""with s as (select o_custkey as episode, o_orderkey as frame, o_orderstatus as st, o_totalprice as p from orders), f as (select episode, case st when 'F' then 'timestamp_interval' when 'O' then 'state_continuity_spike' else 'unexpected_column' end as i, case when p > 400000 then 'high' when p > 200000 then 'medium' else 'low' end as l from s),
v as (select *, cast(case l when 'high' then 12.0 when 'medium' then 5.0 else 2.0 end as double) as pen from f), g as (select episode, coalesce(sum(pen) filter (i like '%timestamp%'), 0::double) as t, coalesce(sum(pen) filter (i like '%state%'), 0::double) as n, count(*) as k from v group by 1)
select episode, round(greatest(0.0, least(20.0, 20.0 - t)), 2) as time_score, round(greatest(0.0, least(25.0, 25.0 - n)), 2) as numeric_score, k as structural_findings, round(greatest(0.0, least(20.0, 20.0 - t)) + greatest(0.0, least(25.0, 25.0 - n)) + 20.0 + 15.0, 2) as total from g""")
def v1_scores(spark, sf):
    """Labels from the order's price, issues from its status."""
    o = T.orders(spark, sf)
    issue = F.when(F.col("o_orderstatus") == "F", "timestamp_interval").when(F.col("o_orderstatus") == "O", "state_continuity_spike").otherwise("unexpected_column")
    f = o.select("episode", issue.alias("issue_type"), F.when(F.col("o_totalprice") > 400000, "high").when(F.col("o_totalprice") > 200000, "medium").otherwise("low").alias("severity"))
    none = f.where("false")
    d = scoring.v1_scores(o.select("episode").distinct(), f, none, none.select("episode", F.lit(0.0).alias("sync_score")))
    return d.select("episode", "time_score", "numeric_score", "structural_findings", F.col("quality_score_without_value").alias("total"))


@query("with c as (select event_type, count(*) as n from events group by 1) select count(*) as tasks, round(min(n) / max(n), 6) as balance, round(15 * (0.7 + 0.3 * min(n) / max(n)), 2) as value_score from c")
def task_balance(spark, sf):
    """A29, A21."""
    return scoring.task_balance(T.events(spark, sf), "event_type").select("tasks", r6("balance"), "value_score")


ST = "case event_type when 'view' then 'ok' when 'click' then 'warning' when 'error' then 'fail' when 'signup' then 'unavailable' else 'odd' end"


@query(f"""with {EV}, s as (select episode, seq, {ST} as st from ev), n as (select *, case when st in ('ok', 'warning', 'unavailable', 'fail') then st else 'fail' end as status from s)
select episode, count(*) filter (status = 'ok') as ok, count(*) filter (status = 'warning') as warning, count(*) filter (status = 'unavailable') as unavailable, count(*) filter (status = 'fail') as fail from n group by 1""")
def status_rollup(spark, sf):
    """A12, F20."""
    d = T.events(spark, sf).withColumn("status", S.normalize_status(F.expr(ST)))
    return status_counts(d, ["episode"], "status", STATUSES)


@query(f"""with {EV}, s as (select episode, event_type, case when value > 90 then 'broken' when value > 60 then 'unavailable' when value > 30 then 'warning' when value > 0.5 then 'ok' end as st from ev), n as (select episode, event_type, case when st is null then 'ok' when st in ('ok', 'warning', 'unavailable', 'fail') then st else 'fail' end as st from s), g as (select episode, list(st) filter (event_type = 'purchase') as core, list(st) filter (event_type <> 'purchase') as more from n group by 1)
select episode, case when list_contains(core, 'fail') then 'fail' when list_contains(core, 'unavailable') then 'unavailable' when list_contains(more, 'fail') then 'fail' when list_contains(more, 'warning') or list_contains(more, 'unavailable') then 'warning' else 'ok' end as status from g""")
def module_status(spark, sf):
    """an episode's purchases are the core, all other events the modules; the value stands for the status."""
    st = F.when(F.col("value") > 90, "broken").when(F.col("value") > 60, "unavailable").when(F.col("value") > 30, "warning").when(F.col("value") > 0.5, "ok")
    d = T.events(spark, sf).withColumn("status", S.normalize_status(st))
    of = lambda test: F.collect_set(F.when(test, F.col("status")))  # noqa: E731  four values at most
    g = d.groupBy("episode").agg(of(F.col("event_type") == "purchase").alias("core"), of(F.col("event_type") != "purchase").alias("more"))
    return g.select("episode", S.aggregate_status(F.col("core"), F.col("more")).alias("status"))


@query("select * from (values " + ", ".join(f"('{k}', '{i}', '{d}', {DIMENSION_POINTS[d]}::double)" for k, (i, _, d) in FAMILIES.items()) + ") t(family, category_id, dimension, points)")
def taxonomy(spark, sf):
    """F33 and the taxonomy table."""
    from framegauge.functions.taxonomy import families

    return families(spark).where(S.finding_family("category_id") == F.col("family")).select("family", "category_id", "dimension", "points")


@query("""select page_id, regexp_replace(url, '[<>:"/\\\\|?*]', '_', 'g') as safe, length(url) > 0 and regexp_matches(url, '^([A-Za-z]:[\\\\/]|/)') as absolute, coalesce(try_cast(regexp_extract(url, '([0-9]+)[^0-9]*$', 1) as bigint), -1) as number from pages""".replace("\\\\", "\\"))
def path_functions(spark, sf):
    """F30, P14, S10."""
    p = T.table(spark, sf, "pages")
    return p.select("page_id", S.safe_name("url").alias("safe"), S.absolute_path("url").alias("absolute"), F.coalesce(F.regexp_extract("url", r"([0-9]+)[^0-9]*$", 1).try_cast("long"), F.lit(-1)).alias("number"))


# ---- samples, pairs, injection, repair -------------------------------------------------------------------------------


@query(f"with {EV}, n as (select *, count(*) over (partition by episode) as n from ev), p as (select distinct episode, cast(floor(r.range * (n - 1) / 7.0) as bigint) as seq from n, range(8) r) select ev.episode, ev.seq, ev.frame from ev join p on p.episode = ev.episode and p.seq = ev.seq")
def even_sample(spark, sf):
    """K7, I27."""
    return sampling.even_sample(T.events(spark, sf), ["episode"], 8).select("episode", "seq", "frame")


@query(f"with {EV}, n as (select *, count(*) over (partition by episode) as n from ev) select episode, seq, frame from n where seq % greatest(1, n // 10) = 0 and seq < 60")
def stride_sample(spark, sf):
    """K8, K9."""
    return sampling.first_rows(sampling.stride_sample(T.events(spark, sf), ["episode"], 10), 60).select("episode", "seq", "frame")


@query("select o_orderkey, ['black_screen', 'state_nan', 'row_reorder'][o_orderkey % 3 + 1] as issue from orders")
def round_robin(spark, sf):
    """K10, I16."""
    return sampling.round_robin(T.table(spark, sf, "orders"), "o_orderkey", ["black_screen", "state_nan", "row_reorder"], "issue").select("o_orderkey", "issue")


@query("with c as (select conv_id, role, count(*) as n from conversations group by 1, 2) select a.conv_id, a.role as view_a, b.role as view_b, a.n as a, b.n as b from c a join c b on a.conv_id = b.conv_id and a.role < b.role")
def view_pairs(spark, sf):
    """J11, C7."""
    c = T.table(spark, sf, "conversations").groupBy("conv_id", "role").agg(F.count("*").alias("n"))
    return vision.view_pairs(c, ["conv_id"], "role", "n")


EN = EV + ", en as (select *, count(*) over (partition by episode) as n from ev), es as (select *, " + SEG.format(len="{len}") + " as s from en)"


def _inj(length: int, anchor: str = "0.35") -> str:
    return EN.replace("{len}", str(length)).replace("0.35", anchor)


@query(f"with {_inj(1)} select episode, frame, round(case when seq < 3 then first_value(value) over (partition by episode order by seq) else lag(value, 3) over (partition by episode order by seq) end, 6) as value from es")
def inject_delay(spark, sf):
    """I13, W29."""
    return J.delay(T.events(spark, sf), ["episode"], ["value"], 3).select("episode", "frame", r6("value"))


@query(f"with {_inj(4)}, h as (select episode, value as held from es where seq = s - 1) select es.episode, frame, case when seq between s and s + 3 then held else value end as value from es join h on h.episode = es.episode")
def inject_repeat(spark, sf):
    """I11."""
    return J.repeat_previous(T.events(spark, sf), ["episode"], "value", 4).select("episode", "frame", "value")


@query(f"with {_inj(4, '0.25')} select episode, frame, case when seq between s and s + 3 then coalesce(lead(value, 12) over (partition by episode order by seq), last_value(value) over (partition by episode order by seq rows between unbounded preceding and unbounded following)) else value end as value from es")
def inject_jump(spark, sf):
    """I12."""
    return J.jump_ahead(T.events(spark, sf), ["episode"], "value", 4, 12).select("episode", "frame", "value")


@query(f"with {_inj(1)} select episode, frame, round(case when seq = s then lag(timestamp) over (partition by episode order by seq) - 0.1 else timestamp end, 6) as timestamp from es")
def inject_step_back(spark, sf):
    """I8."""
    return J.step_back(T.events(spark, sf), ["episode"]).select("episode", "frame", r6("timestamp"))


@query(f"with {_inj(1)} select episode, seq, case when seq = s then lag(frame) over (partition by episode order by seq) else frame end as duplicate, case when seq >= s then frame + 3 else frame end as skip from es")
def inject_index(spark, sf):
    """I9."""
    e = T.events(spark, sf).withColumn("skip", F.col("frame"))
    return J.skip_index(J.duplicate_index(e, ["episode"], "frame"), ["episode"], "skip").select("episode", "seq", F.col("frame").alias("duplicate"), "skip")


@query(f"with {_inj(2)} select episode, frame, case when seq = s then seq + 1 when seq = s + 1 then seq - 1 else seq end as seq from es")
def inject_swap(spark, sf):
    """I10."""
    return J.swap_rows(T.events(spark, sf), ["episode"]).select("episode", "frame", "seq")


@query(f"""with {_inj(20, '0.3')}, a as (select episode, greatest(0.22 * (quantile_cont(value, 0.95) - quantile_cont(value, 0.05)), 0.44 * stddev_pop(value), 0.02) as amp from ev group by 1)
select es.episode, frame, round(case when seq between s and s + 19 then value + case when (seq - s) % 2 = 0 then amp else -amp end else value end, 6) as value from es join a on a.episode = es.episode""")
def inject_jitter(spark, sf):
    """I14."""
    return J.jitter(T.events(spark, sf), ["episode"], "value", 20).select("episode", "frame", r6("value"))


@query(f"with {_inj(4)} select episode, count(*) filter (seq between s and s + 3) as changed, 0 as left_over from es group by 1")
def repair_delta(spark, sf):
    """NaN injected, then the source's rows put back."""
    e = T.events(spark, sf)
    broken = J.replace_value(e, ["episode"], "value", F.lit(float("nan")))
    fixed = J.repair(broken, e, ["episode"], ["value"])
    b = J.changed_spans(e, broken, ["episode"], "value").select("episode", F.col("n").alias("changed"))
    f = J.changed_spans(e, fixed, ["episode"], "value").select("episode", F.col("n").alias("_left"))
    return b.join(f, "episode", "left").select("episode", "changed", F.coalesce("_left", F.lit(0)).cast("int").alias("left_over"))


IO = f"""{_inj(6)}, h as (select episode, value as held from es where seq = s - 1), v as (select es.episode, seq, s, case when seq between s and s + 5 then held else value end as value from es join h on h.episode = es.episode),
x as (select *, case when value = lag(value) over (partition by episode order by seq) then 0 else 1 end as fresh from v), y as (select *, sum(fresh) over (partition by episode order by seq rows unbounded preceding) as i from x),
rn as (select episode, any_value(s) as s, min(seq) as a, max(seq) as b, count(*) as n from y group by episode, i having count(*) >= 4)"""


def _detected(spark, sf):
    e = T.events(spark, sf)
    broken = J.repeat_previous(e, ["episode"], "value", 6)
    expected = J.with_segment(e, ["episode"], 6).where("_hit").groupBy("episode").agg(F.min("seq").alias("e0"), F.max("seq").alias("e1"))
    runs = equal_runs(broken, ["episode"], "seq", "value").where("n >= 4")
    return expected.join(runs, "episode", "left").withColumn("iou", span_iou(F.col("e0"), F.col("e1"), F.col("start"), F.col("end")))


@query(f"with {IO} select episode, s as expected_start, a as found_start, b as found_end, round(greatest(0, least(s + 5, b) - greatest(s, a) + 1) / (6 + b - a + 1 - greatest(0, least(s + 5, b) - greatest(s, a) + 1)), 6) as iou from rn")
def injected_span_iou(spark, sf):
    """An injected freeze against what the run detector finds."""
    return _detected(spark, sf).select("episode", F.col("e0").alias("expected_start"), F.col("start").alias("found_start"), F.col("end").alias("found_end"), r6("iou"))


@query(f"""with {IO}, q as (select episode, greatest(0, least(s + 5, b) - greatest(s, a) + 1) / (6 + b - a + 1 - greatest(0, least(s + 5, b) - greatest(s, a) + 1)) as iou from rn), e as (select distinct episode from ev), c as (select e.episode, max(iou) as iou, count(*) filter (iou < 0.5) as fp from e left join q on q.episode = e.episode group by 1),
m as (select count(*) filter (iou >= 0.5) as tp, count(*) filter (coalesce(iou, 0) < 0.5) as fn, cast(sum(fp) as bigint) as fp, avg(iou) filter (iou >= 0.5) as mean_iou from c)
select tp, fn, fp, round(tp / (tp + fp), 6) as "precision", round(tp / (tp + fn), 6) as recall, round(mean_iou, 6) as mean_iou from m""")
def detection_prf1(spark, sf):
    """A26, I19."""
    d = _detected(spark, sf).groupBy("episode").agg(F.max("iou").alias("iou"), F.count(F.when((F.col("iou") < 0.5) & F.col("start").isNotNull(), 1)).alias("false_positives"))
    m = scoring.detection_metrics(d.select(F.lit(True).alias("expected"), F.coalesce(F.col("iou") >= 0.5, F.lit(False)).alias("hit"), "false_positives", "iou"))
    return m.select("tp", "fn", "fp", r6("precision"), r6("recall"), r6("mean_iou"))


@query("select l_returnflag as status, count(*) as cases, round(sum(l_quantity) / 1000, 6) as seconds from lineitem group by 1")
def benchmark_rows(spark, sf):
    """Rows per status."""
    return T.table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("status")).agg(F.count("*").alias("cases"), r6(F.sum("l_quantity") / 1000).alias("seconds"))


@query(f"""with {FJ}, sp as (select episode, min(frame) as f0, max(frame) as f1 from ev group by 1), c as (select fp.episode, frame_start, greatest(f0, frame_start - 300) as clip_start, least(f1, frame_end + 300) as clip_end from fp join sp on sp.episode = fp.episode)
select c.episode, frame_start, clip_start, clip_end, count(*) as frames, round(max(value), 6) as most, round(quantile_cont(value, 0.5), 6) as median from c join ev on ev.episode = c.episode and ev.frame between clip_start and clip_end group by 1, 2, 3, 4""")
def clip_summary(spark, sf):
    """300 event ids around each jump."""
    e = T.events(spark, sf)
    spans = e.groupBy("episode").agg(F.min("frame").alias("first_frame"), F.max("frame").alias("last_frame"))
    d = clips.clip_summary(clips.clip_windows(_fast_jumps(spark, sf), spans, 300), e, "value")
    return d.select("episode", "frame_start", "clip_start", "clip_end", "frames", r6("most"), r6("median"))


@query(f"""with {EV}, c as (select *, (value + seq + 1) / 2.0 as c, event_type = lag(event_type) over (partition by episode order by seq) as same from ev)
select episode, count(*) as n_rows, round(avg(c), 6) as combined_mean, round(quantile_cont(c, 0.95), 6) as combined_p95, count(*) filter (same) as repeated_actions from c group by 1""")
def focus_summary(spark, sf):
    """I25."""
    d = clips.focus_summary(T.events(spark, sf), ["episode"], [F.col("value"), F.col("seq") + 1.0], "event_type")
    return d.select("episode", "n_rows", r6("combined_mean"), r6("combined_p95"), "repeated_actions")


@query(f"select event_type, {', '.join(f'round({f}, 6) as value_{n}' for n, f in (('median', 'quantile_cont(value, 0.5)'), ('min', 'min(value)'), ('max', 'max(value)')))} from events group by 1")
def view_summary(spark, sf):
    """A23."""
    d = clips.view_summary(T.events(spark, sf), ["event_type"], ["value"])
    return d.select("event_type", r6("value_median"), r6("value_min"), r6("value_max"))


@query(r"with e as (select event_id, value / 7 as x, round(value) as y from events) select event_id, regexp_replace(cast(cast(round(x, 6) as decimal(28, 6)) as varchar), '\.?0+$', '') as shown, regexp_replace(cast(cast(y as decimal(28, 6)) as varchar), '\.?0+$', '') as whole from e")
def number_format(spark, sf):
    """the events' values, divided by seven and rounded to whole numbers."""
    e = T.table(spark, sf, "events")
    return e.select("event_id", S.shortest(F.col("value") / 7).alias("shown"), S.shortest(F.round("value", 0)).alias("whole"))


@query("select l_linenumber % 4 as part, round(avg(case when l_quantity > 25 then 1.0 else 0.0 end), 6) as mismatch, round(count(distinct (floor(l_discount / 0.1001 * 4), floor(l_tax / 0.0801 * 4))) / 16.0, 6) as coverage from lineitem group by 1")
def fractions_and_coverage(spark, sf):
    """A31, A32."""
    t = T.table(spark, sf, "lineitem").withColumn("part", F.col("l_linenumber") % 4)
    a = t.groupBy("part").agg(r6(F.avg((F.col("l_quantity") > 25).cast("double"))).alias("mismatch"))
    b = vision.grid_coverage(t, ["part"], "l_discount", "l_tax", 0.1001, 0.0801).select("part", r6("coverage"))
    return a.join(b, "part")


@query(f"with {EMN} select episode, count(*) filter (seq between a and a + 3) as nan_count, 0 as inf_count from es group by 1".replace("0 as inf_count", "cast(0 as bigint) as inf_count"))
def non_finite_counts(spark, sf):
    """A18, I6."""
    return signals.non_finite_counts(J.replace_element(T.embeddings(spark, sf), ["episode"], "state", F.lit(float("nan"))), ["episode"], "state")


@query(f"with {EV}, em as (select cast(label as bigint) as episode, vec_id, row_number() over (partition by label order by vec_id) - 1 as seq from embeddings) select ev.episode, ev.seq, ev.frame, vec_id from ev join em on em.episode = ev.episode and em.seq = ev.seq")
def positional_zip(spark, sf):
    """The events and the vectors of one number side by side."""
    e = T.embeddings(spark, sf).select("episode", "seq", F.col("frame").alias("vec_id"))
    return signals.positional_zip(T.events(spark, sf).select("episode", "seq", "frame"), e, ["episode"])


@query(f"with {FJ}, n as (select episode, count(*) as n, min(frame_start) as first_start from fp group by 1) select e.episode, coalesce(n, 0) as n, first_start from (select distinct episode from ev) e left join n on n.episode = e.episode order by e.episode limit 20")
def findings_by_episode(spark, sf):
    """The first twenty episodes."""
    d = by_episode(T.events(spark, sf), _fast_jumps(spark, sf))
    return first_cases(d, 20, "episode").select("episode", "n", F.get("first", F.lit(0))["frame_start"].alias("first_start"))


@query("select event_type, round(quantile_cont(value, 0.05), 6) as p05, round(quantile_cont(value, 0.5), 6) as median, round(quantile_cont(value, 0.95), 6) as p95 from events group by 1")
def clip_stats(spark, sf):
    """A3."""
    return clips.clip_stats(T.events(spark, sf), ["event_type"], "value").select("event_type", r6("p05"), r6("median"), r6("p95"))


# ---- first generation: defects ---------------------------------------------------------------------------------------


@query("""with t as (select cast(range as bigint) as seq, range / 10.0 as t0, sin(range / 20.0) + case when range = 80 then 5 else 0 end as x, case when range = 100 then -1 when range between 120 and 129 then 119 else range end as img from range(150)),
u as (select *, case when seq = 50 then lag(t0) over (order by seq) + 0.8 else t0 end as ts, abs(x - 2 * lag(x) over (order by seq) + lag(x, 2) over (order by seq)) as acc, lag(seq) over (order by seq) as mid_at from t), d as (select *, lead(ts) over (order by seq) - ts as diff, lead(seq) over (order by seq) as nxt from u), m as (select quantile_cont(diff, 0.5) as e, quantile_cont(acc, 0.5) as am, mad(acc) as ad from d),
r as (select *, sum(case when img = p then 0 else 1 end) over (order by seq) as i from (select *, lag(img) over (order by seq) as p from t))
select cast(0 as bigint) as episode, cast(0 as bigint) as task, 'timestamp_interval' as issue_type, seq as frame_start, nxt as frame_end from d, m where diff <= 0 or abs(diff - e) > greatest(0.02, 0.25 * e)
union all select 0, 0, 'state_continuity_spike', mid_at, mid_at from d, m where acc > greatest(am + 12 * ad, 0.25) union all select 0, 0, 'frozen_frame_run', min(seq), max(seq) from r group by i having count(*) >= 8""")
def v1_four_defects(spark, sf):
    """The four defects in one made episode, and what the first generation's rules report."""
    d = spark.range(150).select(F.lit(0).cast("long").alias("episode"), F.lit(0).cast("long").alias("task"), F.col("id").alias("seq"), F.col("id").alias("frame"), (F.col("id") / 10).alias("timestamp"), F.array(F.sin(F.col("id") / 20)).alias("state"), F.col("id").cast("string").alias("image"))
    bad = J.four_defects(d, "image", F.lit("black"))
    frozen = equal_runs(bad, KEYS, "seq", "image").where("n >= 8").select(*KEYS, F.lit("frozen_frame_run").alias("issue_type"), F.col("start").alias("frame_start"), F.col("end").alias("frame_end"))
    late = D.v1_timestamps(bad).select(*frozen.columns)
    spikes = D.v1_spikes(signals.vector_accel(bad, KEYS, "state"), "accel").select(*frozen.columns)
    return late.union(spikes).union(frozen)


# ---- streams ---------------------------------------------------------------------------------------------------------


@query("""with s as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval 12 hour then 0 else 1 end as fresh from events), r as (select *, sum(fresh) over (partition by user_id order by ts rows unbounded preceding) as i from s)
select user_id, min(ts) as "start", max(ts) + interval 12 hour as "end", count(*) as n from r group by user_id, i""")
def stream_session_runs(spark, sf):
    """Islands on a stream: the events table read as a stream, sessions of twelve hours."""
    from framegauge.streaming.live import session_runs

    return _streamed(spark, session_runs(_event_stream(spark, sf), ["user_id"], "ts", "12 hours"), "complete")


def _event_stream(spark, sf) -> DataFrame:
    schema = T.table(spark, sf, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf).withColumn("ts", F.col("ts").cast("timestamp"))


def _streamed(spark, df: DataFrame, mode: str) -> DataFrame:
    """What a stream gave when it had read all there is. Its tasks write the rows, the driver holds none; where each batch
    gives the whole result, it takes the place of the one before."""
    import uuid

    folder, kept = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}", set()

    def keep(rows: DataFrame, n: int) -> None:
        path = f"{folder}/rows" if mode == "complete" else f"{folder}/rows-{n}"
        rows.write.mode("overwrite").parquet(path)
        kept.add(path)

    df.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(*sorted(kept)) if kept else spark.createDataFrame([], df.schema)


@query("""with w as (select user_id, value, unnest([cast(floor(epoch_us(ts) / 86400e6) as bigint), cast(floor(epoch_us(ts) / 86400e6) as bigint) - 1]) as d from events)
select user_id, d as day, count(*) as n, round(avg(value), 6) as mean, min(value) as min, max(value) as max from w group by 1, 2""")
def stream_rolling_stats(spark, sf):
    """Sliding windows of two days, one each day, on a stream."""
    from framegauge.streaming.live import rolling_stats

    d = _streamed(spark, rolling_stats(_event_stream(spark, sf), ["user_id"], "ts", "value", "2 days", "1 day"), "complete")
    return d.select("user_id", F.floor(F.unix_micros("start") / 86400e6).alias("day"), "n", r6("mean"), "min", "max")


@query(f"""with {EV}, s as ({stats_sql("ev", "value", "event_type")}), z as (select event_id, value, e.event_type, median, {Z.format(v="value")} as z from events e join s on s.event_type = e.event_type)
select event_id, event_type, value, round({score_sql("z", 4.0, 8.0)}, 6) as score from z where value > median and {score_sql("z", 4.0, 8.0)} >= 0.01""")
def stream_outliers(spark, sf):
    """F5 on a stream: rows joined with frozen statistics of their kind."""
    from framegauge.streaming.live import outliers

    s = robust_stats(T.events(spark, sf), ["event_type"], "value").select("event_type", F.struct(*FIELDS).alias("s"))
    return _streamed(spark, outliers(_event_stream(spark, sf), s, ["event_type"], "value", 0.01), "append").select("event_id", "event_type", "value", r6("score"))
