"""Queries of the weak spatial checks and of module statuses, on event and vector episodes.

The gap to the event before stands for the left arm's speed, the change of value for the right arm's, the value for the
main view's motion and, except for errors, for the panel's area."""

from __future__ import annotations

from pyspark.sql import functions as F

from framegauge.functions import scalars as S
from framegauge.operators import detectors as D
from framegauge.operators import geometry, injection, signals, vision
from framegauge.operators.findings import union_findings
from framegauge.operators.statistics import FIELDS, robust_stats
from framegauge.plans import weak
from framegauge.plans.catalog import DE, DV, EM, EMN, KEYS, NO, REF, Z, islands_sql, query, r6, rounded, score_sql, stats_sql
from framegauge.sources import tables as T

MV = f"""{DE}, mv as (select *, greatest(l, r) as state from (select episode, seq, frame, frame_before, coalesce(timestamp - lag(timestamp) over (partition by episode order by seq), 0) as l, delta as r, value as visual, case when event_type <> 'error' then value end as area from de)),
lg as (select range - 5 as lag from range(11)), pr as (select y.episode, lag, x.visual as a, y.state as b from lg, mv y join mv x on x.episode = y.episode and x.seq = y.seq + lag),
lc as (select episode, lag, corr(a, b) as r from pr group by 1, 2 having count(*) >= 11 and stddev_pop(a) >= 1e-9 and stddev_pop(b) >= 1e-9), lk as (select *, row_number() over (partition by episode order by abs(r) desc, lag) as k from lc),
q4 as (select episode, count(*) as n, quantile_cont(visual, 0.25) as a1, quantile_cont(visual, 0.75) as a3, quantile_cont(state, 0.25) as b1, quantile_cont(state, 0.75) as b3 from mv group by 1 having count(*) >= 11),
cp as (select f.episode, lag, abs(r) as c, f1, f2 from (select mv.episode, avg(case when state >= b3 and visual <= a1 then 1.0 else 0.0 end) as f1, avg(case when visual >= a3 and state <= b1 then 1.0 else 0.0 end) as f2 from mv join q4 using (episode) group by 1) f left join lk on lk.episode = f.episode and lk.k = 1),
pn as (select *, sqrt(power(area - lx, 2) + power(seq - ly, 2)) as jump from (select *, last_value(area ignore nulls) over w as lx, last_value(case when area is not null then seq end ignore nulls) over w as ly from mv window w as (partition by episode order by seq rows between unbounded preceding and 1 preceding))),
ps as (select episode, count(area) as valid, avg(case when area is null then 0.0 else 1.0 end) as valid_fraction from mv group by 1),
dr as (select episode, frame, seq, abs(d - quantile_cont(d, 0.5) over (partition by episode)) as drift from (select *, {NO(DV('state[11:13]', 'state[1:3]'))} as d from em))"""
MV = EM + ", " + MV
BU = f"""{MV}, bu as (select 'global|main_camera|background_motion' as bucket, visual as value from mv where {REF} union all select 'global|left|speed', l from mv where {REF} union all select 'global|right|speed', r from mv where {REF}
 union all select 'global|state_visual_motion_coupling|best_abs_correlation', c from cp where {REF} and c is not null union all select 'global|state_visual_motion_coupling|state_active_visual_quiet_fraction', f1 from cp where {REF} and c is not null union all select 'global|state_visual_motion_coupling|visual_active_state_quiet_fraction', f2 from cp where {REF} and c is not null
 union all select 'global|main_camera|panel_area', area from mv where {REF} union all select 'global|main_camera|panel_center_delta', jump from pn where {REF} union all select 'global|main_camera|panel_valid_fraction', valid_fraction from ps where {REF} and valid >= 5
 union all select 'global|bimanual|distance_drift', drift from dr where {REF}), bs as ({stats_sql("bu", "value", "bucket")})"""


def _signals(spark, sf) -> dict:
    e = T.events(spark, sf)
    gap = F.coalesce(F.col("timestamp") - F.lag("timestamp").over(signals.ordered(["episode"], "seq")), F.lit(0.0))
    m = signals.scalar_delta(e.withColumn("left", gap), ["episode"], "value", "right").select(*KEYS, "seq", "frame", "left", "right", F.greatest("left", "right").alias("state"), F.col("value").alias("visual"))
    area = F.when(F.col("event_type") != "error", F.col("value"))
    panel = vision.panel_jumps(e.select(*KEYS, "seq", "frame", F.lit("image").alias("view"), area.alias("panel_area"), F.lit(2.0).alias("panel_aspect"), area.alias("panel_x"), F.when(area.isNotNull(), F.col("seq")).alias("panel_y")))
    return {"m": m, "couplings": weak.coupled(m), "panel": panel, "panels": vision.panel_summary(panel), "drift": signals.bimanual(T.embeddings(spark, sf), ["episode"])}


def _third(s: dict, reference: bool) -> dict:
    return {k: d.where(F.expr(REF) if reference else ~F.expr(REF)) for k, d in s.items()}


@query(f"with {BU} select bucket, {rounded(FIELDS)} from bs")
def weak_reference(spark, sf):
    """The buckets of a reference."""
    return weak.bucket_stats(weak.buckets(**_third(_signals(spark, sf), True))).select("bucket", *(r6(c) if c != "count" else F.col(c) for c in FIELDS))


ONE = "(select * from bs where bucket = 'global|{}')"
# the thresholds of both arms: the one whose bucket counts more values, the left one of equals
HOT = f"""hi as (select case when a.count >= b.count then a.p95 else b.p95 end as high, m.p05 as low from {ONE.format("left|speed")} a, {ONE.format("right|speed")} b, {ONE.format("main_camera|background_motion")} m),
ch as (select mv.* from mv, hi where not ({REF}) and state >= high and visual <= low)"""


@query(f"""with {BU}, {HOT} select episode, a as frame_start, b as frame_end, n, cast(least(92.0, 55 + 4.0 * n) as double) as severity from ({islands_sql("ch", "episode", "seq", 1, "arg_min(frame_before, seq) as a, arg_max(frame, seq) as b")})""")
def weak_camera_freeze(spark, sf):
    """Fast arms before a still view, from one transition on."""
    s = _signals(spark, sf)
    stats = weak.bucket_stats(weak.buckets(**_third(s, True)))
    f = weak.freezes(_third(s, False)["m"], stats, min_run=1)
    return f.select("episode", "frame_start", "frame_end", F.get_json_object("evidence", "$.run_length").cast("long").alias("n"), "severity")


@query(f"""with {MV}, o as (select *, quantile_cont(state, 0.9) over (partition by episode) as high, quantile_cont(visual, 0.1) over (partition by episode) as low from mv), ch as (select * from o where state >= high and visual <= low)
select episode, a as frame_start, b as frame_end, n from ({islands_sql("ch", "episode", "seq", 1, "arg_min(frame_before, seq) as a, arg_max(frame, seq) as b")})""")
def weak_default_thresholds(spark, sf):
    """Without reference values the episode's own quantiles are the thresholds."""
    m = _signals(spark, sf)["m"]
    f = weak.freezes(m, weak.bucket_stats(m.where("false").select(F.lit("x").alias("bucket"), F.col("visual").alias("value"))), min_run=1)
    return f.select("episode", "frame_start", "frame_end", F.get_json_object("evidence", "$.run_length").cast("long").alias("n"))


UP = f"""va as (select coalesce(max(p05) filter (count >= 5), 0.0) as least from bs where bucket = 'global|main_camera|panel_valid_fraction'),
ph as (select x.* from (select mv.*, coalesce(lead(frame) over (partition by episode order by seq), frame) as after from mv) x join ps using (episode), va, {ONE.format("main_camera|panel_area")} s where not ({REF}) and s.count >= 5 and area <= p05 and valid_fraction >= greatest(0.1, least))"""


@query(f"""with {BU}, {UP} select episode, a as frame_start, b as frame_end, n, cast(least(78.0, 45 + 2.5 * n) as double) as severity from ({islands_sql("ph", "episode", "seq", 1, "arg_min(frame, seq) as a, arg_max(after, seq) as b")})""")
def weak_panel_unstable(spark, sf):
    """Areas under the reference's in episodes whose panel is valid often enough."""
    s = _signals(spark, sf)
    stats = weak.bucket_stats(weak.buckets(**_third(s, True)))
    t = _third(s, False)
    f = weak.unstable_panels(t["panel"], t["panels"], stats, min_run=1)
    return f.select("episode", "frame_start", "frame_end", F.get_json_object("evidence", "$.run_length").cast("long").alias("n"), "severity")


@query(f"""with {BU}, z as (select episode, c, median, {Z.format(v="c")} as z from cp, {ONE.format("state_visual_motion_coupling|best_abs_correlation")} s where not ({REF}) and s.count >= 5 and c < greatest(0.2, p05 * 0.65))
select episode, round(greatest(35.0, 100.0 * {score_sql("z", 2.5, 5.0)}), 2) as severity from z""")
def weak_decoupling(spark, sf):
    """D34."""
    s = _signals(spark, sf)
    stats = weak.bucket_stats(weak.buckets(**_third(s, True)))
    c = weak.beside(_third(s, False)["couplings"].where("status = 'ok'"), stats, s=weak.bucket_name("state_visual_motion_coupling", "best_abs_correlation"))
    return D.decoupled(c).select("episode", "severity")


@query(f"""with {BU}, hi as (select bucket, greatest(0.05, p95, median + 2 * mad) as high from bs where count >= 5), f as (select episode, 'state_active_visual_quiet_fraction' as fraction, f1 as f from cp where c is not null and not ({REF}) union all select episode, 'visual_active_state_quiet_fraction', f2 from cp where c is not null and not ({REF}))
select episode, fraction, round(least(80.0, 40 + 250 * (f - high)), 2) as severity from f join hi on bucket = 'global|state_visual_motion_coupling|' || fraction where f > high""")
def weak_activity_mismatch(spark, sf):
    """Both ways, with a floor of 0.05, the plain 95 % quantile and two deviations."""
    s = _signals(spark, sf)
    stats = weak.bucket_stats(weak.buckets(**_third(s, True)))
    c = _third(s, False)["couplings"].where("status = 'ok'")
    parts = [D.activity_mismatch(weak.beside(c, stats, s=weak.bucket_name("state_visual_motion_coupling", n)), n, floor=0.05, times=1.0, mads=2.0).withColumn("fraction", F.lit(n)) for n in weak.COUPLING[1:]]
    return union_findings(parts).select("episode", "fraction", "severity")


@query(f"""with {BU}, {HOT}, {UP}, cf as (select episode, 'p1_main_camera_freeze_candidate' as issue_type, 'supported' as confidence from ({islands_sql("ch", "episode", "seq", 1)})),
pu as (select episode, 'p1_panel_proxy_unstable_candidate' as issue_type, 'weak' as confidence from ({islands_sql("ph", "episode", "seq", 1)})),
dd as (select dr.* from dr, {ONE.format("bimanual|distance_drift")} s where not ({REF}) and s.count >= 5 and drift > greatest(p99 * 1.4, median + 8 * mad)), df as (select episode, 'p1_bimanual_rigidity_drift_candidate' as issue_type, 'weak' as confidence from ({islands_sql("dd", "episode", "seq", 2)})),
de2 as (select episode, 'p1_state_visual_motion_decoupling_candidate' as issue_type, 'weak' as confidence from cp, {ONE.format("state_visual_motion_coupling|best_abs_correlation")} s where not ({REF}) and s.count >= 5 and c < greatest(0.2, p05 * 0.65)),
mm as (select f.episode, 'p1_state_visual_activity_mismatch_candidate' as issue_type, 'weak' as confidence from (select episode, 'state_active_visual_quiet_fraction' as n, f1 as f from cp where c is not null and not ({REF}) union all select episode, 'visual_active_state_quiet_fraction', f2 from cp where c is not null and not ({REF})) f join bs on bucket = 'global|state_visual_motion_coupling|' || n where bs.count >= 5 and f > greatest(0.12, p95 * 1.5, median + 5 * mad)),
al as (select * from cf union all select * from pu union all select * from df union all select * from de2 union all select * from mm)
select episode, issue_type, confidence, count(*) as n from al group by 1, 2, 3""")
def weak_candidates(spark, sf):
    """All weak findings together, counted."""
    s = _signals(spark, sf)
    stats = weak.bucket_stats(weak.buckets(**_third(s, True)))
    t = _third(s, False)
    f = weak.candidates(t["m"], t["couplings"], stats, 1, t["panel"], t["panels"], t["drift"])
    return f.groupBy("episode", "issue_type", "confidence").agg(F.count("*").alias("n"))


@query(f"""with {EM}, d as (select episode, frame, seq, abs(d - quantile_cont(d, 0.5) over (partition by episode)) as drift from (select *, {NO(DV('state[11:13]', 'state[1:3]'))} as d from em)), s as ({stats_sql("d", "drift")}),
h as (select d.*, median, mad, std from d, s where drift > greatest(p99 * 0.5, median + 1.0 * mad)), i as (select *, {Z.format(v="most")} as z from ({islands_sql("h", "episode", "seq", 2, "arg_min(frame, seq) as a, arg_max(frame, seq) as b, max(drift) as most, any_value(median) as median, any_value(mad) as mad, any_value(std) as std")}))
select episode, a as frame_start, b as frame_end, round(greatest(45.0, 100.0 * {score_sql("z", 4.0, 8.0)}), 2) as severity from i where "end" - "start" + 1 >= 2""")
def weak_rigidity_drift(spark, sf):
    """Drifts of two rows or more beyond half the reference's 99 % quantile."""
    d = signals.bimanual(T.embeddings(spark, sf), ["episode"])
    s = robust_stats(d, [], "drift").select(F.struct(*FIELDS).alias("s"))
    f = D.distance_drifts(d.crossJoin(F.broadcast(s)), times=0.5, mads=1.0, min_run=2, floor=45.0, issue="p1_bimanual_rigidity_drift_candidate")
    return f.select("episode", "frame_start", "frame_end", "severity")


@query(f"""with {MV}, v as (select episode, count(r) as n, avg(case when same then 1.0 else 0.0 end) as again from (select *, visual = lag(visual) over (partition by episode order by seq) as same from mv) where seq > 0 group by 1),
c as (select episode, case when episode % 5 = 0 then 'unavailable' else 'ok' end as core from (select distinct episode from mv)), s as (select c.episode, core, case when core = 'unavailable' or n < 8 or coalesce(again, 0) >= 0.35 then 'unavailable' else 'ok' end as sv from c left join v using (episode))
select episode, case when core = 'unavailable' then 'unavailable' when sv = 'unavailable' then 'warning' else 'warning' end as geometry_status, case when core = 'unavailable' then 5 when sv = 'unavailable' then 2 else 1 end as geometry_unavailable, 0 as geometry_fail from s""")
def geometry_statuses(spark, sf):
    """Every fifth episode has states of two widths, so no module works; the left wrist's view is missing in none,
    the right one's in all, and the arms share a frame."""
    e = T.events(spark, sf)
    state = F.array_repeat(F.col("value"), F.when((F.col("episode") % 5 == 0) & (F.col("seq") == 0), 19).otherwise(20))
    cores = geometry.core_statuses(e.withColumn("state", state).unionByName(e.where("seq = 0 and episode % 5 = 0").withColumn("state", F.array_repeat(F.lit(0.0), 20))))
    moved = signals.scalar_delta(e, ["episode"], "value", "motion").select(*KEYS, "seq", F.lit("left_wrist_image").alias("view"), "motion", F.col("value").cast("string").alias("pixel_hash"), F.lit(True).alias("decoded"))
    d = geometry.geometry_statuses(cores, geometry.view_statuses(moved), common_world=True)
    return d.select("episode", "geometry_status", "geometry_unavailable", "geometry_fail")


@query(f"""with {EMN}, w as (select episode, min(len(v)) as lo, max(len(v)) as hi from (select episode, case when seq = a and episode % 2 = 0 then state[1:19] else state end as v from es) group by 1)
select episode, case when lo <> hi or lo < 20 then 'unavailable' else 'ok' end as core_status from w""".replace("seq = a and", "seq = s1 and").replace("from es)", "from (select *, least(greatest(1, cast(floor(n * 0.35) as bigint)), n - 2) as s1 from en))"))
def core_statuses(spark, sf):
    """Every second episode loses the last element of one state."""
    e = T.embeddings(spark, sf)
    even, odd = e.where("episode % 2 = 0"), e.where("episode % 2 <> 0")
    return geometry.core_statuses(injection.drop_last_element(even, ["episode"], "state").unionByName(odd))


@query("""select * from (values ('ok', 'ok', 'ok', 'ok', 'ok'), ('ok', 'ok', 'ok', 'unavailable', 'warning'), ('ok', 'warning', 'ok', 'ok', 'warning'), ('ok', 'ok', 'fail', 'ok', 'fail'), ('unavailable', 'ok', 'ok', 'ok', 'unavailable')) t(core, bimanual, "left", "right", status)""")
def status_truth_table(spark, sf):
    """the five cases of a core and its modules."""
    rows = [("ok", "ok", "ok", "ok"), ("ok", "ok", "ok", "unavailable"), ("ok", "warning", "ok", "ok"), ("ok", "ok", "fail", "ok"), ("unavailable", "ok", "ok", "ok")]
    d = spark.createDataFrame(rows, "core string, bimanual string, left string, right string")
    return d.withColumn("status", S.aggregate_status(F.array("core"), geometry.module_statuses(F.col("core"), F.col("bimanual"), F.col("left"), F.col("right"))))
