"""Queries of sources, sinks, gates and small functions: what is written is read back and compared with its table."""

from __future__ import annotations

import io
import uuid
import zipfile

from pyspark.sql import functions as F

from framegauge.functions import scalars as S
from framegauge.functions.storage import shared_dir, write_file, written
from framegauge.operators import detectors as D
from framegauge.operators import scoring, signals
from framegauge.operators.findings import counts_by, merged, of_types, report_order, union_findings, with_ids
from framegauge.operators.islands import islands
from framegauge.operators.statistics import FIELDS, robust_stats, scoped_stats, with_baseline
from framegauge.plans import gates
from framegauge.plans.catalog import CX, DE, EV, FJ, KEYS, LI, PH, REF, RO, SC, TG, DV, NO, EXPECTED, _arms, _deltas, _episode_findings, _fast_jumps, _phased, _scores, islands_sql, query, r6, rounded, score_sql, stats_sql
from framegauge.plans.pipeline import arm_values
from framegauge.sources import episodes as E
from framegauge.sources import sinks
from framegauge.sources import tables as T

EVENT_ROWS = "value double, timestamp double, event_type string, frame_index long, episode_index long, task_index long"


def _fresh(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _schema(text: str):
    from pyspark.sql.types import _parse_datatype_string

    return _parse_datatype_string(text)


def _event_dataset(spark, sf) -> str:
    """The events as a dataset of episodes, with hidden and left-over copies that a reader must not see."""
    root = _fresh(spark, "dataset")
    e = T.events(spark, sf)
    rows = e.select("episode", "seq", "value", "timestamp", "event_type", F.col("frame").alias("frame_index"), F.col("episode").alias("episode_index"), (F.col("episode") % 4).alias("task_index"))
    sinks.write_episodes(rows, root, {"fps": 10, "features": {"value": {"dtype": "float64", "shape": [1]}}}, ["a", "b", "c", "d"])
    for name in ("data/episode=0/._part-0.parquet", "__MACOSX/episode_000001.parquet", "outputs/episode_000002.parquet"):
        write_file(spark, f"{root}/{name}", b"not a table")
    return root


# ---- datasets --------------------------------------------------------------------------------------------------------


@query(f"with {EV} select episode, episode % 4 as task, count(*) as n_rows, count(*) as declared, min(frame) as first_frame, max(seq) as last_seq, round(sum(value), 4) as total from ev group by episode")
def dataset_round_trip(spark, sf):
    """Written as episodes, found by the metadata, read with some of the columns."""
    root = _event_dataset(spark, sf)
    d = E.load_dataset(spark, root, _schema(EVENT_ROWS))
    assert d.tasks.count() == 4 and E.find_meta_root(spark, root).endswith("/meta")
    rows = E.read_frames(spark, root, _schema(EVENT_ROWS), ["value", "frame_index", "nothing"])
    g = rows.groupBy("episode", "task").agg(F.count("*").alias("n_rows"), F.min("frame").alias("first_frame"), F.max("seq").alias("last_seq"), F.round(F.sum("value"), 4).alias("total"))
    return E.with_metadata(g, d.episodes).select("episode", "task", "n_rows", F.col("length").alias("declared"), "first_frame", "last_seq", "total")


@query("select count(distinct user_id) as files, true as sized, 2.0::double as disk_gib, 2.0::double as memory_gib from events")
def dataset_preflight(spark, sf):
    """Files without reading a row, and what a run should have."""
    d = gates.preflight(E.summary(E.list_files(spark, _event_dataset(spark, sf))))
    return d.select("files", ((F.col("bytes") >= F.col("largest")) & (S.gib("bytes") < 2)).alias("sized"), "disk_gib", "memory_gib")


@query("select 900000 + n_nationkey as episode, 'parquet_read_error' as issue_type, 'state_illegal' as family, true as illegal from nation")
def unreadable_episodes(spark, sf):
    """A file for each nation that is no table, among the events' episodes."""
    root = _event_dataset(spark, sf)
    for r in T.table(spark, sf, "nation").collect():
        write_file(spark, f"{root}/data/episode_{900000 + r.n_nationkey}.parquet", b"not a table")
    d = E.load_dataset(spark, root, _schema(EVENT_ROWS))
    return D.unreadable_files(E.unread_files(d.files, d.frames)).select("episode", "issue_type", "family", "illegal")


@query(f"with {EV}, n as (select episode, count(*) as n from ev group by 1 having count(*) >= 70) select episode, n as rows from n order by cast(episode as varchar) limit 1")
def source_episode(spark, sf):
    """The first file with seventy rows or more."""
    return E.first_with_rows(E.read_frames(spark, _event_dataset(spark, sf), _schema(EVENT_ROWS)), 70).select("episode", "rows")


@query('select column_name as "column" from (describe events)')
def footer_columns(spark, sf):
    """S5."""
    return spark.createDataFrame([(c,) for c in E.column_names(spark, f"{sf}/events.parquet")], "column string")


@query("select column_name as \"column\", case when column_name = 'props' then 'unexpected' else 'as declared' end as state from (describe events)")
def unexpected_columns(spark, sf):
    """A schema that doesn't know props."""
    present = T.table(spark, sf, "events").columns
    odd = D.unexpected_columns(present, [c for c in EXPECTED if c != "props"])
    return spark.createDataFrame([(c, "unexpected" if c in odd else "as declared") for c in present], "column string, state string")


@query("select page_id, 'run ' || (page_id % 3) || '/' || page_id || '.parquet' as portable, coalesce(page_id % 5 not in (0, 1), false) as real from pages")
def portable_paths(spark, sf):
    """Paths under a root, and which of them are no leftovers."""
    p = T.table(spark, sf, "pages").withColumn("path", F.concat(F.lit("s3://bucket/data.v2/run "), (F.col("page_id") % 3).cast("string"), F.lit("/"), F.col("page_id").cast("string"), F.lit(".parquet")))
    odd = F.when(F.col("page_id") % 5 == 0, F.concat(F.lit("s3://bucket/__MACOSX/"), "page_id")).when(F.col("page_id") % 5 == 1, F.concat(F.lit("s3://bucket/._"), "page_id")).otherwise(F.col("path"))
    return p.select("page_id", E.relative_path(F.col("path"), "s3://bucket/data.v2").alias("portable"), E.real_path(odd).alias("real"))


# ---- sinks -----------------------------------------------------------------------------------------------------------


@query("select s_suppkey, s_name, '[' || s_suppkey || ',' || s_nationkey || ']' as keys, s_acctbal from supplier")
def csv_round_trip(spark, sf):
    """Nested columns as JSON."""
    path = _fresh(spark, "csv")
    sinks.write_csv(T.table(spark, sf, "supplier").select("s_suppkey", "s_name", F.array("s_suppkey", F.col("s_nationkey").cast("long")).alias("keys"), "s_acctbal"), path)
    return spark.read.option("header", True).schema("s_suppkey long, s_name string, keys string, s_acctbal double").csv(path)


@query("select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders")
def json_round_trip(spark, sf):
    """S14, S4."""
    path = _fresh(spark, "json")
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    sinks.write_json(T.table(spark, sf, "orders").select(*cols), path)
    return E.read_jsonl(spark, path, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double")


@query("select o_orderstatus, count(*) as n, round(sum(o_totalprice), 2) as total from orders group by 1")
def parquet_round_trip(spark, sf):
    """A folder per status."""
    path = _fresh(spark, "table")
    sinks.write_parquet(T.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), path, ["o_orderstatus"])
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("select unnest(['# Regions', '', '- nations: ' || (select count(*) from nation), '', '## region', '', '| r_regionkey | r_name |', '|---|---|']) as line union all select '| ' || r_regionkey || ' | ' || r_name || ' |' from region")
def markdown_report(spark, sf):
    """Facts and a table as Markdown, line by line."""
    path = _fresh(spark, "report")
    facts = {"nations": T.table(spark, sf, "nation").count()}
    sinks.write_text(spark, sinks.markdown("Regions", facts, {"region": T.table(spark, sf, "region").select("r_regionkey", "r_name").orderBy("r_regionkey")}).rstrip("\n"), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("select n_nationkey, 's3://out/' || regexp_replace(n_name || ' #' || n_nationkey, '[^A-Za-z0-9_.-]', '_', 'g') as folder from nation")
def run_folders(spark, sf):
    """A folder of its own for each run."""
    return spark.createDataFrame([(r.n_nationkey, sinks.run_root("s3://out/", f"{r.n_name} #{r.n_nationkey}")) for r in T.table(spark, sf, "nation").collect()], "n_nationkey int, folder string")


def _reports(spark, sf) -> str:
    """A small file for each nation, and a table that a package leaves out."""
    root = _fresh(spark, "reports")
    for r in T.table(spark, sf, "nation").collect():
        write_file(spark, f"{root}/notes/{r.n_nationkey}.md", f"{r.n_name}\nregion {r.n_regionkey}\n".encode())
    write_file(spark, f"{root}/notes/left-out.parquet", b"x")
    return root


NOTES = "nt as (select 'notes/' || n_nationkey || '.md' as name, n_name || chr(10) || 'region ' || n_regionkey || chr(10) as text from nation)"


@query(f"with {NOTES} select name, octet_length(encode(text)) as bytes, sha256(text) as sha256 from nt")
def file_checksums(spark, sf):
    """S22, F31."""
    root = _reports(spark, sf)
    c = sinks.checksums(spark, root).where("path not like '%.parquet'")
    return c.select(E.relative_path(F.col("path"), root).alias("name"), "bytes", "sha256")


@query(f"with {NOTES} select name, text, sha256(text) as sha256 from nt")
def package_contents(spark, sf):
    """What the package holds, and what its manifest says about it."""
    with zipfile.ZipFile(io.BytesIO(sinks.package(spark, _reports(spark, sf)))) as z:
        manifest = {name: sha for sha, name in (line.split("  ", 1) for line in z.read("SHA256SUMS").decode().splitlines())}
        rows = [(n, z.read(n).decode(), manifest.get(n)) for n in z.namelist() if n != "SHA256SUMS"]
    return spark.createDataFrame(rows, "name string, text string, sha256 string")


def _slides(texts: list[str]) -> bytes:
    """A presentation with a slide for each text."""
    out, space = io.BytesIO(), "http://schemas.openxmlformats.org/drawingml/2006/main"
    with zipfile.ZipFile(out, "w") as z:
        for i, t in enumerate(texts, 1):
            z.writestr(f"ppt/slides/slide{i}.xml", f'<x xmlns:a="{space}"><a:t>{t}</a:t></x>')
    return out.getvalue()


@query("select r_name, string_agg(n_name, chr(10) order by n_nationkey) as text, concat_ws(', ', case when bool_or(n_name like '%NATION_3%') then 'has NATION_3' end, case when not bool_or(n_name like '%NATION_7%') then 'lacks NATION_7' end) as problems from region join nation on n_regionkey = r_regionkey group by 1")
def slide_texts(spark, sf):
    """A presentation per region, its text, and what it must and must not say."""
    names: dict[str, list[str]] = {}
    for r in T.table(spark, sf, "nation").join(T.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).orderBy("n_nationkey").collect():
        names.setdefault(r.r_name, []).append(r.n_name)
    rows = [(k, text, ", ".join(gates.text_problems(text, ["NATION_3"], ["NATION_7"]))) for k, v in names.items() for text in [sinks.slide_text(_slides(v))]]
    return spark.createDataFrame(rows, "r_name string, text string, problems string")


# ---- gates -----------------------------------------------------------------------------------------------------------


@query("select n_nationkey || '.md' as name from nation where n_nationkey % 5 = 0")
def readiness_files(spark, sf):
    """Every fifth report is not there."""
    root, n = _fresh(spark, "ready"), T.table(spark, sf, "nation")
    for r in n.where("n_nationkey % 5 <> 0").collect():
        write_file(spark, f"{root}/deep/{r.n_nationkey}.md", b"x")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return gates.missing_files(files, n.select(F.concat(F.col("n_nationkey").cast("string"), F.lit(".md")).alias("name")))


@query(f"with {SC}, fs as (select episode from fp union all select episode from tg union all select episode from cx) select (select round(avg(official_score), 2) from official) as score, (select count(*) from official) as episodes, count(*) as findings, count(distinct episode) as abnormal_episodes from fs")
def metrics_export(spark, sf):
    """I23, A30."""
    f = written(_episode_findings(spark, sf), "findings")
    return gates.metrics(f, _scores(spark, sf))


@query(f"with {FJ}, {TG}, {CX} select episode, count(*) as findings from (select episode from fp union all select episode from tg union all select episode from cx) group by 1")
def abnormal_episodes(spark, sf):
    """A30, U3."""
    return gates.abnormal_episodes(_episode_findings(spark, sf))


@query(f"with {EV} select episode, case when count(*) < 65 then 'failed' else 'ok' end as status, case when count(*) < 65 then 'ValueError: ' || count(*) || ' rows' end as error from ev group by 1")
def isolated_cases(spark, sf):
    """An episode that is too short fails, the others don't."""

    def work(rows):
        if len(rows) < 65:
            raise ValueError(f"{len(rows)} rows")

    return gates.isolated(T.events(spark, sf).select("episode", "seq"), "episode", work)


@query("with r as (select case when o_orderstatus = 'F' then 'ok' else 'failed' end as status, o_totalprice / 1e6 as seconds from orders) select count(*) as cases, count(*) filter (status = 'ok') as success, count(*) filter (status <> 'ok') as failed, round(sum(seconds), 6) as total_seconds, round(avg(seconds), 6) as mean_seconds, round(count(*) / sum(seconds), 6) as throughput from r")
def benchmark_totals(spark, sf):
    """The orders as runs, their price in millions as seconds."""
    r = T.table(spark, sf, "orders").select(F.when(F.col("o_orderstatus") == "F", "ok").otherwise("failed").alias("status"), (F.col("o_totalprice") / 1e6).alias("seconds"))
    return scoring.benchmark_summary(r).select("cases", "success", "failed", r6("total_seconds"), r6("mean_seconds"), r6("throughput"))


@query(f"with {SC}, {EV.replace('ev as', 'e2 as')}, q as (select episode, 100.0 - count(*) filter (event_type = 'error') as score, count(*) filter (event_type = 'click') as n from e2 group by 1) select count(*) as cases, ((cast(sum(cast(score - official_score as decimal(18, 2))) * 100 as bigint) * 20 + count(*)) // (2 * count(*))) / 1000.0 as mean_gain, round(avg(n - findings), 3) as mean_findings_delta from q join official using (episode)")
def repair_gain(spark, sf):
    """The events' scores before, and a score of 100 less the errors after."""
    after = T.events(spark, sf).groupBy("episode").agg((100.0 - F.count(F.when(F.col("event_type") == "error", 1))).alias("official_score"), F.count(F.when(F.col("event_type") == "click", 1)).alias("findings"))
    return scoring.repair_summary(_scores(spark, sf), after)


@query("select * from (values ('nation', true, true), ('region', false, true), ('supplier', true, false)) t(name, same, shuffled)")
def equal_tables(spark, sf):
    """As multisets: shuffled, with a row less, with a row twice."""
    n, r, s = (T.table(spark, sf, x) for x in ("nation", "region", "supplier"))
    rows = [("nation", gates.same_rows(n, n.repartition(3)), True), ("region", gates.same_rows(r, r.where("r_regionkey > 0")), True), ("supplier", gates.same_rows(s, s.repartition(2)), gates.same_rows(s, s.union(s.limit(1))))]
    return spark.createDataFrame(rows, "name string, same boolean, shuffled boolean")


# ---- findings and rows -----------------------------------------------------------------------------------------------


@query(f"""with {FJ}, {CX}, al as (select episode, '1.2.2.B' as category_id, frame_start from fp union all select episode, '1.1.2.C', x from (select episode, x from ({islands_sql("cb", "episode", "seq", 1, "arg_min(fb, seq) as x")}) where n >= 2))
select episode, category_id, frame_start, row_number() over (partition by episode order by category_id, case when coalesce(frame_start, 0) = 0 then -1 else frame_start end) as nth from al""")
def ordered_findings(spark, sf):
    """K1: each episode's findings in the order of a report."""
    from pyspark.sql import Window

    f = with_ids(of_types(_episode_findings(spark, sf), "low_dim_fast_jump", "geometry_wrist_state_moves_visual_static"))
    nth = F.row_number().over(Window.partitionBy("episode").orderBy(*report_order()[1:]))
    return f.select("episode", "category_id", "frame_start", nth.alias("nth"))


@query(f"with {EV}, {TG} select episode, count(*) as n from tg group by 1")
def findings_of_type(spark, sf):
    """P13."""
    return counts_by(of_types(_episode_findings(spark, sf), "timestamp_gap_or_reorder"), "episode")


@query(f"with {FJ}, {TG}, {CX} select count(*) as n, count(*) as ids, count(*) as prefixed from (select episode from fp union all select episode from tg union all select episode from cx)")
def finding_ids(spark, sf):
    """As many ids as findings."""
    f = with_ids(_episode_findings(spark, sf))
    return f.agg(F.count("*").alias("n"), F.count_distinct("finding_id").alias("ids"), F.count(F.when(F.col("finding_id").rlike("^V2F-[0-9a-f]{12}$"), 1)).alias("prefixed"))


@query(f"""with {EV}, b as (select episode, seq from ev where event_type = 'error') select episode, "start" as frame_start, "end" as frame_end, n from ({islands_sql("b", "episode", "seq", 1)})""")
def non_finite_index(spark, sf):
    """Errors lose their timestamp to a null, a NaN or an infinity."""
    e = T.events(spark, sf).withColumn("frame", F.col("seq"))
    bad = F.when(F.col("seq") % 3 == 0, F.lit(None).cast("double")).when(F.col("seq") % 3 == 1, F.lit(float("nan"))).otherwise(F.lit(float("-inf")))
    f = D.non_finite(e.withColumn("timestamp", F.when(F.col("event_type") == "error", bad).otherwise(F.col("timestamp"))), "timestamp")
    return f.select("episode", "frame_start", "frame_end", (F.col("frame_end") - F.col("frame_start") + 1).alias("n"))


@query(f"""with {LI} select episode, "start", "end" from ({islands_sql("(select distinct episode, frame * 2 - (frame % 2) as i from li)", "episode", "i", 1)})""")
def distinct_places(spark, sf):
    """U4: repeated indices are one place; pairs of line numbers stand together."""
    d = T.lineitem(spark, sf).withColumn("i", F.col("frame") * 2 - F.col("frame") % 2)
    return islands(d.union(d), ["episode"], "i").select("episode", "start", "end")


@query(f"with {DE} select episode, frame, round(delta, 6) as delta, round(accel, 6) as accel from de")
def scalar_motion(spark, sf):
    """W3."""
    return _deltas(spark, sf).select("episode", "frame", r6("delta"), r6("accel"))


@query(f"with {EV}, g as (select episode, count(distinct event_type) as n from ev group by 1), t as (select episode, count(distinct case when event_type = 'error' then null else event_type end) + max(case when event_type = 'error' then 1 else 0 end) as n from ev group by 1) select g.episode, g.n as plain, t.n as with_null from g join t using (episode)")
def distinct_values(spark, sf):
    """Null counts as a value."""
    from framegauge.operators.statistics import distinct_with_null

    e = T.events(spark, sf).withColumn("odd", F.when(F.col("event_type") != "error", F.col("event_type")))
    return e.groupBy("episode").agg(distinct_with_null("event_type").alias("plain"), distinct_with_null("odd").alias("with_null"))


@query(f"with {EV}, i as (select *, case when episode % 3 = 0 and seq = 1 then episode + 1 else episode end as episode_index from ev) select episode, 'episode_index_inconsistent' as issue_type from i group by 1 having count(distinct episode_index) > 1")
def episode_inconsistent(spark, sf):
    """Every third episode has a row of another."""
    e = T.events(spark, sf).withColumn("episode_index", F.when((F.col("episode") % 3 == 0) & (F.col("seq") == 1), F.col("episode") + 1).otherwise(F.col("episode")))
    return D.inconsistent(e, "episode_index", "episode_index_inconsistent").select("episode", "issue_type")


PS = f"ps as ({stats_sql('ph', 'delta', 'phase')})"


@query(f"""with {PH}, {PS}, h as (select ph.*, p95, ps.median as md, ps.mad as ma, ps.std as sd from ph join ps using (phase) where phase <> 'unknown' and delta >= p95)
select episode, 'low_dim_fast_jump_' || phase as issue_type, a as frame_start, b as frame_end from ({islands_sql("h", "episode, phase", "seq", 1, "arg_min(frame_before, seq) as a, arg_max(frame, seq) as b")})""")
def phased_fast_jumps(spark, sf):
    """Jumps over the 95 % quantile of their phase."""
    d = _phased(spark, sf)
    d = with_baseline(d.where("phase <> 'unknown'").drop("s"), scoped_stats(d, ["phase"], "task", "delta"), ["phase"], "task")
    return D.fast_jumps(d, "delta", "s", ["phase"], threshold=F.col("s.p95")).select("episode", "issue_type", "frame_start", "frame_end")


@query(f"""with {PH}, {PS}, h as (select ph.* from ph join ps using (phase) where phase <> 'unknown' and delta <= ps.p25)
select episode, 'low_dim_freeze_run_' || phase as issue_type, a as frame_start, b as frame_end from ({islands_sql("h", "episode, phase", "seq", 1, "arg_min(frame_before, seq) as a, arg_max(frame, seq) as b")}) where n >= 2""")
def phased_freezes(spark, sf):
    """Two transitions or more under the 25 % quantile of their phase."""
    d = _phased(spark, sf)
    d = with_baseline(d.where("phase <> 'unknown'").drop("s"), scoped_stats(d, ["phase"], "task", "delta"), ["phase"], "task")
    return D.freeze_runs(d, "delta", F.col("s.p25"), ["phase"], min_run=2, min_severity=0.0).select("episode", "issue_type", "frame_start", "frame_end")


# ---- arms ------------------------------------------------------------------------------------------------------------


@query(f"""with {RO}, mo as (select episode, arm, seq, pos, lag(pos) over w as p1, lag(pos, 2) over w as p2 from ar window w as (partition by episode, arm order by seq)),
v as (select episode, arm, 'position_step' as metric, {NO(DV('pos', 'p1'))} as value from mo where p1 is not null union all select episode, arm, 'linear_speed', 10 * {NO(DV('pos', 'p1'))} from mo where p1 is not null union all select episode, arm, 'linear_accel', 100 * {NO(DV(DV('pos', 'p1'), DV('p1', 'p2')))} from mo where p2 is not null
 union all select episode, arm, 'rot6d_n1', n1 from pc union all select episode, arm, 'rot6d_n2', n2 from pc union all select episode, arm, 'rot6d_sin_angle', sin_angle from pc)
select arm, metric, {rounded(FIELDS)} from ({stats_sql("v", "value", "arm, metric")})""")
def arm_reference(spark, sf):
    """The reference's metrics of each arm; turns are in so3_angular_speed."""
    s = scoped_stats(arm_values(_arms(spark, sf)), ["arm", "metric"], "task", "value").where("scope = 'global' and metric <> 'angular_speed'")
    return s.select("arm", "metric", *(F.col(c) if c == "count" else r6(c) for c in FIELDS))


@query(f"""with {RO}, sp as (select episode, arm, seq, frame, lag(frame) over w as fb, 10 * {NO(DV('pos', 'lag(pos) over w'))} as speed from ar window w as (partition by episode, arm order by seq)), h as (select * from sp where fb is not null and speed > 5.0)
select episode, arm, a as frame_start, b as frame_end, round(greatest(60.0, least(100.0, 60 + 40 * (most / 5.0 - 1))), 2) as severity from ({islands_sql("h", "episode, arm", "seq", 1, "arg_min(fb, seq) as a, arg_max(frame, seq) as b, max(speed) as most")})""")
def hardware_limit(spark, sf):
    """An arm faster than five."""
    f = D.hardware_limits(_arms(spark, sf), "speed", 5.0)
    return f.select("episode", F.regexp_extract("issue_type", "geometry_(left|right)_", 1).alias("arm"), "frame_start", "frame_end", "severity")


# ---- small functions -------------------------------------------------------------------------------------------------


@query(f"with {EV}, s as ({stats_sql('ev', 'value')}), z as (select frame, value, abs(value - median) / greatest(1.4826 * mad, std, 1e-9) as z from ev, s) select frame, round(100.0 * {score_sql('z', 1.0, 3.0)}, 6) as score, round(greatest(0.0, least(1.0, (value - 10) / 40.0)), 6) as clamped from z")
def z_scores(spark, sf):
    """F10, F29."""
    e = T.events(spark, sf)
    d = e.crossJoin(F.broadcast(robust_stats(e, [], "value").select(F.struct(*FIELDS).alias("s"))))
    return d.select("frame", r6(S.score_from_z(S.guarded_z("value", F.col("s")), 1.0, 3.0), "score"), r6(S.clamp01("value", 10, 50), "clamped"))


ST = "case event_type when 'view' then 'ok' when 'click' then 'warning' when 'error' then 'fail' when 'signup' then 'unavailable' else 'odd' end"


@query(f"with {EV}, p as (select episode, case event_type when 'view' then 0.0 when 'click' then 0.4 when 'signup' then 1.0 when 'error' then 1.5 else 0.0 end as p, case event_type when 'view' then 0.0 when 'click' then 1.0 when 'signup' then 2.0 when 'error' then 3.0 else 0.0 end as q from ev) select episode, cast(sum(p) as double) as modules, cast(sum(q) as double) as whole from p group by 1")
def status_penalties(spark, sf):
    """the penalties of modules and of the whole geometry."""
    d = T.events(spark, sf).withColumn("st", F.expr(ST))
    return d.groupBy("episode").agg(r6(F.sum(S.status_penalty("st")), "modules"), r6(F.sum(S.status_penalty("st", 3.0, 2.0, 1.0)), "whole"))


@query(f"with {EV}, g as (select episode, count(*) filter (event_type = 'error') as e, count(*) filter (value > 99) as v from ev group by 1) select episode, case when e > 10 then 'errors:' || e when v > 0 then 'minor_reference_penalties' else 'full_credit' end as reasons from g")
def reason_lists(spark, sf):
    """many errors are a reason; without reasons, whether there are soft penalties."""
    g = T.events(spark, sf).groupBy("episode").agg(F.count(F.when(F.col("event_type") == "error", 1)).alias("e"), F.count(F.when(F.col("value") > 99, 1)).alias("v"))
    some = F.when(F.col("e") > 10, F.array(F.concat(F.lit("errors:"), S.shortest(F.col("e").cast("double"))))).otherwise(F.array().cast("array<string>"))
    return g.select("episode", F.array_join(S.score_reasons(some, F.col("v")), ",").alias("reasons"))


@query("select page_id, concat_ws('|', 'global', case when page_id % 3 > 0 then cast(page_id % 3 as varchar) end, lower(url)) as key, case when regexp_matches(lower(url), 'timestamp|frame_index|index_gap|length') then 'time' when regexp_matches(lower(url), 'state|actions|finite|shape') then 'numeric' else 'other' end as grp from (select page_id, case page_id % 4 when 0 then 'timestamp_gap' when 1 then 'state_nan' when 2 then url else 'image_shape' end as url from pages)")
def composed_keys(spark, sf):
    """keys of parts, null ones left out; names routed by what they contain."""
    p = T.table(spark, sf, "pages")
    name = F.lower(F.when(F.col("page_id") % 4 == 0, "timestamp_gap").when(F.col("page_id") % 4 == 1, "state_nan").when(F.col("page_id") % 4 == 2, F.col("url")).otherwise("image_shape"))
    return p.select("page_id", S.bucket_key("global", F.when(F.col("page_id") % 3 > 0, F.col("page_id") % 3), name).alias("key"), S.issue_group(name).alias("grp"))
