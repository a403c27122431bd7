"""The queries of the corpus operators, one for each, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framegauge.llm import chat, decontaminate, lm_score, mixing, near_dedup, quality, secrets, sharding, url_filter, warc
from framegauge.llm.common import shared_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), n=2, percent=80)


def near_dedup_sql(n: int, table: str = "documents") -> str:
    """Components of n-word shingle sets by all pairs that share a shingle."""
    grams = " || ' ' || ".join(f"ws[i + {k}]" for k in range(n))
    return rf"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from {table}),
s as (select doc_id, list_distinct(case when len(ws) = 0 then [] when len(ws) < {n} then [array_to_string(ws, ' ')] else list_transform(range(1, len(ws) - {n - 2}), lambda i: {grams}) end) as sh from w),
n as (select doc_id, len(sh) as n from s),
t as (select doc_id, unnest(sh) as sh from s),
p as (select a.doc_id as a, b.doc_id as b, count(*) as k from t a join t b on a.sh = b.sh and a.doc_id < b.doc_id group by 1, 2),
e as (select a, b from p join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * k >= 80 * (na.n + nb.n - k)),
u as (select a, b from e union all select b, a from e),
r as (select doc_id as id, doc_id as c from {table} union select u.b, r.c from r join u on u.a = r.id)
select n.doc_id, cast(n.n as bigint) as n_shingles, m.c as component_id, n.doc_id = m.c as kept
from n join (select id, min(c) as c from r group by id) m on m.id = n.doc_id
"""


OP1_SQL = near_dedup_sql(2)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the archives and the index, then asks the index for the captures of every page's url and reads their ranges."""
    pages, path = _table(spark, sf_dir, "pages"), f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archives(pages, path)
    rows = warc.read(warc.find(warc.index_archives(spark, path), pages.select("url")), path)
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP2_SQL = """
with recursive d as (select page_id, encode(coalesce(html, '')) as b from pages),
f as (select page_id, octet_length(b) as n, sha1(b) as h, min(page_id) over (partition by sha1(b)) as first from d),
g as (select *, list_transform(range(0, 8), lambda k: cast(('0x' || substr(h, 5 * k + 1, 5)) as bigint)) as five from f),
c as (select *, list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast((five[k // 4 + 1] >> (15 - 5 * (k % 4))) & 31 as bigint) + 1, 1)) as letters from g)
select page_id, n as payload_bytes, array_to_string(letters, '') as payload_digest, case when page_id = first then 'response' else 'revisit' end as record_type, case when page_id = first then null else first end as refers_to from c
"""


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = secrets.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return df.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(secrets.joined(F.col("base_spans")), 256).alias("base_sha256"), secrets.joined(F.col("spans")).alias("spans"))


def _op3_sql() -> str:
    """One list of matches per kind with summed positions; windows counted from scratch."""
    quoted = lambda x: x.replace("'", "''")
    found = lambda kind, pattern, group, least: f"select doc_id, t, '{kind}' as kind, {secrets.KINDS.index(kind) if kind in secrets.KINDS else 9} as o, regexp_extract_all(t, '{quoted(pattern)}') as hits, regexp_extract_all(t, '{quoted(pattern)}', {group}) as counted, regexp_split_to_array(t, '{quoted(pattern)}') as gaps, {least} as least from d"
    kinds = [found(k, *secrets.BASE[k]) for k in secrets.BASE] + [found("candidate", secrets.CANDIDATE, 0, 0), found("piece", secrets.PIECE, 0, 0)]
    allow = " or ".join(f"regexp_matches(v, '{quoted(p)}')" for p in secrets.ALLOW)
    table = "[" + ", ".join(map(str, secrets.XLOGX)) + "]"
    hex_kind, b64_kind = secrets.CLASSES
    (hex_piece, (hex_pattern, *_)), (one_case, (one_pattern, *_)), (mixed, _) = secrets.PIECE_CLASSES.items()
    bits = {k: v[-1] for k, v in (secrets.CLASSES | secrets.PIECE_CLASSES).items()}
    limit = "case kind " + " ".join(f"when '{k}' then {secrets.most_repeated(b)}" for k, b in bits.items()) + " end"
    return f"""
with d as (select doc_id, coalesce(text, '') as t from documents),
m as ({" union all ".join(kinds)}),
p as (select doc_id, kind, o, least, counted, hits, gaps, unnest(range(1, len(hits) + 1)) as i from m),
s as (select doc_id, kind, o, hits[i] as v, length(counted[i]) >= least as good, coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) as a from p),
b as (select doc_id, kind, o, a, a + length(v) as e from s where kind not in ('candidate', 'piece') and good),
c as (select doc_id, a, v, case when regexp_matches(v, '^[0-9A-Fa-f]+$') then '{hex_kind}' else '{b64_kind}' end as kind from s where kind = 'candidate' and not ({allow})
 union all select doc_id, a, v, case when regexp_matches(v, '{hex_pattern}') then '{hex_piece}' when regexp_matches(v, '{one_pattern}') then '{one_case}' else '{mixed}' end from s where kind = 'piece' and (regexp_matches(v, '[0-9]') or regexp_matches(v, '{secrets._MIXED}')) and not regexp_matches(v, '{secrets.SAMPLE}')),
x as (select doc_id, a, kind, a + length(v) as e, w, unnest(string_split(substr(case when kind in ('{hex_kind}', '{hex_piece}', '{one_case}') then lower(v) else v end, w, {secrets.WINDOW}), '')) as ch from (select *, unnest(range(1, length(v) - {secrets.WINDOW - 2})) as w from c)),
y as (select doc_id, a, e, kind, w, count(*) as k from x group by doc_id, a, e, kind, w, ch),
z as (select doc_id, a, e, kind, sum({table}[k + 1]) as q from y group by doc_id, a, e, kind, w),
h as (select doc_id, kind, list_position({secrets.KINDS}, kind) - 1 as o, a, e from z group by doc_id, a, e, kind having min(q) <= {limit}),
j as (select doc_id, string_agg(kind || ':' || a || ':' || e, ',' order by a, o) as text, count(*) filter (kind = 'assign') as n1, count(*) filter (kind = 'access') as n2, count(*) filter (kind = 'hex') as n3 from b group by doc_id),
k as (select doc_id, string_agg(kind || ':' || a || ':' || e, ',' order by a, o) as text from (select * from b union all select * from h) group by doc_id)
select d.doc_id, coalesce(n1, 0) as n_assign, coalesce(n2, 0) as n_access, coalesce(n3, 0) as n_hex, sha256(coalesce(j.text, '')) as base_sha256, coalesce(k.text, '') as spans
from d left join j on j.doc_id = d.doc_id left join k on k.doc_id = d.doc_id
"""


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return chat.digests(chat.format_turns(rows.union(more)))


OP4_SQL = r"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e as (select *, replace(replace(replace(text, '\', '\\'), '###', '\#\#\#'), '</turn>', '<\/turn>') as body from c),
p as (select conv_id, list('### ' || role || ': ' || body || ' </turn>' || chr(10) order by turn, role, text) as pieces, list(role order by turn, role, text) as roles from e group by conv_id),
x as (select conv_id, list_transform(list_filter(range(1, len(roles) + 1), lambda i: roles[i] = 'assistant'), lambda i: sha256(array_to_string(pieces[1:i], ''))) as shas from p),
t as (select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
 cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars, sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
 cast(sum(length(role) + length(body) + 15) as bigint) as formatted_chars from e group by conv_id)
select t.*, len(shas) as n_examples, sha256(array_to_string(shas, ',')) as examples_sha256 from t join x on x.conv_id = t.conv_id
"""

URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list of keys stands for a public block list: the eighth of all host-and-path keys with the lowest MD5."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    host, path = url_filter.host_and_path(F.col("_url"))
    key = F.concat(host, path)
    universe = pages.withColumn("_url", F.col("url")).select(key.alias("key")).distinct().withColumn("listed", F.md5(F.col("key").cast("binary")) < "20")
    return url_filter.judge(pages, URL_RULES, url_filter.cascade(universe)).select("page_id", "host", "path", "rule", "verdict")


OP5_SQL = r"""
with p as (select page_id, case when position('://' in url) > 0 then substr(url, position('://' in url) + 3) end as rest from pages),
h as (select page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path from p),
r as (select *, case when (host = 'example.org' or ends_with(host, '.example.org')) and starts_with(path, '/en/1') then 'example.org/en/1'
 when (host = 'example.org' or ends_with(host, '.example.org')) and starts_with(path, '/es/') then 'example.org/es/'
 when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/fr/') then 'com/fr/'
 when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/de/') then 'com/de/'
 when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/') then 'org/' end as rule from h)
select page_id, host, path, rule, case when rule in ('org/', 'com/fr/') then 'allow' when rule is not null then 'block' when md5(host || path) < '20' then 'block' else 'allow' end as verdict from r
"""


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = quality.judge(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.array_join("failed_rules", ",").alias("failed_rules"))


_STOP = ", ".join(f"'{w}'" for w in [*quality.STOP_WORDS, *(w.capitalize() for w in quality.STOP_WORDS)])
OP6_SQL = rf"""
with d as (select doc_id, coalesce(text, '') as t from documents),
w as (select doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as ls from d),
g as (select doc_id, i, array_to_string(ws[i:i + 7], ' ') as gram from (select doc_id, ws, unnest(range(1, len(ws) - 6)) as i from w where len(ws) >= 8)),
c as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, gram) as k from g) where k > 1),
r as (select doc_id, sum(least(8, coalesce(nxt - i, 8))) as n from (select doc_id, i, lead(i) over (partition by doc_id order by i) as nxt from c) group by doc_id),
m as (select w.doc_id, cast(len(ws) as bigint) as n_words, cast(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) as bigint) as word_chars,
  cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols, cast(len(ls) as bigint) as n_lines, cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines,
  cast(coalesce(r.n, 0) as bigint) as n_repeat_words, len(list_distinct(list_transform(list_intersect(list_distinct(ws), [{_STOP}]), lambda x: lower(x)))) as n_stop_words
  from w left join r on r.doc_id = w.doc_id),
f as (select *, list_filter([{", ".join(f"case when {c} then null else '{n}' end" for n, c in quality.RULES)}], lambda x: x is not null) as failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, not (({quality.RULES[0][1]}) and ({quality.RULES[1][1]})) as base_failed, len(failed) = 0 as kept, array_to_string(failed, ',') as failed_rules from f
"""


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


_SHINGLES = r"""select {id} as id, unnest(list_distinct(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')] else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) end)) as sh
 from (select {id}, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from {table})"""
OP7_SQL = f"""
with d as ({_SHINGLES.format(id="doc_id", table="documents")}), b as ({_SHINGLES.format(id="item_id", table="benchmark")}),
s as (select id, list(sh order by sh) as sh from b group by id), c as (select min(id) as item, count(*) as n_items, len(any_value(sh)) as n from s group by sh),
p as (select d.id as doc_id, b.id as item_id, count(*) as k from d join b on d.sh = b.sh where b.id in (select item from c) group by 1, 2)
select doc_id, item_id, n_items, n as n_shingles, k as n_shared from p join c on c.item = p.item_id where 100 * k >= 80 * n
"""


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"), shards=8)


OP8_SQL = r"""
with recursive t0 as (select range as i, range as c, 0 as k from range(256) union all select i, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from t0 where k < 8),
tab as (select list(c order by i) as tab from t0 where k = 8),
d as (select doc_id, source, octet_length(encode(coalesce(text, ''))) + 1 as size, md5('1:' || coalesce(cast(doc_id as varchar), 'null')) as key, list_prepend(cast(4294967295 as bigint), list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: cast(('0x' || h) as bigint))) as bs from documents),
e as (select doc_id, source, size, key, xor(list_reduce(bs, lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295) as crc from d, tab),
r as (select *, coalesce('=' || source, '') as grp, (2 * (row_number() over (partition by source order by key, doc_id, crc) - 1) + 1)::double / (2 * count(*) over (partition by source)) as frac from e),
p as (select *, row_number() over (order by frac, grp, key, doc_id, crc) - 1 as pos, count(*) over () as n from r),
s as (select *, pos * 8 // n as shard from p)
select doc_id, source, size, crc as text_crc32, 'rows' as law, cast(shard as int) as shard, pos - (shard * n + 7) // 8 as slot, cast(null as int) as grown_shard from s
"""


def op10_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "source"))


OP10_SQL = r"""
with s as (select source, count(*) as n from documents group by source), g as (select sum(n) as rows, count(*) as k from s),
r as (select source, cast(rows as double) / (k * n) as rate from s, g),
c as (select source, rate, list_transform(range(0, cast(ceil(rate + 12 * sqrt(rate) + 25) as bigint) + 1), lambda k: list_sum(list_transform(range(0, k + 1), lambda j: exp(-rate + j * ln(rate) - lgamma(j + 1))))) as cdf from r),
u as (select doc_id, source, cast(('0x' || substr(md5('1:' || coalesce(cast(doc_id as varchar), 'null') || ':1'), 1, 13)) as bigint) / 4503599627370496.0::double as u from documents),
d as (select doc_id, u.source, rate, len(list_filter(cdf, lambda f: f <= u)) as copies from u join c on c.source is not distinct from u.source)
select doc_id, source, rate, copies, copy, md5('1:order:' || coalesce(cast(doc_id as varchar), 'null') || ':' || copy) as shuffle_key
from (select *, unnest(range(1, copies + 1)) as copy from d)
"""


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the documents labelled as of good quality; background: all documents. Losses to six decimals."""
    good = _table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    df = lm_score.score(_table(spark, sf_dir, "documents"), good)
    return df.select("doc_id", "n_tokens", *(F.round(c, 6).alias(c) for c in ("target_loss", "background_loss", "score")))


#: The unknown word is '', a text's beginning ' '.
OP9_SQL = rf"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws, doc_id in (select doc_id from labels where quality = 1) as good from documents),
t as (select doc_id, good, i, ws[i] as w from (select doc_id, good, ws, unnest(range(1, len(ws) + 1)) as i from d)),
v as (select w from t group by w having count(*) >= 2),
u as (select doc_id, good, i, coalesce(v.w, '') as w from t left join v on v.w = t.w),
p as (select doc_id, good, w, coalesce(lag(w) over (partition by doc_id order by i), ' ') as b from u),
n as (select w, count(*) as n, count(*) filter (good) as k from p group by w),
x as (select b, count(*) as n, count(*) filter (good) as k from p group by b),
q as (select b, w, count(*) as n, count(*) filter (good) as k from p group by b, w),
a as (select count(*) as n, count(*) filter (good) as k, (select count(*) from v) as size from p),
o as (select doc_id, good, b, w, case when good then count(*) over (partition by doc_id, w) else 0 end as ow, case when good then count(*) over (partition by doc_id, b) else 0 end as ob, case when good then count(*) over (partition by doc_id, b, w) else 0 end as op, case when good then count(*) over (partition by doc_id) else 0 end as oa from p),
l as (select doc_id, ln(x.k - ob + {lm_score.PRIOR}) - ln(q.k - op + {lm_score.PRIOR} * (n.k - ow + 1.0::double) / (a.k - oa + a.size + 1)) as lt, ln(x.n + {lm_score.PRIOR}) - ln(q.n + {lm_score.PRIOR} * (n.n + 1.0::double) / (a.n + a.size + 1)) as lb
 from o join n on n.w = o.w join x on x.b = o.b join q on q.b = o.b and q.w = o.w cross join a),
s as (select doc_id, avg(lt) as lt, avg(lb) as lb from l group by doc_id)
select d.doc_id, cast(len(ws) as bigint) as n_tokens, round(lt, 6) as target_loss, round(lb, 6) as background_loss, round(lt - lb, 6) as score from d left join s on s.doc_id = d.doc_id
"""


_QUERIES = (op1_minhash_near_dedup, op2_warc, op3_secret_scan, op4_chat_formatting, op5_url_filter, op6_quality_rules, op7_benchmark_decontamination, op8_sharding, op9_lm_scoring, op10_poisson_mixing)


def queries() -> dict:
    return {f.__name__: f for f in _QUERIES}


def pipeline_sql() -> str:
    """The stages of the corpus pipeline one after the other, each on what the one before it kept."""
    on = lambda sql, table: sql.replace("from documents", f"from {table}")
    return f"""
with s1 as materialized (select * from documents where doc_id in (select doc_id from ({OP6_SQL}) where kept)),
s2 as materialized (select * from s1 where doc_id in (select doc_id from ({near_dedup_sql(5, "s1")}) where kept)),
s3 as materialized (select * from s2 where doc_id not in (select doc_id from ({on(OP7_SQL, "s2")}))),
s4 as materialized (select s3.* from s3 join ({on(OP10_SQL, "s3")}) m on m.doc_id = s3.doc_id)
select * from ({on(OP8_SQL, "s4")})
"""


def oracle_sql() -> dict[str, str]:
    sql = (OP1_SQL, OP2_SQL, _op3_sql(), OP4_SQL, OP5_SQL, OP6_SQL, OP7_SQL, OP8_SQL, OP9_SQL, OP10_SQL)
    return {f.__name__: x for f, x in zip(_QUERIES, sql, strict=True)}
