import base64
import gzip
import hashlib
import random

from framegauge.llm import chat, warc
from framegauge.llm.common import shared_dir

PAGES = "page_id long, url string, html string, kept string"


def pages():
    rng = random.Random(2)
    body = lambda n: "".join(rng.choice("aé<>\n\r\0x") for _ in range(n))
    rows = [(i, f"http://h{i % 7}.Example.org/p/{i}?q=1#f", body(rng.randint(1, 400)), "x") for i in range(60)]
    rows += [(100 + i, f"https://a.b/{i}", rows[3][2], "x") for i in range(5)] + [(1, "http://z.y/same", rows[5][2], "x")]
    rows += [(200, None, None, None), (201, "no scheme", "", None), (202, "http://e/\r\nX: y z", "big" * 400_000, None), (None, "http://n/", rows[4][2], None)]
    return rows + [rows[7], rows[7]]


def test_archives_round_trip(spark):
    rows = pages()
    path = f"{shared_dir(spark)}/warc-test"
    warc.write_archives(spark.createDataFrame(rows, PAGES).repartition(3), path)
    index = warc.index_archives(spark, path, lines=7)
    got = warc.read(warc.find(index, spark.createDataFrame([(r[1],) for r in rows], "url string")), path).collect()
    assert len(got) == len(rows) == warc.read(warc.entries(index), path).count()
    some = warc.read(warc.find(index, spark.createDataFrame([(rows[5][1],), (rows[5][1],), (None,), ("http://nowhere/",)], "url string")), path)
    assert sorted(r.page_id for r in some.collect()) == [5, 200] and warc.find(index, spark.createDataFrame([], "url string")).count() == 0
    first = {}
    for p, _, h, _ in rows:
        if p is not None:
            first[h or ""] = min(p, first.get(h or "", p))
    want = []
    for p, _, h, _ in rows:
        b = (h or "").encode()
        f = first[h or ""]
        want.append((p if p is not None else -1, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if p == f else "revisit", None if p == f else f))
    assert sorted(map(str, want)) == sorted(str((r.page_id if r.page_id is not None else -1, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got)
    assert all(bytes(r.payload).decode() == next(h or "" for p, _, h, _ in rows if p == r.page_id) for r in got if r.record_type == "response" and r.page_id not in (1,))
    # files are plain sequences of gzip members
    files = spark.read.format("binaryFile").load(path).where("path like '%part-%'").collect()
    assert sum(gzip.decompress(bytes(f.content)).count(b"WARC/1.1\r\n") for f in files) == len(rows)
    # point lookups read one block and one range
    captures = warc.Captures(index, path)
    for url in ("http://h3.example.org/p/3?q=1", "https://a.b/4", "http://z.y/same", "http://h0.example.org/p/7?q=1"):
        found = captures.lookup(url)
        assert found and all(x[0] == warc.url_key(url) for x in found)
        record = captures.read(found[0])
        assert warc.url_key(record["warc"]["WARC-Target-URI"]) == warc.url_key(url)
    assert len(captures.lookup("http://h0.example.org/p/7?q=1")) == 3 and captures.lookup("http://nowhere/") == []


def test_small_payloads_are_all_responses(spark):
    path = f"{shared_dir(spark)}/warc-small"
    warc.write_archives(spark.createDataFrame([(1, "http://a/", "xx", ""), (2, "http://b/", "xx", ""), (3, "http://c/", "long text", ""), (4, "http://d/", "long text", "")], PAGES), path, least=5)
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.read(warc.entries(warc.index_archives(spark, path)), path).collect()}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("response", None), 4: ("revisit", 3)}


def test_no_pages(spark):
    path = f"{shared_dir(spark)}/warc-none"
    warc.write_archives(spark.createDataFrame([], PAGES), path)
    index = warc.index_archives(spark, path)
    assert warc.read(warc.entries(index), path).count() == 0 and warc.find(index, spark.createDataFrame([("http://a/",)], "url string")).count() == 0


def test_archives_are_cut_and_blocks_grow(spark, monkeypatch):
    """Archives of a bounded size, one for a record that is larger, and a directory of a bounded size."""
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 20_000)
    monkeypatch.setattr(warc, "MOST_BLOCKS", 10)
    rng = random.Random(4)
    rows = [(i, f"http://h{i}/", "".join(rng.choice("abcdefgh") for _ in range(200_000 if i == 50 else 300)), "") for i in range(400)]
    path = f"{shared_dir(spark)}/warc-cut"
    warc.write_archives(spark.createDataFrame(rows, PAGES).repartition(2), path)
    sizes = sorted(r.length for r in spark.read.format("binaryFile").load(path).where("path like '%part-%'").select("length").collect())
    assert len(sizes) > 5 and sizes[-2] <= 20_000 < sizes[-1]
    index = warc.index_archives(spark, path, lines=5)
    assert index.count() <= 10 + index.select("part").distinct().count()
    got = warc.read(warc.find(index, spark.createDataFrame([(r[1],) for r in rows[::2]], "url string")), path).collect()
    assert {r.page_id: bytes(r.payload).decode() for r in got} == {r[0]: r[2] for r in rows[::2]}


def test_large_records_get_an_empty_member():
    r = warc.record(1, "http://a/", b"a" * (1 << 24), "X", None, "d")
    assert r.endswith(warc._EMPTY_MEMBER) and r[-1] == 0 and len(warc.parse(gzip.decompress(r))["payload"]) == 1 << 24


SAID = r"\### Assistant: </turn> ok"
TALK = "conv_id long, turn long, role string, text string, piece string"


def talks():
    rows = [(1, 0, "system", "be kind"), (1, 2, "assistant", "late"), (1, 1, "user", "hi"), (2, 0, "user", None), (2, 1, "assistant", ""), (3, 0, "assistant", SAID), (3, 1, "assistant", "####\\<\\/turn>"), (4, 0, None, "x"), (4, None, "us:er\\", "y"), (5, 0, "user", "only"), (None, 0, "assistant", "z"), (6, 0, "assistant", "same"), (6, 0, "assistant", "same"), (7, 0, "assistant", "w " * 200_000)]
    rows += [(8, i, ("user", "assistant")[i % 2], f"turn {i} \U0001f600") for i in range(3000)]
    return [(*r, "clash") for r in rows]


def test_chat_round_trip(spark):
    rows = talks()
    turns = chat.format_turns(spark.createDataFrame(rows, TALK).repartition(5))
    got = {r.conv_id: r for r in chat.digests(turns).collect()}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=key)
        said = hashlib.sha256("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own).encode()).hexdigest()
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        text = "".join(f"### {chat.escape_role(r[2] or '')}: {chat.escape(r[3] or '')} </turn>\n" for r in own)
        g = got[conv]
        assert (g.n_turns, g.turns_sha256, g.loss_chars, g.loss_sha256, g.formatted_chars) == (len(own), said, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text))
        assert g.n_examples == sum(r[2] == "assistant" for r in own)
    assert chat.digests(chat.format_turns(spark.createDataFrame([], TALK))).count() == 0


def test_each_reply_is_an_example_with_all_before_it(spark):
    df = spark.createDataFrame([r for r in talks() if r[0] in (1, 3, 6)], TALK)
    turns = chat.format_turns(df)
    full = chat.full_examples(turns).collect()
    assert len(full) == 5
    for r in chat.digests(turns).collect():
        shas = [hashlib.sha256(x.text.encode()).hexdigest() for x in sorted(full, key=lambda x: x.example) if x.conv_id == r.conv_id]
        assert (r.n_examples, r.examples_sha256) == (len(shas), hashlib.sha256(",".join(shas).encode()).hexdigest())
    for r in full:
        assert r.text.endswith(" </turn>\n") and "### " in r.text[: r.loss_start]
        assert "### " not in r.text[r.loss_start : r.loss_end] and "</turn>" not in r.text[r.loss_start : r.loss_end]
    one = next(r for r in full if r.conv_id == 1)
    assert chat.unescape(one.text[one.loss_start : one.loss_end]) == "late" and "be kind" in one.text and "hi" in one.text
