"""WARC archives and their two-level capture index.

Archives: a gzip member per record, written by Spark's own text writer, so any store that Spark writes will do. A row
that is written is a whole archive of up to ``ARCHIVE_BYTES``. Its last byte is the highest byte of the last member's
length, zero for records under 16 MB; it is left off and comes back as the writer's line separator. Larger records get
an empty member behind them.

Index: every record's reversed-host URL key with file, offset and length, sorted by range partitions and packed into
compressed blocks; the directory holds only the first key of each block and stays under ``MOST_BLOCKS``, as blocks get
longer beyond it. A lookup searches the directory by halving, unpacks one block, searches in it by halving and reads
the record's range of the archive. ``Captures`` answers single questions, ``find`` and ``read`` whole tables of them."""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framegauge.llm.common import written

BLOCK_LINES = 3000
MOST_BLOCKS = 1_000_000
#: Packed records of an archive; a larger record is an archive of its own.
ARCHIVE_BYTES = 1 << 25
#: Up to so many ranges go to the archives by broadcast (about 24 MB); more are joined with them.
BROADCAST_RANGES = 1_000_000
_EMPTY_MEMBER = gzip.compress(b"", mtime=0)
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ENTRY = "key string, page_id long, file string, offset long, length long"


def url_key(url: str | None) -> str:
    """``https://m.example.org:80/a?b#c`` -> ``org,example,m:80)/a?b``; white space and control bytes are escaped."""
    if url is None:
        return "-"
    rest = url.partition("://")[2] if "://" in url else url
    rest = rest.partition("#")[0]
    host = re.match(r"[^/?]*", rest)[0]
    name, colon, port = host.lower().partition(":")
    key = ",".join(reversed(name.split("."))) + colon + port + ")" + (rest[len(host) :] or "/")
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", key)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC record as a gzip member; a record with ``refers_to`` is a revisit without payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_REVISIT}"]
    block = http + (payload if refers_to is None else b"")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    data = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    member = gzip.compress(data, 6, mtime=0)
    return member if len(data) < 1 << 24 else member + _EMPTY_MEMBER


def parse(data: bytes) -> dict:
    """Headers, HTTP headers and payload of one unpacked record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    out = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(out["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return {"warc": out, "http": dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), "payload": payload}


def _id(urn: str | None) -> int | None:
    return int(urn[10:-1]) if urn and urn != "<urn:page:>" else None


def _revisits(own: DataFrame, least: int) -> DataFrame:
    """``(_id, _sha, _first)`` of the payloads that are not the first of their digest: the smallest page_id with it."""
    ids = written(own.where(F.length("body") >= least).select("page_id", "sha").distinct(), "digests", per_core=8)
    first = ids.groupBy("sha").agg(F.min("page_id").alias("_first"), F.count("*").alias("n")).where("n > 1 and _first is not null")
    first = written(first.select(F.col("sha").alias("_sha"), "_first"), "repeated-digests", per_core=2)
    again = ids.join(first, F.col("sha") == F.col("_sha")).where("page_id is null or page_id > _first")
    return written(again.select(F.col("page_id").alias("_id"), "_sha", "_first"), "revisits", per_core=2)


def write_archives(pages: DataFrame, path: str, least: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """A record per row of ``pages`` (page_id, url, html), as gzip members in the files of ``path``.

    Of records with equal payloads of ``least`` bytes or more, the one with the smallest page_id is a response and the
    others revisit it; smaller ones are all responses. Null html is an empty payload; without a url the record has no
    target; a null page_id has an empty record id and never is what others refer to; repeated rows are records of their own,
    responses or revisits as the first of them. An empty table gives archives without records."""
    body = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    own = pages.select("page_id", "url", body.alias("body"), F.unhex(F.sha1(body)).alias("sha"))
    again = _revisits(own, least)
    rows = own.join(again, own["page_id"].eqNullSafe(again["_id"]) & (own["sha"] == again["_sha"]), "left").select("page_id", "url", "body", "sha", "_first")

    def run(batches):
        out, size = [], 0
        for batch in batches:
            for page, url, data, sha, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out.append(record(page, url, data, base64.b32encode(sha).decode(), first, date))
                size += len(out[-1])
                if size > ARCHIVE_BYTES and len(out) > 1:
                    yield _archive(out[:-1])
                    out, size = out[-1:], len(out[-1])
        if out:
            yield _archive(out)

    def _archive(members):
        return pa.RecordBatch.from_arrays([pa.array([b"".join(members)[:-1]], pa.binary())], ["archive"])

    rows.mapInArrow(run, "archive binary").select(F.col("archive").cast("string").alias("value")).write.option("lineSep", "\0").option("maxRecordsPerFile", 1).text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def index_archives(spark: SparkSession, path: str, lines: int = BLOCK_LINES) -> DataFrame:
    """The index as a written table ``(part, block, first_key, n, packed)``; a packed block holds sorted lines
    ``key page_id file offset length``, ``lines`` of them or as many more as keep the directory under ``MOST_BLOCKS``."""

    def scan(batches):
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data, at, rows = memoryview(content.as_buffer()), 0, []
                while at < len(data):
                    start = at
                    unpacked = b""
                    while at < len(data) and (at == start or not unpacked):
                        d = zlib.decompressobj(31)
                        unpacked += d.decompress(data[at : at + (1 << 20)])
                        at += min(1 << 20, len(data) - at)
                        while not d.eof:
                            unpacked += d.decompress(data[at : at + (1 << 20)])
                            at += min(1 << 20, len(data) - at)
                        at -= len(d.unused_data)
                    if data[at : at + len(_EMPTY_MEMBER)] == _EMPTY_MEMBER:
                        at += len(_EMPTY_MEMBER)
                    w = parse(unpacked)["warc"]
                    rows.append((url_key(w.get("WARC-Target-URI")), _id(w["WARC-Record-ID"]), file.rpartition("/")[2], start, at - start))
                for lo in range(0, len(rows), 10_000):
                    cols = list(zip(*rows[lo : lo + 10_000], strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k in (0, 2) else pa.int64()) for k, c in enumerate(cols)], [x.split()[0] for x in _ENTRY.split(", ")])

    by = ["key", "page_id", "file", "offset"]
    entries = written(_files(spark, path).mapInArrow(scan, _ENTRY), "captures", per_core=8)
    lines = max(lines, -(-entries.count() // MOST_BLOCKS))
    ordered = entries.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("part", F.spark_partition_id().cast("long"))

    def pack(batches):
        kept, part, block = [], None, 0
        for batch in batches:
            for *row, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                kept.append("\t".join("" if x is None else str(x) for x in row))
                if len(kept) >= lines:
                    yield _packed(part, block, kept)
                    kept, block = [], block + 1
        if kept:
            yield _packed(part, block, kept)

    def _packed(part, block, kept):
        return pa.RecordBatch.from_pylist([{"part": part, "block": block, "first_key": kept[0].split("\t")[0], "n": len(kept), "packed": zlib.compress("\n".join(kept).encode())}])

    return written(ordered.mapInArrow(pack, "part long, block long, first_key string, n long, packed binary"), "capture-index", per_core=8)


def unpack(packed: bytes) -> list[tuple]:
    """(key, page_id, file, offset, length) of a block's lines."""
    out = []
    for line in zlib.decompress(packed).decode().split("\n"):
        key, page, file, offset, length = line.split("\t")
        out.append((key, int(page) if page else None, file, int(offset), int(length)))
    return out


def _directory(index: DataFrame) -> tuple[list[str], list[tuple[int, int]]]:
    """The first key and the place of every block, in order."""
    rows = sorted(zip(*(c.to_pylist() for c in index.select("part", "block", "first_key").toArrow().columns), strict=True))
    return [key for *_, key in rows], [(part, block) for part, block, _ in rows]


def _may_hold(keys: list[str], key: str) -> range:
    """The blocks that may hold a key: from the last that begins before it to the last that begins with it."""
    return range(max(bisect.bisect_left(keys, key) - 1, 0), bisect.bisect_right(keys, key))


def _within(lines: list[tuple], key: str) -> list[tuple]:
    return lines[bisect.bisect_left(lines, key, key=lambda x: x[0]) : bisect.bisect_right(lines, key, key=lambda x: x[0])]


class Captures:
    """Point lookups: the sparse directory in memory, a block and a range of an archive read for each question."""

    def __init__(self, index: DataFrame, path: str):
        self.index, self.path, self.spark = index, path, index.sparkSession
        self.keys, self.places = _directory(index)

    def lookup(self, url: str) -> list[tuple]:
        """All captures of a url: (key, page_id, file, offset, length)."""
        key, found = url_key(url), []
        for at in _may_hold(self.keys, key):
            part, block = self.places[at]
            found += _within(unpack(bytes(self.index.where((F.col("part") == part) & (F.col("block") == block)).first().packed)), key)
        return found

    def read(self, entry: tuple) -> dict:
        """The record of an entry, by a range read."""
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{entry[2]}")
        stream = where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).open(where)
        try:
            stream.seek(entry[3])
            return parse(gzip.decompress(bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, entry[4]))))
        finally:
            stream.close()


def find(index: DataFrame, urls: DataFrame) -> DataFrame:
    """``(key, page_id, file, offset, length)``: every capture of every url of column ``url``, once for each key.

    A key is searched in the directory; blocks and the keys asked of them meet by shuffle, a block's keys stream past it
    in order. A null url asks for the captures without url; an empty table on either side gives no rows."""
    firsts, places = _directory(index)

    def keys(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(sorted({url_key(u) for u in batch.column(0).to_pylist()}), pa.string())], ["key"])

    def place(batches):
        for batch in batches:
            rows = [(*places[at], key) for key in batch.column(0).to_pylist() for at in _may_hold(firsts, key)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string()))], ["part", "block", "key"])

    def answer(batches):
        lines = []
        for batch in batches:
            found = []
            for key, packed in zip(batch.column(2).to_pylist(), batch.column(3), strict=True):
                if key is None:
                    lines = unpack(packed.as_py())
                else:
                    found += _within(lines, key)
            for lo in range(0, len(found), 10_000):
                cols = list(zip(*found[lo : lo + 10_000], strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k in (0, 2) else pa.int64()) for k, c in enumerate(cols)], [x.split()[0] for x in _ENTRY.split(", ")])

    asked = urls.select(F.col("url").cast("string")).mapInArrow(keys, "key string").distinct().mapInArrow(place, "part long, block long, key string")
    both = index.select("part", "block", F.lit(None).cast("string").alias("key"), "packed").union(asked.select("part", "block", "key", F.lit(None).cast("binary")))
    return both.repartition("part", "block").sortWithinPartitions("part", "block", F.col("key").asc_nulls_first()).mapInArrow(answer, _ENTRY)


def entries(index: DataFrame) -> DataFrame:
    """Every capture of the index."""

    def run(batches):
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                cols = list(zip(*unpack(packed), strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k in (0, 2) else pa.int64()) for k, c in enumerate(cols)], [x.split()[0] for x in _ENTRY.split(", ")])

    return index.select("packed").mapInArrow(run, _ENTRY)


def read(captures: DataFrame, path: str) -> DataFrame:
    """The records of ``captures`` (file, offset, length), each from its range of its archive: ``(page_id, url,
    record_type, refers_to, payload, payload_bytes, payload_digest)``. A revisit has a null payload; its size and digest
    are those of the full payload. Ranges are brought to the archive they lie in; an archive and its ranges are one task's
    work, bounded by ``ARCHIVE_BYTES``."""
    captures = written(captures.select("file", "offset", "length"), "ranges", per_core=8)
    ranges = captures.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("ranges"))
    if captures.count() <= BROADCAST_RANGES:
        ranges = F.broadcast(ranges)
    files = _files(captures.sparkSession, path).withColumn("file", F.element_at(F.split("path", "/"), -1)).join(ranges, "file").select("content", "ranges")

    def records(batches):
        for batch in batches:
            for content, ranges in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                data, rows, size = memoryview(content.as_buffer()), [], 0
                for r in ranges:
                    x = parse(gzip.decompress(data[r["offset"] : r["offset"] + r["length"]]))
                    w, revisit = x["warc"], x["warc"]["WARC-Type"] == "revisit"
                    if not revisit and base64.b32encode(hashlib.sha1(x["payload"]).digest()).decode() != w["WARC-Payload-Digest"][5:]:
                        raise ValueError(f"digest of {w['WARC-Record-ID']} differs")
                    rows.append({"page_id": _id(w["WARC-Record-ID"]), "url": w.get("WARC-Target-URI"), "record_type": w["WARC-Type"], "refers_to": _id(w.get("WARC-Refers-To")), "payload": None if revisit else x["payload"], "payload_bytes": int(x["http"]["Content-Length"]), "payload_digest": w["WARC-Payload-Digest"][5:]})
                    size += len(x["payload"])
                    if size > 1 << 22:
                        yield _batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows)

    kinds = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "payload": pa.binary(), "payload_bytes": pa.int64(), "payload_digest": pa.string()}

    def _batch(rows):
        return pa.RecordBatch.from_pylist(rows, pa.schema(list(kinds.items())))

    return files.mapInArrow(records, "page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, payload_digest string")
