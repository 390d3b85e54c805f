"""Operator 13: WARC archives with an externally merged capture index.

Writing.  Every task sorts its pages by URL key, time and record id, writes them
as WARC records (one gzip member each) into archive files of its own, and the
lines of its sorted capture run, in compressed blocks, into an index file.  Of
records whose payloads are equal (by SHA-256) and not small, one is a response
and the others revisit it; groups are found on digests, not on pages.

Merging.  Runs are merged ``FAN_IN`` at a time, in passes, until one is left.  In
a pass every task merges one key range of one group of runs: it opens the blocks
that overlap the range, holds one block of every run, and a loser tree gives the
next line.  Ranges are cut at fence lines of the blocks, drawn as a range
partitioner draws them (a bounded sample; only balance depends on it), and lines
order by time and record id below the URL key, so one hot URL is spread too.  The
last run is the capture history in global order.

Reading.  The index deals captures out by archive segment; a task reads a
segment's records by their places, checks every payload against its digest, and
revisits are joined with the responses that they name.

Tasks write straight to the folder, which all executors must share, one file for
each attempt; what they return names the files that count, so leftovers of lost
tasks are never read.

Defined cases: a null payload is empty; a null URL has the key ``-`` and no target
URI; white space and control characters in URLs are percent-encoded; a null id is
kept and ranks below all others; of repeated rows with the largest id all are
responses; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import importable, stored
from .token_counts import _store

LEAST_BYTES = 1000            # smaller payloads are never revisits
FILE_BYTES = 1 << 30          # an archive file is closed beyond this
BLOCK_LINES = 3000            # index lines compressed together
FAN_IN = 64                   # runs merged at once
RANGE_LINES = 1 << 18         # lines that a merging task aims at
MAX_RANGES = 4096
SAMPLE = 1 << 14              # fence lines that ranges are cut from, at most
FENCE_BYTES = 512             # of a fence line are enough to cut
SEGMENT = 8 << 20             # bytes of an archive read together
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_EPOCH = datetime(1970, 1, 1, tzinfo=UTC)
_UNSAFE = re.compile(rb"[\x00-\x20\x7f]")
_BLOCKS = "run long, seq long, file string, start long, length long, n long, first binary, last binary"


# --- columns -----------------------------------------------------------------
def url_key(url: Column) -> Column:
    """Sort-friendly key: host labels from the last to the first, then path and query (``com,example)/a?b``)."""
    bare = F.regexp_replace(url, r"(?s)#.*", "")
    scheme = r"(?s)^[A-Za-z][A-Za-z0-9+.\-]*://"
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, scheme + r"(?:[^/?@]*@)?([^/?:]*)", 1)), r"^www\d*\.", "")
    rest = F.regexp_extract(bare, scheme + r"[^/?]*(.*)$", 1)
    key = F.when(host == "", bare).otherwise(F.concat(
        F.array_join(F.reverse(F.split(host, r"\.")), ","), F.when(rest.startswith("/"), ")").otherwise(")/"), rest))
    return F.regexp_replace(F.when(F.coalesce(key, F.lit("")) == "", "-").otherwise(key), r"[\x00-\x20\x7F]", "%20")


def _record_id(page: Column, url: Column, digest: Column) -> Column:
    """The same id whenever the same record is written."""
    nulls = F.concat(page.isNull().cast("string"), url.isNull().cast("string"))
    return F.md5(F.concat_ws("\u001f", nulls, page.cast("string"), digest, url))


def _planned(pages: DataFrame, page_id: str, url: str, payload: str, at: Column, least: int) -> DataFrame:
    """Pages with key, digests, record id and, for revisits, the record that they refer to."""
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(F.col(page_id).alias("page"), F.col(url).alias("url"), body.alias("body"), at.cast("long").alias("at"),
                        F.octet_length(body).cast("long").alias("size"), F.sha2(body, 256).alias("same"))
    equal = (rows.where(F.col("size") >= least).groupBy("same")
             .agg(F.count(F.lit(1)).alias("copies"), F.max(F.struct("page", "url", "at")).alias("first")).where("copies > 1"))
    equal = stored(equal.select("same", "first"), "equal-payloads").withColumnRenamed("same", "_same")
    first = F.col("first")
    revisit = first.isNotNull() & ~F.struct("page", "url", "at").eqNullSafe(first)
    told = rows.join(equal, F.col("same") == F.col("_same"), "left")
    return told.select(
        "page", "url", "at", "size", url_key(F.col("url")).alias("key"), F.sha1("body").alias("sha1"),
        _record_id(F.col("page"), F.col("url"), F.col("same")).alias("record"),
        F.when(revisit, F.lit("")).otherwise(F.col("body")).alias("body"),
        F.when(revisit, _record_id(first["page"], first["url"], F.col("same"))).alias("ref"),
        F.when(revisit, first["url"]).alias("ref_url"), F.when(revisit, first["at"]).alias("ref_at"))


# --- records -----------------------------------------------------------------
def _uri(url: bytes) -> bytes:
    return _UNSAFE.sub(lambda m: b"%%%02X" % m[0][0], url)


def _urn(record: str) -> str:
    return f"<urn:uuid:{record[:8]}-{record[8:12]}-{record[12:16]}-{record[16:20]}-{record[20:]}>"


def _stamp(at: int | None) -> str:
    return f"{_EPOCH + timedelta(seconds=at or 0):%Y-%m-%dT%H:%M:%SZ}"


def record_bytes(fields: list[tuple[str, str | bytes | None]], block: bytes) -> bytes:
    """One WARC record; fields without a value are left out."""
    head = b"".join(k.encode() + b": " + (v.encode() if isinstance(v, str) else v) + b"\r\n"
                    for k, v in [*fields, ("Content-Length", str(len(block)))] if v is not None)
    return b"WARC/1.1\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, bytes], bytes]:
    """Fields (names in lower case) and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not version.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    fields = {k.decode().lower(): v.strip() for k, _, v in (line.partition(b":") for line in lines)}
    size = int(fields["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("WARC record: its length does not match")
    return fields, rest[:size]


def packed(data: bytes) -> bytes:
    """One gzip member."""
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


class _BlockWriter:
    """Sorted index lines of one run, in compressed blocks of one file; ``rows`` tells of the blocks."""

    def __init__(self, out, name: str, run: int, seq: int = 0):
        self.out, self.name, self.run, self.seq, self.at, self.lines, self.rows = out, name, run, seq, 0, [], []

    def add(self, line: bytes) -> None:
        self.lines.append(line)
        if len(self.lines) == BLOCK_LINES:
            self.flush()

    def flush(self) -> None:
        if self.lines:
            data = packed(b"\n".join(self.lines))
            self.out.write(data)
            self.rows.append((self.run, self.seq, self.name, self.at, len(data), len(self.lines), self.lines[0], self.lines[-1]))
            self.seq, self.at, self.lines = self.seq + 1, self.at + len(data), []

    def told(self, schema: pa.Schema) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        return pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)


_BLOCK_SCHEMA = pa.schema([("run", pa.int64()), ("seq", pa.int64()), ("file", pa.string()), ("start", pa.int64()),
                           ("length", pa.int64()), ("n", pa.int64()), ("first", pa.binary()), ("last", pa.binary())])


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", payload: str = "html",
                   at: Column | None = None, least: int = LEAST_BYTES) -> DataFrame:
    """Write the pages' archives and capture runs; returns the stored list of the runs' index blocks.

    ``at`` is the time of capture in seconds since 1970 (null: 1970).
    """
    importable(pages.sparkSession)
    planned = (_planned(pages, page_id, url, payload, F.lit(0) if at is None else at, least)
               .withColumn("at", F.coalesce("at", F.lit(0))).withColumn("page", F.col("page").cast("string"))
               .sortWithinPartitions("key", "at", "record"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get(), 0
        part = f"{task.partitionId():06d}-{task.taskAttemptId()}"
        where, base = _store(folder)
        archive = index = None
        name, place = "", FILE_BYTES
        for batch in batches:
            if index is None:
                index = where.open_output_stream(f"{base}/run-{part}.cdx.gz", compression=None)
                blocks = _BlockWriter(index, f"run-{part}.cdx.gz", task.partitionId())
            bodies = batch.column("body").cast(pa.binary())
            rows = batch.select([c for c in batch.schema.names if c != "body"]).to_pylist()
            for row, body in zip(rows, bodies):
                if place >= FILE_BYTES:
                    if archive is not None:
                        archive.close()
                    name, number = f"pages-{part}-{number:05d}.warc.gz", number + 1
                    archive = where.open_output_stream(f"{base}/{name}", compression=None)
                    place = 0
                    data = packed(record_bytes(
                        [("WARC-Type", "warcinfo"), ("WARC-Record-ID", _urn(hashlib.md5(name.encode()).hexdigest())),
                         ("WARC-Date", _stamp(row["at"])), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")],
                        b"format: WARC File Format 1.1\r\n"))
                    archive.write(data)
                    place += len(data)
                stamp, revisit = _stamp(row["at"]), row["ref"] is not None
                uri = None if row["url"] is None else _uri(row["url"].encode())
                http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % row["size"]
                fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _urn(row["record"])),
                          ("WARC-Date", stamp), ("WARC-Target-URI", uri), ("WARC-Page-ID", row["page"]),
                          ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(row["sha1"])).decode())]
                if revisit:
                    fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _urn(row["ref"])),
                               ("WARC-Refers-To-Target-URI", None if row["ref_url"] is None else _uri(row["ref_url"].encode())),
                               ("WARC-Refers-To-Date", _stamp(row["ref_at"]))]
                fields.append(("Content-Type", "application/http; msgtype=response"))
                data = packed(record_bytes(fields, http if revisit else http + body.as_py()))
                archive.write(data)
                digits = re.sub(r"\D", "", stamp)
                blocks.add(f"{row['key']} {digits} {row['record']} {'revisit' if revisit else 'response'} {name} "
                           f"{place:012d} {len(data):010d}".encode())
                place += len(data)
            yield blocks.told(_BLOCK_SCHEMA)
        if index is not None:
            blocks.flush()
            index.close()
            archive.close()
            yield blocks.told(_BLOCK_SCHEMA)

    return stored(planned.mapInArrow(run, _BLOCKS), "capture-runs")


# --- merging -----------------------------------------------------------------
def loser_tree(streams: list[Iterator[bytes]]) -> Iterator[bytes]:
    """The lines of sorted streams in one order; each line costs one comparison for every level of the tree."""
    k = len(streams)
    heads = [next(s, None) for s in streams]

    def loses(a: int, b: int) -> bool:
        """Whether stream ``a`` comes after ``b``; an ended stream comes last."""
        x, y = heads[a], heads[b]
        return x is None or y is not None and (y, b) < (x, a)

    tree: list[int | None] = [None] * max(k, 1)        # tree[0]: the winner, others: who lost there
    for i in range(k):
        node = (i + k) // 2
        while node and tree[node] is not None:
            if loses(i, tree[node]):
                i, tree[node] = tree[node], i
            node //= 2
        tree[node] = i
    while k and (line := heads[winner := tree[0]]) is not None:
        yield line
        heads[winner] = next(streams[winner], None)
        node = (winner + k) // 2
        while node:
            if loses(winner, tree[node]):
                winner, tree[node] = tree[node], winner
            node //= 2
        tree[0] = winner


def _lines(opened, blocks: list[tuple[str, int, int]], low: bytes | None, high: bytes | None) -> Iterator[bytes]:
    """The lines of one run's blocks from ``low`` on and before ``high``; one block is held at a time."""
    for name, start, length in blocks:
        lines = zlib.decompress(opened(name).read_at(length, start), 31).split(b"\n")
        i = 0 if low is None else bisect.bisect_left(lines, low)
        j = len(lines) if high is None else bisect.bisect_left(lines, high)
        yield from lines[i:j]


class _Files:
    """Open files of a folder, the ``limit`` last used."""

    def __init__(self, folder: str, limit: int = 2 * FAN_IN):
        self.where, self.base = _store(folder)
        self.limit, self.files = limit, {}

    def __call__(self, name: str):
        f = self.files.pop(name, None) or self.where.open_input_file(f"{self.base}/{name}")
        self.files[name] = f
        if len(self.files) > self.limit:
            self.files.pop(next(iter(self.files))).close()
        return f


def merge_pass(blocks: DataFrame, folder: str, fan_in: int = FAN_IN, range_lines: int = RANGE_LINES) -> DataFrame:
    """Merge every ``fan_in`` neighbouring runs into one; returns the stored list of the new blocks."""
    spark = blocks.sparkSession
    total = blocks.agg(F.sum("n")).first()[0] or 0
    wanted = min(MAX_RANGES, -(-total // range_lines))
    fences = sorted({bytes(r[0]) for r in blocks.select(F.substring("first", 1, FENCE_BYTES).alias("f"))
                     .orderBy(F.xxhash64("f")).limit(SAMPLE).collect()})
    bounds = sorted({fences[len(fences) * i // wanted] for i in range(1, wanted)}) if fences else []
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def overlapping(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [row | {"group": row["run"] // fan_in, "range": r} for row in batch.to_pylist()
                    for r in range(bisect.bisect_right(bounds, row["first"]), bisect.bisect_right(bounds, row["last"]) + 1)]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([*_BLOCK_SCHEMA, ("group", pa.int64()), ("range", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name, out, opened = f"merged-{task.partitionId():06d}-{task.taskAttemptId()}-{task.stageId()}.cdx.gz", None, _Files(folder)
        rows = (row for batch in batches for row in batch.to_pylist())
        at = 0
        for (group, part), own in groupby(rows, lambda r: (r["group"], r["range"])):
            if out is None:
                out = opened.where.open_output_stream(f"{opened.base}/{name}", compression=None)
            low, high = bounds[part - 1] if part else None, bounds[part] if part < len(bounds) else None
            runs = [[(r["file"], r["start"], r["length"]) for r in of] for _, of in groupby(own, lambda r: r["run"])]
            writer = _BlockWriter(out, name, group, part << 32)
            writer.at = at
            for line in loser_tree([_lines(opened, of, low, high) for of in runs]):
                writer.add(line)
                if len(writer.rows) >= 256:
                    yield writer.told(_BLOCK_SCHEMA)
            writer.flush()
            yield writer.told(_BLOCK_SCHEMA)
            at = writer.at
        if out is not None:
            out.close()

    dealt = (blocks.mapInArrow(overlapping, _BLOCKS + ", group long, range long")
             .repartition(parts, "group", "range").sortWithinPartitions("group", "range", "run", "seq"))
    return stored(dealt.mapInArrow(run, _BLOCKS), "capture-index")


def merge_runs(blocks: DataFrame, folder: str, fan_in: int = FAN_IN, range_lines: int = RANGE_LINES) -> DataFrame:
    """Merge all runs into one, in as many passes as ``fan_in`` asks for; its blocks order by ``seq``."""
    runs = blocks.agg(F.max("run")).first()[0]
    while True:
        blocks = merge_pass(blocks, folder, fan_in, range_lines)
        runs = (runs or 0) // fan_in
        if not runs:
            return blocks


def captures(index: DataFrame, folder: str) -> DataFrame:
    """The capture history: ``place`` (in global order, from 0), ``key``, ``stamp``, ``record``, ``type``, ``file``, ``start``, ``length``."""
    part = F.shiftright("seq", 32)
    per = index.groupBy(part.alias("_part")).agg(F.sum("n").alias("_n"))             # MAX_RANGES rows at most
    before = per.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    inside = F.sum("n").over(Window.partitionBy("_part").orderBy("seq")) - F.col("n")
    placed = (index.withColumn("_part", part).withColumn("_inside", inside).join(F.broadcast(before), "_part")
              .select((F.col("_before") + F.col("_inside")).alias("place"), "file", "start", "length"))
    schema = pa.schema([("place", pa.int64()), ("key", pa.string()), ("stamp", pa.string()), ("record", pa.string()),
                        ("type", pa.string()), ("file", pa.string()), ("start", pa.int64()), ("length", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = _Files(folder)
        for batch in batches:
            for place, name, start, length in zip(*[c.to_pylist() for c in batch.columns]):
                rows = [line.decode().split(" ") for line in _lines(opened, [(name, start, length)], None, None)]
                key, stamp, record, kind, file, at, size = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(place, place + len(rows)))] + [pa.array(c) for c in (key, stamp, record, kind, file)]
                    + [pa.array([*map(int, at)]), pa.array([*map(int, size)])], schema=schema)

    return placed.mapInArrow(run, "place long, key string, stamp string, record string, type string, file string, start long, length long")


# --- reading -----------------------------------------------------------------
def read_records(found: DataFrame, folder: str, keep: tuple[str, ...] = ("place", "key", "stamp"), payload: bool = False) -> DataFrame:
    """The records of captures: ``keep`` columns, ``record``, ``type``, ``page``, ``url``, ``refers_to``, ``payload_bytes``, ``payload_digest``.

    A response's payload is read, measured and held against its digest; a revisit
    has the digest that it names and no size.  With ``payload`` the payload's text
    comes too.  ``page`` and ``url`` are text as written.
    """
    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (found.select(*keep, "file", "start", "length").withColumn("_segment", F.floor(F.col("start") / SEGMENT))
             .repartition(parts, "file", "_segment").sortWithinPartitions("file", "start"))
    names = ["record", "type", "page", "url", "refers_to", "payload_bytes", "payload_digest"] + ["payload"] * payload
    kinds = [pa.int64() if n == "payload_bytes" else pa.string() for n in names]

    def one(data: bytes) -> tuple:
        fields, block = parse_record(zlib.decompress(data, 31))
        text = {k: v.decode() for k, v in fields.items()}
        record, refers = (None if v is None else v[10:-1].replace("-", "")
                          for v in (text["warc-record-id"], text.get("warc-refers-to")))
        told = base64.b32decode(text["warc-payload-digest"].removeprefix("sha1:")).hex()
        size = body = None
        if text["warc-type"] == "response":
            body = block.partition(b"\r\n\r\n")[2]
            size = len(body)
            if hashlib.sha1(body).hexdigest() != told:
                raise ValueError(f"payload of record {record} does not match its digest")
        return record, text["warc-type"], text.get("warc-page-id"), text.get("warc-target-uri"), refers, size, told, body

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = _Files(folder, 4)
        for batch in batches:
            rows = list(zip(*[batch.column(c).to_pylist() for c in ("file", "start", "length")]))
            i = 0
            while i < len(rows):
                name, low, _ = rows[i]
                j = i + 1                       # records side by side are read at once
                while j < len(rows) and rows[j][0] == name and rows[j][1] - low < SEGMENT and rows[j][1] == sum(rows[j - 1][1:]):
                    j += 1
                data = opened(name).read_at(rows[j - 1][1] + rows[j - 1][2] - low, low)
                done = [one(data[s - low:s - low + n]) for _, s, n in rows[i:j]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(i, j - i) for c in keep]
                    + [pa.array(c, t) for c, t in zip(list(zip(*done))[:len(names)], kinds)], names=[*keep, *names])
                i = j

    kept = [f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema if f.name in keep]
    schema = ", ".join(kept + [f"{n} {'long' if n == 'payload_bytes' else 'string'}" for n in names])
    return dealt.mapInArrow(run, schema)


def archive_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", at: Column | None = None,
                  folder: str | None = None, least: int = LEAST_BYTES) -> DataFrame:
    """Write the pages' archives, merge their capture index, and read every record back.

    One row per page: id, ``payload_bytes``, ``payload_digest`` (SHA-1 of the full
    payload), ``record_type``, ``refers_to`` (the id of the response that a
    revisit names), ``url_key``, ``captured`` (14 digits) and ``place`` in the
    capture history.
    """
    spark: SparkSession = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    index = merge_runs(write_archives(pages, folder, page_id, url, payload, at, least), folder)
    records = stored(read_records(captures(index, folder), folder), "records")
    kind = pages.schema[page_id].dataType
    row = [F.col("page").cast(kind).alias(page_id), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to",
           F.col("key").alias("url_key"), F.col("stamp").alias("captured"), "place"]
    own = records.where(F.col("refers_to").isNull()).select(*row[:4], F.lit(None).cast(kind).alias("refers_to"), *row[5:])
    # Repeated rows give equal records; a revisit names one.
    named = (records.where(F.col("refers_to").isNull()).select(F.col("record").alias("refers_to"), F.col("page").alias("_page"),
                                                               F.col("payload_bytes").alias("_bytes")).dropDuplicates(["refers_to"]))
    again = (records.where(F.col("refers_to").isNotNull()).join(named, "refers_to")
             .withColumn("payload_bytes", F.col("_bytes")).withColumn("refers_to", F.col("_page").cast(kind)).select(*row))
    return own.unionByName(again)
