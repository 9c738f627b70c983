"""WARC archives of pages with a two-level capture index, written and read by range.

A folder holds

* ``archive-*.warc.gz``: records, one gzip member each. The payload is the page in UTF-8. Of pages with equal payloads (of at
  least ``least_bytes``) the one with the smallest id is a ``response``; the others are ``revisit`` records without payload
  that refer to it and carry its digest and length.
* ``index-*.blocks``: capture lines sorted by reversed-host key (``com,example,www)/path``), compressed in
  blocks of ``BLOCK_LINES``, and ``index-*.directory``: first key, place, length and lines of every block of that file.

Lookup: the first keys of the index files (one per partition that wrote the index) choose a file, its directory a
block, both by binary search; then the block and the record are read by range. Only the parts touched are read. A key with
many captures is looked up in pieces (``lookups``): blocks before a piece are passed over by their number of lines.

Executors write and read through ``pyarrow.fs``, so the folder can be any shared file system it knows. A task attempt
writes to files of its own name; only those of the attempt that Spark kept are listed in the index.

Edge cases: a null page is an empty payload; a null id counts as larger than all others; rows equal in id and
payload are all responses if theirs is the smallest id; a null or odd URL has its text as key; an empty table gives
an empty archive and index.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import re
import uuid
import zlib
from collections import OrderedDict
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.storage import materialize

BLOCK_LINES = 500
READ_BYTES = 64 << 20  # of archives, read by one task
LEAST_READ_BYTES = 1 << 20
ARCHIVE_BYTES = 1 << 30
CAPTURES = "key string, page_id long, url string, file string, offset long, length long"
_URL = re.compile(r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::\d+)?([^#]*)")


def url_key(url: str | None) -> str:
    """Host labels in reverse, then path and query: pages of a domain are neighbours."""
    found = _URL.match(url or "")
    if not found:
        return url or ""
    host = found[1].lower().removeprefix("www.").split(".")
    return f"{','.join(reversed(host))}){found[2] or '/'}"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _open_folder(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One WARC record with its HTTP response headers, not compressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {target}", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if revisit:
        head.insert(6, f"WARC-Refers-To: <urn:page:{refers_to}>")
        head.insert(6, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Header fields and payload of one record (``payload`` is None for a revisit)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    named = lambda name: int(x) if (x := fields.get(name, "<urn:page:>")[10:-1]) else None
    return {
        "type": fields["WARC-Type"], "page_id": named("WARC-Record-ID"), "refers_to": named("WARC-Refers-To"), "url": fields["WARC-Target-URI"],
        "digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"), "length": length, "payload": None if fields["WARC-Type"] == "revisit" else payload,
    }


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Write all records; the captures (``CAPTURES``) of the written files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _open_folder(folder)
        out, name, size = None, "", 0
        try:
            for batch in batches:
                rows = []
                for page_id, url, html, refers_to, revisit in zip(*[c.to_pylist() for c in batch.columns]):
                    if out is None or size > ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        name, size = f"archive-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz", 0
                        system.create_dir(path, recursive=True)
                        out = system.open_output_stream(f"{path}/{name}", compression=None)
                    member = gzip.compress(record(page_id, url, (html or "").encode(), refers_to, revisit, date), 6, mtime=0)
                    out.write(member)
                    rows.append((url_key(url), page_id, url, name, size, len(member)))
                    size += len(member)
                kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], kinds[j]) for j in range(6)], ["key", "page_id", "url", "file", "offset", "length"])
        finally:
            if out is not None:
                out.close()

    html = F.coalesce("html", F.lit(""))
    last = F.lit((1 << 63) - 1)
    keyed = pages.select(F.coalesce("page_id", last).alias("id"), F.sha1(html.cast("binary")).alias("digest"), F.octet_length(html).alias("bytes"))
    groups = keyed.where(F.col("bytes") >= least_bytes).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    later = keyed.join(groups, "digest").where("id > first").select("id", F.col("digest").alias("same"), "first").distinct()
    later = materialize(later, "revisits")
    rows = pages.select(F.coalesce("page_id", last).alias("id"), "page_id", "url", "html", F.sha1(html.cast("binary")).alias("digest"))
    joined = rows.join(later.hint("merge"), (rows["id"] == later["id"]) & (rows["digest"] == later["same"]), "left")
    records = joined.select("page_id", "url", "html", F.col("first").alias("refers_to"), F.col("first").isNotNull().alias("revisit"))
    return materialize(records.mapInArrow(run, CAPTURES), "captures")


def write_index(captures: DataFrame, folder: str) -> DataFrame:
    """Write the sorted blocks and their directories; one row per index file: ``first_key, file``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _open_folder(folder)
        name, lines, places, size, out = f"index-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}", [], [], 0, None
        for batch in batches:
            lines += zip(*[c.to_pylist() for c in batch.columns])
            while len(lines) >= BLOCK_LINES:
                out = out or system.open_output_stream(f"{path}/{name}.blocks")
                size = _write_block(out, lines[:BLOCK_LINES], places, size)
                lines = lines[BLOCK_LINES:]
        if lines:
            out = out or system.open_output_stream(f"{path}/{name}.blocks")
            _write_block(out, lines, places, size)
        if out is not None:
            out.close()
            with system.open_output_stream(f"{path}/{name}.directory") as directory:
                directory.write(zlib.compress(json.dumps(places).encode()))
            yield pa.RecordBatch.from_arrays([pa.array([places[0][0]]), pa.array([name])], ["first_key", "file"])

    order = [F.col("key"), F.col("page_id"), F.col("file"), F.col("offset")]
    rows = captures.select("key", "page_id", "file", "offset", "length").repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(rows.mapInArrow(run, "first_key string, file string"), "index-files")


def _write_block(out, lines: list[tuple], places: list, size: int) -> int:
    data = zlib.compress(json.dumps(lines).encode())
    out.write(data)
    places.append((lines[0][0], size, len(data), len(lines)))
    return size + len(data)


class IndexReader:
    """Captures of a key, by binary search over files, over a file's directory, then over a block."""

    def __init__(self, folder: str, files: list[tuple[str, str]], kept: int = 32):
        self.system, self.path = _open_folder(folder)
        self.files, self.kept = sorted(files), kept
        self.first_keys = [f[0] for f in self.files]
        self.opened: OrderedDict = OrderedDict()
        self.cached: OrderedDict = OrderedDict()

    def read(self, name: str, offset: int, length: int) -> bytes:
        handle = self.opened.pop(name, None) or self.system.open_input_file(f"{self.path}/{name}")
        self.opened[name] = handle
        if len(self.opened) > self.kept:
            self.opened.popitem(last=False)[1].close()
        return handle.read_at(length, offset)

    def _keep(self, name, make):
        value = self.cached.pop(name, None) or make()
        self.cached[name] = value
        if len(self.cached) > self.kept:
            self.cached.popitem(last=False)
        return value

    def _directory(self, file: str) -> list:
        def load() -> list:
            with self.system.open_input_file(f"{self.path}/{file}.directory") as directory:
                return json.loads(zlib.decompress(directory.readall()))

        return self._keep(file, load)

    def captures(self, key: str, begin: int = 0, end: int | None = None) -> Iterator[tuple]:
        """Capture lines of a key, from number ``begin`` to ``end`` (without it). The key may begin in the block before the first that starts with it."""
        passed = 0
        at = max(bisect.bisect_left(self.first_keys, key) - 1, 0)
        for first_key, file in self.files[at:]:
            if first_key > key:
                return
            places = self._directory(file)
            first = max(bisect.bisect_left(places, key, key=lambda p: p[0]) - 1, 0)
            for i, (block_key, offset, length, n) in enumerate(places[first:], first):
                if end is not None and passed >= end:
                    return
                if block_key > key:
                    break
                if passed + n <= begin and block_key == key and i + 1 < len(places) and places[i + 1][0] == key:
                    passed += n
                    continue
                block = self._keep((file, offset), lambda: json.loads(zlib.decompress(self.read(f"{file}.blocks", offset, length))))
                low, high = (side(block, key, key=lambda line: line[0]) for side in (bisect.bisect_left, bisect.bisect_right))
                until = high if end is None else min(high, low + end - passed)
                for line in block[low + max(begin - passed, 0) : max(until, low)]:
                    yield tuple(line)
                passed += high - low

    def record(self, capture: tuple) -> dict:
        _, _, file, offset, length = capture
        return parse_record(gzip.decompress(self.read(file, offset, length)))


RECORDS = "key string, page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def lookups(captures: DataFrame) -> tuple[DataFrame, int]:
    """Look-ups that read all captures, ``key, begin, end`` (line numbers of the key), and how many tasks should share them.

    No look-up has more lines than an even share of a task, so a URL that most pages have (or null) is read by many tasks.
    """
    sums = captures.agg(F.sum("length").alias("bytes"), F.count("*").alias("lines")).first()
    size = sums["bytes"] or 0
    tasks = max(min(int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // LEAST_READ_BYTES)), -(-size // READ_BYTES), 1)
    share = max(-(-sums["lines"] // tasks), 1)
    counted = captures.groupBy("key").agg(F.count("*").alias("lines"))
    pieces = counted.select("key", F.explode(F.expr(f"sequence(0L, lines - 1, {share}L)")).alias("begin"))
    return pieces.withColumn("end", F.col("begin") + share), tasks


def read_records(keys: DataFrame, folder: str, index_files: DataFrame, with_payload: bool = True, tasks: int | None = None) -> DataFrame:
    """All records of the given ``key`` rows (each once), as ``RECORDS``; payloads are checked against their digests.

    Rows may have ``begin`` and ``end`` (``lookups``), else all captures of the key are read. ``index_files`` has a row per index
    file; only this list is held by every task.
    """
    pieces = {"begin", "end"} <= set(keys.columns)
    wanted = keys.select("key", *["begin", "end"] if pieces else [F.lit(0).cast("long").alias("begin"), F.lit(None).cast("long").alias("end")])
    files = [(r["first_key"], r["file"]) for r in index_files.collect()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = IndexReader(folder, files)
        for batch in batches:
            rows, size = [], 0
            for key, begin, end in zip(*[c.to_pylist() for c in batch.columns]):
                for capture in reader.captures(key, begin, end):
                    got = reader.record(capture)
                    if got["payload"] is not None and (len(got["payload"]), payload_digest(got["payload"])) != (got["length"], got["digest"]):
                        raise ValueError(f"damaged record of page {got['page_id']} in {capture[2]}")
                    rows.append((key, got["page_id"], got["url"], got["type"], got["length"], got["digest"], got["refers_to"], got["payload"] if with_payload else None))
                    size += got["length"] * with_payload
                    if len(rows) >= 5_000 or size > 16 << 20:
                        yield _record_batch(rows)
                        rows, size = [], 0
            if rows:
                yield _record_batch(rows)

    # The number of partitions is given: the keys are small, what they stand for is not.
    dealt = wanted.distinct().repartitionByRange(*[tasks] if tasks else [], "key", "begin").sortWithinPartitions("key", "begin")
    return dealt.mapInArrow(run, RECORDS)


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    names = [field.split()[0] for field in RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], kinds[j]) for j in range(8)], names)


def archive_pages(spark: SparkSession, pages: DataFrame, folder: str, least_bytes: int = 0) -> tuple[DataFrame, DataFrame]:
    """Write archives and index; the captures and the list of index files."""
    captures = write_archives(pages, folder, least_bytes)
    return captures, write_index(captures, folder)
