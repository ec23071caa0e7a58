"""WARC archives of pages, read back, and one capture index merged from their sorted runs.

Method: every task packs its pages into archives of bounded size, one gzip member per record,
and leaves a run of index lines (URL key, time, archive, offset, length) sorted within the
archive. The runs are merged by an external k-way merge: Spark deals index lines out by ranges
of (URL key, time, page) so that each range has a bounded number of lines, and in a range a
loser tree merges the runs' sorted parts. Ranges are in order, so their results together are
the globally ordered capture history; positions in it come from the ranges' counts.

Of pages with equal payloads (100 bytes or more) the one with the smallest page_id is stored
as a response, the others as revisits that name it. Digests are grouped with partial sums, so
a payload that a third of all pages share is one row per task.

Archives are written with pyarrow's file systems below the cluster's shared folder, under
names of their own for each attempt; only archives named by the stored index are read, so an
attempt that was lost leaves nothing behind that counts.

Defined cases: a null html is an empty payload; a null url has the empty key; pages without
page_id are written with the id `null` and never referred to; repeated rows are one response
and one record each (the same id is no revisit of itself); an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tickloom.llm.common import raw, stored
from tickloom.session import work_folder

SMALLEST_SHARED = 100               # payload bytes from which equal payloads are shared
ARCHIVE_BYTES = 32 * 1024 * 1024    # packed bytes after which a task starts a new archive
RANGE_LINES = 100_000               # index lines that one merging task should hold
FIRST_CAPTURE = 1_704_067_200       # 2024-01-01, the time of page 0; later pages follow by seconds
INDEX = ("archive string, offset long, length long, url_key string, captured_at long, page_id long, "
         "url string, record_type string")


def url_key(url: str | None) -> str:
    """Host labels from the last to the first, then the path: `com,example)/path?query`."""
    rest = re.sub(r"^[a-z][a-z0-9+.-]*://", "", (url or "").strip(), flags=re.I)
    host, mark, path = re.match(r"([^/?#]*)([/?]?)([^#]*)", rest).groups()
    host = re.sub(r"^www\d*\.", "", host.rpartition("@")[2].lower())
    name, _, port = host.partition(":")
    port = "" if port in ("", "80", "443") else f":{port}"
    return f"{','.join(reversed(name.split('.')))}{port}){mark if mark == '/' else '/' + mark}{path.lower()}"


def record(fields: dict[str, str], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in fields.items())
    return b"WARC/1.1\r\n" + head.encode() + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not version.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.decode().split(": ", 1) for line in lines)
    size = int(fields["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a record's length does not agree with its header")
    return fields, rest[:size]


def _files(folder: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(folder)


def _records(page, at, url, html, digest, first) -> Iterator[bytes]:
    when = f"{_stamp(at)}Z"
    fields = {"WARC-Type": "response" if first is None else "revisit",
              "WARC-Record-ID": f"<urn:page:{page}>", "WARC-Date": when,
              "WARC-Target-URI": re.sub(r"[\r\n]", " ", url or ""),
              "WARC-Payload-Digest": f"sha256:{digest}"}
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if first is not None:
        fields |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                   "WARC-Refers-To": f"<urn:page:{first}>"}
    head = f"{http}Content-Length: {len(html)}\r\n\r\n".encode()
    yield record(fields | {"Content-Type": "application/http; msgtype=response"}, head + (html if first is None else b""))


def _stamp(seconds: int) -> str:
    from datetime import datetime, timezone

    return datetime.fromtimestamp(seconds, timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html") -> DataFrame:
    """Write the pages as archives below `folder`; returns the stored index lines, each
    archive's lines sorted by URL key, time and page."""
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        html.alias("html"), F.sha2(html, 256).alias("digest"),
                        F.octet_length(html).cast("long").alias("n"))
    # Digests that occur once need no decision, so only shared ones are joined back.
    shared = stored(rows.filter((F.col("n") >= SMALLEST_SHARED) & F.col("page_id").isNotNull()).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count("*").alias("copies")).filter("copies > 1").select("digest", "first"))
    decided = rows.join(shared, "digest", "left").withColumn(
        "first", F.when((F.col("n") >= SMALLEST_SHARED) & (F.col("first") < F.col("page_id")), F.col("first")))

    def run(batches):
        files, base = _files(folder)
        name, sink, lines, offset = None, None, [], 0

        def close():
            sink.close()
            lines.sort(key=lambda x: (x[3], x[4], x[5] is None, x[5] or 0))
            for at in range(0, len(lines), 10_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*lines[at:at + 10_000]), KINDS)], NAMES)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "digest", "first")]
            for page, url, digest, first, html in zip(*columns, raw(batch.column("html"))):
                if sink is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    sink, lines, offset = files.open_output_stream(f"{base}/{name}", compression=None), [], 0
                at = FIRST_CAPTURE + (page or 0)
                packed = b"".join(gzip.compress(r, 1, mtime=0) for r in _records(page, at, url, html, digest, first))
                sink.write(packed)
                lines.append((name, offset, len(packed), url_key(url), at, page, url,
                              "response" if first is None else "revisit"))
                offset += len(packed)
                if offset >= ARCHIVE_BYTES:
                    yield from close()
                    sink = None
        if sink is not None:
            yield from close()

    files, base = _files(folder)
    files.create_dir(base, recursive=True)
    return stored(decided.select("page_id", "url", "html", "digest", "first").mapInArrow(run, INDEX))


KINDS = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
NAMES = ["archive", "offset", "length", "url_key", "captured_at", "page_id", "url", "record_type"]


class LoserTree:
    """K-way merge of sorted lists: inner nodes hold the loser of their match, the root's
    winner is the smallest head, and taking it replays one path."""

    def __init__(self, runs: list[list], key):
        self.runs, self.key, self.k = runs, key, max(1, len(runs))
        self.at = [0] * len(runs)
        self.heads = [self._head(i) for i in range(len(runs))] or [(1,)]
        self.losers = [-1] * self.k
        self.winner = self._build(1)

    def _head(self, i: int) -> tuple:
        run = self.runs[i]
        return (0, self.key(run[self.at[i]]), i) if self.at[i] < len(run) else (1,)

    def _build(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._build(2 * node), self._build(2 * node + 1)
        a, b = (a, b) if self.heads[a] <= self.heads[b] else (b, a)
        self.losers[node] = b
        return a

    def __iter__(self):
        heads, losers, k = self.heads, self.losers, self.k
        while heads[self.winner][0] == 0:
            i = self.winner
            yield self.runs[i][self.at[i]]
            self.at[i] += 1
            heads[i] = self._head(i)
            node = (i + k) // 2
            while node:
                if heads[losers[node]] < heads[i]:
                    losers[node], i = i, losers[node]
                node //= 2
            self.winner = i


def merge_index(index: DataFrame, range_lines: int = RANGE_LINES) -> DataFrame:
    """The runs of all archives in one order: URL key, time, page. Adds `position` (from 0 over
    everything) and `capture` (from 1 within a URL key)."""
    ranges = max(1, -(-index.count() // range_lines))
    order = ["url_key", "captured_at", "page_id", "archive", "offset"]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in index.schema)
    names = index.columns
    places = [names.index(c) for c in order]

    def merge(batches):
        from pyspark import TaskContext

        runs: dict[str, list[tuple]] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                runs.setdefault(row[names.index("archive")], []).append(row)
        part, out, n = TaskContext.get().partitionId(), [], 0

        def key(row):
            url, at, page, archive, offset = (row[p] for p in places)
            return url, at, page is None, page or 0, archive, offset

        for row in LoserTree([runs[a] for a in sorted(runs)], key):
            out.append((*row, part, n))
            n += 1
            if len(out) == 10_000:
                yield _batch(out, index_schema)
                out = []
        if out:
            yield _batch(out, index_schema)

    index_schema = pa.schema([*(pa.field(n, k) for n, k in zip(NAMES, KINDS)),
                              pa.field("range", pa.int32()), pa.field("at", pa.int64())])
    # Lines of an archive arrive in their run's order; page and offset make every key unique, so
    # that captures of one URL can be cut into several ranges.
    dealt = index.repartitionByRange(ranges, *order).sortWithinPartitions("archive", *order[:3], "offset")
    merged = stored(dealt.mapInArrow(merge, f"{fields}, range int, at long"))
    by_range = merged.groupBy("range").agg(F.count("*").alias("n"))
    offsets = by_range.select("range", F.coalesce(F.sum("n").over(
        Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    placed = merged.join(F.broadcast(offsets) if ranges <= 100_000 else offsets, "range").withColumn(
        "position", F.col("at") + F.col("before"))
    # A URL key's first position over all ranges gives the number of a capture.
    first = placed.groupBy("url_key").agg(F.min("position").alias("first"))
    return placed.join(first, "url_key").withColumn(
        "capture", F.col("position") - F.col("first") + 1).drop("range", "at", "before", "first")


def _batch(rows, schema):
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """Every record that the index names, read from the archives: page_id, payload_bytes,
    payload_digest, record_type and refers_to. A response's payload is checked against its digest."""
    wanted = index.select("archive", "offset", "length").repartition("archive").sortWithinPartitions("archive", "offset")

    def run(batches):
        files, base = _files(folder)
        name, source = None, None
        for batch in batches:
            out = []
            for archive, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if archive != name:
                    if source is not None:
                        source.close()
                    name, source = archive, files.open_input_file(f"{base}/{archive}")
                source.seek(offset)
                fields, block = parse(zlib.decompress(source.read(length), 31))
                out.append((archive, offset, *_described(fields, block)))
            if out:
                yield _batch(out, READ)
        if source is not None:
            source.close()

    return wanted.mapInArrow(run, "archive string, offset long, payload_bytes long, "
                                  "payload_digest string, refers_to long, kind string")


READ = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("payload_bytes", pa.int64()),
                  ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("kind", pa.string())])


def _described(fields: dict[str, str], block: bytes) -> tuple:
    head, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", head)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Type"] == "revisit":
        return size, digest, int(re.search(r"page:(-?\d+)", fields["WARC-Refers-To"])[1]), "revisit"
    if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"damaged payload of {fields['WARC-Record-ID']}")
    return size, digest, None, "response"


def capture_history(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                    html_col: str = "html") -> DataFrame:
    """Write the pages, read them back, and return them in the order of the merged index."""
    folder = f"{work_folder(pages.sparkSession)}/warc"
    index = write_archives(pages, folder, id_col, url_col, html_col)
    read = read_archives(index, folder)
    merged = merge_index(index).drop("record_type")
    return merged.join(read, ["archive", "offset"]).select(
        "page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), "refers_to",
        "url_key", "captured_at", "position", "capture", "archive", "offset", "length")
