"""Operator 4: WARC archives and their merged capture index.

Writing: pages are joined with the largest ``page_id`` of their payload digest,
and every task streams its records, one gzip member each, into files of at most
``FILE_RECORDS`` records. The page with the largest id keeps the payload
(``response``); others with an equal payload of at least ``MIN_REVISIT`` bytes
are ``revisit`` records that refer to it.

Reading: each file is parsed record by record (header, Content-Length, body), so
memory holds one record; digest and length of a response are those of the bytes
read. A file's captures, sorted by (URL key, timestamp, page), are one run.

Index: the runs are dealt out by ranges of the full sort key, so captures of one
hot URL spread over ranges, and each task merges its k runs with a loser tree.
Ranges in order, rows in order inside, are the global capture history.

The tables carry no capture time; it is ``EPOCH`` plus ``page_id`` seconds.

Defined results: a null html is the empty payload; a null url has the empty URL
key; a null ``page_id`` is never the largest unless all of its group are null
(then each is a response); repeated rows of the largest id are all responses; an
empty table gives no archive and no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aisle.llm.store import kept, new_folder, new_name, open_folder, tasks_of

MIN_REVISIT = 0
FILE_RECORDS = 50_000
EPOCH = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_SPACE = uuid.UUID("6f0d0b0e-58a4-5c0e-9d1c-3c1b7f5a2e10")


# ---- records ---------------------------------------------------------------

def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'page:{page_id}')}>"


def capture_time(page_id: int | None) -> str:
    seconds = (page_id or 0) % (400 * 365 * 86400)
    return (EPOCH + dt.timedelta(seconds=seconds)).strftime("%Y-%m-%dT%H:%M:%SZ")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def format_record(page_id: int | None, url: str | None, payload: bytes, keeper: int | None) -> bytes:
    """One WARC 1.1 record; ``keeper`` is the page to refer to, or None."""
    fields = [("WARC-Type", "revisit" if keeper is not None else "response"),
              ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", capture_time(page_id))]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="%/:=&?~#+!$,;'@()*[]")))
    fields.append(("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"))
    head = HTTP_HEAD % len(payload)
    if keeper is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(keeper)),
                   ("X-Refers-To-Page-ID", str(keeper)), ("X-Payload-Length", str(len(payload)))]
        block = head
    else:
        block = head + payload
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return text.encode() + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def members(src, block: int = 1 << 18) -> Iterator[bytes]:
    """The gzip members of a stream, one at a time."""
    z, out, data = zlib.decompressobj(31), [], b""
    while True:
        data = data or src.read(block)
        if not data:
            if out:
                raise ValueError("the archive ends inside a record")
            return
        out.append(z.decompress(data))
        data = b""
        if z.eof:
            data = z.unused_data
            yield b"".join(out)
            z, out = zlib.decompressobj(31), []


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """(fields, payload) of a record; the payload is the HTTP body."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines)
    block = rest[:int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def url_key(url: str | None) -> str:
    """Sort-friendly key: reversed host, then path and query, in lower case."""
    if not url:
        return ""
    try:
        p = urlsplit(url)
        host = (p.hostname or "").removeprefix("www.")
    except ValueError:
        return url.lower()
    return (",".join(reversed(host.split("."))) + ")" + (p.path or "/") + ("?" + p.query if p.query else "")).lower()


# ---- loser tree ------------------------------------------------------------

class LoserTree:
    """Merges k sorted streams; each step replays one path of losers, about
    log2(k) comparisons. Ties go to the stream with the smaller number."""

    def __init__(self, streams: list[Iterator[tuple]]):
        self.streams, self.k = streams, max(1, len(streams))
        self.heads = [next(s, None) for s in streams] or [None]
        self.tree = [-1] * self.k
        for i in range(self.k):
            self._replay(i)

    def _beats(self, a: int, b: int) -> bool:
        if a < 0 or b < 0:          # an unfilled place loses nothing and wins all while building
            return a < 0
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return x < y or (x == y and a < b)

    def _replay(self, i: int) -> None:
        winner, node = i, (i + self.k) // 2
        while node > 0:
            if self._beats(self.tree[node], winner):
                winner, self.tree[node] = self.tree[node], winner
            node //= 2
        self.tree[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while (w := self.tree[0]) >= 0 and self.heads[w] is not None:
            yield self.heads[w]
            self.heads[w] = next(self.streams[w], None)
            self._replay(w)


# ---- jobs ------------------------------------------------------------------

CAPTURE = ("run string, url_key string, captured string, page_id long, payload_bytes long, payload_digest string, "
           "record_type string, refers_to long, record_offset long")
FIELDS = [c.split()[0] for c in CAPTURE.split(", ")]


def _batch(rows: list[tuple], kinds: str) -> pa.RecordBatch:
    types = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}
    names = [c.split()[0] for c in kinds.split(", ")]
    cols = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, types[k.split()[1]]) for c, k in zip(cols, kinds.split(", "))], names=names)


def write_archives(pages: DataFrame, folder: str, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write all records; returns the manifest (path, records), checkpointed."""
    raw = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                       F.coalesce(F.col("html"), F.lit("")).alias("html"))
    keyed = raw.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    # pre-aggregated per task, so a hot payload is one row per task here; the
    # join below has plain equi-join shuffles, which AQE splits when skewed
    best = keyed.groupBy("digest").agg(F.max("page_id").alias("keeper"))
    joined = keyed.join(best, "digest").select(
        "page_id", "url", "html",
        F.when((F.col("keeper").isNotNull()) & ~F.col("page_id").eqNullSafe(F.col("keeper"))
               & (F.octet_length("html") >= min_revisit), F.col("keeper")).alias("refers_to"))

    def run(batches):
        fsys, base = open_folder(folder)
        part, out, path, n, rows = TaskContext.get().partitionId(), None, "", 0, []
        for b in batches:
            for r in range(b.num_rows):
                if out is None:
                    fsys.create_dir(base, recursive=True)
                    path, n = f"{base}/{new_name(f'pages-{part:06d}', '.warc.gz')}", 0
                    out = fsys.open_output_stream(path)
                page_id, url, html, keeper = (b.column(c)[r].as_py() for c in range(4))
                out.write(gzip_member(format_record(page_id, url, html.encode(), keeper)))
                n += 1
                if n >= FILE_RECORDS:
                    out.close()
                    rows.append((path, n))
                    out = None
        if out is not None:
            out.close()
            rows.append((path, n))
        if rows:
            yield _batch(rows, "path string, records long")

    return kept(joined.mapInArrow(run, "path string, records long"))


def read_archive(src, run: str) -> Iterator[tuple]:
    """The captures of one archive in file order, as rows of ``CAPTURE``."""
    for data in members(src):
        f, payload = parse_record(data)
        if f["WARC-Type"] == "response":
            size, digest, refers = len(payload), payload_digest(payload), None
        else:
            size, digest = int(f["X-Payload-Length"]), f["WARC-Payload-Digest"].removeprefix("sha1:")
            refers = int(f["X-Refers-To-Page-ID"])
        page = int(f["X-Page-ID"]) if "X-Page-ID" in f else None
        yield (run, url_key(f.get("WARC-Target-URI")), f["WARC-Date"], page, size, digest, f["WARC-Type"], refers)


def _key(row: tuple) -> tuple:
    return row[1], row[2], -1 if row[3] is None else row[3]


def capture_runs(manifest: DataFrame, folder: str) -> DataFrame:
    """One sorted run of captures per archive (at most ``FILE_RECORDS`` rows)."""
    def run(batches):
        fsys, _ = open_folder(folder)
        for b in batches:
            for path in b.column(0).to_pylist():
                with fsys.open_input_stream(path) as src:
                    rows = sorted((r for r in read_archive(src, path.rpartition("/")[2])), key=_key)
                yield _batch([(*r, i) for i, r in enumerate(rows)], CAPTURE)

    return (manifest.select("path").repartition(tasks_of(manifest.sparkSession), "path")
            .mapInArrow(run, CAPTURE))


def merge_runs(runs: DataFrame, rows_per_range: int = 100_000, total: int | None = None) -> DataFrame:
    """The captures in global (URL key, timestamp, page) order: ``range_no``
    ascending, ``pos`` ascending inside. A range holds about
    ``rows_per_range`` index rows, whatever the keys."""
    n = runs.count() if total is None else total
    ranges = max(1, -(-n // rows_per_range), min(tasks_of(runs.sparkSession), n // 1000))
    dealt = (runs.repartitionByRange(ranges, "url_key", "captured", F.col("page_id").asc_nulls_first(), "run")
             .sortWithinPartitions("run", "record_offset"))
    out_kinds = CAPTURE.replace("record_offset long", "range_no int, pos long")

    def run(batches):
        part, by_run = TaskContext.get().partitionId(), {}
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                by_run.setdefault(row[0], []).append(row)
        streams = [iter([(_key(r), r) for r in rows]) for rows in by_run.values()]
        rows = []
        for i, (_, r) in enumerate(LoserTree([_ranked(s, k) for k, s in enumerate(streams)])):
            rows.append((*r[:-1], part, i))
            if len(rows) >= 10_000:
                yield _batch(rows, out_kinds)
                rows = []
        if rows:
            yield _batch(rows, out_kinds)

    return dealt.mapInArrow(run, out_kinds)


def _ranked(stream: Iterator[tuple], number: int) -> Iterator[tuple]:
    """Makes items comparable by key alone."""
    for i, (key, row) in enumerate(stream):
        yield _Item((key, number, i), row)


class _Item(tuple):
    __slots__ = ()

    def __new__(cls, key, row):
        return tuple.__new__(cls, (key, row))

    def __lt__(self, other):
        return self[0] < other[0]

    def __eq__(self, other):
        return self[0] == other[0]

    __hash__ = None


def numbered(history: DataFrame) -> DataFrame:
    """The history with ``history_no``, from 1 over all ranges in order. The
    ranges' counts are one row per range."""
    before = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    base = (history.groupBy("range_no").agg(F.count(F.lit(1)).alias("_n"))
            .select("range_no", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")))
    return history.join(base, "range_no").withColumn("history_no", F.col("_base") + F.col("pos") + 1).drop("_base")


def op4_warc_history(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    folder = new_folder(spark, "warc")
    manifest = write_archives(pages, folder)
    total = manifest.agg(F.sum("records")).first()[0] or 0
    history = kept(merge_runs(kept(capture_runs(manifest, folder)), total=total))
    return numbered(history).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                                    "url_key", "captured", "history_no")


_CHARS = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v >> {b}) & 31 AS INTEGER) + 1, 1)" for b in (15, 10, 5, 0))
SQL = rf"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex, coalesce(url, '') AS url FROM pages),
u AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS keeper,
             regexp_extract(url, '^[a-zA-Z]+://([^/:?#]+)([^?#]*)([?][^#]*)?', ['host', 'path', 'query']) AS part FROM p),
k AS (SELECT *, lower(array_to_string(list_reverse(string_split(regexp_replace(part.host, '^www[.]', ''), '.')), ',') || ')'
                      || CASE WHEN part.path = '' THEN '/' ELSE part.path END || part.query) AS url_key,
             strftime(TIMESTAMP '2024-01-01' + to_seconds(page_id), '%Y-%m-%dT%H:%M:%SZ') AS captured FROM u)
SELECT page_id, strlen(html) AS payload_bytes,
       array_to_string([{_CHARS} for v in [('0x' || substr(hex, 5 * i + 1, 5))::BIGINT for i in range(8)]], '') AS payload_digest,
       CASE WHEN page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> keeper THEN keeper END AS refers_to, url_key, captured,
       row_number() OVER (ORDER BY url_key, captured, page_id) AS history_no
FROM k"""
