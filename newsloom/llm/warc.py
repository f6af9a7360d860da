"""WARC archives of pages, and their capture index by external merging.

write() makes a WARC/1.0 record per page and writes gzipped archives through Spark's own writer, so that any file system
that Spark can write will do; the writer's separator between values is the blank line that ends a record.  Of records
with equal payloads of at least ``min_bytes`` bytes, that with the smallest id is the response and the others are revisits.

read() parses archives by Content-Length, checks each stored payload against its digest, and sorts each archive's captures
into a run by URL key and time, with each record's place in the inflated archive.  index() writes the runs, deals them out by
ranges of at most some ``RANGE_ROWS`` captures, and merges the stretches of the runs within each range with a loser tree; the
result is in global order.  No task holds more than a range, whatever the number of captures, as keys end with the run and the
place, so that even repeated rows differ.  fetch() reads records back by run, place and length.

Defined results: a null payload is empty; a null url has no target and an empty key; rows with a null id come last among
equals and never are what others refer to; several rows with the smallest id of a group are all responses; other columns
are not looked at.  A payload that doesn't match its digest raises ValueError.  No pages give no captures.  A fetched revisit
has no payload of its own.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator
from itertools import islice
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch

#: Records in one archive, and bytes of payloads before they are zipped (a larger payload has an archive of its own).
ARCHIVE_RECORDS, ARCHIVE_BYTES = 2000, 256 << 20
#: Captures in a range of the index, on average.
RANGE_ROWS = 100_000
#: Rows of the table of repeated payloads up to which it is broadcast; beyond, it is joined by shuffle.
BROADCAST_ROWS = 200_000
#: Time of the first capture where the pages tell none (seconds since 1970).
EPOCH = 1_704_067_200
_END = "\r\n\r\n"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def base32_sha1(data: Column) -> Column:
    """SHA-1 in upper-case base32: forty bits at a time, from hexadecimal to base 32."""
    sha = F.sha1(data)
    parts = (F.lpad(F.conv(F.substring(sha, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4))
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", time_col: str | None = None, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES, compression: str = "gzip") -> None:
    """A file is one gzip member; with compression "none", the index has places in the file itself."""
    seconds = F.col(time_col).cast("long") if time_col else F.lit(EPOCH) + F.coalesce(F.col(id_col).cast("long"), F.lit(0))
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    df = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), payload.alias("payload"), F.octet_length(payload).cast("long").alias("size"), base32_sha1(payload.cast("binary")).alias("digest"), seconds.alias("seconds"))
    groups = df.where(F.col("size") >= min_bytes).groupBy("digest", "size").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    longest = df.agg(F.max("size")).first()[0] or 0
    records = max(1, min(ARCHIVE_RECORDS, archive_bytes // max(1, longest)))
    groups = groups.cache()
    try:
        few = groups.count() <= BROADCAST_ROWS
        df = df.join(F.broadcast(groups) if few else groups, ["digest", "size"], "left")
        revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
        block = F.when(revisit, F.lit(_HTTP)).otherwise(F.concat(F.lit(_HTTP), "payload"))
        line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
        target = F.regexp_replace(F.regexp_replace("url", r"\r", "%0D"), r"\n", "%0A")
        record = F.concat(
            F.lit("WARC/1.0\r\n"),
            line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
            line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("null")), F.lit(">"))),
            line("WARC-Date", F.date_format(F.timestamp_seconds("seconds"), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
            F.when(F.col("url").isNull(), "").otherwise(line("WARC-Target-URI", target)),
            line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
            line("X-Payload-Length", F.col("size").cast("string")),
            F.when(revisit, F.concat(line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">"))), F.lit("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest\r\n"))).otherwise(""),
            F.lit("Content-Type: application/http; msgtype=response\r\n"),
            line("Content-Length", F.octet_length(block).cast("string")),
            F.lit("\r\n"),
            block,
        )
        df.select(record.alias("value")).write.option("lineSep", _END).option("compression", compression).option("maxRecordsPerFile", records).text(path)
    finally:
        groups.unpersist()


def inflate(data: bytes) -> bytes:
    """All members of a gzip file; what is no gzip file comes back as it is."""
    if data[:2] != b"\x1f\x8b":
        return data
    out = []
    while data:
        z = zlib.decompressobj(31)
        out.append(z.decompress(data) + z.flush())
        data = z.unused_data
    return b"".join(out)


def records(archive: bytes) -> Iterator[tuple[dict[str, str], bytes, int, int]]:
    """Headers (names in lower case), block, place and length of each record, with the blank line that ends it."""
    at = 0
    while at < len(archive):
        end = archive.index(b"\r\n\r\n", at)
        head = archive[at:end].decode().split("\r\n")
        if not head[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head[1:])}
        start = end + 4
        stop = start + int(fields["content-length"])
        if archive[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} has another length than it tells")
        yield fields, archive[start:stop], at, stop + 4 - at
        at = stop + 4


def url_key(url: str | None) -> str:
    """Sort-friendly key: host labels reversed, then the path and query; scheme, www., default ports and fragments go."""
    if not url:
        return ""
    try:
        u = urlsplit(url if "//" in url else f"//{url}")
        host, port = (u.hostname or "").removeprefix("www."), u.port
    except ValueError:
        return url.lower()
    shown = f":{port}" if port and port not in (80, 443) else ""
    return ",".join(reversed(host.split("."))) + shown + ")" + (u.path or "/") + (f"?{u.query}" if u.query else "")


_CAPTURE = "url_key string, captured string, id long, url string, size long, digest string, type string, refers_to long, run string, offset long, length long"
_NAMES = [x.split()[0] for x in _CAPTURE.split(", ")]


def _page(urn: str) -> int | None:
    number = urn.strip("<>").rpartition(":")[2]
    return None if number == "null" else int(number)


def _order(key: str, captured: str, id_: int | None, run: str, offset: int) -> tuple:
    return key, captured, id_ is None, id_ or 0, run, offset


def _payload(block: bytes) -> bytes:
    """What follows the headers of the HTTP answer."""
    return block[block.index(b"\r\n\r\n") + 4 :]


def captures(archive: bytes, run: str) -> list[tuple]:
    """The captures of an archive as a sorted run."""
    out = []
    for f, block, at, length in records(archive):
        digest = f["warc-payload-digest"].removeprefix("sha1:")
        if f["warc-type"] == "response":
            payload = _payload(block)
            if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest or len(payload) != int(f["x-payload-length"]):
                raise ValueError(f"{f['warc-record-id']}: the payload doesn't match its digest")
        url = f.get("warc-target-uri")
        refers = f.get("warc-refers-to")
        out.append((url_key(url), f["warc-date"], _page(f["warc-record-id"]), url, int(f["x-payload-length"]), digest, f["warc-type"], _page(refers) if refers else None, run, at, length))
    out.sort(key=lambda r: _order(*r[:3], *r[8:10]))
    return out


def _archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.{gz,warc,txt}").load(path).select(F.element_at(F.split("path", "/"), -1).alias("run"), "content")


def read(spark: SparkSession, path: str) -> DataFrame:
    """The captures of all archives under a path; each archive is a sorted run."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column(0), b.column(1), strict=True):
                rows = captures(inflate(content.as_py()), name.as_py())
                if rows:
                    yield _batch(rows)

    return _archives(spark, path).mapInArrow(parse, _CAPTURE)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64() if x.endswith("long") else pa.string() for x in _CAPTURE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=_NAMES)


class LoserTree:
    """Merges sorted runs.  Inner nodes hold the run that lost there; one comparison a level replays the winner's path."""

    def __init__(self, runs: list[Iterable], key):
        self.runs, self.key = [iter(r) for r in runs], key
        self.k = max(1, len(runs))
        self.head: list = [self._next(i) for i in range(self.k)] if runs else [None]
        self.lost = [-1] * self.k
        for i in range(self.k):
            self._replay(i)

    def _next(self, i: int):
        row = next(self.runs[i], None)
        return None if row is None else (self.key(row), i, row)

    def _before(self, a: int, b: int) -> bool:
        x, y = self.head[a], self.head[b]
        return y is None or (x is not None and x[:2] < y[:2])

    def _replay(self, winner: int) -> None:
        node = (winner + self.k) // 2
        while node:
            other = self.lost[node]
            if other < 0:  # the other side has not come up yet
                self.lost[node] = winner
                return
            if self._before(other, winner):
                self.lost[node], winner = winner, other
            node //= 2
        self.lost[0] = winner

    def __iter__(self) -> Iterator:
        while (top := self.head[self.lost[0]]) is not None:
            yield top[2]
            i = top[1]
            self.head[i] = self._next(i)
            self._replay(i)


def index(found: DataFrame, scratch: Scratch, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Captures in global order of URL key, time, id and place: the written runs in ranges, each merged by a loser tree."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        rows = pa.Table.from_batches(parts).combine_chunks()
        keys = list(map(_order, *(rows.column(n).to_pylist() for n in ("url_key", "captured", "id", "run", "offset"))))
        # rows come as their runs were written, some runs in pieces: each stretch in order is one run of the merge
        cuts = [0, *(i for i in range(1, len(keys)) if keys[i] < keys[i - 1]), len(keys)]
        merged = iter(LoserTree([range(a, b) for a, b in zip(cuts, cuts[1:])], keys.__getitem__))
        while places := list(islice(merged, 5000)):
            yield from rows.take(places).combine_chunks().to_batches()

    runs = scratch.keep(found, "runs")
    ranges = max(1, -(-runs.count() // range_rows))
    return runs.repartitionByRange(ranges, "url_key", "captured", F.col("id").isNull(), "id", "run", "offset").mapInArrow(merge, _CAPTURE)


def fetch(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """run, offset, payload of the captures wanted (run, offset, length); an archive without any is not inflated."""
    places = wanted.groupBy("run").agg(F.collect_list(F.struct("offset", "length")).alias("places"))  # as many as the archive has records

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for b in batches:
            for run, content, places in zip(*(b.column(n) for n in ("run", "content", "places")), strict=True):
                archive = inflate(content.as_py())
                for p in places.as_py():
                    _, block, *_ = next(records(archive[p["offset"] : p["offset"] + p["length"]]))
                    yield pa.RecordBatch.from_arrays([pa.array([run.as_py()]), pa.array([p["offset"]], pa.int64()), pa.array([_payload(block)], pa.binary())], names=["run", "offset", "payload"])

    return _archives(spark, path).join(places, "run").mapInArrow(cut, "run string, offset long, payload binary")
