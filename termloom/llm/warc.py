"""Web archives: WARC files of pages with revisit records, and a merged index of their captures."""

from __future__ import annotations

import base64
import datetime
import hashlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm.tables import limit_batches, map_batches, staged

# Records of an archive file, and payload bytes that it is meant to have at most (one record may be larger).
RECORDS = 2000
ARCHIVE_BYTES = 64 * 1024 * 1024

# Pages carry no time: a page is captured as many seconds after this moment as its number says.
EPOCH = datetime.datetime(2024, 1, 1)

# Fixed values of the format.
VERSION = b"WARC/1.1"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE = "urn:x-page:"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def captured(page: int | None) -> str:
    # The years that a date can have are gone round again by very large numbers.
    return (EPOCH + datetime.timedelta(seconds=(page or 0) % 10**10)).strftime("%Y-%m-%dT%H:%M:%SZ")


def url_key(url: str | None) -> str:
    """Host labels in reverse, then the rest, lower-cased, so that captures of a site sort together."""
    _, found, rest = (url or "").partition("://")
    rest = rest if found else url or ""
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, tail = rest[:end].lower(), rest[end:].lower()
    return f"{','.join(reversed(host.split('.')))}){tail or '/'}"


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record without the two line ends behind it; a revisit has no payload but says how long it is."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{PAGE}{'' if page is None else page}>",
        f"WARC-Date: {captured(page)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=_PLAIN)}")
    if revisit:
        lines += [f"WARC-Refers-To: <{PAGE}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return b"\r\n".join([VERSION, *(line.encode() for line in lines), b"", block])


# Printable characters but the percent sign stay as they are in a header; others are escaped, so any URL comes back.
_PLAIN = "".join(chr(c) for c in range(33, 127) if chr(c) != "%")


def records(data: bytes) -> Iterator[tuple[int, int, dict[str, str], dict[str, str], bytes]]:
    """``(offset, length, headers, HTTP headers, payload)`` of every record of an archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, _, lines = data[at:end].partition(b"\r\n")
        if version != VERSION:
            raise ValueError(f"no record at byte {at}")
        headers = _headers(lines)
        start, size = end + 4, int(headers["content-length"])
        block = data[start : start + size]
        if len(block) != size or data[start + size : start + size + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} is cut")
        head, _, payload = block.partition(b"\r\n\r\n")
        yield at, start + size + 4 - at, headers, _headers(head.partition(b"\r\n")[2]), payload
        at = start + size + 4


def _headers(lines: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in lines.decode().split("\r\n") if line)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _page(reference: str | None) -> int | None:
    number = (reference or "").strip("<>").removeprefix(PAGE)
    return int(number) if number else None


DIGESTED = "page_id long, url string, payload binary, digest string, n_bytes long"


def digested(pages: DataFrame, html: str = "html", url: str = "url", id: str = "page_id") -> DataFrame:
    """``(page_id, url, payload, digest, n_bytes)``; a null payload is empty."""
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads = batch[2].to_pylist()
            digests = pa.array([payload_digest(p) for p in payloads], pa.string())
            sizes = pa.array([len(p) for p in payloads], pa.int64())
            yield pa.record_batch([*batch.columns, digests, sizes], ["page_id", "url", "payload", "digest", "n_bytes"])

    return map_batches(rows, run, DIGESTED)


def write_archives(
    pages: DataFrame, path: str, least: int = 0, html: str = "html", url: str = "url", id: str = "page_id"
) -> None:
    """A WARC record for every row, in archive files below a path that must not exist.

    Of pages with equal payloads of at least ``least`` bytes the one with the largest id is a response and the others
    are revisits that refer to it; shorter ones, and payloads that no page with an id has, are responses. Spark's own
    writer writes the files, so a lost task leaves nothing behind.
    """
    rows = digested(pages, html, url, id)
    facts = staged(rows.select("page_id", "digest", "n_bytes"), "payloads")
    groups = facts.where(F.col("n_bytes") >= least).groupBy("digest", "n_bytes")
    repeated = groups.agg(F.max("page_id").alias("first"), F.count("*").alias("copies")).where("copies > 1")
    # Only payloads that occur again: Spark broadcasts their files if they are small, or splits the hot ones.
    repeated = staged(repeated.select("digest", "n_bytes", "first"), "repeated")
    largest = facts.agg(F.max("n_bytes")).first()[0] or 1
    named = rows.join(repeated, ["digest", "n_bytes"], "left")
    refers = F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
    named = named.select("page_id", "url", "payload", "digest", refers.alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch[i].to_pylist() for i in range(5)), strict=True)
            yield pa.record_batch([pa.array([record(*row) for row in rows], pa.binary())], ["value"])

    written = map_batches(named, run, "value binary").select(F.col("value").cast("string"))
    per_file = max(1, min(RECORDS, ARCHIVE_BYTES // largest))
    written.write.option("lineSep", END).option("maxRecordsPerFile", per_file).text(path)


CAPTURES = (
    "url_key string, captured string, page_id long, url string, record_type string, payload_digest string, "
    "payload_bytes long, refers_to long, archive string, offset long, length long"
)
_NAMES = [column.split()[0] for column in CAPTURES.split(", ")]


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """One row for every record of the archives below a path, each archive's in the order of its keys.

    Digest and length of a response are worked out from the payload that is read; a revisit has them in its headers.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content in zip(batch[0].to_pylist(), batch[1], strict=True):
                found = sorted(_captures(archive, content.as_py()), key=_order)
                columns = list(zip(*found, strict=True)) or [[] for _ in _NAMES]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(columns, _TYPES, strict=True)], names=_NAMES
                )

    limit_batches(spark)
    return files.mapInArrow(run, CAPTURES)


_TYPES = [pa.int64() if column.endswith(" long") else pa.string() for column in CAPTURES.split(", ")]


def _captures(archive: str, data: bytes) -> Iterator[tuple]:
    for offset, length, headers, http, payload in records(data):
        url = headers.get("warc-target-uri")
        url = None if url is None else unquote(url)
        kind = headers["warc-type"]
        if kind == "response":
            digest, size = payload_digest(payload), len(payload)
        else:
            digest, size = headers["warc-payload-digest"].removeprefix("sha1:"), int(http["content-length"])
        page = _page(headers["warc-record-id"])
        refers = _page(headers.get("warc-refers-to"))
        yield url_key(url), headers["warc-date"], page, url, kind, digest, size, refers, archive, offset, length


def _order(capture: tuple) -> tuple:
    """URL key, time, page (null first), and where the record lies."""
    return capture[0], capture[1], capture[2] is not None, capture[2] or 0, capture[8], capture[9]


class LoserTree:
    """Merges sorted runs: each inner node keeps the run that lost there, so a step costs one path to the top."""

    def __init__(self, runs: list[Iterable[tuple]], key=_order):
        self.runs = [iter(run) for run in runs]
        self.key = key
        self.head: list[tuple | None] = [None] * len(runs)
        self.keys: list[tuple | None] = [None] * len(runs)
        self.losers = [-1] * len(runs)
        for run in range(len(runs)):
            self._advance(run)
        for run in range(len(runs)):
            self._play(run, building=True)

    def _advance(self, run: int) -> None:
        self.head[run] = next(self.runs[run], None)
        self.keys[run] = None if self.head[run] is None else self.key(self.head[run])

    def _beats(self, a: int, b: int) -> bool:
        if self.keys[a] is None or self.keys[b] is None:
            return self.keys[b] is None and (self.keys[a] is not None or a < b)
        return (self.keys[a], a) < (self.keys[b], b)

    def _play(self, run: int, building: bool = False) -> None:
        node, winner = (run + len(self.runs)) // 2, run
        while node:
            other = self.losers[node]
            if other < 0 and building:
                self.losers[node] = winner
                return
            if other >= 0 and self._beats(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.runs and self.head[self.losers[0]] is not None:
            run = self.losers[0]
            yield self.head[run]
            self._advance(run)
            self._play(run)


def capture_histories(captures: DataFrame) -> DataFrame:
    """The captures in the global order of URL key, time and page.

    The key space is cut into ranges, down to single captures of one URL; each range gets its part of every archive's
    sorted run and merges them with a loser tree.
    """
    parts = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = captures.repartitionByRange(parts, "url_key", "captured", "page_id", "archive", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[str, list[tuple]] = {}
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                runs.setdefault(row[8], []).append(row)
        for rows in runs.values():
            if any(_order(b) < _order(a) for a, b in zip(rows, rows[1:], strict=False)):
                rows.sort(key=_order)  # an exchange need not keep the order of a run
        merged: list[tuple] = []
        for row in LoserTree([runs[name] for name in sorted(runs)]):
            merged.append(row)
            if len(merged) == 4096:
                yield _batch(merged)
                merged = []
        if merged:
            yield _batch(merged)

    return ranged.mapInArrow(run, CAPTURES)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names=_NAMES)
