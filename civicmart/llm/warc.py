"""WARC archives with a salvage reader.

The writer makes one gzip member per record (so that damage to one record leaves the
others readable), in archives of about ``archive_bytes`` each. Equal payloads are
written once: the record with the largest page_id is the ``response``, the others are
``revisit`` records that name it. Payloads shorter than ``min_bytes`` are always
written whole.

The reader streams an archive member by member. Every check must hold: the gzip member
inflates and its CRC fits, the version line and headers parse, Content-Length equals the
block, the block digest and (for responses) the payload digest fit. After a failed check
it searches for the next member start (or, in plain archives, the next version line)
from the byte behind the failed start, verifies the record found there, and logs the
bytes in between as a quarantined gap (file, start, end, reason). The window grows in place,
a header line is read once and a block copied once, so a large record takes time in
proportion to its size; memory is bounded by the read window and the largest record. Payloads are equal if their SHA-1, SHA-256
and length are.

Defined results: null html is the empty payload; a null page_id never is the original
while another page has the payload; rows tied on the largest page_id are all responses;
an empty table gives no archive and no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicmart.llm.common import salted_join, scratch, stored
from civicmart.llm.files import attempt_name, open_store

ARCHIVE_BYTES = 16 << 20
WINDOW = 1 << 18
# No Spark string holds 2 GiB, so no record written here is larger: such a claim is damage,
# quarantined and not read into memory.
MAX_RECORD = (1 << 31) + (1 << 20)
GZIP = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
START = re.compile(rb"\x1f\x8b\x08|WARC/1\.")
LINE_END = re.compile(rb"\r\n")
# Fixed values of the WARC 1.1 format.
NAMESPACE = "urn:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "file string, n_records long, n_bytes long"
RECORD = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
          "refers_to long, url string, payload binary, file string, at long, gap_end long, "
          "reason string")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(kind: str, page_id, url: str | None, payload: bytes | None, digest: str,
                 size: int, refers_to) -> bytes:
    """One WARC record. A revisit carries no block; the payload's length stands in a header."""
    clean = re.sub(r"[\r\n]+", " ", url or "")
    head = [b"WARC/1.1", b"WARC-Type: " + kind.encode(),
            f"WARC-Record-ID: <{NAMESPACE}{'' if page_id is None else page_id}>".encode(),
            b"WARC-Date: 1970-01-01T00:00:00Z", b"WARC-Target-URI: " + clean.encode("utf-8", "replace"),
            f"WARC-Payload-Digest: sha1:{digest}".encode(), f"X-Payload-Length: {size}".encode()]
    block = b"" if kind == "revisit" else payload
    if kind == "revisit":
        head += [f"WARC-Refers-To: <{NAMESPACE}{refers_to}>".encode(),
                 f"WARC-Profile: {PROFILE}".encode()]
    head += [f"WARC-Block-Digest: sha1:{base32_sha1(block)}".encode(),
             b"Content-Type: text/html", f"Content-Length: {len(block)}".encode()]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    c = zlib.compressobj(1, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


@dataclass
class Found:
    """A verified record (``headers``, ``block``) or a gap (``reason``) of bytes [at, end)."""

    at: int
    end: int
    headers: dict[str, str] | None = None
    block: bytes = b""
    reason: str | None = None


class _Bytes:
    """A window over a file that moves forward; positions are absolute. Bytes are read once, and copied when asked for."""

    def __init__(self, source) -> None:
        self.source, self.start, self.data, self.over = source, 0, bytearray(), False

    def has(self, at: int) -> bool:
        """Whether a byte stands at ``at``; reads on as needed."""
        while at >= self.start + len(self.data) and not self.over:
            block = self.source.read(WINDOW)
            self.over = not block
            self.data += block
        return at < self.start + len(self.data)

    def end(self) -> int:
        """Where the bytes at hand end."""
        return self.start + len(self.data)

    def rest(self, at: int, limit: int) -> bytes:
        """At most ``limit`` bytes of what is at hand from ``at`` on (some, unless the file ends there)."""
        if not self.has(at):
            return b""
        begin = at - self.start
        return bytes(memoryview(self.data)[begin:begin + limit])

    def whole(self, at: int, n: int) -> bytes:
        """The ``n`` bytes from ``at`` on; EOFError if the file has fewer."""
        if n and not self.has(at + n - 1):
            raise EOFError("shorter than its Content-Length")
        return self.rest(at, n) if n else b""

    def find(self, mark: re.Pattern, at: int) -> int | None:
        """The first place of ``mark`` from ``at`` on, in the bytes at hand."""
        hit = mark.search(self.data, max(0, at - self.start))
        return None if hit is None else self.start + hit.start()

    def more(self) -> bool:
        return self.has(self.end())

    def forget(self, at: int) -> None:
        if at - self.start > 4 * WINDOW:
            del self.data[:at - self.start]
            self.start = at


class _Inflated:
    """What a gzip member at ``at`` of a window inflates to, with the methods of a file."""

    def __init__(self, window: _Bytes, at: int) -> None:
        self.window, self.pos, self.inflate, self.held = window, at, zlib.decompressobj(31), b""

    def read(self, n: int) -> bytes:
        while not self.held and not self.inflate.eof:
            chunk = self.inflate.unconsumed_tail or self.window.rest(self.pos, WINDOW >> 2)
            if not chunk:
                raise EOFError("member doesn't end")
            fresh = not self.inflate.unconsumed_tail
            try:
                self.held = self.inflate.decompress(chunk, n)
            except zlib.error as e:
                raise ValueError(f"gzip: {e}") from None
            self.pos += (len(chunk) if fresh else 0) - len(self.inflate.unused_data)
        out, self.held = self.held[:n], self.held[n:]
        return out


def _line(window: _Bytes, at: int) -> bytes:
    """The line at ``at`` without its end; EOFError if it doesn't end."""
    begin = at
    while True:
        stop = window.find(LINE_END, begin)
        if stop is not None:
            return window.rest(at, stop - at)
        begin = max(at, window.end() - 1)  # the mark may stand across the window's end
        if window.end() - at > MAX_RECORD:
            raise ValueError("record over MAX_RECORD bytes")
        if not window.more():
            raise EOFError("headers don't end")


def _record(window: _Bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record at ``at``; ValueError if a check fails.

    Header lines are parsed once, up to the empty one (a line that can't be a header, such as
    another version line, ends the attempt there); then Content-Length says what belongs to the
    block. EOFError: the bytes end before the record does.
    """
    window.has(at + 9)
    if not VERSION.match(window.rest(at, 10)):
        raise ValueError("no version line")
    headers, stop = {}, at + 10
    while line := _line(window, stop):
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("header line without a colon")
        headers[name.strip().lower().decode("utf-8", "replace")] = \
            value.strip().decode("utf-8", "replace")
        stop += len(line) + 2
    begin = stop + 2
    size = headers.get("content-length", "")
    if not (size.isascii() and size.isdigit()):
        raise ValueError("no Content-Length")
    if len(size) > 19 or int(size) > MAX_RECORD:
        raise ValueError("record over MAX_RECORD bytes")
    end = begin + int(size)
    if window.whole(end, 4) != b"\r\n\r\n":
        raise ValueError("no record end where Content-Length says")
    block = window.whole(begin, int(size))
    digest = "sha1:" + base32_sha1(block)
    if (headers.get("warc-block-digest") or digest) != digest:
        raise ValueError("block digest")
    if headers.get("warc-type") == "response" and "x-payload-length" in headers and (
            headers["x-payload-length"] != str(len(block))
            or headers.get("warc-payload-digest") != digest):
        raise ValueError("payload digest")
    return headers, block, end + 4


def _member(window: _Bytes, at: int) -> tuple[dict, bytes, int]:
    """The record in the gzip member at ``at``, and the member's end."""
    source = _Inflated(window, at)
    inner = _Bytes(source)
    headers, block, end = _record(inner, 0)
    if inner.has(end):
        raise ValueError("bytes behind the record in its member")
    return headers, block, source.pos


def _next_start(window: _Bytes, at: int) -> int | None:
    """The next place from ``at`` on where a member or a version line may begin."""
    while window.has(at):
        hit = window.find(START, at)
        if hit is not None:
            return hit
        at = max(at, window.end() - 6)  # a mark may stand across the window's end
        if not window.more():
            return None
        window.forget(at)
    return None


def salvage(source) -> Iterator[Found]:
    """All records of an archive (gzip members or plain), and the gaps between them."""
    window, at, gap, reason = _Bytes(source), 0, None, None
    while window.has(at):
        try:
            while len(window.rest(at, 3)) < 3 and window.more():
                pass
            read = _member if window.rest(at, 3) == GZIP else _record
            headers, block, end = read(window, at)
        except (ValueError, EOFError) as e:
            if gap is None:
                gap, reason = at, str(e)
            found = _next_start(window, at + 1)
            if found is None:
                break
            at = found
            continue
        if gap is not None:
            yield Found(gap, at, reason=reason)
            gap = None
        yield Found(at, end, headers, block)
        at = end
        window.forget(at)
    if gap is not None:
        while window.more():
            window.forget(window.end())
        yield Found(gap, window.end(), reason=reason)


def plan_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Each page with its digest and record type; the html goes along once."""
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce("html", F.lit("")).alias("html"))
    # SHA-1 is the format's digest; payloads made to collide in it differ in SHA-256.
    same = ["digest", "sha256", "n_bytes"]
    keyed = rows.select("*", F.sha1(F.col("html").cast("binary")).alias("digest"),
                        F.sha2(F.col("html").cast("binary"), 256).alias("sha256"),
                        F.octet_length("html").cast("long").alias("n_bytes"))
    groups = stored(keyed.groupBy(*same)
                    .agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("n")),
                    scratch(spark, "warc-digests"))
    total = groups.agg(F.sum("n")).first()[0] or 0
    dealt = salted_join(keyed, groups, same, "n", total,
                        F.xxhash64("page_id", "url"), "inner")
    revisit = ((F.col("n_bytes") >= min_bytes)
               & ~F.col("page_id").eqNullSafe(F.col("original")))
    return dealt.select("page_id", "url", "n_bytes",
                        F.when(revisit, F.lit(None)).otherwise(F.col("html")).alias("html"),
                        "digest", F.when(revisit, F.col("original")).alias("refers_to"),
                        revisit.alias("revisit"))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0,
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per page to archives below ``folder``; returns the manifest."""

    def write(it):
        store, where = open_store(folder)
        store.create_dir(where, recursive=True)
        out, size, n, name, done = None, 0, 0, "", []
        for table in it:
            for page, url, length, html, digest, refers, revisit in zip(
                    *(table.column(c).to_pylist() for c in ("page_id", "url", "n_bytes", "html",
                                                            "digest", "refers_to", "revisit")),
                    strict=True):
                if out is None:
                    name = attempt_name(where, "pages") + ".warc.gz"
                    out, size, n = store.open_output_stream(name, compression=None), 0, 0
                b32 = base64.b32encode(bytes.fromhex(digest)).decode()
                data = gzip_member(record_bytes(
                    "revisit" if revisit else "response", page, url,
                    None if revisit else html.encode(), b32, length, refers))
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= archive_bytes:
                    out.close()
                    done.append((name.rsplit("/", 1)[1], n, size))
                    out = None
        if out is not None:
            out.close()
            done.append((name.rsplit("/", 1)[1], n, size))
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*done, strict=True),
                                                (pa.string(), pa.int64(), pa.int64()), strict=True)],
                names=["file", "n_records", "n_bytes"])

    return stored(plan_records(pages, min_bytes).mapInArrow(write, MANIFEST),
                  scratch(pages.sparkSession, "warc-manifest"))


def _number(headers: dict[str, str], name: str) -> int | None:
    text = headers.get(name, "").removeprefix(f"<{NAMESPACE}").removesuffix(">")
    return int(text) if re.fullmatch(r"-?\d+", text) else None


def read_archives(spark: SparkSession, files: DataFrame, folder: str,
                  payloads: bool = True) -> DataFrame:
    """Every record of the listed archives (column ``file``), and the quarantined gaps.

    Gap rows have a reason, and ``at`` / ``gap_end`` in the file; record rows have none.
    """

    def read(it):
        store, where = open_store(folder)
        for table in it:
            for file in table.column("file").to_pylist():
                rows, held = [], 0
                with store.open_input_stream(f"{where.rstrip('/')}/{file}", compression=None) as source:
                    for f in salvage(source):
                        if f.headers is None:
                            rows.append((None, None, None, None, None, None, None, file, f.at,
                                         f.end, f.reason))
                        else:
                            h = f.headers
                            length = h.get("x-payload-length", str(len(f.block)))
                            rows.append((
                                _number(h, "warc-record-id"), int(length),
                                h.get("warc-payload-digest", "").removeprefix("sha1:"),
                                h.get("warc-type"), _number(h, "warc-refers-to"),
                                h.get("warc-target-uri"),
                                f.block if payloads and h.get("warc-type") == "response" else None,
                                file, f.at, None, None))
                        held += len(f.block) if payloads else 100
                        if held > 4 << 20:
                            yield _batch(rows)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows)

    # One archive a task: archives are of bounded size.
    n = max(1, min(files.count(), 100_000))
    return files.select("file").repartition(n).mapInArrow(read, RECORD)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(),
             pa.binary(), pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
        names=[x.split()[0] for x in RECORD.split(", ")])


def warc_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write all pages to archives and read the records back."""
    spark = pages.sparkSession
    folder = scratch(spark, "warc")
    manifest = write_archives(pages, folder, min_bytes)
    return read_archives(spark, manifest, folder, payloads=False).where("reason IS NULL")
