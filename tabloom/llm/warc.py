"""WARC archives: monolithic gzip streams rewritten with a member per record and a sidecar index.

``write_archives`` writes a record per page into whole-file gzip streams. A
payload seen before is a revisit record that names the response; which page is
the response is decided by a grouping on the payload's digest that combines
before the shuffle. ``normalise`` inflates each such stream once, in pieces,
writes every record again as a gzip member of its own, and beside the archive an
index of offsets. ``read_archives`` goes through the index and opens members one
by one. Neither holds more than a record's header and a piece of its block,
except the reader, which holds one record.

Files go to the shared folder under names of their own; only the manifest, which
Spark returns from successful tasks, says which files count.

Cases: a null html is an empty payload; a null url gives no target header; a
null page id is written empty and read back as null, and is the response of a
group only if all ids are null; pages that repeat the smallest id of a group are
all responses; control characters of urls are percent-encoded; an empty table
gives no files and no rows; further columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm.files import at, fresh, mapped, one_task_each
from tabloom.plans.sizing import pinned_if_small
from tabloom.session import shared_dir

PIECE = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP = 31


# ------------------------------------------------------------------- records


def _header(pairs: list[tuple[str, str | None]], first: str) -> bytes:
    return "\r\n".join([first, *(f"{k}: {v}" for k, v in pairs if v is not None), "", ""]).encode()


def _clean(url: str | None) -> str | None:
    return None if url is None else "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def record(page_id: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None, revisit: bool) -> bytes:
    """A response with its payload, or a revisit that keeps only the HTTP header."""
    http = _header([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))], "HTTP/1.1 200 OK")
    block = http if revisit else http + payload
    pairs = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:page:{page_id or ''}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Target-URI", _clean(url)), ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Refers-To", f"<urn:page:{refers_to}>" if revisit else None), ("WARC-Profile", PROFILE if revisit else None),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
    ]
    return _header(pairs, "WARC/1.1") + block + b"\r\n\r\n"


def fields(header: bytes) -> dict[str, str]:
    """Header lines after the first, by lower-case name."""
    lines = header.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}


class Inflated:
    """A gzip file's content in pieces, whether it is one member or many."""

    def __init__(self, source):
        self.source, self.inflate, self.raw, self.held = source, zlib.decompressobj(GZIP), b"", bytearray()

    def _more(self) -> bool:
        if self.inflate.eof:
            self.raw, self.inflate = self.inflate.unused_data + self.raw, zlib.decompressobj(GZIP)
        if not self.raw:
            self.raw = self.source.read(PIECE)
            if not self.raw:
                return False
        self.held += self.inflate.decompress(self.raw, PIECE)
        self.raw = self.inflate.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes:
        """What comes up to and with the mark; empty at the end."""
        seen = 0
        while (k := self.held.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.held)
            if not self._more():
                if self.held.strip():
                    raise ValueError("the archive ends inside a record")
                return b""
        out = bytes(self.held[: k + len(mark)])
        del self.held[: k + len(mark)]
        return out

    def take(self, n: int):
        """The next ``n`` bytes in pieces."""
        while n:
            if not self.held and not self._more():
                raise ValueError("the archive ends inside a record")
            piece = bytes(self.held[:n])
            del self.held[: len(piece)]
            n -= len(piece)
            if piece:
                yield piece


# -------------------------------------------------------------------- writing


def _manifest(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))


MANIFEST = "path string, records long, bytes long"


def decided(pages: DataFrame, id_col: str, url_col: str, html_col: str, least_bytes: int) -> DataFrame:
    """Pages with their payload's digest and, where payloads repeat, the smallest id of the group."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), html.alias("html"), F.sha1(html.cast("binary")).alias("sha1"))
    size = F.octet_length("html")
    groups = rows.filter(size >= least_bytes).groupBy("sha1").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    repeated, _ = pinned_if_small(groups.filter("n > 1").select("sha1", "first"))
    return rows.join(repeated, "sha1", "left").select("id", "url", "html", "sha1", "first", (F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))).alias("revisit"))


def write_archives(pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0) -> pa.Table:
    """Monolithic archives, one per task; the manifest has a row per file."""

    def write(batches):
        out = path = None
        n = size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    path = fresh(folder, f"mono-{TaskContext.get().partitionId():06d}") + ".warc.gz"
                    store, where = at(path)
                    out, press = store.open_output_stream(where, compression=None), zlib.compressobj(1, zlib.DEFLATED, GZIP)
                page_id, url, html, sha1, first, revisit = row
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                size += out.write(press.compress(record(page_id, url, html.encode(), digest, first, revisit)))
                n += 1
        if out is not None:
            size += out.write(press.flush())
            out.close()
            yield _manifest([{"path": path, "records": n, "bytes": size}])

    rows = decided(pages, id_col, url_col, html_col, least_bytes)
    rows = rows.select(F.col("id").cast("string"), "url", "html", "sha1", F.col("first").cast("string"), "revisit")
    return mapped(rows, write, MANIFEST).toArrow().sort_by("path")


def normalise_file(source, out, index) -> tuple[int, int]:
    """Rewrite an archive with a member per record; write a line of the index for each. Returns records and bytes."""
    content, offset, n = Inflated(source), 0, 0
    while header := content.until(b"\r\n\r\n"):
        names = fields(header)
        press, length = zlib.compressobj(6, zlib.DEFLATED, GZIP), 0
        length += out.write(press.compress(header))
        for piece in content.take(int(names["content-length"])):
            length += out.write(press.compress(piece))
        if b"".join(content.take(4)) != b"\r\n\r\n":
            raise ValueError("a record is longer than it says")
        length += out.write(press.compress(b"\r\n\r\n") + press.flush())
        line = {"offset": offset, "length": length, "type": names.get("warc-type"), "id": names.get("warc-record-id"), "digest": names.get("warc-payload-digest")}
        index.write(json.dumps(line).encode() + b"\n")
        offset, n = offset + length, n + 1
    return n, offset


def normalise(spark: SparkSession, manifest: pa.Table, folder: str) -> pa.Table:
    """Every archive of the manifest with a member per record, and ``.index`` beside it."""

    def rewrite(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, where = at(path)
                new = fresh(folder, "member") + ".warc.gz"
                target, there = at(new)
                with store.open_input_stream(where, compression=None) as source, target.open_output_stream(there, compression=None) as out, target.open_output_stream(there + ".index") as index:
                    n, size = normalise_file(source, out, index)
                yield _manifest([{"path": new, "records": n, "bytes": size}])

    files = one_task_each(manifest, lambda t: spark.createDataFrame(t, MANIFEST))
    return mapped(files, rewrite, MANIFEST).toArrow().sort_by("path")


# -------------------------------------------------------------------- reading


def read_member(raw: bytes) -> dict:
    """What one member says of its page; digests of responses are taken from the payload itself."""
    text = zlib.decompress(raw, GZIP)
    header, _, rest = text.partition(b"\r\n\r\n")
    names = fields(header)
    block = rest[: int(names["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size, kind = int(fields(http)["content-length"]), names["warc-type"]
    digest = names["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response":
        if len(payload) != size:
            raise ValueError("a payload is not as long as its header says")
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    ident = lambda x: x and (x.removeprefix("<urn:page:").removesuffix(">") or None)
    return {"page_id": ident(names["warc-record-id"]), "payload_bytes": size, "payload_digest": digest, "record_type": kind, "refers_to": ident(names.get("warc-refers-to"))}


ROW = pa.schema([("page_id", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string())])


def read_archives(spark: SparkSession, manifest: pa.Table) -> DataFrame:
    """One row per record of normalised archives, each opened at the place its index gives."""

    def read(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, where = at(path)
                rows = []
                with store.open_input_stream(where + ".index") as lines:
                    index = [json.loads(x) for x in lines.read().splitlines()]
                with store.open_input_file(where) as source:
                    for line in index:
                        source.seek(line["offset"])
                        rows.append(read_member(source.read(line["length"])))
                        if len(rows) == 5_000:
                            yield pa.RecordBatch.from_pylist(rows, ROW)
                            rows = []
                yield pa.RecordBatch.from_pylist(rows, ROW)

    files = one_task_each(manifest, lambda t: spark.createDataFrame(t, MANIFEST))
    return mapped(files, read, "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string")


def archived(pages: DataFrame, id_col: str = "page_id", **options) -> DataFrame:
    """Write, normalise and read back ``pages``."""
    spark, kind = pages.sparkSession, pages.schema[id_col].dataType
    mono = write_archives(pages, shared_dir(spark, "warc-mono"), id_col=id_col, **options)
    out = read_archives(spark, normalise(spark, mono, shared_dir(spark, "warc")))
    return out.withColumns({"page_id": F.col("page_id").cast(kind), "refers_to": F.col("refers_to").cast(kind)})


ORACLE = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS s FROM pages),
g AS (SELECT s, min(page_id) AS first FROM p GROUP BY s)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        ((('0x' || substr(s, CAST(k // 4 * 5 + 1 AS INT), 5))::INT >> CAST(15 - k % 4 * 5 AS INT)) & 31) + 1, 1)), '') AS payload_digest,
    CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id IS NOT DISTINCT FROM first THEN NULL ELSE first END AS refers_to
FROM p JOIN g USING (s)
"""
