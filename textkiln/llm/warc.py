"""WARC archives of page captures, and the assembly of captures from their records.

A capture is written as three records: the request, the response (or a revisit that refers to the response of
equal payload) and metadata; request and metadata name the response record in WARC-Concurrent-To. Reading
joins the three by that identifier and gives one nested row per capture. Only what the headers say, sizes and digests are
shuffled for that; payloads are read again by their place in the archives, and only where they are asked for.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from contextlib import ExitStack

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textkiln.llm.common import batch_of, slices, text_batches
from textkiln.llm.files import atomic_writer, attempt_name, deal, reader
from textkiln.operators.storage import materialize

#: Payloads that occur twice or more are broadcast up to this count (about 20 MB), and joined by a shuffle beyond it.
BROADCAST_PAYLOADS = 100_000

SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = b"\r\n"


def record_id(kind: str, page_id: int | None, uri: str | None, sha: str, tag: str = "") -> str:
    """Of the payload's digest too: captures of one page and url with other payloads are other captures."""
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'{kind}/{page_id}/{sha}/{tag}/' + repr(uri))}>"


def one_line(value: str) -> str:
    """A header value: control characters and what isn't UTF-8 text of one line are percent-encoded."""
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in value)


def record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A gzip member of one record."""
    lines = [("WARC-Type", kind), *headers, ("Content-Length", str(len(block)))]
    head = b"WARC/1.1" + CRLF + b"".join(f"{k}: {v}".encode() + CRLF for k, v in lines) + CRLF
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(head + block + CRLF + CRLF) + packer.flush()


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def capture_records(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, refers_id: str | None = None, tag: str = "") -> Iterator[bytes]:
    """The records of one capture; with ``refers_to`` a revisit without payload. ``tag`` tells repeated captures apart."""
    uri, sha = one_line(url or ""), digest(payload)
    own = record_id("response", page_id, url, sha, tag)
    date = [("WARC-Date", DATE), ("WARC-Target-URI", uri)]
    host = uri.partition("://")[2].split("/")[0].split("?")[0].split("#")[0]
    target = "/" + uri.partition("://")[2].partition("/")[2]
    yield record("request", [("WARC-Record-ID", record_id("request", page_id, url, sha, tag)), *date, ("WARC-Concurrent-To", own), ("Content-Type", "application/http; msgtype=request")], f"GET {target} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode())
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    common = [("WARC-Record-ID", own), *date, ("WARC-Payload-Digest", f"sha1:{sha}"), ("Content-Type", "application/http; msgtype=response")]
    if refers_to is None:
        yield record("response", common, http + payload)
    else:
        yield record("revisit", [*common, ("WARC-Profile", REVISIT), *[("WARC-Refers-To", refers_id)] * (refers_id is not None)], http)
    fields = [("page-id", "" if page_id is None else str(page_id)), ("payload-bytes", str(len(payload)))] + [("refers-to-page-id", str(refers_to))] * (refers_to is not None)
    yield record("metadata", [("WARC-Record-ID", record_id("metadata", page_id, url, sha, tag)), *date, ("WARC-Concurrent-To", own), ("Content-Type", "application/warc-fields")], b"".join(f"{k}: {v}\r\n".encode() for k, v in fields))


def members(stream, size: int = 1 << 20) -> Iterator[bytes]:
    """The decompressed gzip members of a stream, one after the other; a torn last member is left out."""
    unpacker, parts = zlib.decompressobj(31), []
    while data := stream.read(size):
        while data:
            parts.append(unpacker.decompress(data))
            data = b""
            if unpacker.eof:
                yield b"".join(parts)
                data, unpacker, parts = unpacker.unused_data, zlib.decompressobj(31), []


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(CRLF + CRLF)
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        k, _, v = line.partition(":")
        fields[k.strip().lower()] = v.strip()
    n = int(fields.get("content-length", "0"))
    return fields, rest[:n]


FILES = pa.schema([("path", pa.string()), ("n_captures", pa.int64()), ("bytes", pa.int64())])
FILES_DDL = "path string, n_captures long, bytes long"


def write_archives(pages: DataFrame, folder: str, *, least: int = 0, file_bytes: int = 256 << 20) -> DataFrame:
    """Write pages (page_id, url, html) as archives in ``folder``: one row per file (path, n_captures, bytes).

    Of records with equal payloads of at least ``least`` bytes the one with the largest page_id is the response and the
    others revisit it; rows that share that page_id are all responses. A null html is an empty payload, a null
    url an empty URI; rows of a null page_id are revisits of a group that has an id, else responses. Repeated rows
    are captures of their own, an empty table gives no file. A very long html is one record. Other columns, whatever their
    names, are not read. The pages are shuffled only if more than BROADCAST_PAYLOADS payloads occur twice or more, and
    then a hot payload is split as any skewed join.
    """
    rows = text_batches(pages).select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1("html"))
    same = rows.where(F.octet_length("html") >= least).groupBy("sha", "page_id", "url").agg(F.count("*").alias("n"))
    first = same.groupBy("sha").agg(F.sum("n").alias("n"), F.max(F.struct("page_id", "url", F.col("n").alias("rows"))).alias("r"))
    first = first.where("n > 1").select(F.col("sha").alias("s"), F.col("r.page_id").alias("to_id"), F.col("r.url").alias("to_url"), (F.col("r.rows") == 1).alias("sole"))
    first = materialize(first, "warc-first")
    few = first.limit(BROADCAST_PAYLOADS + 1).count() <= BROADCAST_PAYLOADS
    dealt = rows.join(F.broadcast(first) if few else first.hint("merge"), rows["sha"] == first["s"], "left").select("page_id", "url", "html", "to_id", "to_url", "sole")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, file = TaskContext.get().partitionId(), 0, 0
        rows = (r for batch in slices(batches, "html", 4 << 20) for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        row = next(rows, None)
        while row is not None:
            n, size, name = 0, 0, attempt_name("captures", file, ".warc.gz")
            with ExitStack() as open_:
                stream = open_.enter_context(atomic_writer(folder, name))
                while row is not None and size < file_bytes:
                    page_id, url, html, to_id, to_url, sole = row
                    seen += 1
                    refers, payload = None if to_id == page_id else to_id, html.encode()
                    known = len(payload) >= least if sole is None else sole and (page_id, url) == (to_id, to_url)  # alone with its payload, or the one that others refer to
                    to = record_id("response", to_id, to_url, digest(payload)) if sole else None
                    for x in capture_records(page_id, url, payload, refers, to, "" if known else f"{part}/{seen}"):
                        size += stream.write(x)
                    n, row = n + 1, next(rows, None)
            yield batch_of(FILES, [[f"{folder}/{name}"], [n], [size]])
            file += 1

    return materialize(dealt.mapInArrow(run, FILES_DDL), "warc-files")


def list_archives(spark: SparkSession, pattern: str) -> DataFrame:
    """Paths of archives by a Spark path pattern; contents are not read."""
    return spark.read.format("binaryFile").load(pattern).select("path")


HEADERS = (("capture", "warc-concurrent-to"), ("record_id", "warc-record-id"), ("kind", "warc-type"), ("uri", "warc-target-uri"), ("date", "warc-date"), ("digest", "warc-payload-digest"), ("refers_to", "warc-refers-to"))
RECORDS = pa.schema(
    [("path", pa.string()), ("position", pa.int64()), *[(name, pa.string()) for name, _ in HEADERS], ("fields", pa.map_(pa.string(), pa.string())), ("payload_bytes", pa.int64()), ("payload_sha1", pa.string())]
)
RECORDS_DDL = "path string, position long, " + ", ".join(f"{name} string" for name, _ in HEADERS) + ", fields map<string, string>, payload_bytes long, payload_sha1 string"


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    """What follows the HTTP header, however long it is; of a block without one all, and of a header without end nothing."""
    if headers.get("content-type", "").replace(" ", "").startswith("application/http"):
        return block.partition(CRLF + CRLF)[2]
    return block


def fields_of(block: bytes) -> dict[str, str]:
    """Lines of application/warc-fields; of a repeated name the last."""
    pairs = (line.partition(":") for line in block.decode("utf-8", "replace").split("\r\n"))
    return {k.strip(): v.strip() for k, _, v in pairs if k.strip()}


def _records(path: str) -> Iterator[tuple[int, dict[str, str], bytes]]:
    with reader(path) as stream:
        for position, raw in enumerate(members(stream)):
            yield position, *parse(raw)


def read_records(files: DataFrame) -> DataFrame:
    """One row per WARC record of the archives in ``files`` (path), without its block.

    ``capture`` is the response's record id, ``path`` and ``position`` are the record's place, ``fields`` the lines of
    a metadata record (null for others); payload_bytes and payload_sha1 (base32) are measured on the payload read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path in (p for batch in batches for p in batch.column("path").to_pylist()):
            rows = []
            for position, h, block in _records(path):
                payload = payload_of(h, block)
                fields = list(fields_of(block).items()) if h.get("content-type") == "application/warc-fields" else None
                names = [h.get(name) for _, name in HEADERS]
                names[0] = names[0] or names[1]
                rows.append((path, position, *names, fields, len(payload), digest(payload)))
                if len(rows) >= 2048:
                    yield batch_of(RECORDS, [list(c) for c in zip(*rows, strict=True)])
                    rows = []
            if rows:
                yield batch_of(RECORDS, [list(c) for c in zip(*rows, strict=True)])

    return deal(files.select("path")).mapInArrow(run, RECORDS_DDL)


PAYLOADS = pa.schema([("path", pa.string()), ("position", pa.int64()), ("payload", pa.binary())])


def read_payloads(files: DataFrame) -> DataFrame:
    """(path, position, payload) of the response records of ``files`` (path)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path in (p for batch in batches for p in batch.column("path").to_pylist()):
            rows, held = [], 0
            for position, h, block in _records(path):
                if h.get("warc-type") == "response":
                    rows.append((path, position, payload_of(h, block)))
                    held += len(rows[-1][2])
                if held > 4 << 20:
                    yield batch_of(PAYLOADS, [list(c) for c in zip(*rows, strict=True)])
                    rows, held = [], 0
            if rows:
                yield batch_of(PAYLOADS, [list(c) for c in zip(*rows, strict=True)])

    return deal(files.select("path")).mapInArrow(run, "path string, position long, payload binary")


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: capture id, structs response, request and metadata (first by record id), and counts of records.

    A record whose concurrent-to names no response in the input still gives a row, with a null response. Records without
    an id are ordered last; equal ones, as of an archive that is listed twice, by their place. Aggregated before
    it is shuffled, so a hot identifier costs a row a task.
    """
    body = F.struct(*[c for c in records.columns if c != "capture"])
    role = F.when(F.col("kind").isin("response", "revisit"), "response").otherwise(F.col("kind"))
    order = F.struct(F.col("record_id").isNull(), "record_id", "path", "position")
    pick = lambda name: F.min_by(F.when(role == name, body), F.when(role == name, order)).alias(name)
    return records.groupBy("capture").agg(pick("response"), pick("request"), pick("metadata"), F.count("*").alias("n_records"))


def captures(files: DataFrame, *, payload: bool = False) -> DataFrame:
    """A nested row per capture of our archives: page_id, url, response, request, metadata, digests and what a revisit refers to.

    With ``payload`` also the response's payload (null for revisits), read again by its place. An empty list of files gives no rows.
    """
    field = lambda name: F.nullif(F.element_at("metadata.fields", name), F.lit(""))
    response = F.col("response.kind") == "response"
    out = assemble(read_records(files)).select(
        "capture", "response", "request", "metadata", "n_records", field("page-id").cast("long").alias("page_id"), F.col("response.uri").alias("url"), F.col("response.kind").alias("record_type"),
        F.when(response, F.col("response.payload_bytes")).otherwise(field("payload-bytes").cast("long")).alias("payload_bytes"),
        F.substring_index("response.digest", ":", -1).alias("payload_digest"), (F.substring_index("response.digest", ":", -1) == F.when(response, F.col("response.payload_sha1"))).alias("digest_holds"),
        field("refers-to-page-id").cast("long").alias("refers_to"),
    )
    if not payload:
        return out
    found = read_payloads(files)
    return out.join(found, (F.col("response.path") == found["path"]) & (F.col("response.position") == found["position"]), "left").drop("path", "position")
