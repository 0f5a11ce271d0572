"""WARC archives: one gzip member per record, read sequentially with incremental decompression.

Tasks write their own archives into a shared folder and report them in a manifest; archives of attempts that failed
are in no manifest and are never read. Readers take one archive each, decompress it piece by piece, cut records by
their Content-Length and verify payloads against their digests, holding one record at most.
"""

from __future__ import annotations

import hashlib
import io
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scratch import scratch_dir
from .common import rows_of, stage

#: A task begins a new archive once the present one has so many bytes.
ARCHIVE_BYTES = 64_000_000
#: Equal payloads of fewer bytes are stored again.
REVISIT_BYTES = 100
#: Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = b"\r\n"


@dataclass
class Record:
    headers: dict[str, str]
    http: dict[str, str]
    length: int
    digest: str
    payload: bytes | None


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page {page_id}')}>"


def _one_line(value: str) -> str:
    """Control signs percent-encoded, so that a value can't end its header."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def encode_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str, level: int) -> bytes:
    """One record as a gzip member. A revisit has the response's HTTP headers but no payload."""
    kind = "response" if refers_to is None else "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if refers_to is None else b"")
    headers = {"WARC-Type": kind, "WARC-Record-ID": _record_id(page_id), "WARC-Date": date, "WARC-Payload-Digest": f"sha256:{digest}"}
    if page_id is not None:
        headers["Page-ID"] = str(page_id)
    if url is not None:
        headers["WARC-Target-URI"] = _one_line(url)
    if refers_to is not None:
        headers |= {"WARC-Profile": PROFILE, "WARC-Refers-To": _record_id(refers_to), "Refers-To-Page-ID": str(refers_to)}
    headers |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    head = VERSION + CRLF + b"".join(f"{k}: {v}\r\n".encode() for k, v in headers.items()) + CRLF
    gz = zlib.compressobj(level, zlib.DEFLATED, 31)
    return gz.compress(head) + gz.compress(block) + gz.compress(CRLF + CRLF) + gz.flush()


def _fields(lines: list[bytes]) -> dict[str, str]:
    return {k.decode().strip(): v.decode().strip() for k, _, v in (line.partition(b":") for line in lines if line)}


def _members(pieces: Iterable[bytes]) -> Iterator[Iterator[bytes]]:
    """Each gzip member as an iterator of decompressed bytes; a member must be used up before the next is taken."""
    source, rest = iter(pieces), b""

    def member() -> Iterator[bytes]:
        nonlocal rest
        unzip = zlib.decompressobj(31)
        while not unzip.eof:
            piece = rest or next(source, b"")
            if not piece:
                raise ValueError("an archive ends within a gzip member")
            rest = b""
            while piece and not unzip.eof:
                yield unzip.decompress(piece, 1 << 20)
                piece = unzip.unconsumed_tail
        rest = unzip.unused_data

    while True:
        rest = rest or next(source, b"")
        if not rest:
            return
        yield member()


def read_records(pieces: Iterable[bytes], keep: bool = True) -> Iterator[Record]:
    """Records of an archive given in pieces. Payloads are hashed as they come, and held only if ``keep``."""
    for member in _members(pieces):
        buffer = b""

        def head() -> list[bytes]:
            nonlocal buffer
            while (end := buffer.find(CRLF + CRLF)) < 0:
                piece = next(member, None)
                if piece is None:
                    raise ValueError("a record ends within its headers")
                buffer += piece
            lines, buffer = buffer[:end].split(CRLF), buffer[end + 4 :]
            return lines

        first, *lines = head()
        if not first.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {first[:40]!r}")
        headers = _fields(lines)
        left = int(headers["Content-Length"])
        # The block's own headers count towards its length.
        http: dict[str, str] = {}
        if headers.get("Content-Type", "").startswith("application/http"):
            before = len(buffer)
            while buffer.find(CRLF + CRLF) < 0:
                piece = next(member, None)
                if piece is None:
                    raise ValueError("a record ends within its block")
                buffer += piece
                before += len(piece)
            http = _fields(head()[1:])
            left -= before - len(buffer)
        if left < 0:
            raise ValueError("Content-Length is shorter than the block's headers")
        held, sha, length = io.BytesIO(), hashlib.sha256(), left
        while True:
            part, buffer = buffer[:left], buffer[left:]
            sha.update(part)
            if keep:
                held.write(part)
            left -= len(part)
            if not left:
                break
            buffer = next(member, None)
            if buffer is None:
                raise ValueError("a record is shorter than its Content-Length")
        buffer += b"".join(member)
        if buffer != CRLF + CRLF:
            raise ValueError("a record is longer than its Content-Length")
        yield Record(headers, http, length, sha.hexdigest(), held.getvalue() if keep else None)


def _writer(folder: str, date: str, level: int, archive_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pa.fs.FileSystem.from_uri(folder)
        fs.create_dir(root)
        out, path, size, count = None, "", 0, 0
        done: list[tuple[str, int, int]] = []
        for ids, urls, pages, digests, refers in rows_of(batches, "page_id", "url", "html", "digest", "refers_to"):
            for page_id, url, html, digest, to in zip(ids, urls, pages, digests, refers):
                if out is None:
                    path, size, count = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(path, compression=None)
                member = encode_record(page_id, url, (html or "").encode(), digest, to, date, level)
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= archive_bytes:
                    out.close()
                    done.append((path, count, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, count, size))
        names = ["archive", "records", "bytes"]
        yield pa.RecordBatch.from_pydict({n: [d[i].rpartition("/")[2] if not i else d[i] for d in done] for i, n in enumerate(names)}, pa.schema(zip(names, (pa.string(), pa.int64(), pa.int64()))))

    return write


def write_archives(pages: DataFrame, folder: str | None = None, date: str = "1970-01-01T00:00:00Z", level: int = 6, archive_bytes: int = ARCHIVE_BYTES, revisit_bytes: int = REVISIT_BYTES) -> tuple[str, DataFrame]:
    """Write page_id, url and html as WARC records; the folder and its manifest (archive, records, bytes).

    Of records with equal payloads of at least ``revisit_bytes``, those with the smallest page_id are responses and
    the others revisit it. A null html is an empty payload, a null url leaves out the target, a null page_id leaves
    out the page's id and never is the one revisited. Repeated rows give a record each; an empty table gives an empty manifest.
    The pages themselves are shuffled only where the table of repeated payloads is too large to broadcast.
    """
    spark = pages.sparkSession
    folder = folder or scratch_dir(spark, "warc")
    body = F.coalesce(F.col("html"), F.lit(""))
    given = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha2(body, 256).alias("digest"))
    alike = given.filter(F.octet_length("html") >= revisit_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    alike = stage(alike.filter("n > 1").select(F.col("digest").alias("of"), "first"), "payloads")
    linked = given.join(alike, F.col("digest") == F.col("of"), "left")
    linked = linked.withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))).select("page_id", "url", "html", "digest", "refers_to")
    written = linked.mapInArrow(_writer(folder, date, level, archive_bytes), "archive string, records long, bytes long")
    return folder, stage(written, "manifest")


def _reader(folder: str, keep: bool):
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("verified", pa.bool_())])
    names = schema.names

    def row(r: Record) -> tuple:
        said = r.headers.get("WARC-Payload-Digest", "").removeprefix("sha256:")
        kind = r.headers["WARC-Type"]
        number = lambda k: int(r.headers[k]) if k in r.headers else None
        full = kind != "revisit"
        text = r.payload.decode() if keep and full else None
        length = r.length if full else int(r.http["Content-Length"])
        return number("Page-ID"), r.headers.get("WARC-Target-URI"), text, length, r.digest if full else said, kind, number("Refers-To-Page-ID"), r.digest == said if full else None

    def pieces(stream) -> Iterator[bytes]:
        while piece := stream.read(1 << 20):
            yield piece

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], schema.field(i).type) for i in range(len(names))], schema=schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pa.fs.FileSystem.from_uri(folder)
        for (archives,) in rows_of(batches, "archive"):
            for archive in archives:
                rows, held = [], 0
                with fs.open_input_stream(f"{root}/{archive}", compression=None) as stream:
                    for record in read_records(pieces(stream), keep):
                        rows.append(row(record))
                        held += len(record.payload or b"")
                        if len(rows) >= 5_000 or held >= 16_000_000:
                            yield batch(rows)
                            rows, held = [], 0
                yield batch(rows)

    return read


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame, keep: bool = True) -> DataFrame:
    """One row per record: page_id, url, payload (null for revisits, or if not ``keep``), payload_bytes, payload_digest
    (of the payload read; of revisits the one they state), record_type, refers_to, verified (null for revisits).

    Broken framing raises; a payload that doesn't match its digest has verified false. Each archive is one task.
    """
    archives = manifest.select("archive").repartition(max(1, manifest.count()))
    return archives.mapInArrow(
        _reader(folder, keep),
        "page_id long, url string, payload string, payload_bytes long, payload_digest string, record_type string, refers_to long, verified boolean",
    )
