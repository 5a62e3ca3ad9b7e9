"""WARC archives: written from tasks, read back record by record.

Each record is a gzip member of its own. The reader keeps one chunk of compressed bytes and one decompressor, frames
blocks by their Content-Length and verifies block and payload digests. Records of equal payloads are written once as
a response; the others are revisit records that hold the HTTP headers only and refer to it.

Cases: a null html is an empty payload, a null url gives a record without target; of pages with equal payloads, the
response is the one with the largest page_id, and rows that repeat that page_id are responses too (so ties stay ties); very long payloads are
inflated and digested chunk by chunk, but held whole as one row's text; an empty table gives no archives and no rows; extra columns are not carried.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import fresh_path, saved

#: An archive is closed at this many compressed bytes; bytes read at once.
ARCHIVE_BYTES, CHUNK = 64 << 20, 1 << 16
_ID, _DATE = "urn:page:", "1970-01-01T00:00:00Z"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, payload_digest: str, refers_to: int | None, revisit: bool, date: str = _DATE) -> bytes:
    """One WARC record, not compressed."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if not revisit:
        block += payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{_ID}{page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in url))
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{_ID}{refers_to}>"]
    head += [f"WARC-Payload-Digest: sha1:{payload_digest}", f"WARC-Block-Digest: sha1:{digest(block)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def members(stream) -> Iterator[bytes]:
    """The gzip members of a stream, each decompressed piece by piece as its bytes come in."""
    data = stream.read(CHUNK)
    while data:
        unzip, parts = zlib.decompressobj(31), []
        while True:
            parts.append(unzip.decompress(data))
            if unzip.eof:
                break
            data = stream.read(CHUNK)
            if not data:
                raise ValueError("the archive ends inside a record")
        yield b"".join(parts)
        data = unzip.unused_data or stream.read(CHUNK)


def _headers(lines: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines.decode().split("\r\n")[1:])}


def parsed(member: bytes) -> dict:
    """Headers, HTTP headers and payload of a record; ValueError if length or a digest doesn't hold."""
    at = member.find(b"\r\n\r\n")
    if not member.startswith(b"WARC/1.") or at < 0:
        raise ValueError("not a WARC record")
    head = _headers(member[:at])
    n = int(head["content-length"])
    block = member[at + 4 : at + 4 + n]
    if len(block) != n or member[at + 4 + n :] != b"\r\n\r\n":
        raise ValueError("the block is not as long as Content-Length says")
    if "warc-block-digest" in head and head["warc-block-digest"] != f"sha1:{digest(block)}":
        raise ValueError("the block digest does not hold")
    http, _, payload = block.partition(b"\r\n\r\n")
    if head["warc-type"] == "response" and head.get("warc-payload-digest") != f"sha1:{digest(payload)}":
        raise ValueError("the payload digest does not hold")
    return {"head": head, "http": _headers(http), "payload": payload}


def records(path: str) -> Iterator[dict]:
    """parsed() records of an archive at a path or URI, in order."""
    from pyarrow import fs

    system, where = fs.FileSystem.from_uri(path)
    with system.open_input_stream(where, compression=None) as stream:
        for member in members(stream):
            yield parsed(member)


def with_revisits(pages: DataFrame, min_bytes: int = 0, hot_parts: int = 1000) -> DataFrame:
    """(page_id, url, payload, sha1, response_id): response_id is null for a page that is its own response.

    Payloads are grouped by digest and length. A digest with over 1 / hot_parts of all rows is hot; there are fewer than
    hot_parts of those, which is the bound of the broadcast. The others are joined by a shuffle, for which rows
    already matched get a key of their own, so that no key holds over 1 / hot_parts of the rows.
    """
    rows = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload")).withColumn("n_bytes", F.octet_length("payload"))
    groups = rows.filter(F.col("n_bytes") >= min_bytes).groupBy("sha1", "n_bytes").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n"))
    groups = saved(groups.filter("n > 1"), "warc-groups")
    least = max(2, pages.count() // hot_parts)
    hot = groups.filter(F.col("n") > least).select("sha1", "n_bytes", F.struct("last").alias("hot"))
    cold = groups.filter(F.col("n") <= least).select(F.concat_ws(":", "sha1", "n_bytes").alias("key"), F.col("last").alias("cold"))
    rows = rows.join(F.broadcast(hot), ["sha1", "n_bytes"], "left")
    rows = rows.withColumn("key", F.when(F.col("hot").isNull(), F.concat_ws(":", "sha1", "n_bytes")).otherwise(F.concat(F.lit("page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))))
    rows = rows.join(cold, "key", "left").withColumn("last", F.coalesce(F.col("hot")["last"], F.col("cold")))
    return rows.select("page_id", "url", "payload", "sha1", F.when(~F.col("last").eqNullSafe(F.col("page_id")), F.col("last")).alias("response_id"))


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, level: int = 6) -> DataFrame:
    """Write the rows of with_revisits() to .warc.gz files in the folder; (path, records) of the finished ones.

    A task that is run again writes under new names; only files that the returned table names count.
    """

    def write(batches):
        import pyarrow as pa
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        out, name, size, count = None, "", 0, 0
        paths, counts = [], []
        for batch in batches:
            for page_id, url, payload, sha1, response in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "sha1", "response_id")), strict=True):
                if out is None:
                    name, size, count = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                zipped = zlib.compressobj(level, zlib.DEFLATED, 31)
                raw = record(page_id, url, payload, base64.b32encode(bytes.fromhex(sha1)).decode(), response, response is not None)
                data = zipped.compress(raw) + zipped.flush()
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= archive_bytes:
                    out.close()
                    paths.append(f"{folder}/{name}"), counts.append(count)
                    out = None
        if out is not None:
            out.close()
            paths.append(f"{folder}/{name}"), counts.append(count)
        yield pa.RecordBatch.from_pydict({"path": pa.array(paths, pa.string()), "records": pa.array(counts, pa.int64())})

    return saved(pages.mapInArrow(write, "path string, records long"), "warc-manifest")


def read_archives(manifest: DataFrame) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of every record in the archives."""

    def read(batches):
        import pyarrow as pa

        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

        def page(ref: str | None):
            found = (ref or "").strip("<>").removeprefix(_ID)
            return int(found) if found not in ("", "None") else None

        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows = []
                for r in records(path):
                    h = r["head"]
                    rows.append((page(h["warc-record-id"]), h.get("warc-target-uri"), int(r["http"]["content-length"]), h["warc-payload-digest"].removeprefix("sha1:"), h["warc-type"], page(h.get("warc-refers-to"))))
                    if len(rows) == 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    paths = manifest.select("path")
    n = paths.count()
    return paths.repartition(max(1, n)).mapInArrow(read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archived(pages: DataFrame, min_bytes: int = 0, folder: str | None = None, **options) -> DataFrame:
    """Write all pages to archives in the folder (a new one in the shared folder by default) and read them back."""
    folder = folder or fresh_path(pages.sparkSession, "warc")
    return read_archives(write_archives(with_revisits(pages, min_bytes), folder, **options))
