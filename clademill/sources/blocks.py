"""Block-gzipped text, read in splits: a .gz file of small members that tell their length (BGZF), so that a large file isn't one task.

A split finds the first block that begins in its range of bytes, by the members' fixed head and a second head where the first one ends. It has the lines that
begin in its blocks' text: what is before the first line end belongs to the split before, and the last line is read on into the blocks of the next one.

Cases: plain gzip files, small files, and files on file systems that Arrow doesn't know are left to Spark's reader, a task each; an empty block, as at a file's end or
where files were put together, has no text; a last line without an end is a line; a range without a block, or in the midst of a line, has none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: The head of a block, and a file's last one.
HEAD, HEAD_BYTES = b"\x1f\x8b\x08\x04", 18
LAST = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
#: Bytes of text in a block that is written, and what Arrow opens.
TEXT_BYTES, SCHEMES = 0xFF00, ("file", "hdfs", "s3", "gs", "abfs")


def _head(spark: SparkSession, path: str, more_than: int) -> tuple[bytes, int]:
    """A file's first bytes, if it is larger, and its length."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    length = system.getFileStatus(where).getLen()
    if length <= more_than:
        return b"", length
    stream = system.open(where)
    try:
        head = [stream.read() for _ in range(HEAD_BYTES)]
    finally:
        stream.close()
    return bytes(x for x in head if x >= 0), length


def lengths(spark: SparkSession, folder: str) -> list[int]:
    """Bytes of the block-gzipped files in a folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    return [s.getLen() for s in found if s.getPath().getName().endswith(".gz")]


def is_blocked(head: bytes) -> bool:
    return len(head) == HEAD_BYTES and head.startswith(HEAD) and head[12:16] == b"BC\x02\x00"


def split_ranges(spark: SparkSession, files: list[str], size: int) -> list[tuple[str, int, int]]:
    """(file, start, end) of the block-gzipped ones among files that are larger than size."""
    out = []
    for f in files:
        if f.endswith(".gz") and f.split(":", 1)[0] in SCHEMES:
            head, length = _head(spark, f, size)
            if is_blocked(head):
                out += [(f, at, min(at + size, length)) for at in range(0, length, size)]
    return out


def read_blocks(spark: SparkSession, ranges: list[tuple[str, int, int]]) -> DataFrame:
    """(file, block, m, value): lines of ranges, m their order in the range that starts at block; a task a range."""

    def read(batches):
        import zlib

        import pyarrow as pa
        from pyarrow import fs

        def size_of(head):
            ok = len(head) == 18 and head[:4] == b"\x1f\x8b\x08\x04" and head[12:16] == b"BC\x02\x00"
            return int.from_bytes(head[16:18], "little") + 1 if ok else 0

        def lines(path, start, end):
            uri = path if "://" in path else path.replace(":/", ":///", 1)
            system, at = fs.FileSystem.from_uri(uri)
            with system.open_input_file(at) as f:
                length = f.size()

                def head(pos):
                    return f.read_at(18, pos) if pos + 18 <= length else b""

                def first():
                    pos = start
                    while pos < end:
                        piece = f.read_at(min(1 << 17, length - pos), pos)
                        k = piece.find(b"\x1f\x8b\x08\x04")
                        if k < 0:
                            pos += max(1, len(piece) - 3)
                            continue
                        size = size_of(head(pos + k))
                        if size and (pos + k + size == length or size_of(head(pos + k + size))):
                            return pos + k
                        pos += k + 1
                    return end

                def texts(pos, stop):
                    while pos < stop:
                        size = size_of(head(pos))
                        if not size:
                            raise OSError(f"{path}: no block at {pos}")
                        yield pos + size, zlib.decompress(f.read_at(size, pos), 31)
                        pos += size

                at, left, begun = first(), b"", start == 0
                if at >= end:
                    return
                for at, text in texts(at, end):
                    if not begun:  # the line began in the range before
                        k = text.find(b"\n")
                        if k < 0:
                            continue
                        text, begun = text[k + 1 :], True
                    *whole, left = (left + text).split(b"\n")
                    yield from whole
                if begun:  # also where the range ends with a line: the next one leaves out what is before its first line end
                    for _, text in texts(at, length):
                        k = text.find(b"\n")
                        left += text if k < 0 else text[:k]
                        if k >= 0:
                            yield left
                            return
                    if left:
                        yield left

        def batch(path, start, n, values):
            return pa.RecordBatch.from_pydict({"file": pa.array([path] * len(values), pa.string()), "block": pa.array([start] * len(values), pa.int64()), "m": pa.array(range(n, n + len(values)), pa.int64()), "value": pa.array(values, pa.string())})

        for rows in batches:
            for r in rows.to_pylist():
                n, held, size = 0, [], 0
                for line in lines(r["file"], r["start"], r["end"]):
                    held.append(line.removesuffix(b"\r").decode("utf-8", "replace"))
                    size += len(line)
                    if size > 1 << 22:
                        yield batch(r["file"], r["start"], n, held)
                        n, held, size = n + len(held), [], 0
                yield batch(r["file"], r["start"], n, held)

    rows = spark.createDataFrame(ranges, "file string, start long, end long").coalesce(1).repartition(max(1, len(ranges)))
    return rows.mapInArrow(read, "file string, block long, m long, value string")


def write_blocks(lines: DataFrame, folder: str) -> None:
    """Lines (a column of text) as block-gzipped files part-<k>.txt.gz of an existing folder that Arrow can write to, a file a partition, in order."""
    uri = folder.rstrip("/") if "://" in folder else folder.rstrip("/").replace(":/", ":///", 1)

    def write(batches):
        import struct
        import uuid
        import zlib

        import pyarrow as pa
        from pyarrow import fs
        from pyspark import TaskContext

        system, at = fs.FileSystem.from_uri(uri) if ":/" in uri else (fs.LocalFileSystem(), uri)
        name = f"{at}/part-{TaskContext.get().partitionId():05}.txt.gz"
        own = f"{at}/.{uuid.uuid4().hex}"

        def block(text):
            pack = zlib.compressobj(6, zlib.DEFLATED, -15)
            body = pack.compress(text) + pack.flush()
            return struct.pack("<4s4x2BHBBHH", b"\x1f\x8b\x08\x04", 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(text), len(text))

        n, held = 0, b""
        with system.open_output_stream(own, compression=None) as out:
            for b in batches:
                values = b.column(0).to_pylist()
                n += len(values)
                held += "".join(f"{v}\n" for v in values if v is not None).encode()
                whole = len(held) // 0xFF00 * 0xFF00
                for k in range(0, whole, 0xFF00):
                    out.write(block(held[k : k + 0xFF00]))
                held = held[whole:]
            if held:
                out.write(block(held))
            out.write(bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000"))
        system.move(own, name)
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    lines.mapInArrow(write, "n long").count()
