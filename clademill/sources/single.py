"""Named single files out of the parts that Spark writes, without one task that writes all rows.

Parts are written in parallel, in order. A file system that can (HDFS) strings them together by their blocks; elsewhere a task for each file copies bytes, which are not
parsed or compressed again: gzip members one after another are a gzip file. Nothing goes through the driver but names.

Cases: a file without parts is empty (one empty member if it is named .gz); a task that is run again writes a file of its own and renames it; file systems
that neither append blocks nor are known to Arrow are an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .provenance import _file, exists


def part_files(spark: SparkSession, folder: str) -> list[str]:
    """Spark's part files in a folder, in order; without empty ones."""
    system, where = _file(spark, folder)
    found = [(s.getPath().getName(), s.getPath().toString(), s.getLen()) for s in system.listStatus(where)] if system.exists(where) else []
    return [path for name, path, size in sorted(found) if name.startswith("part-") and size]


def _appended(spark: SparkSession, target: str, parts: list[str]) -> bool:
    """Whether the file system has made target of its parts' blocks."""
    system, where = _file(spark, target)
    if len(parts) < 2 or system.getClass().getSimpleName() != "DistributedFileSystem":
        return False
    path = spark._jvm.org.apache.hadoop.fs.Path
    rest = spark._gateway.new_array(path, len(parts) - 1)
    for i, p in enumerate(parts[1:]):
        rest[i] = path(p)
    return bool(system.rename(path(parts[0]), where)) and system.concat(where, rest) is None


def join_parts(spark: SparkSession, files: dict[str, list[str]], header: bytes = b"") -> None:
    """Make each named file of its parts, in order, after header."""
    same = lambda target, parts: all(p.endswith(".gz") == target.endswith(".gz") for p in parts)
    left = [(target, parts) for target, parts in files.items() if header or not same(target, parts) or not _appended(spark, target, parts)]
    if not left:
        return

    def copy(batches):
        import gzip
        import shutil
        import uuid

        import pandas as pd
        from pyarrow import fs

        def opened(uri):
            scheme, sep, rest = uri.partition(":/")
            return fs.FileSystem.from_uri(uri if not sep or rest.startswith("/") else f"{scheme}:///{rest.lstrip('/')}") if sep else (fs.LocalFileSystem(), uri)

        for batch in batches:
            for target, parts in zip(batch["target"], batch["parts"], strict=True):
                system, path = opened(target)
                own = f"{path}.{uuid.uuid4().hex}"
                start = header if not target.endswith(".gz") else gzip.compress(header, mtime=0) if header or not len(parts) else b""
                with system.open_output_stream(own, compression=None) as out:
                    out.write(start)
                    for part in parts:
                        source, at = opened(part)
                        with source.open_input_stream(at, compression=None) as piece:
                            unpacked = gzip.GzipFile(fileobj=piece) if part.endswith(".gz") and not target.endswith(".gz") else piece
                            shutil.copyfileobj(unpacked, out, 1 << 22)
                system.move(own, path)
            yield pd.DataFrame({"target": batch["target"]})

    rows = spark.createDataFrame([(str(t), list(p)) for t, p in left], "target string, parts array<string>")
    rows.repartition(min(len(left), 1000), "target").mapInPandas(copy, "target string").count()


def write_single(df: DataFrame, folder: str, target: str, header: bytes = b"", compression: str | None = None) -> None:
    """Lines (a column of text) as the file target; their parts are written to folder first, and stay in df's order."""
    writer = df.write.mode("errorifexists")
    (writer.option("compression", compression) if compression else writer).text(folder)
    join_parts(df.sparkSession, {target: part_files(df.sparkSession, folder)}, header)
    system, where = _file(df.sparkSession, folder)
    system.delete(where, True)


def named(spark: SparkSession, folder: str, output: str, names: dict[str, str]) -> None:
    """Files of output by name, each of the parts in one folder of those under folder; gzipped parts are unpacked for names without .gz."""
    system, where = _file(spark, output)
    system.mkdirs(where)
    join_parts(spark, {f"{output}/{file}": part_files(spark, f"{folder}/{part}") for part, file in names.items() if not exists(spark, f"{output}/{file}")})
