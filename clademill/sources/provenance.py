"""What a table was made of and by: a small JSON file beside it, checked before the table is used.

Table and facts are written aside and renamed together once both are whole, so a job that fails leaves what was there before. Only renames can be cut short;
the next job that is to write to the path, or recover(), puts back what they had moved.
"""

from __future__ import annotations

import gzip
import json
import sys
import uuid
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from .. import __version__

#: Tables written by older versions than this are refused.
LEAST_VERSION = "0.1.0"


def _version(text: str) -> tuple[int, ...]:
    return tuple(int(x) if x.isdigit() else 0 for x in text.split("-")[0].split("."))


def _file(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _file(spark, path)
    return system.exists(where)


def companion(path: str) -> str:
    return path.rstrip("/") + ".json"


def write_provenance(spark: SparkSession, path: str, file_type: str, source: str = "", sorting: str = "", standard: str = "GENERIC", **more: str) -> dict[str, str]:
    facts = {
        "version": __version__, "file_type": file_type, "command": " ".join(sys.argv), "created": datetime.now(timezone.utc).isoformat(),
        "sorting": sorting, "source": source, "data_standard": standard, **more,
    }
    system, where = _file(spark, companion(path))
    stream = system.create(where, True)
    try:
        stream.write(bytearray(json.dumps(facts, indent=2).encode()))
    finally:
        stream.close()
    return facts


def read_provenance(spark: SparkSession, path: str) -> dict[str, str]:
    """The facts beside a table; none if there is no file."""
    if not exists(spark, companion(path)):
        return {}
    return json.loads("\n".join(r["value"] for r in spark.read.text(companion(path)).collect()))


def checked(spark: SparkSession, path: str, file_type: str, columns: tuple[str, ...] = ()) -> dict[str, str]:
    """The facts beside a table; an error if table or facts are missing, or version, type or columns don't fit."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    facts = read_provenance(spark, path)
    if not facts:
        raise FileNotFoundError(f"{companion(path)}: a table needs the file that tells its provenance")
    if "version" not in facts:
        raise ValueError(f"{companion(path)} names no version")
    if _version(facts["version"]) < _version(LEAST_VERSION):
        raise ValueError(f"{path} was written by version {facts['version']}; the oldest that fits is {LEAST_VERSION}")
    if _version(facts["version"]) > _version(__version__):
        raise ValueError(f"{path} was written by version {facts['version']}, which is newer than this one")
    if facts.get("file_type") != file_type:
        raise ValueError(f"{path} is a {facts.get('file_type')}, not a {file_type}")
    if columns:
        from .tables import read_table

        missing = set(columns) - set(read_table(spark, path).columns)
        if missing:
            raise ValueError(f"{path} has no column {', '.join(sorted(missing))}")
    return facts


def _split(path: str) -> tuple[str, str]:
    """The folder that a table is in, without a last slash (empty for the root), and its name."""
    folder, slash, name = path.rstrip("/").rpartition("/")
    return folder if slash else ".", name


def staging(path: str) -> str:
    """A new place for path's table, of the same name, in a hidden folder beside it."""
    folder, name = _split(path)
    return f"{folder}/.staged-{uuid.uuid4().hex}/{name}"


def _replaced(path: str) -> str:
    folder, name = _split(path)
    return f"{folder}/.replaced-{name}"


def _moved(spark: SparkSession, source: str, target: str) -> None:
    system, where = _file(spark, source)
    if not system.rename(where, _file(spark, target)[1]):
        raise OSError(f"{source} could not be renamed to {target}")


def discard(spark: SparkSession, staged: str) -> None:
    """Delete a staging place and what was written to it."""
    system, where = _file(spark, _split(staged)[0])
    system.delete(where, True)


def publish(spark: SparkSession, staged: str, path: str, table: str | None = None) -> None:
    """Move a table (at staged, unless table says another place in its folder) and its facts to path, in place of what is there.

    The old ones go aside first; the new table comes last, so a table at path is whole and has its facts.
    """
    recover(spark, path)
    aside = _replaced(path)
    system, where = _file(spark, aside)
    system.mkdirs(where)
    for p in (path.rstrip("/"), companion(path)):
        if exists(spark, p):
            _moved(spark, p, f"{aside}/{_split(p)[1]}")
    for new, p in ((companion(staged), companion(path)), (table or staged, path.rstrip("/"))):
        if exists(spark, new):
            _moved(spark, new, p)
    system.delete(where, True)
    discard(spark, staged)


def recover(spark: SparkSession, path: str) -> None:
    """End a publish() that was cut short: if the new table isn't at its place, the old one and its facts go back."""
    aside = _replaced(path)
    if not exists(spark, aside):
        return
    system, where = _file(spark, aside)
    if not exists(spark, path):
        for p in (companion(path), path.rstrip("/")):
            old = f"{aside}/{_split(p)[1]}"
            if exists(spark, old):
                system.delete(_file(spark, p)[1], True)
                _moved(spark, old, p)
    system.delete(where, True)


def free(spark: SparkSession, path: str, overwrite: bool) -> None:
    """An error if something is at path already and may not be replaced, or if path, or its nearest folder that exists, may not be written to."""
    recover(spark, path)
    system, where = _file(spark, path)
    there = system.exists(where)
    if there and not overwrite:
        raise FileExistsError(f"{path} is there already")
    while not system.exists(where) and where.getParent() is not None:
        where = where.getParent()
    try:
        system.access(where, spark._jvm.org.apache.hadoop.fs.permission.FsAction.WRITE)
    except Py4JJavaError as e:
        if "AccessControlException" in str(e.java_exception):
            raise PermissionError(f"{where.toString()} may not be written to") from e
        raise


def tables_in(spark: SparkSession, path: str) -> list[str]:
    """path itself if it is a table with its facts, or else the Parquet tables with facts in the folder path, by name."""
    if exists(spark, companion(path)):
        return [path]
    system, where = _file(spark, path)
    names = sorted(s.getPath().toString() for s in system.listStatus(where)) if system.exists(where) else []
    found = [p for p in names if p.rstrip("/").endswith(".parquet") and exists(spark, companion(p))]
    if not found:
        raise FileNotFoundError(f"{path} has no Parquet tables with the files that tell their provenance")
    return found


def empty_text(spark: SparkSession, path: str) -> None:
    """An empty gzipped file."""
    system, where = _file(spark, path)
    if not system.exists(where):
        stream = system.create(where)
        try:
            stream.write(bytearray(gzip.compress(b"")))
        finally:
            stream.close()
