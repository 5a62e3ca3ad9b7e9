"""Tables in the shared folder, and Python workers that can import the package."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from .. import shared
from ..shared import drop_saved, fresh_path

__all__ = ["drop_saved", "fresh_path", "importable", "saved", "small_batches", "unused", "whole_ids"]

#: Rows of whole texts that go to a Python worker at once.
TEXT_ROWS = 1000


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write df once in the shared folder and read it back; the shuffle files of the write go with its end, not when the driver happens to collect its garbage."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key)
    conf.set(key, "true")
    try:
        return shared.saved(df, name)
    finally:
        conf.set(key, before)


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package wherever the driver was started; a cluster ships it (--py-files)."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in (paths := env.get("PYTHONPATH", "").split(os.pathsep)):
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


@contextmanager
def small_batches(spark: SparkSession, rows: int = TEXT_ROWS) -> Iterator[None]:
    """Fewer rows in an Arrow batch while a job over whole texts runs: buffers grow by doubling, on both sides."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def unused(name: str, columns: list[str]) -> str:
    """name, or else name with a number, that no column has."""
    taken = {c.lower() for c in columns}
    return next(n for n in (name, *(f"{name}_{k}" for k in range(len(columns)))) if n.lower() not in taken)


def whole_ids(docs: DataFrame, id_col: str) -> None:
    """An error that names the type if ids are not whole numbers of up to 64 bits."""
    kind = docs.select(f"`{id_col}`").schema[0].dataType.simpleString()
    if kind not in ("tinyint", "smallint", "int", "bigint", "void"):
        raise TypeError(f"ids in {id_col} are {kind}; whole numbers are needed")
