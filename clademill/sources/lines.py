"""Text files whose order of lines matters, read in parallel.

A split knows its offset in the file, and lines come in order inside a split; counting the lines of each split gives every line its
number without one task reading a whole file. Block-gzipped files are split like plain ones, other compressed files are one split each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .blocks import read_blocks, split_ranges

#: Splits whose offsets are broadcast at most; more are joined as Spark decides.
BROADCAST_SPLITS = 50_000


def split_size(spark: SparkSession) -> int:
    """Bytes of a file that Spark reads as one split."""
    return int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())


def raw_lines(spark: SparkSession, paths: str | list[str], size: int | None = None) -> DataFrame:
    """(file, block, m, value): block is where a line's split begins in its file; m rises with the lines of a split. size: bytes of a split of block-gzipped files."""
    text = spark.read.text(paths)
    files = text.inputFiles()
    ranges = split_ranges(spark, list(files), size or split_size(spark))
    plain = lambda df: df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("m"), "value")
    if not ranges:
        return plain(text)
    blocked = read_blocks(spark, ranges)
    rest = sorted(set(files) - {f for f, _, _ in ranges})
    return plain(spark.read.text(rest)).unionByName(blocked) if rest else blocked


def numbered(spark: SparkSession, paths: str | list[str], across: bool = False) -> DataFrame:
    """(file, line, value): lines count from 0 in each file; with across, through all files in the order of their names."""
    raw = raw_lines(spark, paths)
    splits = raw.groupBy("file", "block").agg(F.min("m").alias("first"), F.count(F.lit(1)).alias("n"))
    # One row a split.
    before = (Window.orderBy("file", "block") if across else Window.partitionBy("file").orderBy("block")).rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("file", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    # One row for each split that Spark reads as a partition at most: lines stay where they were read.
    starts = F.broadcast(starts) if raw.rdd.getNumPartitions() <= BROADCAST_SPLITS and len(raw.inputFiles()) <= BROADCAST_SPLITS else starts
    return raw.join(starts, ["file", "block"]).select("file", (F.col("m") + F.col("shift")).alias("line"), "value")


def ascending(rows: DataFrame, at: str, value: str, block: int = 1 << 17) -> bool:
    """Whether value strictly grows in the order of at: checked inside blocks of places, then from block to block."""
    b = rows.select(F.floor(F.col(at) / block).alias("b"), F.col(at).alias("at"), F.col(value).alias("v"))
    b = b.withColumn("ok", F.coalesce(F.col("v") > F.lag("v").over(Window.partitionBy("b").orderBy("at")), F.lit(True)))
    per = b.groupBy("b").agg(F.bool_and("ok").alias("ok"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    # One row for each block of places.
    after = F.coalesce(F.col("lo") > F.lag("hi").over(Window.orderBy("b")), F.lit(True))
    return bool(per.select((F.col("ok") & after).alias("ok")).agg(F.coalesce(F.bool_and("ok"), F.lit(True))).first()[0])


def field(columns: Column, k: int) -> Column:
    """k-th of an array of strings, from 0; null if there is none or it is empty."""
    x = F.get(columns, F.lit(k))
    return F.when(x != "", x)
