"""Reads of wanted taxa, one set for each taxon.

Cases: a read in several wanted clades goes to each of them; reads without the first sequence are left out where sequences are
written; no wanted ids give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import in_period, short_name
from .taxonomy import clade_members, clade_ranges


def _disjoint(ranges: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The union of (id, entry, exit) as intervals; clades are nested or apart."""
    out: list[tuple[int, int]] = []
    for _, lo, hi in sorted(ranges, key=lambda r: (r[1], -r[2])):
        if not out or lo >= out[-1][1]:
            out.append((lo, hi))
    return out


def wanted_reads(reads: DataFrame, taxa: DataFrame, wanted: list[int], mode: str = "clade", by_place: bool = False, **between: int | None) -> DataFrame:
    """reads with the column target, the wanted id; mode clade takes whole clades, taxon the ids alone. between: see in_period().

    by_place: reads have the column entry of the same prepared taxonomy. A clade is then a range of it, and a filter with constants, which reaches the scan,
    takes the place of the join; a table that is clustered by entry has most of its row groups skipped.
    """
    if mode not in ("taxon", "clade"):
        raise ValueError("mode is taxon or clade")
    ids = [int(x) for x in dict.fromkeys(wanted)]
    rows = reads.filter(in_period(F.col("year"), F.col("week"), **between)) if any(v is not None for v in between.values()) else reads
    if by_place:
        ranges = clade_ranges(taxa, ids)
        if mode == "taxon":
            ranges = [(t, lo, lo + 1) for t, lo, _ in ranges]
        inside = F.lit(False)
        for lo, hi in _disjoint(ranges):
            inside = inside | ((F.col("entry") >= lo) & (F.col("entry") < hi))
        targets = [F.when((F.col("entry") >= lo) & (F.col("entry") < hi), F.lit(t).cast("long")) for t, lo, hi in ranges] or [F.lit(None).cast("long")]
        return rows.filter(inside).select(*reads.columns, F.explode(F.array_compact(F.array(*targets))).alias("target"))
    if mode == "taxon":
        return rows.filter(F.col("t_id").isin(*ids)).withColumn("target", F.col("t_id"))
    return rows.join(clade_members(taxa, ids), "t_id").select(*reads.columns, "target")


def set_name(mode: str, combined: bool, suffix: str = "") -> Column:
    """Name of a read's set from sample_id, target and the target's scientific name (column name): sample or 'combined', mode, id, short name."""
    short = F.coalesce(short_name(F.col("name")), F.lit("unknown"))
    first = F.lit("combined") if combined else F.col("sample_id")
    return F.concat(F.concat_ws("_", first, F.lit(mode), F.col("target").cast("string"), F.regexp_replace(short, r"[^\w.-]+", "_")), F.lit(suffix if combined else ""))


def fastq_lines(id_col: Column, sequence: Column, quality: Column) -> Column:
    """A record's four lines."""
    return F.concat_ws("\n", F.concat(F.lit("@"), id_col), sequence, F.lit("+"), quality)


def write_sets(spark: SparkSession, parts: list[DataFrame], folder: str) -> None:
    """Lines of parts (set, sample_id, place, read_id, value) as gzipped text, a folder set=<name> each, whose files follow each other in that order; a large set spans several."""
    out = None
    for part in parts:
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], "set string, sample_id string, place long, read_id string, value string")
    order = ["set", "sample_id", "place", "read_id"]
    out = out.repartitionByRange(*order).sortWithinPartitions(*order).select("set", "value")
    out.write.partitionBy("set").option("compression", "gzip").text(folder)
