"""Reads: one line of classifier output each, with or without their sequences.

Cases: a line without a hit string has an empty one, one without a valid number of minimizer hits has 0; lengths that aren't numbers are 0; a record of FASTQ
that is cut off is left out; sequences must come in the order of the classified reads, and where read ids repeat, each sequence goes to the first read of its id
after the sequence before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import is_dated, sample_name, sample_week, sample_year
from ..shared import saved
from .lines import field, numbered, raw_lines
from .matching import matched_places


def _parsed(lines: DataFrame, *more: str) -> DataFrame:
    c = F.split("value", "\t")
    length = lambda k: F.coalesce(F.get(F.split(F.coalesce(field(c, 3), F.lit("")), r"\|"), F.lit(k)).try_cast("int"), F.lit(0))
    rows = lines.filter(F.size(c) >= 4).select(
        *more, "sample_id", field(c, 0).alias("status"), field(c, 1).alias("read_id"), field(c, 2).try_cast("long").alias("t_id"),
        F.coalesce(field(c, 4).try_cast("int"), F.lit(0)).alias("mhg"), length(0).alias("r1_len"), length(1).alias("r2_len"),
        field(c, 3).alias("lengths"), F.coalesce(field(c, 5), F.lit("")).alias("kmer_string"),
    )
    dated = is_dated(F.col("sample_id"))
    return rows.withColumns({"total_len": F.col("r1_len") + F.col("r2_len"), "year": F.when(dated, sample_year(F.col("sample_id"))), "week": F.when(dated, sample_week(F.col("sample_id")))})


def read_classified(spark: SparkSession, paths: str | list[str], size: int | None = None) -> DataFrame:
    """(sample_id, status, read_id, t_id, mhg, r1_len, r2_len, lengths, kmer_string, total_len, year, week); year and week are null unless the file is named for them."""
    return _parsed(raw_lines(spark, paths, size).select(sample_name(F.col("file")).alias("sample_id"), "value"))


def _read_id(header: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.get(F.split(header, r"\s"), F.lit(0)), "^@", ""), "/[12]$", "")


def read_fastq(spark: SparkSession, paths: str | list[str], across: bool = False) -> DataFrame:
    """(file, record, read_id, seq, qual), records counted from 0 in each file; with across, through all files in the order of their names."""
    rows = numbered(spark, paths, across).select(F.lit("").alias("file") if across else "file", F.floor(F.col("line") / 4).alias("record"), (F.col("line") % 4).alias("k"), "value")
    at = lambda k: F.max(F.when(F.col("k") == k, F.col("value")))
    whole = rows.groupBy("file", "record").agg(at(0).alias("head"), at(1).alias("seq"), at(3).alias("qual"))
    return whole.filter("head IS NOT NULL AND qual IS NOT NULL AND head LIKE '@%'").select("file", "record", _read_id(F.col("head")).alias("read_id"), "seq", "qual")


def with_sequences(spark: SparkSession, classified: str, first: str | None = None, second: str | None = None) -> DataFrame:
    """Classified reads of one file, with place, r1_seq, r1_qual, r2_seq and r2_qual of its FASTQ files where they have the read. A file may be a folder of parts in order.

    Both FASTQ files or none; their reads must all be classified ones, in the same order, and the second's must be in the first. Read ids may repeat.
    """
    if (first is None) != (second is None):
        raise ValueError("give both FASTQ files or none")
    if first is None:
        return read_classified(spark, classified)
    lines = numbered(spark, classified, across=True).select(sample_name(F.col("file")).alias("sample_id"), "line", "value")
    reads = _parsed(lines, "line")
    # Read as text once: records, ids and places are asked for several times.
    mates = [saved(read_fastq(spark, p, across=True).select("record", "read_id", "seq", "qual"), "records") for p in (first, second)]
    # Ids and places are matched alone. Sequences then meet their reads by id, or by line where ids repeat: each is shuffled once, or twice.
    places, unique = saved(reads.select(F.col("read_id").alias("id"), "line"), "places"), True
    for rows, what, p in zip(mates, ("first", "second"), ("r1", "r2"), strict=True):
        match, alone = matched_places(places, rows.select(F.col("read_id").alias("id"), "record"), f"reads of the {what} FASTQ file")
        match, unique = saved(match, "matched"), unique and alone
        own = rows.select("read_id", "record", F.col("seq").alias(f"{p}_seq"), F.col("qual").alias(f"{p}_qual"))
        reads = reads.join(own.drop("record"), "read_id", "left") if unique else reads.join(own.drop("read_id").join(match, "record").drop("record"), "line", "left")
        if what == "first":
            places = saved(places.join(match.select("line"), "line", "left_semi"), "places")
    return reads.withColumnRenamed("line", "place")


#: A taxonomy of so many nodes is sent to the tasks that read reads, as two numbers a node.
SENT_NODES = 4_000_000


def placed(reads: DataFrame, taxa: DataFrame) -> DataFrame:
    """reads with entry, the preorder place of their taxon (see operators.taxonomy.nested_sets()); null for taxa that a prepared taxonomy hasn't."""
    places = taxa.select("t_id", "entry")
    # Checked; a larger taxonomy is joined as Spark decides.
    small = places.limit(SENT_NODES + 1).count() <= SENT_NODES
    return reads.drop("entry").join(F.broadcast(places) if small else places, "t_id", "left").select(*[c for c in reads.columns if c != "entry"], "entry")


def clustered(reads: DataFrame) -> DataFrame:
    """Reads ordered by place if they are placed(), or else by taxon, so that a reader of few clades, or taxa, skips most row groups; a frequent taxon spans several files."""
    by = "entry" if "entry" in reads.columns else "t_id"
    return reads.repartitionByRange(by, "read_id").sortWithinPartitions(by, "read_id")
