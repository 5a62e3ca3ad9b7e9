"""Records of one file matched to lines of another that has them in the same order, where ids may repeat and lines may have no record.

The match is the one that a reader of both files makes who walks down the lines and takes the next record wherever its id is the line's: every record must find a line, below that of the
record before. If an id is as often among the lines as among the records, its k-th record can only be on its k-th line. These places are anchors; they
must rise together, or the files are out of sync. Between two anchors lie the few records whose id has more lines than records. Each such
stretch is walked by itself, in parallel, with ids and places alone; short neighbours are handed to a task in bundles.

Cases: records without a line left are an error, and so is a stretch of more than MOST_BETWEEN lines and records without an anchor; null ids match nothing; no records match
nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shared import saved
from .lines import ascending

#: Places that are numbered together, and places of one stretch that a task takes.
BLOCK, MOST_BETWEEN = 1 << 17, 1 << 24
#: Neighbouring stretches that are walked in one go, and places of a stretch that is walked by itself.
TOGETHER, LARGE = 1 << 10, 1 << 10


class OutOfSync(RuntimeError, ValueError):
    """Files whose order or whose repeated ids don't fit."""


def _stretches(rows: DataFrame, anchors: DataFrame, at: str) -> DataFrame:
    """rows (id, at) with stretch, the number of anchors (at) before each: counted in blocks of places, and the blocks' counts summed."""
    both = rows.select("id", at, F.lit(0).alias("anchor")).unionByName(anchors.select(F.lit(None).cast("string").alias("id"), at, F.lit(1).alias("anchor")))
    both = both.withColumn("block", F.floor(F.col(at) / BLOCK))
    inside = Window.partitionBy("block").orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One row for each block of places.
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = both.groupBy("block").agg(F.sum("anchor").alias("n")).select("block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return both.withColumn("own", F.sum("anchor").over(inside)).filter("anchor = 0").join(sums, "block").select("id", at, (F.col("before") + F.col("own")).alias("stretch"))


def _bundled(rows: DataFrame, large: DataFrame) -> DataFrame:
    """rows with bundle, the same for neighbouring stretches; large ones (stretch, alone) have one to themselves."""
    bundle = F.when(F.col("alone"), -F.col("stretch") - 1).otherwise(F.floor(F.col("stretch") / TOGETHER))
    return rows.join(large, "stretch", "left").select("id", "at", "stretch", bundle.alias("bundle"))


def matched_places(lines: DataFrame, records: DataFrame, what: str = "records") -> tuple[DataFrame, bool]:
    """(record, line) of lines (id, line) and records (id, record), and whether every record's id has one line alone."""
    counts = lines.groupBy("id").agg(F.count(F.lit(1)).alias("n")).join(records.groupBy("id").agg(F.count(F.lit(1)).alias("m")), "id", "right").select("id", F.coalesce("n", F.lit(0)).alias("n"), "m")
    counts = saved(counts, "id-counts")
    worst = counts.agg(F.bool_or(F.coalesce(F.col("m") > F.col("n"), F.lit(True))).alias("few"), F.bool_or(F.col("m") < F.col("n")).alias("open"), F.bool_or(F.col("n") > 1).alias("repeats")).first()
    if worst["few"]:
        raise OutOfSync(f"the {what} are out of sync with the lines: an id repeats more often, or is not there")
    sure = counts.filter("m = n")
    if worst["repeats"]:
        nth = lambda rows, at: rows.join(sure.select("id"), "id", "left_semi").select("id", at, F.row_number().over(Window.partitionBy("id").orderBy(at)).alias("k"))
        anchors = nth(lines, "line").join(nth(records, "record"), ["id", "k"]).select("record", "line")
    else:
        anchors = lines.join(sure.select("id"), "id", "left_semi").join(records, "id").select("record", "line")
    anchors = saved(anchors, "anchors")
    if not ascending(anchors, "record", "line"):
        raise OutOfSync(f"the {what} are out of sync with the lines: their order differs")
    if not worst["open"]:
        return anchors, not worst["repeats"]
    rest = counts.filter("m < n").select("id")
    left = _stretches(lines.join(rest, "id", "left_semi"), anchors, "line").withColumnRenamed("line", "at")
    right = _stretches(records.join(rest, "id", "left_semi"), anchors, "record").withColumnRenamed("record", "at")
    right = saved(right, "between")
    left = saved(left.join(right.select("stretch").distinct(), "stretch", "left_semi"), "between")
    large = saved(left.unionByName(right).groupBy("stretch").count().filter(F.col("count") > LARGE), "large").withColumn("alone", F.lit(True))
    largest = large.agg(F.max("count")).first()[0] or 0
    if largest > MOST_BETWEEN:
        raise OutOfSync(f"the {what} repeat ids over {largest} places without one that tells where they stand")
    left, right = (_bundled(rows, large.drop("count")) for rows in (left, right))

    def walk(one, other):
        import pandas as pd

        one, other = one.sort_values("at"), other.sort_values("at")
        names = lambda df: list(zip(df["stretch"].tolist(), df["id"].tolist(), strict=True))  # noqa: E731 - a record stays in its stretch
        ids, places, k, found = names(other), other["at"].tolist(), 0, []
        for name, at in zip(names(one), one["at"].tolist(), strict=True):
            if k < len(ids) and ids[k] == name:
                found.append(at)
                k += 1
        found += [None] * (len(ids) - k)  # no line is left
        return pd.DataFrame({"record": places, "line": pd.array(found, dtype="Int64")})

    between = saved(left.groupBy("bundle").cogroup(right.groupBy("bundle")).applyInPandas(walk, "record long, line long"), "walked")
    if between.filter("line IS NULL").limit(1).count():
        raise OutOfSync(f"the {what} are out of sync with the lines: their order differs")
    return anchors.unionByName(between), False
