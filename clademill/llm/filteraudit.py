"""How filters overlap: what each removes, for every order in which they could be applied.

Rows are first counted by part and mask, the set of filters that they fail; with k filters there are 2^k cells a part at most, however many rows there are. Cells are
unpivoted against the steps of every order. A running bit-or over a cell's steps holds the filters that it failed before, which decides
whether a step removes it; sums by step, and windows over a filter's steps in all orders, give the figures.

Cases: null texts are empty, a null part is the empty string; labels of an id that repeats count once, as 1 if any is 1; documents without labels are neither good nor
toxic; a null id has no labels, equals no smaller one's text and is smaller than none; rows that repeat an id are rows of their own, and none of them a copy of the other; very long
texts are measured whole; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import json
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import saved
from .text import words

#: Orders grow with the factorial.
MOST_FILTERS = 6


def interactions(masks: DataFrame, filters: tuple[str, ...]) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of masks (part, mask, good, toxic), a row a document.

    Bit i of mask is set if the document fails filters[i]. filter_order joins the filters' names; step counts from 1.
    """
    if not 1 <= len(filters) <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters")
    cells = masks.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))
    orders = F.from_json(F.lit(json.dumps([list(p) for p in permutations(range(len(filters)))])), "array<array<int>>")
    name = F.array(*[F.lit(f) for f in filters])
    steps = cells.select("*", F.explode(orders).alias("order"))
    steps = steps.select("part", "mask", "n", "good", "toxic", F.array_join(F.transform("order", lambda i: F.get(name, i)), "").alias("filter_order"), F.posexplode("order").alias("at", "filter"))
    bit = F.expr("shiftleft(1, filter)")
    steps = steps.withColumn("bit", bit).withColumn("fails", F.col("mask").bitwiseAND(F.col("bit")))
    before = Window.partitionBy("part", "filter_order", "mask").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.withColumn("earlier", F.coalesce(F.bit_or("fails").over(before), F.lit(0)))
    fails, gone = F.col("fails") != 0, F.col("earlier") != 0
    of = lambda cond, what="n": F.coalesce(F.sum(F.when(cond, F.col(what))), F.lit(0)).cast("long")
    figures = steps.groupBy("part", "filter_order", (F.col("at") + 1).alias("step"), "filter").agg(
        of(~fails & ~gone).alias("kept"), of(fails & ~gone).alias("removed"), of(fails & gone).alias("redundant"), of(F.col("mask") == F.col("bit")).alias("unique_fails"),
        of(fails & ~gone, "good").alias("good_lost"), of(fails & ~gone, "toxic").alias("toxic_lost"),
    )
    return figures.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "filter"))).drop("filter")


def measured(docs: DataFrame, conditions: dict[str, Column], copies: str, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(doc_id, part, mask): conditions by name, each true for a document that fails; the name copies is failed by texts that a smaller id has too.

    Texts are told apart by their SHA-256, so only digests are shuffled; a text that many rows have is one row of the table of repeated texts.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    bits = [F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(conditions.values())]
    mask = bits[0] if bits else F.lit(0)
    for b in bits[1:]:
        mask = mask.bitwiseOR(b)
    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{part_col}`"), F.lit("")).alias("part"), mask.alias("mask"), F.sha2(text, 256).alias("sha"))
    slim = saved(slim, "masks")
    # Written, so that both sides of the join are plain scans, of which Spark can split a text that very many rows have.
    repeated = saved(slim.groupBy("sha").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("sha", "first"), "repeated")
    copy = F.when(F.col("doc_id") > F.col("first"), F.lit(1 << len(conditions))).otherwise(F.lit(0))
    return slim.join(repeated, "sha", "left").select("doc_id", "part", F.col("mask").bitwiseOR(copy).alias("mask"))


def conditions_of(text: Column) -> dict[str, Column]:
    """The four filters of single texts: short, repetitive, in capitals, with symbols."""
    x = F.coalesce(text, F.lit(""))
    w = words(x)
    return {
        "A": F.size(w) < 200,
        "B": 100 * F.size(F.array_distinct(w)) < 50 * F.size(w),
        "C": 100 * F.regexp_count(x, F.lit("[A-Z]")) > 2 * F.length(x),
        "D": x.rlike("[#$%&*|]"),
    }


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """interactions() of the filters A to D and E, the copies, by source."""
    conditions = conditions_of(F.col("text"))
    masks = measured(docs, conditions, "E")
    one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(c)
    known = labels.groupBy("doc_id").agg(one("quality"), one("toxic"))
    masks = masks.join(known, "doc_id", "left").select("part", "mask", F.coalesce("quality", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    return interactions(masks, (*conditions, "E"))
