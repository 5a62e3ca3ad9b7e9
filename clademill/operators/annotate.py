"""Annotated tables: names and lineages, metadata, row statistics, and the order of a tree.

Cases: ids 0 and FILTERED have fixed names; other ids without a node are an error with strict, else they keep null names and come last; a metadata table that
repeats an id repeats the row; a column that is there already gets its table's name as a suffix; a table without samples has statistics of 0.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from .taxonomy import CANONICAL_RANKS, FILTERED, ROOT, UNCLASSIFIED, child_code, child_places, closure, described

#: Names of ids that are not in a taxonomy.
SPECIAL_NAMES = {UNCLASSIFIED: "unclassified", FILTERED: "Filtered classified"}
SPECIAL_RANKS = {UNCLASSIFIED: "no rank", FILTERED: "synthetic"}


def annotated(table: DataFrame, taxa: DataFrame, metadata: dict[str, DataFrame] | None = None, add_stats: bool = False, ranks: tuple[str, ...] = CANONICAL_RANKS, strict: bool = True) -> DataFrame:
    """table (t_id and samples) with taxonomy columns, those of metadata (name to table with t_id), sig_avg and sig_med, then the samples."""
    samples = [c for c in table.columns if c != "t_id"]
    special = F.col("t_id").isin(*SPECIAL_NAMES)
    names = described(table.filter(~special), taxa, ranks, strict)
    first = [c for c in names.columns if c != "t_id"]
    out = table.join(names, "t_id", "left")
    for t_id, name in SPECIAL_NAMES.items():
        named = {"t_scientific_name": name, "t_rank": SPECIAL_RANKS[t_id]}
        out = out.withColumns({c: F.when(F.col("t_id") == t_id, F.lit(v)).otherwise(F.col(c)) for c, v in named.items()})
    added: list[str] = []
    for name, more in (metadata or {}).items():
        out, new = with_metadata(out, more, name)
        added += new
    stats = []
    if add_stats:
        numeric = [c for c in samples if isinstance(table.schema[c].dataType, NumericType)]
        out, stats = out.withColumns({"sig_avg": row_mean(numeric), "sig_med": row_median(numeric)}), ["sig_avg", "sig_med"]
    return out.select("t_id", *[F.col(f"`{c}`") for c in (*first, *added, *stats, *samples)])


def with_metadata(table: DataFrame, more: DataFrame, name: str) -> tuple[DataFrame, list[str]]:
    """table joined with another by t_id, and the names that its columns got. Warns of a table that has nothing but t_id: its separator may be another one."""
    if "t_id" not in more.columns:
        raise ValueError(f"the metadata table {name} has no column t_id")
    if len(more.columns) == 1:
        warnings.warn(f"the metadata table {name} has no column but t_id", stacklevel=3)
    new = {c: f"{c}_{name}" if c in table.columns else c for c in more.columns if c != "t_id"}
    return table.join(more.withColumnsRenamed(new), "t_id", "left"), list(new.values())


def matched(table: DataFrame, more: DataFrame) -> tuple[int, int]:
    """Taxa of a table that a metadata table has, and taxa of the table."""
    ids = table.select("t_id").distinct()
    return ids.join(more.select("t_id").distinct(), "t_id", "left_semi").count(), ids.count()


def _present(columns: list[str]) -> Column:
    return F.filter(F.array(*[F.col(f"`{c}`").cast("double") for c in columns]), lambda x: x.isNotNull())


def row_mean(columns: list[str]) -> Column:
    if not columns:
        return F.lit(0.0)
    values = _present(columns)
    return F.when(F.size(values) > 0, F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.size(values))


def row_median(columns: list[str]) -> Column:
    if not columns:
        return F.lit(0.0)
    values = F.sort_array(_present(columns))
    n = F.size(values)
    return F.when(n > 0, (F.get(values, F.floor((n - 1) / 2).cast("int")) + F.get(values, F.floor(n / 2).cast("int"))) / 2)


def _special_first() -> Column:
    """Place of ids that come before all others: 0, FILTERED, the root."""
    return F.when(F.col("t_id") == UNCLASSIFIED, 0).when(F.col("t_id") == FILTERED, 1).when(F.col("t_id") == ROOT, 2).otherwise(3)


def alphabetical_keys(table: DataFrame, ranks: tuple[str, ...] = CANONICAL_RANKS) -> list[Column]:
    """Sort keys of an annotated table: special ids, then names rank by rank without regard to case, then ids."""
    return [_special_first(), *[F.lower(F.col(f"t_{r}")).asc_nulls_last() for r in ranks if f"t_{r}" in table.columns], F.col("t_id")]


def depth_first(table: DataFrame, taxa: DataFrame, weight: str | None = None, largest: bool = False) -> DataFrame:
    """table with dfs_key, a code to sort by: the tree's order with heavier clades first, ties by id; dfs_places() has its numbers.

    A clade weighs the sum of its rows' weights (1 each without weight), or with largest, as in clade tables, the largest one.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    own = table.groupBy("t_id").agg(F.coalesce(F.max(w), F.lit(0.0)).alias("w")).filter(~F.col("t_id").isin(*SPECIAL_NAMES))
    links = closure(taxa.join(own, "t_id", "left_semi"))
    total = F.max("w") if largest else F.sum("w")
    clades = links.join(own, "t_id").groupBy(F.col("ancestor_id").alias("node")).agg(total.alias("clade_weight"))
    clades = clades.join(taxa.select(F.col("t_id").alias("node"), F.when(F.size("path") > 1, F.col("parent_id")).alias("parent")), "node")
    order = Window.partitionBy("parent").orderBy(F.desc("clade_weight"), "node")
    ranked = clades.select("node", child_code(F.row_number().over(order) - 1).alias("at"))
    # As long as the tree is deep.
    code = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ancestor_depth", "at"))), lambda x: x["at"]), "")
    keys = links.join(ranked, F.col("ancestor_id") == F.col("node")).groupBy("t_id").agg(code.alias("_code"))
    first = _special_first()
    # Unknown ids come last.
    place = F.when(first < 3, first).when(F.col("_code").isNotNull(), F.lit(3)).otherwise(F.lit(4))
    key = F.concat(child_code(place), F.when(place == 3, F.col("_code")).otherwise(F.lit("")))
    return table.join(keys, "t_id", "left").withColumn("dfs_key", key).drop("_code")


def dfs_places(key: Column) -> Column:
    """0, 1 and 2 for ids that come first, 4 for unknown ones, or 3 and the places from the root down, counted from 1."""
    return F.transform(child_places(key), lambda x, i: F.when(i == 0, x).otherwise(x + 1))
