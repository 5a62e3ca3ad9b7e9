"""Roll-ups of counts along a taxonomy that conserve mass.

A count is lifted to all ancestors by exploding its path before one aggregation. Clade sums grow towards the root, so if a
node passes a threshold on its clade, so do its ancestors: what failing nodes hold lands on their nearest passing ancestor-or-self,
which is one lookup per taxon and needs no loop over levels. Canonical remainders don't grow that way; they are passed up node by node, in as
many steps as the longest route has nodes of a canonical rank, one for each rank unless ranks repeat on a path.

Cases: ids without a path (0, unknown ones) are their own clade and exempt from thresholds; null ids or counts are left out; repeated rows
add up; a table without rows gives none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shared import saved
from .taxonomy import CANONICAL_RANKS, ROOT, UNCLASSIFIED


def pooled(reads: DataFrame) -> DataFrame:
    """(t_id, sample_id, taxon_reads), one row a cell."""
    return reads.filter("t_id IS NOT NULL AND taxon_reads IS NOT NULL").groupBy("t_id", "sample_id").agg(F.sum(F.col("taxon_reads").cast("long")).alias("taxon_reads"))


def within(taxa: DataFrame, top: int) -> DataFrame:
    """The clade of a node as a taxonomy of its own: paths start at the node."""
    from_top = lambda c: F.slice(c, F.array_position("path", top).cast("int"), F.size("path"))
    return taxa.filter(F.array_contains("path", top)).select(*[c for c in taxa.columns if c not in ("path", "ranks", "depth", "entry", "exit", "code")], (F.size(from_top("path")) - 1).alias("depth"), from_top("path").alias("path"), from_top("ranks").alias("ranks"))


def clade_sums(reads: DataFrame, taxa: DataFrame, own: tuple[str, ...] = ()) -> DataFrame:
    """(t_id, sample_id, taxon_reads, clade_reads, *own) of every node with reads in its clade, in the samples where it has them.

    own: numbers of reads that are summed up for a node's own rows, without its clade; null where it has none.
    """
    if own:  # rows without a count have these numbers too
        cells = reads.filter("t_id IS NOT NULL").groupBy("t_id", "sample_id").agg(F.sum(F.col("taxon_reads").cast("long")).alias("taxon_reads"), *[F.sum(c).alias(c) for c in own])
    else:
        cells = pooled(reads)
    lifted = cells.join(taxa.select("t_id", "path"), "t_id", "left").select("sample_id", "taxon_reads", *own, F.col("t_id").alias("own"), F.explode(F.coalesce("path", F.array("t_id"))).alias("t_id"))
    itself = F.col("own") == F.col("t_id")
    here = F.when(itself, F.col("taxon_reads")).otherwise(F.lit(0))
    more = [F.sum(F.when(itself & F.col("sample_id").isNotNull(), F.col(c))).alias(c) for c in own]
    sums = lifted.groupBy("t_id", "sample_id").agg(F.sum(here).alias("taxon_reads"), F.sum("taxon_reads").alias("clade_reads"), *more)
    return sums.filter((F.col("clade_reads") > 0) | (F.col("t_id") == UNCLASSIFIED))


def _with_zeros(cells: DataFrame, reads: DataFrame, columns: list[str]) -> DataFrame:
    """Reads without a taxon have a cell in every sample, if they occur at all."""
    samples = reads.select("sample_id").distinct()
    has = reads.filter(F.col("t_id") == UNCLASSIFIED).select("sample_id").distinct()
    # One row at most on the right: whether any sample has them.
    some = has.limit(1).select(F.lit(True).alias("_some"))
    missing = samples.join(has, "sample_id", "left_anti").join(F.broadcast(some), F.col("_some"), "left_semi")
    return cells.unionByName(missing.select(F.lit(UNCLASSIFIED).cast("long").alias("t_id"), "sample_id", *[F.lit(0).cast("long").alias(c) for c in columns]))


def pushed_up(reads: DataFrame, taxa: DataFrame, min_reads: int = 0, min_observed: int = 0, top: int = ROOT) -> DataFrame:
    """clade_sums() of the nodes that pass; the own reads of the others go to the nearest ancestor that does.

    A node passes with min_reads in some sample and reads in min_observed samples, counted over its clade; top always passes.
    """
    sums = clade_sums(reads, taxa)
    enough = (F.max("clade_reads") >= min_reads) & (F.count_if(F.col("clade_reads") > 0) >= min_observed)
    known = taxa.select("t_id", F.lit(True).alias("known"))
    passing = sums.groupBy("t_id").agg(enough.alias("enough")).join(known, "t_id", "left").filter((F.col("t_id") == top) | F.col("enough") | F.col("known").isNull()).select("t_id")
    own = pooled(reads)
    up = own.select("t_id").distinct().join(taxa.select("t_id", "path"), "t_id", "left").select("t_id", F.posexplode(F.coalesce("path", F.array("t_id"))).alias("at", "ancestor"))
    target = up.join(passing.select(F.col("t_id").alias("ancestor")), "ancestor").groupBy("t_id").agg(F.max_by("ancestor", "at").alias("target"))
    landed = own.join(target, "t_id").groupBy(F.col("target").alias("t_id"), "sample_id").agg(F.sum("taxon_reads").alias("taxon_reads"))
    cells = sums.drop("taxon_reads").join(passing, "t_id", "left_semi").join(landed, ["t_id", "sample_id"], "left")
    cells = cells.select("t_id", "sample_id", F.coalesce("taxon_reads", F.lit(0)).alias("taxon_reads"), "clade_reads")
    return _with_zeros(cells, reads, ["taxon_reads", "clade_reads"])


def canonical_remainders(
    reads: DataFrame, taxa: DataFrame, min_reads: int = 0, min_observed: int = 0, top: int = ROOT, keep_unclassified: bool = False, ranks: tuple[str, ...] = CANONICAL_RANKS
) -> DataFrame:
    """(t_id, sample_id, value): reads of each node of a canonical rank that are not in a canonical node below it.

    Every read goes to its nearest ancestor-or-self of a canonical rank, or else to top. Nodes whose remainder fails a threshold
    give it to the next canonical node above, deepest first; top is exempt. Ids outside the taxonomy are left out, but for 0 with keep_unclassified.
    """
    canonical = F.transform(F.filter(F.arrays_zip("path", "ranks"), lambda x: x["ranks"].isin(*ranks) & (x["path"] != top)), lambda x: x["path"])
    routes = taxa.select("t_id", F.concat(F.array(F.lit(top).cast("long")), canonical).alias("route"))
    state = pooled(reads).join(routes, "t_id").groupBy("route", "sample_id").agg(F.sum("taxon_reads").alias("value"))
    node = Window.partitionBy("route")
    if min_reads > 0 or min_observed > 0:
        state = saved(state, "remainders")
    longest = state.agg(F.max(F.size("route"))).first()[0] or 1 if min_reads > 0 or min_observed > 0 else 1
    for level in range(longest, 1, -1):
        few = (F.max("value").over(node) < min_reads) | (F.count_if(F.col("value") > 0).over(node) < min_observed)
        moved = state.withColumn("few", few).withColumn("route", F.when(F.col("few") & (F.size("route") == level), F.slice("route", 1, level - 1)).otherwise(F.col("route")))
        state = moved.groupBy("route", "sample_id").agg(F.sum("value").alias("value"))
    cells = state.filter("value > 0").select(F.element_at("route", -1).alias("t_id"), "sample_id", "value")
    if not keep_unclassified:
        return cells
    bare = pooled(reads.filter(F.col("t_id") == UNCLASSIFIED)).withColumnRenamed("taxon_reads", "value")
    return _with_zeros(cells.unionByName(bare.select(cells.columns)), reads, ["value"])


def mass_balance(before: DataFrame, after: DataFrame, column: str = "value") -> DataFrame:
    """(sample_id, before, after) of samples whose sums differ: none if mass is conserved."""
    a = before.groupBy("sample_id").agg(F.sum("taxon_reads").alias("before"))
    b = after.groupBy("sample_id").agg(F.sum(column).alias("after"))
    both = a.join(b, "sample_id", "full").select("sample_id", F.coalesce("before", F.lit(0)).alias("before"), F.coalesce("after", F.lit(0)).alias("after"))
    return both.filter("before <> after")


def read_migration(reads: DataFrame, cells: DataFrame, taxa: DataFrame) -> DataFrame:
    """(rank, before, after, moved): reads by the rank of the taxon that they are assigned to, in reads and in a table's cells (t_id, sample_id, value)."""
    before = rank_totals(pooled(reads), taxa, "taxon_reads").select("rank", F.col("total").alias("before"))
    after = rank_totals(cells, taxa, "value").select("rank", F.col("total").alias("after"))
    both = before.join(after, "rank", "full").select("rank", F.coalesce("before", F.lit(0)).alias("before"), F.coalesce("after", F.lit(0)).alias("after"))
    return both.withColumn("moved", F.col("after") - F.col("before"))


def rank_totals(cells: DataFrame, taxa: DataFrame, column: str = "clade_reads") -> DataFrame:
    """(rank, total, n_taxa) of a table's cells; ids without a node have the rank 'unknown', 0 has 'unclassified'."""
    per = cells.groupBy("t_id").agg(F.sum(column).alias("total")).join(taxa.select("t_id", "rank"), "t_id", "left")
    rank = F.when(F.col("t_id") == UNCLASSIFIED, F.lit("unclassified")).otherwise(F.coalesce("rank", F.lit("unknown")))
    return per.groupBy(rank.alias("rank")).agg(F.sum("total").alias("total"), F.count(F.lit(1)).alias("n_taxa"))
