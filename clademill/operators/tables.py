"""Abundance tables: counts or proportions by taxon and sample, kept long until a file needs them wide.

Cases: samples named for exclusion that don't occur are reported by absent_samples(); proportions of a sample without reads are null (0 in
clade mode); a table without rows gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.scalar import period
from ..shared import saved
from .rollup import canonical_remainders, pooled, pushed_up, within
from .taxonomy import CANONICAL_RANKS, FILTERED, ROOT, UNCLASSIFIED

MODES = ("taxon", "clade", "canonical")


def selected_reads(reports: DataFrame, exclude: tuple[str, ...] = (), by_period: bool = False) -> DataFrame:
    """(t_id, sample_id, taxon_reads) without the excluded samples; by_period, samples of a week are one."""
    rows = reports.filter(~F.col("sample_id").isin(*exclude)) if exclude else reports
    sample = period(F.col("year"), F.col("week")) if by_period else F.col("sample_id")
    return rows.select("t_id", sample.alias("sample_id"), "taxon_reads")


def absent_samples(reports: DataFrame, exclude: tuple[str, ...]) -> list[str]:
    """Those of the excluded samples that the reports don't have."""
    if not exclude:
        return []
    found = {r["sample_id"] for r in reports.filter(F.col("sample_id").isin(*exclude)).select("sample_id").distinct().collect()}
    return [x for x in exclude if x not in found]


def sample_totals(cells: DataFrame, mode: str) -> DataFrame:
    """(sample_id, total): what a table holds of each sample.

    In clade mode, a sample's reads are those of its largest clade, without a taxon, and filtered; otherwise the sum of all.
    """
    if mode != "clade":
        return cells.groupBy("sample_id").agg(F.sum("value").alias("total"))
    apart = F.col("t_id").isin(UNCLASSIFIED, FILTERED)
    return cells.groupBy("sample_id").agg((F.coalesce(F.max(F.when(~apart, F.col("value"))), F.lit(0)) + F.coalesce(F.sum(F.when(apart, F.col("value"))), F.lit(0))).alias("total"))


def proportions(cells: DataFrame, mode: str) -> DataFrame:
    """cells with value as a share of the sample's total."""
    total = F.col("total")
    share = F.col("value") / (F.when(total == 0, 1).otherwise(total) if mode == "clade" else F.when(total != 0, total))
    return cells.join(sample_totals(cells, mode), "sample_id").select("t_id", "sample_id", share.alias("value"))


def abundance_table(reads: DataFrame, taxa: DataFrame, mode: str = "clade", *limits: int, as_proportions: bool = False, **options) -> DataFrame:
    """(t_id, sample_id, value): table_cells() without own, or with as_proportions the shares of the samples' totals."""
    cells = table_cells(reads, taxa, mode, *limits, **options).select("t_id", "sample_id", "value")
    return proportions(cells, mode) if as_proportions else cells


def table_cells(
    reads: DataFrame,
    taxa: DataFrame,
    mode: str = "clade",
    min_reads: int = 50,
    min_observed: int = 25,
    clade: int | None = None,
    keep_unclassified: bool = False,
    keep_filtered: bool = False,
    ranks: tuple[str, ...] = CANONICAL_RANKS,
) -> DataFrame:
    """(t_id, sample_id, value, own) of reads (t_id, sample_id, taxon_reads); own are the reads that a cell holds itself, not those of nodes below.

    mode: taxon (own reads after push-up), clade (reads of the whole clade) or canonical (remainders). clade keeps that clade alone, whose
    root then takes the root's part; keep_filtered adds what it leaves out as the taxon FILTERED. In canonical mode a clade
    leaves out reads without a taxon even with keep_unclassified.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {', '.join(MODES)}")
    rows = pooled(reads if keep_unclassified else reads.filter(F.col("t_id") != UNCLASSIFIED))
    before, top = rows, ROOT
    if clade is not None:
        if keep_filtered:  # counted once for the clade and for what it leaves out
            rows = before = saved(rows, "pooled")
        if mode == "canonical":
            rank = taxa.filter(F.col("t_id") == clade).select("rank").first()
            if rank is None or rank["rank"] not in ranks:
                raise ValueError("a canonical table needs a clade of a canonical rank")
        taxa, top = within(taxa, clade), clade
        bare = F.col("t_id") == UNCLASSIFIED
        rows = rows.join(taxa.select("t_id"), "t_id", "left_semi").unionByName(rows.filter(bare))
    if mode == "canonical":
        cells = canonical_remainders(rows, taxa, min_reads, min_observed, top, keep_unclassified and clade is None, ranks).withColumn("own", F.col("value"))
    else:
        cells = pushed_up(rows, taxa, min_reads, min_observed, top).select("t_id", "sample_id", F.col("taxon_reads" if mode == "taxon" else "clade_reads").alias("value"), F.col("taxon_reads").alias("own"))
        cells = cells.filter((F.col("value") > 0) | (F.col("t_id") == UNCLASSIFIED))
    if keep_filtered and clade is not None:
        all_reads = before.groupBy("sample_id").agg(F.sum("taxon_reads").alias("all"))
        cells = saved(cells, "cells")
        # Only samples that the table has get such a cell.
        lost = sample_totals(cells, mode).join(all_reads, "sample_id").select(F.lit(FILTERED).cast("long").alias("t_id"), "sample_id", F.greatest(F.col("all") - F.col("total"), F.lit(0)).alias("value")).withColumn("own", F.col("value"))
        cells = cells.unionByName(lost.filter("value > 0"))
    return cells


def wide(cells: DataFrame, samples: list[str] | None = None) -> DataFrame:
    """Cells as a table with a column a sample, 0 where there is none; the samples are looked up unless given."""
    if samples is None:
        cells = saved(cells, "cells")  # read for the samples' names, and again for the table
        samples = sorted(r[0] for r in cells.select("sample_id").distinct().collect())
    return cells.groupBy("t_id").pivot("sample_id", samples).agg(F.sum("value")).na.fill(0)


#: What an audit calls ids that have no rank: reads without a taxon, and ids that the taxonomy hasn't.
NO_RANK = ("unclassified", "unknown")


class Watch:
    """Figures of an audit, observed while its tables are written: no job of their own reads them again.

    base() is put before the reads are written, table() before the cells, taxa_before() and taxa_after() before a row a taxon; figures() is asked for afterwards. Ranks
    are those that the taxonomy has.
    """

    def __init__(self, taxa: DataFrame):
        self.ranked = taxa.select("t_id", "rank")
        # One row for each rank that there is.
        named = sorted(r["rank"] for r in self.ranked.select("rank").filter("rank IS NOT NULL").distinct().collect())
        self.ranks = [*[r for r in named if r not in NO_RANK], *NO_RANK]
        self.seen: dict[str, Observation] = {}

    def _watched(self, rows: DataFrame, name: str, amount: Column) -> DataFrame:
        """rows as they are; the amount by rank is observed."""
        rank = F.when(F.col("t_id") == UNCLASSIFIED, NO_RANK[0]).otherwise(F.coalesce("rank", F.lit(NO_RANK[1])))
        self.seen[name] = Observation()
        by_rank = [F.sum(F.when(rank == r, amount)).alias(r) for r in self.ranks]
        return rows.join(self.ranked, "t_id", "left").observe(self.seen[name], F.sum(amount).alias("in all"), *by_rank).select(rows.columns)

    def base(self, reads: DataFrame) -> DataFrame:
        return self._watched(reads, "before", F.col("taxon_reads"))

    def table(self, cells: DataFrame) -> DataFrame:
        return self._watched(cells, "after", F.col("own"))

    def taxa_before(self, ids: DataFrame) -> DataFrame:
        return self._watched(ids, "taxa_before", F.lit(1))

    def taxa_after(self, ids: DataFrame) -> DataFrame:
        return self._watched(ids, "taxa_after", F.lit(1))

    def of(self, name: str) -> dict[str, int]:
        return {k: int(v or 0) for k, v in self.seen[name].get.items()} if name in self.seen else {}

    def figures(self) -> list[tuple[str, int, int, int, int]]:
        """(rank, taxa before, after, reads before, after) of ranks that occur."""
        names = ("taxa_before", "taxa_after", "before", "after")
        found = {n: self.of(n) for n in names}
        rows = [(r, *[found[n].get(r, 0) for n in names]) for r in self.ranks]
        return [r for r in rows if any(r[1:])]


def watched_table(chosen: DataFrame, taxa: DataFrame, mode: str, keep_unclassified: bool = False, clade: int | None = None, **options) -> tuple[DataFrame, DataFrame, Watch]:
    """(reads, cells, watch): both written, with an audit's figures. Taxa count before if they, or nodes below, have reads; after if they have a row."""
    watch = Watch(taxa)
    reads = saved(watch.base(pooled(chosen)), "base")
    cells = saved(watch.table(table_cells(reads, taxa, mode, keep_unclassified=keep_unclassified, clade=clade, **options)), "cells")
    scope = taxa if clade is None else taxa.filter(F.array_contains("path", clade))
    own = reads.filter("taxon_reads > 0").select("t_id").distinct().join(scope.select("t_id", "path"), "t_id", "left")
    bare = own.filter(F.col("path").isNotNull() if clade is not None else F.lit(True)).select(F.explode(F.coalesce("path", F.array("t_id"))).alias("t_id")).distinct()
    before = bare if clade is None else bare.join(scope.select("t_id"), "t_id", "left_semi")
    before = before if keep_unclassified else before.filter(F.col("t_id") != UNCLASSIFIED)
    for ids, see in ((before, watch.taxa_before), (cells.select("t_id").distinct(), watch.taxa_after)):
        see(ids).write.format("noop").mode("overwrite").save()
    return reads, cells, watch


def audit(reads: DataFrame, cells: DataFrame, watch: Watch, mode: str) -> dict:
    """Figures of a table against the reads that it was made of; reads and cells are written tables, and what the watch has seen isn't counted again."""
    kept = sample_totals(cells, mode).agg(F.sum("total").alias("reads"), F.count(F.lit(1)).alias("samples")).first()
    all_reads, taxa = watch.of("before")["in all"], watch.of("taxa_before")["in all"]
    rows = watch.figures()
    share = (kept["reads"] or 0) / all_reads if all_reads else 0.0
    return {
        "samples": reads.select("sample_id").distinct().count(), "samples_kept": kept["samples"], "reads": all_reads, "reads_kept": kept["reads"] or 0,
        "intact": share >= 0.999, "taxa": taxa, "taxa_kept": watch.of("taxa_after")["in all"],
        "taxa_by_rank": {r[0]: r[2] for r in rows if r[2]}, "taxa_by_rank_before": {r[0]: r[1] for r in rows if r[1]},
        "reads_by_rank": {r[0]: [r[3], r[4]] for r in rows if r[3] or r[4]},  # own reads before and after, in every mode
    }
