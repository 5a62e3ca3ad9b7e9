"""Feature tables about how well taxa are supported by their reads.

Cases: a ratio whose denominator is 0 is null; statistics of no values are null; hits without a node in the taxonomy count as classified
outside the clade and have no distance; relative depths of taxa of depth 1 or less are null; tables without rows give none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import correlation_p, distribution, distributions, pearson, ratio
from ..shared import saved
from .rollup import clade_sums
from .taxonomy import FILTERED, ROOT, UNCLASSIFIED, code_depth, coded, common_code, is_within

COUNTS = ("total", "classified", "unclassified", "clade", "exclade", "lineage", "root", "misclassified")
#: Numerator and denominator of each ratio.
RATIOS = (
    ("clade", "classified"), ("lineage", "classified"), ("misclassified", "classified"), ("root", "classified"),
    ("clade", "total"), ("classified", "total"), ("lineage", "total"), ("root", "total"), ("misclassified", "total"), ("exclade", "total"), ("supporting", "total"),
    ("root", "exclade"), ("lineage", "exclade"),
)
#: A correlation needs so many samples; the filtered one leaves out the largest 1 %, 3 at least.
CORRELATED_SAMPLES, OUTLIER_PERCENT, LEAST_OUTLIERS = 6, 1, 3


#: Groups of features by scope, and the parts that can be asked for.
SCOPES = {"global": ["t_id"], "sample": ["sample_id", "t_id"]}
PARTS = ("counts", "stats", "top")


def ratio_names(prefix: str) -> list[str]:
    return [f"{prefix}_{a}VS{b}_ratio" for a, b in RATIOS]


def labelled_hits(pairs: DataFrame, taxa: DataFrame) -> DataFrame:
    """pairs (t_id, kmer_tax_id, ...) with in_clade, in_lineage, hit_depth, distance, relative_lca_depth and relative_depth."""
    taxa = coded(taxa)
    side = lambda x, p: taxa.select(F.col("t_id").alias(x), F.col("code").alias(p))
    p, q = F.col("_own"), F.col("_hit")
    depth, hit_depth = code_depth(p), code_depth(q)
    both = pairs.join(side("t_id", "_own"), "t_id", "left").join(side("kmer_tax_id", "_hit"), "kmer_tax_id", "left").withColumn("_lca", code_depth(common_code(p, q)))
    below_root = F.when(depth > 1, (depth - 1).cast("double"))
    return both.select(
        *pairs.columns,
        is_within(q, p).alias("in_clade"),
        is_within(p, q).alias("in_lineage"),
        F.when(q.isNotNull(), hit_depth).alias("hit_depth"),
        (depth + hit_depth - 2 * F.col("_lca")).alias("distance"),
        (F.col("_lca") / below_root).alias("relative_lca_depth"),
        F.when(q.isNotNull(), hit_depth / below_root).alias("relative_depth"),
    )


def _top_hits(hits: DataFrame, keys: list[str], k: int, name: str, totals: Column, names: DataFrame) -> DataFrame:
    """(keys, <name>_taxids, <name>_shares, <name>_names): the k largest hits of each group, ties by id."""
    order = Window.partitionBy(*keys).orderBy(F.desc("kmer_count"), "kmer_tax_id")
    best = hits.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= k)
    best = best.join(names, best["kmer_tax_id"] == names["_id"], "left")
    # k rows a group at most.
    rows = F.array_sort(F.collect_list(F.struct("_rank", F.col("kmer_tax_id").alias("id"), (F.col("kmer_count") / totals).alias("share"), F.coalesce("_name", F.lit("Unknown")).alias("name"))))
    return best.groupBy(*keys).agg(rows.alias("_r")).select(*keys, F.col("_r.id").alias(f"{name}_taxids"), F.col("_r.share").alias(f"{name}_shares"), F.col("_r.name").alias(f"{name}_names"))


def kmer_counts_and_ratios(hits: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    """(keys, 8 counts, 13 ratios) of labelled hits."""
    c, inside, some = F.col("kmer_count"), F.col("in_clade"), F.coalesce(F.col("kmer_tax_id") > 0, F.lit(False))
    of = lambda cond: F.coalesce(F.sum(F.when(cond, c)), F.lit(0)).cast("long")
    n = hits.groupBy(*keys).agg(
        F.sum(c).cast("long").alias("total"), of(inside).alias("clade"), of(~inside & some).alias("exclade"),
        of(F.col("in_lineage") & ~inside).alias("lineage"), of((F.col("kmer_tax_id") == ROOT) & ~inside).alias("root"),
    )
    n = n.withColumn("classified", F.col("clade") + F.col("exclade")).withColumn("misclassified", F.col("exclade") - F.col("lineage"))
    n = n.withColumn("unclassified", F.col("total") - F.col("classified")).withColumn("supporting", F.col("clade") + F.col("lineage"))
    return n.select(*keys, *[F.col(x).alias(f"{prefix}_{x}_count") for x in COUNTS], *[ratio(F.col(a), F.col(b)).alias(name) for (a, b), name in zip(RATIOS, ratio_names(prefix), strict=True)])


def kmer_hits(kmers: DataFrame, taxa: DataFrame, scope: str = "global") -> DataFrame:
    """Hits of every taxon (scope global) or sample and taxon (scope sample), pooled and labelled."""
    keys = SCOPES[scope]
    pooled = kmers.groupBy(*keys, "kmer_tax_id").agg(F.sum("kmer_count").alias("kmer_count"))
    if scope == "global":
        hits = labelled_hits(pooled, taxa)
    else:  # codes are compared once for each pair, not for each sample; hits are pooled once for both sides of the join
        pooled = saved(pooled, "pooled")
        labels = labelled_hits(pooled.select("t_id", "kmer_tax_id").distinct(), taxa)
        labels = labels.withColumnsRenamed({"t_id": "_t", "kmer_tax_id": "_k"})
        hits = pooled.join(labels, (F.col("t_id") == F.col("_t")) & F.col("kmer_tax_id").eqNullSafe(F.col("_k"))).drop("_t", "_k")
    return hits


def kmer_features(kmers: DataFrame, taxa: DataFrame, scope: str = "global", top: int | None = None, parts: tuple[str, ...] = PARTS) -> DataFrame:
    """Counts and ratios, statistics of distances, and top hits for every taxon (scope global) or sample and taxon (scope sample); parts of them if asked.

    kmers: (t_id, kmer_tax_id, kmer_count, sample_id). The top 5 hits are kept globally, 3 by sample. Labelled hits are written once for all parts.
    """
    keys = SCOPES[scope]
    top, prefix = top or {"global": 5, "sample": 3}[scope], f"kmers_{scope}"
    hits = kmer_hits(kmers, taxa, scope)
    if parts == ("counts",):
        return kmer_counts_and_ratios(hits, keys, prefix)
    hits = saved(hits, "hits")
    counts = kmer_counts_and_ratios(hits, keys, prefix)
    out = counts if "counts" in parts else hits.select(*keys).distinct()
    outside = hits.filter(~F.col("in_clade") & (F.col("kmer_tax_id") > 0))
    wrong, above = ~F.col("in_lineage"), F.col("in_lineage")
    if "stats" in parts:
        stats = distributions(
            outside, keys,
            {
                f"{prefix}_misclassified_dist": F.when(wrong, F.col("distance")),
                f"{prefix}_misclassified_depth": F.when(wrong, F.col("hit_depth")),
                f"{prefix}_misclassified_relative_lca_depth": F.when(wrong, F.col("relative_lca_depth")),
                f"{prefix}_lineage_relative_depth": F.when(above, F.col("relative_depth")),
            },
            "kmer_count", hits.count() if scope == "sample" else None,  # a taxon of all samples may have most of the hits
        )
        out = out.join(stats, keys, "left")
    if "top" not in parts:
        return out
    names = taxa.select(F.col("t_id").alias("_id"), F.col("name").alias("_name"))
    totals = counts.select(*keys, F.col(f"{prefix}_misclassified_count").alias("_m"), F.col(f"{prefix}_exclade_count").alias("_e"))
    measured = outside.join(totals, keys)
    for rows, kind, total in ((measured.filter(wrong), "misclassified", "_m"), (measured, "exclade", "_e")):
        out = out.join(_top_hits(rows, keys, top, f"{prefix}_{kind}_top{top}", F.col(total), names), keys, "left")
    return out


def kmer_stability(samples: DataFrame) -> DataFrame:
    """Occupancy, and statistics over samples of the ratios of kmer_features(scope="sample"), whose part counts is enough."""
    samples = saved(samples.select("sample_id", "t_id", *ratio_names("kmers_sample")), "ratios")
    n = samples.select("sample_id").distinct().count()
    present = samples.groupBy("t_id").agg((F.count(F.lit(1)) / F.lit(max(n, 1))).alias("kmers_stability_occupancy_ratio"))
    stats = distributions(samples, ["t_id"], {b: F.col(a) for a, b in zip(ratio_names("kmers_sample"), ratio_names("kmers_stability"), strict=True)}, n_rows=samples.count())
    return present.join(stats, "t_id", "left")


def read_length_features(lengths: DataFrame, scope: str = "global", min_reads: int = 50) -> DataFrame:
    """Reads and statistics of their lengths for every taxon with min_reads (global), or for every sample and taxon."""
    if scope == "global":
        keys, prefix, least = ["t_id"], "reads_global", min_reads
    else:
        keys, prefix, least = ["t_id", "sample_id", *[c for c in ("year", "week") if c in lengths.columns]], "reads_sample", 0
    pooled = lengths.groupBy(*keys, "read_length").agg(F.sum("read_count").alias("read_count"))
    totals = pooled.groupBy(*keys).agg(F.sum("read_count").cast("long").alias(f"{prefix}_total_count")).filter(F.col(f"{prefix}_total_count") >= least)
    return totals.join(distributions(pooled, keys, {f"{prefix}_readlen": F.col("read_length")}, "read_count"), keys)


def abundance_features(cells: DataFrame, inspect: DataFrame | None = None) -> DataFrame:
    """Statistics over samples of cells (t_id, sample_id, value), one for every sample; with inspect (t_id, clade_minimizers), also by minimizer."""
    out = distributions(cells, ["t_id"], {"abund_global": F.col("value")})
    # A taxon without any value keeps its row.
    out = cells.select("t_id").distinct().join(out, "t_id", "left")
    if inspect is None:
        return out
    own = cells.join(inspect.select("t_id", F.col("clade_minimizers").cast("double").alias("_mm")), "t_id", "left").withColumn("_r", ratio(F.col("value"), F.col("_mm")))
    by = distribution(own, ["t_id"], "_r").select("t_id", F.col("mean").alias("abund_global_meanVSmm_ratio"), F.col("median").alias("abund_global_medianVSmm_ratio"))
    return out.join(by, "t_id", "left")


def unpivoted(table: DataFrame) -> DataFrame:
    """A wide table (t_id and a column a sample) as cells (t_id, sample_id, value)."""
    samples = [c for c in table.columns if c != "t_id"]
    if not samples:
        raise ValueError("the table has no sample column beside t_id")
    return table.select("t_id", *[F.col(f"`{c}`").cast("double").alias(c) for c in samples]).unpivot("t_id", [F.col(f"`{c}`") for c in samples], "sample_id", "value")


def minimizer_samples(reports: DataFrame, inspect: DataFrame, taxa: DataFrame) -> DataFrame:
    """(t_id, sample_id, reads_tot, mm_tot, mm_uniq, mm_uniq_per_read, mm_uniq_prop, mm_obs_cov, mm_exp_cov).

    reports: (t_id, sample_id, taxon_reads, mm_tot, mm_uniq), one row a cell; inspect: (t_id, clade_minimizers). Reads are
    clade sums. The expected cover of R reads is 1 - (1 - 1/M)^R, with M the minimizers known over the taxon's median yield of a read.
    """
    rows = clade_sums(reports, taxa, ("mm_tot", "mm_uniq")).filter(~F.col("t_id").isin(UNCLASSIFIED, FILTERED))
    rows = rows.join(inspect.select("t_id", F.col("clade_minimizers").alias("_db")), "t_id", "left")
    rows = rows.select("t_id", "sample_id", F.col("clade_reads").alias("reads_tot"), "mm_tot", "mm_uniq", ratio(F.col("mm_uniq"), F.col("clade_reads")).alias("mm_uniq_per_read"), ratio(F.col("mm_uniq"), F.col("mm_tot")).alias("mm_uniq_prop"), ratio(F.col("mm_uniq"), F.col("_db")).alias("mm_obs_cov"), "_db")
    usual = F.median("mm_uniq_per_read").over(Window.partitionBy("t_id"))
    rows = rows.withColumn("_m", F.when(usual > 0, F.col("_db") / usual))
    return rows.withColumn("mm_exp_cov", F.when(F.col("_m") > 0, 1 - F.pow(1 - 1 / F.col("_m"), F.col("reads_tot")))).drop("_m", "_db")


def minimizer_correlations(samples: DataFrame) -> DataFrame:
    """Correlation of observed and expected cover over samples, with and without the largest ones, and the distribution of the observed."""
    rows = saved(samples.select("t_id", "sample_id", "mm_obs_cov", "mm_exp_cov"), "covers")
    n = F.count(F.lit(1)).over(Window.partitionBy("t_id"))
    place = F.row_number().over(Window.partitionBy("t_id").orderBy(F.desc_nulls_last("mm_obs_cov"), "sample_id"))
    most = F.round(F.greatest(n * OUTLIER_PERCENT / 100, F.lit(float(LEAST_OUTLIERS))))
    placed = rows.withColumn("_in", (place > most) & F.col("mm_obs_cov").isNotNull())
    enough, x, y = F.count(F.lit(1)) >= CORRELATED_SAMPLES, F.col("mm_obs_cov"), F.col("mm_exp_cov")
    inside = lambda c: F.when(F.col("_in"), c)
    out = placed.groupBy("t_id").agg(
        F.count(F.lit(1)).alias("mm_pearson_n"), F.count_if("_in").alias("mm_pearson_filtered_n"),
        F.when(enough, pearson(x, y)).alias("mm_pearson_corr"), F.when(enough, pearson(inside(x), inside(y))).alias("mm_pearson_filtered_corr"),
    )
    out = out.join(distributions(rows, ["t_id"], {"mm_obs_cov": x}), "t_id", "left")
    p = lambda kind: correlation_p(F.col(f"{kind}_corr"), F.col(f"{kind}_n")).alias(f"{kind}_p")
    named = lambda kind: [F.col(f"{kind}_corr"), p(kind), F.col(f"{kind}_n")]
    return out.select("t_id", *named("mm_pearson"), *named("mm_pearson_filtered"), *[c for c in out.columns if c.startswith("mm_obs_cov")])
