"""The registered queries of the taxonomic operators over the star schema's tables; their SQL is in oracle.py."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar
from ..functions.stats import STATISTICS, distribution
from ..operators import annotate, extract, features, kmers, rollup, tables, taxonomy
from ..shared import fresh_path, saved
from ..sources import blocks, single
from ..sources import lines as lines_of
from ..sources import reads as read_files
from ..sources import reports as report_files
from ..streaming import kmers as streaming
from . import warehouse as w

#: Thresholds and the clade (the region AMERICA) of the filtered queries.
MIN_READS, MIN_OBSERVED, CLADE = 3, 4, 11
_DIGITS = 6


def _rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits, lists as text: sums of doubles depend on their order."""
    out = {}
    for name, kind in df.dtypes:
        if kind == "double":
            out[name] = F.round(name, _DIGITS)
        elif kind == "array<double>":
            out[name] = F.array_join(F.transform(name, lambda x: F.format_number(x, 4)), ";")
        elif kind.startswith("array"):
            out[name] = F.array_join(F.col(name).cast("array<string>"), ";")
    return df.withColumns(out) if out else df


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmers.read_counts(w.bare_reads(spark, sf_dir))


def _kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmers.kmer_counts(w.reads(spark, sf_dir), w.taxa(spark, sf_dir))


def taxonomy_paths(spark, sf_dir):
    return w.taxa(spark, sf_dir).select("t_id", "parent_id", "rank", "name", "depth", F.array_join(F.col("path").cast("array<string>"), "/").alias("path"))


def nested_sets(spark, sf_dir):
    return taxonomy.nested_sets(w.taxa(spark, sf_dir))


def taxonomy_closure(spark, sf_dir):
    return taxonomy.closure(w.taxa(spark, sf_dir))


def clade_members(spark, sf_dir):
    return taxonomy.clade_members(w.taxa(spark, sf_dir), [CLADE, 100, 1000])


def lca_distance(spark, sf_dir):
    pairs = _kmers(spark, sf_dir).filter("kmer_tax_id > 0").select("t_id", "kmer_tax_id").distinct()
    return taxonomy.lowest_common(pairs, w.taxa(spark, sf_dir), "t_id", "kmer_tax_id")


def annotate_lineage(spark, sf_dir):
    ids = w.bare_reads(spark, sf_dir).select("t_id").filter("t_id > 0")
    return taxonomy.described(ids, w.taxa(spark, sf_dir), ("superkingdom", "phylum", "species"))


def report_merge(spark, sf_dir):
    return _counts(spark, sf_dir)


def report_files_read(spark, sf_dir):
    """Reports written as text, a folder a sample, and read again through the folder's name."""
    path = fresh_path(spark, "reports")
    rows = w.reports(spark, sf_dir).join(w.taxa(spark, sf_dir).select("t_id", "name"), "t_id", "left")
    line = F.concat_ws("\t", F.lit("0.0"), "taxon_reads", "taxon_reads", "mm_tot", "mm_uniq", F.lit("-"), "t_id", F.coalesce("name", F.lit("unclassified")))
    rows.select(F.concat("sample_id", F.lit(".report")).alias("sample"), line.alias("value")).repartition("sample").write.partitionBy("sample").text(path)
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"sample=([^/]+)/", 1)
    found, _, _ = report_files.read_reports(spark, path, "*.txt", sample_from=folder)
    return found


def period_counts(spark, sf_dir):
    rows = kmers.read_counts(w.bare_reads(spark, sf_dir), ("sample_id", "year", "week"))
    return rollup.pooled(tables.selected_reads(rows, ("1995-01", "2001-07"), by_period=True))


def _table(mode: str, **options):
    def query(spark, sf_dir):
        return _rounded(tables.abundance_table(_counts(spark, sf_dir), w.taxa(spark, sf_dir), mode, **options))

    return query


def clade_sum(spark, sf_dir):
    return rollup.clade_sums(_counts(spark, sf_dir), w.taxa(spark, sf_dir))


def clade_pushup(spark, sf_dir):
    return rollup.pushed_up(_counts(spark, sf_dir), w.taxa(spark, sf_dir), MIN_READS, MIN_OBSERVED)


def mass_balance(spark, sf_dir):
    """Reads of each sample before and after push-up and bubbling."""
    counts, taxa = _counts(spark, sf_dir).filter("t_id > 0"), w.taxa(spark, sf_dir)
    pushed = rollup.pushed_up(counts, taxa, MIN_READS, MIN_OBSERVED).groupBy("sample_id").agg(F.sum("taxon_reads").alias("pushed_up"))
    bubbled = rollup.canonical_remainders(counts, taxa, MIN_READS, MIN_OBSERVED).groupBy("sample_id").agg(F.sum("value").alias("bubbled"))
    return counts.groupBy("sample_id").agg(F.sum("taxon_reads").alias("reads")).join(pushed, "sample_id").join(bubbled, "sample_id")


def rank_totals(spark, sf_dir):
    return rollup.rank_totals(rollup.clade_sums(_counts(spark, sf_dir), w.taxa(spark, sf_dir)), w.taxa(spark, sf_dir))


def wide_table(spark, sf_dir):
    years = w.bare_reads(spark, sf_dir).withColumn("sample_id", F.left("sample_id", F.lit(4)))
    cells = tables.abundance_table(kmers.read_counts(years), w.taxa(spark, sf_dir), "clade", MIN_READS, MIN_OBSERVED, keep_unclassified=True)
    return tables.wide(cells)


def wide_monthly(spark, sf_dir):
    """wide_table with a column a month."""
    cells = tables.abundance_table(_counts(spark, sf_dir), w.taxa(spark, sf_dir), "clade", MIN_READS, MIN_OBSERVED, keep_unclassified=True)
    return tables.wide(cells)


def abundance_monthly(spark, sf_dir):
    """abundance_stats over months."""
    return _rounded(features.abundance_features(features.unpivoted(saved(wide_monthly(spark, sf_dir), "monthly"))))


def species_rollup(spark, sf_dir):
    return w.bare_reads(spark, sf_dir).select("read_id", "t_id").join(kmers.species_of(w.taxa(spark, sf_dir)), "t_id")


def kmer_aggregate(spark, sf_dir):
    return _kmers(spark, sf_dir)


def kmer_stream(spark, sf_dir):
    """kmer_aggregate from text files that a stream picks up."""
    path = fresh_path(spark, "stream")
    rows = w.reads(spark, sf_dir)
    line = F.concat_ws("\t", "status", F.col("read_id").cast("string"), F.col("t_id").cast("string"), "lengths", F.lit("0"), "kmer_string")
    rows.select(line.alias("value")).write.text(f"{path}/in")
    taxa = w.taxa(spark, sf_dir)
    streaming.count_arrivals(streaming.classified_stream(spark, f"{path}/in", 4).withColumn("sample_id", F.lit("all")), taxa, f"{path}/counts", f"{path}/checkpoint").awaitTermination()
    return streaming.counted(spark, f"{path}/counts").drop("sample_id")


def read_length_aggregate(spark, sf_dir):
    return kmers.read_lengths(w.bare_reads(spark, sf_dir), w.taxa(spark, sf_dir))


def _kmer_features(scope: str, part: str):
    def query(spark, sf_dir):
        needed = (part,) if part in features.PARTS else ("counts",)
        out = features.kmer_features(_kmers(spark, sf_dir), w.taxa(spark, sf_dir), scope, parts=needed)
        keys = features.SCOPES[scope]
        parts = {
            "counts": [c for c in out.columns if c.endswith("_count")],
            "ratios": [c for c in out.columns if c.endswith("_ratio")],
            "stats": [c for c in out.columns if c.endswith(tuple(f"_{s}" for s in STATISTICS))],
            "top": [c for c in out.columns if c.endswith(("_taxids", "_shares", "_names"))],
        }
        return _rounded(out.select(*keys, *parts[part]))

    return query


def kmer_bucketed_counts(spark, sf_dir):
    """kmer_global_counts of a stored table in buckets: no row of it moves by taxon."""
    out = features.kmer_features(w.bucketed_kmers(spark, sf_dir), w.taxa(spark, sf_dir), "global", parts=("counts",))
    return out.select("t_id", *[c for c in out.columns if c.endswith("_count")])


def price_quantiles(spark, sf_dir):
    """Statistics of the extended prices of line items by return flag: three groups of a third of all rows, split into intervals of values."""
    rows = w.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice", F.col("l_quantity").cast("double").alias("quantity"))
    plain = distribution(rows, ["l_returnflag"], "l_extendedprice", most=1000)
    weighted = distribution(rows, ["l_returnflag"], "l_extendedprice", "quantity", most=1000)
    named = lambda df, p: df.select("l_returnflag", *[F.round(s, 4).alias(f"{p}_{s}") for s in STATISTICS])
    return named(plain, "price").join(named(weighted, "by_quantity"), "l_returnflag")


def kmer_stability(spark, sf_dir):
    return _rounded(features.kmer_stability(features.kmer_features(_kmers(spark, sf_dir), w.taxa(spark, sf_dir), "sample", parts=("counts",))))


def readlen_global(spark, sf_dir):
    return _rounded(features.read_length_features(read_length_aggregate(spark, sf_dir), "global", 5))


def readlen_sample(spark, sf_dir):
    return _rounded(features.read_length_features(read_length_aggregate(spark, sf_dir), "sample"))


def _halves(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the first and of the second half of the samples that there are."""
    samples = sorted(r[0] for r in rows.select("sample_id").distinct().collect())
    cut = F.lit(samples[len(samples) // 2] if samples else None).cast("string")
    return rows.filter(F.col("sample_id") < cut), rows.filter(F.col("sample_id") >= cut)


def chunk_union(spark, sf_dir):
    """Read length features of all samples from two halves that were counted apart."""
    first, second = (features.read_length_features(half, "sample") for half in _halves(read_length_aggregate(spark, sf_dir)))
    return _rounded(first.unionByName(second))


def _dense(spark, sf_dir) -> DataFrame:
    """Yearly clade counts as a wide table, written once for all that reads it."""
    return saved(wide_table(spark, sf_dir), "wide")


def abundance_stats(spark, sf_dir):
    return _rounded(features.abundance_features(features.unpivoted(_dense(spark, sf_dir))))


def abundance_norm(spark, sf_dir):
    return _rounded(features.abundance_features(features.unpivoted(_dense(spark, sf_dir)), w.inspect(spark, sf_dir)))


def _minimizers(spark, sf_dir) -> DataFrame:
    return features.minimizer_samples(w.reports(spark, sf_dir), w.inspect(spark, sf_dir), w.taxa(spark, sf_dir))


def minimizer_cov(spark, sf_dir):
    return _rounded(_minimizers(spark, sf_dir))


def minimizer_corr(spark, sf_dir):
    return _rounded(features.minimizer_correlations(_minimizers(spark, sf_dir)))


def annotate_join(spark, sf_dir):
    """A table with lineages, two metadata tables (one with a clashing column) and row statistics."""
    taxa = w.taxa(spark, sf_dir)
    customers = w.table(spark, sf_dir, "customer").select((100_000 + F.col("c_custkey")).alias("t_id"), F.col("c_acctbal").alias("status"))
    clash = w.inspect(spark, sf_dir).select("t_id", F.col("clade_minimizers").alias("status"))
    return _rounded(annotate.annotated(_dense(spark, sf_dir), taxa, {"one": customers, "two": clash}, add_stats=True, ranks=("superkingdom", "phylum", "species")))


def sort_hierarchical(spark, sf_dir):
    ranks = ("superkingdom", "phylum", "species")
    table = annotate.annotated(_dense(spark, sf_dir), w.taxa(spark, sf_dir), ranks=ranks)
    keys = annotate.alphabetical_keys(table, ranks)
    return table.orderBy(*keys).select("t_id", keys[0].alias("first"), *[F.lower(f"t_{r}").alias(r) for r in ranks])


def sort_dfs(spark, sf_dir):
    table = _dense(spark, sf_dir)
    table = table.select("t_id", annotate.row_mean(table.columns[1:]).alias("sig_avg"))
    rows = annotate.depth_first(table, w.taxa(spark, sf_dir), "sig_avg", largest=True)
    return rows.orderBy("dfs_key").select("t_id", F.array_join(annotate.dfs_places(F.col("dfs_key")).cast("array<string>"), "/").alias("dfs_key"))


def sort_dfs_unweighted(spark, sf_dir):
    rows = annotate.depth_first(_dense(spark, sf_dir).select("t_id"), w.taxa(spark, sf_dir))
    return rows.orderBy("dfs_key").select("t_id", F.array_join(annotate.dfs_places(F.col("dfs_key")).cast("array<string>"), "/").alias("dfs_key"))


def reads_by_clade(spark, sf_dir):
    taxa = w.taxa(spark, sf_dir)
    rows = extract.wanted_reads(w.placed_reads(spark, sf_dir), taxa, [CLADE, 100, 1000, 100_001], by_place=True)
    rows = rows.join(taxa.select(F.col("t_id").alias("target"), "name"), "target")
    return rows.select("read_id", "target", extract.set_name("clade", False).alias("set_name"))


def temporal_filter(spark, sf_dir):
    rows = w.bare_reads(spark, sf_dir)
    return rows.filter(scalar.in_period(F.col("year"), F.col("week"), 1996, 12, 1998, None)).select("read_id", "year", "week", scalar.period(F.col("year"), F.col("week")).alias("period"))


def reads_in_period(spark, sf_dir):
    rows = extract.wanted_reads(w.placed_reads(spark, sf_dir), w.taxa(spark, sf_dir), [CLADE], by_place=True, from_year=1996, to_year=1997, to_week=20)
    return rows.select("read_id", "target")


def classified_files_read(spark, sf_dir):
    """Reads written as classifier output and read back."""
    path = fresh_path(spark, "classified")
    rows = w.bare_reads(spark, sf_dir)
    rows.select(F.concat_ws("\t", "status", F.col("read_id").cast("string"), F.col("t_id").cast("string"), "lengths").alias("value")).write.text(path)
    return read_files.read_classified(spark, path).select("read_id", "status", "t_id", "r1_len", "r2_len", "total_len")


#: Lines of a file of several that make up one input, beyond eight files.
FILE_LINES = 500_000


def _in_files(rows: DataFrame, key: str):
    """Deals frames of rows' key and value to files in the key's order: eight, or more for many rows."""
    files = max(8, -(-rows.count() // FILE_LINES))
    return lambda df: df.repartitionByRange(files, key).sortWithinPartitions(key).select("value")


def fastq_matched(spark, sf_dir):
    """Reads with the sequences of FASTQ files, each written as several files in order."""
    path = fresh_path(spark, "fastq")
    rows = w.bare_reads(spark, sf_dir)
    lines = F.concat_ws("\t", "status", F.col("read_id").cast("string"), F.col("t_id").cast("string"), "lengths")
    # Part files are numbered by range.
    ordered = saved(rows.select("read_id", lines.alias("value")), "fastq-rows")
    place = _in_files(ordered, "read_id")
    place(ordered).write.text(f"{path}/classified")
    for mate, letter in ((1, "A"), (2, "C")):
        n = F.col("read_id")
        seq = F.repeat(F.lit(letter), F.pmod(n, F.lit(7)).cast("int") + 1)
        record = extract.fastq_lines(F.concat(n.cast("string"), F.lit(f"/{mate}")), seq, F.regexp_replace(seq, letter, "@"))
        place(ordered.select("read_id", record.alias("value"))).write.text(f"{path}/r{mate}")
    out = read_files.with_sequences(spark, f"{path}/classified", f"{path}/r1", f"{path}/r2")
    return out.select(F.col("read_id").cast("long").alias("read_id"), "t_id", "r1_seq", "r2_seq", "r1_qual")


def fastq_repeated(spark, sf_dir):
    """Reads whose ids repeat, three in a row, beside FASTQ files that lack some of each id: a sequence goes to the first read of its id that is left."""
    path = fresh_path(spark, "repeated")
    rows = saved(w.bare_reads(spark, sf_dir).select(F.col("read_id").alias("k"), F.floor(F.col("read_id") / 3).cast("long").alias("id"), "t_id", "lengths", "status"), "repeated-rows")
    place = _in_files(rows, "k")
    place(rows.select("k", F.concat_ws("\t", "status", F.col("id").cast("string"), F.col("t_id").cast("string"), "lengths").alias("value"))).write.text(f"{path}/classified")
    for mate, letter, left_out in ((1, "A", 5), (2, "C", 4)):
        seq = F.repeat(F.lit(letter), F.pmod(F.col("k"), F.lit(7)).cast("int") + 1)
        record = extract.fastq_lines(F.concat(F.col("id").cast("string"), F.lit(f"/{mate}")), seq, seq)
        # The second file has no more reads of an id than the first: it lacks the same ones, and whole ids.
        some = (F.col("k") % 5 != 0) if mate == 1 else (F.col("k") % 5 != 0) & (F.col("id") % left_out != 0)
        place(rows.filter(some).select("k", record.alias("value"))).write.text(f"{path}/r{mate}")
    out = read_files.with_sequences(spark, f"{path}/classified", f"{path}/r1", f"{path}/r2")
    return out.select(F.col("read_id").cast("long").alias("read_id"), "t_id", "lengths", "r1_seq", "r2_seq")


def named_files(spark, sf_dir):
    """Ids of the reads of some clades, by sample and clade, from named files."""
    path, taxa = fresh_path(spark, "named"), w.taxa(spark, sf_dir)
    rows = extract.wanted_reads(w.placed_reads(spark, sf_dir), taxa, [CLADE, 1000], by_place=True).join(taxa.select(F.col("t_id").alias("target"), "name"), "target")
    part = rows.select(extract.set_name("clade", False).alias("set"), "sample_id", F.lit(0).cast("long").alias("place"), F.lpad(F.col("read_id").cast("string"), 20, "0").alias("read_id"), F.col("read_id").cast("string").alias("value"))
    part = saved(part, "named-rows")
    extract.write_sets(spark, [part], f"{path}/parts")
    names = [r["set"] for r in part.select("set").distinct().toLocalIterator()]  # samples times two clades
    single.named(spark, f"{path}/parts", f"{path}/files", {f"set={n}": f"{n}.txt" for n in names})
    lines = lines_of.numbered(spark, f"{path}/files")
    return lines.select(F.regexp_replace(F.element_at(F.split("file", "/"), -1), r"\.txt$", "").alias("set_name"), "line", F.col("value").cast("long").alias("read_id"))


def block_gzip_read(spark, sf_dir):
    """Reads written as block-gzipped classifier output and read back, each file in eight splits."""
    path = fresh_path(spark, "blocks")
    rows = w.bare_reads(spark, sf_dir)
    lines = rows.select("read_id", F.concat_ws("\t", "status", F.col("read_id").cast("string"), F.col("t_id").cast("string"), "lengths").alias("value"))
    rows.limit(0).select("status").write.text(path)  # the folder
    blocks.write_blocks(lines.repartitionByRange(2, "read_id").sortWithinPartitions("read_id").select("value"), path)
    size = max(1, max(blocks.lengths(spark, path), default=0) // 8)
    return read_files.read_classified(spark, f"{path}/*.gz", size).select("read_id", "status", "t_id", "r1_len", "r2_len", "total_len")


def _audit(mode: str):
    def query(spark, sf_dir):
        """Taxa and own reads by rank before and after, as observed while the table was made."""
        _, _, watch = tables.watched_table(_counts(spark, sf_dir), w.taxa(spark, sf_dir), mode, True, min_reads=MIN_READS, min_observed=MIN_OBSERVED)
        return spark.createDataFrame(watch.figures(), "rank string, taxa_before long, taxa_after long, reads_before long, reads_after long")

    return query


def _with_domains(spark, sf_dir) -> DataFrame:
    """The taxonomy with domains at its top."""
    named = lambda c: F.when(c == "superkingdom", F.lit("domain")).otherwise(c)
    return w.taxa(spark, sf_dir).withColumns({"rank": named(F.col("rank")), "ranks": F.transform("ranks", named)})


def canonical_domain(spark, sf_dir):
    """canonical_bubbled of a taxonomy whose top rank is domain."""
    taxa = _with_domains(spark, sf_dir)
    return tables.abundance_table(_counts(spark, sf_dir), taxa, "canonical", MIN_READS, MIN_OBSERVED, ranks=taxonomy.canonical_ranks(taxa))


def sort_domains(spark, sf_dir):
    """sort_hierarchical of a taxonomy whose top rank is domain."""
    taxa = _with_domains(spark, sf_dir)
    ranks = tuple(r for r in taxonomy.canonical_ranks(taxa) if r in ("domain", "superkingdom", "phylum", "species"))
    table = annotate.annotated(_dense(spark, sf_dir), taxa, ranks=ranks)
    keys = annotate.alphabetical_keys(table, ranks)
    return table.orderBy(*keys).select("t_id", keys[0].alias("first"), *[F.lower(f"t_{r}").alias(r) for r in ranks])


def read_migration(spark, sf_dir):
    """Reads by rank before and after push-up."""
    taxa, counts = w.taxa(spark, sf_dir), saved(_counts(spark, sf_dir), "counts")
    cells = saved(tables.abundance_table(counts, taxa, "taxon", MIN_READS, MIN_OBSERVED, keep_unclassified=True), "cells")
    return rollup.read_migration(counts, cells, taxa)


def queries() -> dict:
    names = (
        taxonomy_paths, nested_sets, taxonomy_closure, clade_members, lca_distance, annotate_lineage, report_merge, report_files_read, period_counts,
        clade_sum, clade_pushup, mass_balance, rank_totals, wide_table, species_rollup, kmer_aggregate, kmer_stream, read_length_aggregate, kmer_stability,
        readlen_global, readlen_sample, chunk_union, abundance_stats, abundance_norm, minimizer_cov, minimizer_corr, annotate_join, sort_hierarchical, sort_dfs,
        sort_dfs_unweighted, reads_by_clade, temporal_filter, reads_in_period, classified_files_read, fastq_matched, fastq_repeated, named_files, block_gzip_read, kmer_bucketed_counts, price_quantiles, wide_monthly, abundance_monthly,
        canonical_domain, sort_domains, read_migration,
    )
    limits = {"min_reads": MIN_READS, "min_observed": MIN_OBSERVED}
    made = {
        "taxon_table": _table("taxon", **limits, keep_unclassified=True),
        "clade_table": _table("clade", **limits),
        "clade_filtered": _table("clade", **limits, clade=CLADE),
        "keep_filtered_taxon": _table("taxon", **limits, clade=CLADE, keep_unclassified=True, keep_filtered=True),
        "keep_filtered_clade": _table("clade", **limits, clade=CLADE, keep_unclassified=True, keep_filtered=True),
        "proportions_taxon": _table("taxon", **limits, keep_unclassified=True, as_proportions=True),
        "proportions_clade": _table("clade", **limits, keep_unclassified=True, as_proportions=True),
        "canonical_remainder": _table("canonical", min_reads=0, min_observed=0, keep_unclassified=True),
        "canonical_bubbled": _table("canonical", **limits),
        "canonical_clade": _table("canonical", **limits, clade=CLADE, keep_filtered=True),
    }
    made |= {f"audit_{mode}": _audit(mode) for mode in tables.MODES}
    made |= {f"kmer_{scope}_{part}": _kmer_features(scope, part) for scope in ("global", "sample") for part in ("counts", "ratios", "stats", "top")}
    return {f.__name__: f for f in names} | made
