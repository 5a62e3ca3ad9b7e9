"""Whole jobs from files to files: read, check provenance, run an operator, write the table and what it was made of.

Cases: nothing is replaced unless overwrite is set, and that is checked before any work; inputs of another type or version are errors; an input without rows
gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import annotate as notes
from ..operators import extract, features, kmers, rollup, tables
from ..functions.scalar import name_in_period
from ..operators.taxonomy import FILTERED, UNCLASSIFIED, canonical_ranks, prepared, signature
from ..shared import saved
from ..sources import provenance, reads, reports, single
from ..sources.tables import read_ids, read_inspect, read_table, read_taxonomy, write_table


def load_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """Nodes with paths, intervals and codes: a folder of dump files is prepared once into <folder>/prepared.parquet, which is read after that."""
    ready = f"{path.rstrip('/')}/prepared.parquet"
    if not provenance.exists(spark, f"{ready}/_SUCCESS"):
        prepared(read_taxonomy(spark, path)).write.mode("overwrite").parquet(ready)
    return spark.read.parquet(ready)


def _finish(spark: SparkSession, df: DataFrame, path: str, file_type: str, source: str, overwrite: bool, sorting: str = "", single: bool = False, **more: str) -> str:
    """The table and its facts are written aside and published together, so that a job that fails leaves what was there."""
    staged = provenance.staging(path)
    try:
        write_table(df, staged, quoted=file_type.endswith("FEATURE_TABLE"), single=single)
        provenance.write_provenance(spark, staged, file_type, source, sorting, **more)
        if not overwrite:
            provenance.free(spark, path, False)
        provenance.publish(spark, staged, path)
    except BaseException:
        provenance.discard(spark, staged)
        raise
    return path


def collect_reports(spark: SparkSession, folder: str, output: str, pattern: str = "*.report", recursive: bool = True, overwrite: bool = False) -> str:
    provenance.free(spark, output, overwrite)
    rows, kind, dated = reports.read_reports(spark, folder, pattern, recursive)
    return _finish(spark, reports.sorted_reports(rows), output, "REPORT_PARQUET", folder, overwrite, "year, week, sample_id, t_id" if dated else "sample_id, t_id", standard="DATED" if dated else "GENERIC", report_format=kind)


def collect_classifications(spark: SparkSession, classified: str, output: str, first: str | None = None, second: str | None = None, overwrite: bool = False, taxonomy: str | None = None) -> str:
    """With a taxonomy, reads are stored by their places in it, and extract_reads() with the same one reads little but the wanted clades."""
    provenance.free(spark, output, overwrite)
    rows, more = reads.with_sequences(spark, classified, first, second), {}
    if taxonomy:
        taxa = load_taxonomy(spark, taxonomy)
        rows, more = reads.placed(rows, taxa), {"taxonomy": signature(taxa)}
    return _finish(spark, reads.clustered(rows), output, "KRAKEN_PARQUET", classified, overwrite, "entry" if taxonomy else "t_id", has_fastq=str(first is not None), **more)


def collect_kmers(spark: SparkSession, classified: str, output: str, taxonomy: str, overwrite: bool = False) -> tuple[str, str]:
    """k-mer counts and read lengths by species, two tables in the folder output."""
    paths = f"{output.rstrip('/')}/kmers.parquet", f"{output.rstrip('/')}/read_lengths.parquet"
    for p in paths:
        provenance.free(spark, p, overwrite)
    rows, taxa = reads.read_classified(spark, classified), load_taxonomy(spark, taxonomy)
    by = ("sample_id", "year", "week")
    _finish(spark, kmers.kmer_counts(rows, taxa, by).orderBy("t_id", "kmer_tax_id"), paths[0], "KMER_AGG_PARQUET", classified, overwrite, "t_id, kmer_tax_id")
    _finish(spark, kmers.read_lengths(rows, taxa, by).orderBy("t_id", "read_length"), paths[1], "READ_LEN_PARQUET", classified, overwrite, "t_id, read_length")
    return paths


def collect_chunks(spark: SparkSession, pattern: str, output: str, overwrite: bool = False) -> str:
    """Feature tables that were made in parts, as one; their types, columns and versions are checked."""
    provenance.free(spark, output, overwrite)
    paths = sorted({f.rsplit("/", 1)[0] for f in spark.read.parquet(pattern).inputFiles()})
    types = {provenance.read_provenance(spark, p).get("file_type") for p in paths}
    if len(types) != 1 or not types <= {"FEATURE_TABLE", "LONG_FEATURE_TABLE"}:
        raise ValueError(f"{pattern}: parts are feature tables of one type, not {sorted(map(str, types))}")
    (file_type,) = types
    columns = tuple(spark.read.parquet(paths[0]).columns)
    for p in paths:
        provenance.checked(spark, p, file_type, columns)
        if set(spark.read.parquet(p).columns) != set(columns):
            raise ValueError(f"{p} has other columns than {paths[0]}")
    rows = spark.read.parquet(*paths)
    keys = [c for c in ("sample_id", "t_id") if c in rows.columns]
    return _finish(spark, rows.orderBy(*keys), output, file_type, pattern, overwrite, ", ".join(keys))


def make_table(
    spark: SparkSession, report: str, output: str, taxonomy: str, mode: str = "clade", min_reads: int = 50, min_observed: int = 25, clade: int | None = None, exclude: str | None = None,
    keep_unclassified: bool = False, keep_filtered: bool = False, mass_balance: bool = False, as_proportions: bool = False, dry_run: bool = False, overwrite: bool = False, single: bool = False,
) -> dict:
    """An abundance table with a column a sample (a column a week for dated samples), and its audit, which is observed while the table is made. single: CSV and TSV are one file."""
    if not dry_run:
        provenance.free(spark, output, overwrite)
    facts = provenance.checked(spark, report, "REPORT_PARQUET", ("sample_id", "t_id", "taxon_reads"))
    keep_unclassified, keep_filtered = keep_unclassified or mass_balance, keep_filtered or mass_balance
    rows, taxa = spark.read.parquet(report), load_taxonomy(spark, taxonomy)
    out = tuple(read_ids(spark, exclude)) if exclude else ()
    chosen = tables.selected_reads(rows, out, facts["data_standard"] == "DATED")
    base, cells, watch = tables.watched_table(chosen, taxa, mode, keep_unclassified, clade, min_reads=min_reads, min_observed=min_observed, keep_filtered=keep_filtered, ranks=canonical_ranks(taxa))
    if mode == "canonical":
        kept = base if keep_unclassified else base.filter(F.col("t_id") != UNCLASSIFIED)
        scope = taxa if clade is None else taxa.filter(F.array_contains("path", clade))
        known = kept.join(scope.select("t_id"), "t_id", "left_semi")
        held = cells.filter(~F.col("t_id").isin(UNCLASSIFIED, FILTERED))
        if rollup.mass_balance(known, held).limit(1).count():
            raise RuntimeError("the canonical table does not hold all reads")
    audit = tables.audit(base, cells, watch, mode) | {"absent": tables.absent_samples(rows, out)}
    audit |= {"many_needed": min_observed * 2 > audit["samples"]}
    if not dry_run:
        values = tables.proportions(cells, mode) if as_proportions else cells.drop("own")
        _finish(spark, tables.wide(values).orderBy("t_id"), output, "RAW_TABLE", report, overwrite, "t_id", single, standard=facts["data_standard"], mode=mode)
    return audit


def make_features(spark: SparkSession, kind: str, source: str, output: str, taxonomy: str | None = None, inspect: str | None = None, exclude: str | None = None, min_reads: int = 50, long_output: str | None = None, overwrite: bool = False, single: bool = False) -> str:
    """kind: kmer-global, kmer-sample, kmer-stability, read-lengths-global, read-lengths-sample, abundance or minimizers."""
    provenance.free(spark, output, overwrite)
    taxa = load_taxonomy(spark, taxonomy) if taxonomy else None
    keys, file_type = ["t_id"], "FEATURE_TABLE"
    if kind in ("kmer-global", "kmer-sample"):
        out = features.kmer_features(spark.read.parquet(source), taxa, kind.removeprefix("kmer-"))
        if kind == "kmer-sample":
            keys, file_type = ["sample_id", "t_id"], "LONG_FEATURE_TABLE"
    elif kind == "kmer-stability":
        out = features.kmer_stability(spark.read.parquet(source))
    elif kind in ("read-lengths-global", "read-lengths-sample"):
        out = features.read_length_features(spark.read.parquet(source), kind.removeprefix("read-lengths-"), min_reads)
        if kind == "read-lengths-sample":
            keys, file_type = ["t_id", "sample_id"], "LONG_FEATURE_TABLE"
    elif kind == "abundance":
        out = features.abundance_features(features.unpivoted(read_table(spark, source)), read_inspect(spark, inspect) if inspect else None)
    elif kind == "minimizers":
        provenance.checked(spark, source, "REPORT_PARQUET", ("mm_tot", "mm_uniq"))
        rows = spark.read.parquet(source)
        bad = read_ids(spark, exclude) if exclude else []
        rows = saved(features.minimizer_samples(rows.filter(~F.col("sample_id").isin(bad)) if bad else rows, read_inspect(spark, inspect), taxa), "minimizers")
        if long_output:
            provenance.free(spark, long_output, overwrite)
            _finish(spark, rows.orderBy("t_id", "sample_id"), long_output, "LONG_FEATURE_TABLE", source, overwrite, "t_id, sample_id")
        out = features.minimizer_correlations(rows)
    else:
        raise ValueError(f"no features of the kind {kind}")
    return _finish(spark, out.orderBy(*keys), output, file_type, source, overwrite, ", ".join(keys), single)


def annotate(spark: SparkSession, source: str, output: str, taxonomy: str, metadata: tuple[str, ...] = (), order: str = "alphabetical", add_stats: bool = False, overwrite: bool = False, single: bool = False) -> str:
    """A table with names, lineages and metadata, in the order of names or of the tree. single: CSV and TSV are one file."""
    if order not in ("alphabetical", "dfs"):
        raise ValueError("order is alphabetical or dfs")
    provenance.free(spark, output, overwrite)
    facts = provenance.checked(spark, source, "RAW_TABLE", ("t_id",))
    taxa = load_taxonomy(spark, taxonomy)
    more = {p.rstrip("/").rsplit("/", 1)[-1].split(".")[0]: read_table(spark, p) for p in metadata}
    rows, ranks = read_table(spark, source), canonical_ranks(taxa)
    table = notes.annotated(rows, taxa, more, add_stats, ranks)
    found = {f"matched_{name}": "{} of {}".format(*notes.matched(rows, m)) for name, m in more.items()}
    if order == "alphabetical":
        table = table.orderBy(*notes.alphabetical_keys(table, ranks))
    else:
        table = notes.depth_first(table, taxa, "sig_avg" if add_stats else None, facts.get("mode") == "clade").orderBy("dfs_key", "t_id").drop("dfs_key")
    return _finish(spark, table, output, "ANNOTATED_TABLE", source, overwrite, order, single, **found)


def extract_reads(
    spark: SparkSession, source: str, output: str, taxonomy: str, wanted: list[int], mode: str = "clade", combined: bool = False,
    from_year: int | None = None, from_week: int | None = None, to_year: int | None = None, to_week: int | None = None, overwrite: bool = False, files: bool = False,
) -> str:
    """Reads of wanted taxa, a folder set=<name> each, as gzipped FASTQ (mates apart) or lists of ids; a set without reads gets an empty file.

    With files, each set is one file instead, <name>_R1.fastq.gz, <name>_R2.fastq.gz or <name>.txt. Reads come by sample, in the order of the classified file where the table
    has it, or else of their ids. source is a table of reads, or a folder of such tables; tables named for a week outside the period are not read, and of
    tables stored with the same taxonomy only the wanted clades.
    """
    provenance.free(spark, output, overwrite)
    taxa = load_taxonomy(spark, taxonomy)
    between = {"from_year": from_year, "from_week": from_week, "to_year": to_year, "to_week": to_week}
    paths = [p for p in provenance.tables_in(spark, source) if name_in_period(p, **between)]
    facts = [provenance.checked(spark, p, "KRAKEN_PARQUET", ("sample_id", "t_id", "read_id", "year", "week")) for p in paths]
    week = lambda w: "" if w is None else f"W{w:02}"
    span = f"_{from_year or 'Start'}{week(from_week)}-to-{to_year or 'End'}{week(to_week)}" if from_year or to_year else ""
    name = extract.set_name(mode, combined, span)
    wanted = [int(x) for x in dict.fromkeys(wanted)]
    targets = spark.createDataFrame([(x,) for x in wanted], "target long").join(taxa.select(F.col("t_id").alias("target"), "name"), "target", "left")
    own, parts, sets = signature(taxa) if any("taxonomy" in f for f in facts) else None, [], []
    kinds = [(f.get("has_fastq") == "True", own is not None and f.get("taxonomy") == own) for f in facts]
    for with_mates, by_place in sorted(set(kinds)):
        rows = spark.read.parquet(*[p for p, kind in zip(paths, kinds, strict=True) if kind == (with_mates, by_place)])
        samples = rows.select("sample_id").distinct()
        rows = extract.wanted_reads(rows, taxa, wanted, mode, by_place, **between).join(targets, "target")
        each = [F.concat(name, F.lit(f"_{m}")) for m in ("R1", "R2")] if with_mates else [name]
        # Few names: samples times the ids that the user lists.
        both = targets if combined or not wanted else samples.withColumn("target", F.explode(F.array(*[F.lit(x).cast("long") for x in wanted]))).join(targets, "target")
        sets.append(both.select(F.explode(F.array(*each)).alias("set"), F.lit(".fastq.gz" if with_mates else ".txt").alias("ending")))
        order = ["sample_id", (F.col("place") if "place" in rows.columns else F.lit(0)).cast("long").alias("place"), "read_id"]
        if with_mates:
            parts += [rows.filter("r1_seq IS NOT NULL" if p == "r1" else "r1_seq IS NOT NULL AND r2_seq IS NOT NULL").select(x.alias("set"), *order, extract.fastq_lines(F.col("read_id"), F.col(f"{p}_seq"), F.col(f"{p}_qual")).alias("value")) for p, x in zip(("r1", "r2"), each, strict=True)]
        else:
            parts.append(rows.select(name.alias("set"), *order, F.col("read_id").alias("value")))
    endings: dict[str, str] = {}
    for s in sets:
        endings |= {r["set"]: r["ending"] for r in s.distinct().toLocalIterator()}
    staged = provenance.staging(output)
    try:
        extract.write_sets(spark, parts, staged)
        if files:
            single.named(spark, staged, f"{staged}.files", {f"set={n}": f"{n}{e}" for n, e in endings.items()})
        else:
            for n in endings:
                if not provenance.exists(spark, f"{staged}/set={n}"):
                    provenance.empty_text(spark, f"{staged}/set={n}/part-00000.txt.gz")
        provenance.publish(spark, staged, output, f"{staged}.files" if files else staged)
    except BaseException:
        provenance.discard(spark, staged)
        raise
    return output


def show(spark: SparkSession, path: str) -> dict[str, str]:
    """What a table was made of."""
    facts = provenance.read_provenance(spark, path)
    if not facts:
        raise FileNotFoundError(provenance.companion(path))
    return facts


