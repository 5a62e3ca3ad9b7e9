from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F
from tree import NODES, SCHEMA

from clademill.functions import scalar
from clademill.functions.stats import correlation_p, correlations, distribution
from clademill.operators import annotate, extract, features, kmers, taxonomy


@pytest.fixture(scope="module")
def taxa(spark):
    return taxonomy.with_paths(spark.createDataFrame(NODES, SCHEMA)).cache()


def _value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_two_samples_pooled(spark, taxa):
    """30 hits in the clade, 2 in the lineage, 5 elsewhere."""
    rows = [("a", "C", 9606, "150|150", "9606:10 1:2 A:3 |:|"), ("b", "C", 9606, "150|150", "9606:20 562:5 0:1"), ("b", "C", 10090, "150", ""), ("b", "U", 0, "100|90", "0:9"), ("b", "C", 7711, "100", "9606:1")]
    reads = spark.createDataFrame(rows, "sample_id string, status string, t_id long, lengths string, kmer_string string")
    counts = kmers.kmer_counts(reads, taxa)
    r = {x.t_id: x for x in features.kmer_features(counts, taxa).collect()}
    assert set(r) == {9606, 10090}
    x = r[9606]
    assert (x.kmers_global_clade_count, x.kmers_global_lineage_count, x.kmers_global_misclassified_count, x.kmers_global_unclassified_count) == (30, 2, 5, 1)
    assert round(x.kmers_global_cladeVSclassified_ratio, 5) == 0.81081 and abs(x.kmers_global_misclassifiedVSclassified_ratio - 5 / 37) < 1e-9
    assert x.kmers_global_misclassified_top5_taxids == [562] and x.kmers_global_exclade_top5_names == ["Escherichia coli", "root"]
    assert r[10090].kmers_global_total_count == 0 and r[10090].kmers_global_cladeVStotal_ratio is None
    lengths = {(x.sample_id, x.t_id): (x.read_length, x.read_count) for x in kmers.read_lengths(reads, taxa).collect()}
    assert lengths == {("a", 9606): (300, 1), ("b", 9606): (300, 1), ("b", 10090): (150, 1)}


def test_weighted_distribution(spark):
    rows = [(100, "S1", 10.0, 1), (100, "S1", 20.0, 1), (200, "S1", 100.0, 10), (300, "S1", None, 4), (400, "S1", 5.0, 0)]
    got = {r.t_id: r for r in distribution(spark.createDataFrame(rows, "t_id long, sample_id string, v double, w long"), ["t_id", "sample_id"], "v", "w").collect()}
    assert set(got) == {100, 200}
    assert (got[100]["mean"], got[100]["median"], got[200]["mean"], got[200]["stdev"]) == (15, 10, 100, 0)
    big = distribution(spark.createDataFrame([(9606, 150, 50_000_000)], "t_id long, v int, w int"), ["t_id"], "v", "w").first()
    assert (big["mean"], big["median"]) == (150, 150)


def test_nearest_quantiles(spark):
    """The 5 % place of 1 .. 31 is 2.5, which is nearest to the third value."""
    r = distribution(spark.range(1, 32).select(F.lit(1).alias("k"), F.col("id").alias("v")), ["k"], "v").first()
    assert (r["mean"], r["median"], r["p05"], r["p95"]) == (16, 16, 3, 30)


def test_correlation(spark):
    """t of 2 with 4 degrees of freedom, and of 1 with 1, are in any table."""
    p = lambda r, n: _value(spark, correlation_p(F.lit(r), F.lit(n)))
    r4, r1 = 2 / math.sqrt(2 * 2 + 4), 1 / math.sqrt(1 + 1)
    assert abs(p(r4, 6) - 0.116117) < 1e-6 and abs(p(r1, 3) - 0.5) < 1e-12
    assert p(1.0, 6) == 0 and p(0.5, 2) is None and _value(spark, correlation_p(F.lit(None).cast("double"), F.lit(6))) is None
    rows = spark.createDataFrame([(1, 1.0, 2.0), (1, 2.0, 4.0), (1, 3.0, None), (2, 1.0, 1.0), (2, 1.0, 2.0)], "k int, x double, y double")
    assert {r.k: (r.n_pairs, r.r) for r in correlations(rows, ["k"], "x", "y").collect()} == {1: (2, 1.0), 2: (2, None)}


def test_too_few_samples(spark, taxa):
    rows = [(562, f"s{i}", 5 + i, 100, 10 + i) for i in range(5)]
    reports = spark.createDataFrame(rows, "t_id long, sample_id string, taxon_reads long, mm_tot long, mm_uniq long")
    inspect = spark.createDataFrame([(562, 1000)], "t_id long, clade_minimizers long")
    r = features.minimizer_correlations(features.minimizer_samples(reports, inspect, taxa)).filter("t_id = 562").first()
    assert r.mm_pearson_corr is None and r.mm_pearson_n == 5


def test_abundance_by_minimizer(spark):
    table = spark.createDataFrame([(100, 10.0, 20.0), (200, 5.0, 5.0), (300, None, None)], "t_id long, a double, b double")
    inspect = spark.createDataFrame([(100, 10), (200, 5)], "t_id long, clade_minimizers long")
    r = {x.t_id: x for x in features.abundance_features(features.unpivoted(table), inspect).collect()}
    assert (r[100]["abund_global_meanVSmm_ratio"], r[200]["abund_global_medianVSmm_ratio"], r[300]["abund_global_mean"]) == (1.5, 1.0, None)
    with pytest.raises(ValueError, match="sample column"):
        features.unpivoted(table.select("t_id"))


def test_annotated_order(spark, taxa):
    table = spark.createDataFrame([(9606, 100, 10), (2, 1, 1), (10090, 20, 20), (0, 5, 5), (taxonomy.FILTERED, 1, 1)], "t_id long, a int, b int")
    meta = spark.createDataFrame([(9606, "x", 1)], "t_id long, status string, a int")
    out = annotate.annotated(table, taxa, {"m": meta, "n": meta}, add_stats=True)
    assert [c for c in out.columns if c.startswith(("status", "a_", "sig"))] == ["status", "a_m", "status_n", "a_n", "sig_avg", "sig_med"]
    rows = {r.t_id: r for r in out.collect()}
    assert rows[9606].sig_avg == 55 and rows[9606].t_genus == "Homo" and rows[0].t_scientific_name == "unclassified"
    dfs = annotate.depth_first(out, taxa, "sig_avg").orderBy("dfs_key")
    assert [r.t_id for r in dfs.collect()] == [0, taxonomy.FILTERED, 9606, 10090, 2]
    assert [r.t_id for r in out.orderBy(*annotate.alphabetical_keys(out)).collect()] == [0, taxonomy.FILTERED, 2, 9606, 10090]
    with pytest.raises(ValueError, match="t_id"):
        annotate.with_metadata(table, meta.drop("t_id"), "m")


def test_names_and_periods(spark):
    short = lambda x: _value(spark, scalar.short_name(F.lit(x)))
    assert [short(x) for x in ("Homo sapiens", "Candidatus Liberibacter", "Bacteria", "root")] == ["HomSap", "CanLib", "Bacteria", "root"]
    dated = lambda x: _value(spark, scalar.is_dated(F.lit(x)))
    assert [dated(x) for x in ("Ki_2013_7_1", "Lj-1974-53-001", "Ki_2013_54_1", "Xx_2013_7_1", "my_experiment", "Ki_2013_0_1")] == [True, True, False, False, False, False]
    inside = lambda y, w, **k: _value(spark, scalar.in_period(F.lit(y), F.lit(w), **k))
    assert inside(2013, 5, from_year=2013) and not inside(2013, 5, from_year=2013, from_week=6) and inside(2013, 5, to_year=2013) and inside(2013, 5, from_week=40)
    assert _value(spark, scalar.period(F.lit(2013), F.lit(7))) == "2013_07"
    assert _value(spark, scalar.sample_name(F.lit("file:/x/Ki_2013_7_1.kraken.gz"))) == "Ki_2013_7_1"


def test_reads_of_overlapping_clades(spark, taxa):
    reads = spark.createDataFrame([("r1", 9606, 2013, 1), ("r2", 562, 2014, 1), ("r3", 0, 2013, 1)], "read_id string, t_id long, year int, week int")
    pick = lambda *a, **k: sorted((r.read_id, r.target) for r in extract.wanted_reads(reads, taxa, *a, **k).collect())
    assert pick([2759, 9605, 9605]) == [("r1", 2759), ("r1", 9605)] and pick([2759], "taxon") == [] and pick([]) == []
    assert pick([1], from_year=2014) == [("r2", 1)]
