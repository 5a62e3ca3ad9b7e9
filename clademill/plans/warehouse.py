"""A taxonomy with reads, made of the star schema's tables, for queries that DuckDB can check.

root > region (superkingdom) > nation (phylum) > market segment of a nation (clade, not canonical) > customer (species) >
customer and order priority (strain). An order is a read of one of these, a line item is a stretch of k-mers, a month is a sample.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.kmers import kmer_counts
from ..operators.taxonomy import prepared
from ..shared import bucketed, saved
from ..sources.reads import clustered, placed

_taxonomies: dict[tuple[str, str], DataFrame] = {}
_ingests: dict[tuple[str, str], DataFrame] = {}
_tables: dict[tuple[str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    # A handful of segments.
    segments = customers.select("c_mktsegment").distinct().withColumn("segment", F.row_number().over(Window.orderBy("c_mktsegment")) - 1)
    return customers.join(segments, "c_mktsegment")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    return orders.join(_customers(spark, sf_dir).drop("c_name", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))


def _nation(c: str = "c_nationkey"):
    return 100 + F.col(c)


def _clade():
    return 1000 + 10 * F.col("c_nationkey") + F.col("segment")


def _species():
    return 100_000 + F.col("c_custkey")


def _strain():
    return 10_000_000 + 10 * F.col("c_custkey") + F.left("o_orderpriority", F.lit(1)).cast("int")


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = lambda df, t, p, rank, name: df.select(t.cast("long").alias("t_id"), p.cast("long").alias("parent_id"), F.lit(rank).alias("rank"), name.alias("name"))
    customers = _customers(spark, sf_dir)
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderpriority")
    strains = orders.join(customers.select("c_custkey"), "c_custkey", "left_semi").distinct()
    parts = [
        row(spark.range(1), F.lit(1), F.lit(1), "no rank", F.lit("root")),
        row(table(spark, sf_dir, "region"), 10 + F.col("r_regionkey"), F.lit(1), "superkingdom", F.col("r_name")),
        row(table(spark, sf_dir, "nation"), _nation("n_nationkey"), 10 + F.col("n_regionkey"), "phylum", F.col("n_name")),
        row(customers, _clade(), _nation(), "clade", F.concat_ws(" ", "c_mktsegment", F.col("c_nationkey").cast("string"))).distinct(),
        row(customers, _species(), _clade(), "species", F.col("c_name")),
        row(strains, _strain(), _species(), "strain", F.concat(F.lit("strain "), _strain().cast("string"))),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def taxa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nodes(), prepared and written once a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _taxonomies:
        _taxonomies[key] = saved(prepared(nodes(spark, sf_dir)), "taxonomy")
    return _taxonomies[key]


def bare_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(read_id, sample_id, year, week, status, t_id, lengths): reads without their hits."""
    k, date = F.col("o_orderkey"), F.col("o_orderdate")
    t_id = F.when(k % 10 == 0, F.lit(0)).when(k % 10 == 1, _nation()).when(k % 10 == 2, _clade()).when(k % 10 <= 7, _species()).otherwise(_strain()).cast("long")
    return _orders(spark, sf_dir).select(
        k.alias("read_id"), F.date_format(date, "yyyy-MM").alias("sample_id"), F.extract(F.lit("YEAROFWEEK"), date).cast("int").alias("year"), F.weekofyear(date).alias("week"),
        F.when(t_id == 0, "U").otherwise("C").alias("status"), t_id.alias("t_id"),
        F.concat_ws("|", (50 + k % 100).cast("string"), (50 + 7 * k % 100).cast("string")).alias("lengths"),
    )


def placed_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bare_reads() as an ingest stores them, clustered by their places in the taxonomy; written once a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _ingests:
        _ingests[key] = saved(clustered(placed(bare_reads(spark, sf_dir), taxa(spark, sf_dir))), "ingest")
    return _ingests[key]


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bare_reads() with kmer_string."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", F.col("l_quantity").cast("long").alias("q"))
    lines = lines.join(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    lines = lines.join(_orders(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"))
    kind = F.col("l_linenumber") % 4
    hit = F.when(kind == 0, F.lit(0)).when(kind == 1, _species()).when(kind == 2, _nation("s_nationkey")).otherwise(_nation())
    strings = lines.groupBy(F.col("l_orderkey").alias("read_id")).agg(F.concat_ws(" ", F.sort_array(F.collect_list(F.concat_ws(":", hit.cast("string"), F.col("q").cast("string"))))).alias("kmer_string"))
    return bare_reads(spark, sf_dir).join(strings, "read_id", "left").withColumn("kmer_string", F.coalesce("kmer_string", F.lit("")))


def bucketed_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k-mer counts as a table in buckets of taxa; written once a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _tables:
        _tables[key] = f"clademill_kmers_{uuid.uuid4().hex}"
        bucketed(kmer_counts(reads(spark, sf_dir), taxa(spark, sf_dir)), _tables[key], ["t_id"], int(spark.conf.get("spark.sql.shuffle.partitions")))
    return spark.table(_tables[key])


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(t_id, sample_id, taxon_reads, mm_tot, mm_uniq): one row a taxon and sample.

    Reads are made once. A read carries its stretches to its cell, where they are told apart: they are pooled in a cell's task alone.
    """
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("read_id"), F.col("l_quantity").cast("long").alias("q"), "l_partkey")
    # The stretches of a read.
    lines = lines.groupBy("read_id").agg(F.sum("q").alias("q"), F.collect_list("l_partkey").alias("parts"))
    rows = bare_reads(spark, sf_dir).select("read_id", "t_id", "sample_id").join(lines, "read_id", "left").select("t_id", "sample_id", "q", "parts").repartition("t_id", "sample_id")
    rows = rows.select("t_id", "sample_id", "q", F.posexplode_outer("parts").alias("at", "part"))
    first = lambda c: F.when(F.coalesce("at", F.lit(0)) == 0, c)
    rows = rows.groupBy("t_id", "sample_id", "part").agg(F.count(first(F.lit(1))).alias("reads"), F.sum(first(F.col("q"))).alias("q"))
    cells = rows.groupBy("t_id", "sample_id").agg(F.sum("reads").alias("taxon_reads"), F.sum("q").alias("q"), F.count("part").alias("uniq"))
    known = F.col("t_id").isNotNull() & F.col("sample_id").isNotNull()
    return cells.select("t_id", "sample_id", "taxon_reads", F.coalesce(F.when(known, F.col("q")), F.lit(0)).alias("mm_tot"), F.when(known, F.col("uniq")).otherwise(0).cast("long").alias("mm_uniq"))


def inspect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(t_id, clade_minimizers)."""
    return taxa(spark, sf_dir).select("t_id", (1000 + F.col("t_id") % 9000).alias("clade_minimizers"))
