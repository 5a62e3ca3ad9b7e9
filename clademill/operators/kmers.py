"""From classified reads to k-mer evidence and read lengths by species.

Hits are pooled by the taxon as classified before they meet the taxonomy, so what is joined and shuffled are distinct pairs, not reads.

Cases: reads that are not classified, or whose taxon has no species above it, are left out; a species without any hit keeps a row with a null
hit and the count 0; missing lengths are 0; tables without rows give none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import hits, total_length
from .taxonomy import at_rank


def species_of(taxa: DataFrame, rank: str = "species") -> DataFrame:
    """(t_id, species_id)."""
    return at_rank(taxa, rank, "species_id")


def kmer_counts(reads: DataFrame, taxa: DataFrame, by: tuple[str, ...] = ("sample_id",), rank: str = "species") -> DataFrame:
    """(by, t_id, kmer_tax_id, kmer_count) of classified reads (status, t_id, kmer_string), summed up to species."""
    keys = list(by)
    pairs = reads.filter("status = 'C'").select(*keys, "t_id", F.explode_outer(hits(F.col("kmer_string"))).alias("hit"))
    pairs = pairs.groupBy(*keys, "t_id", F.col("hit.kmer_tax_id").alias("kmer_tax_id")).agg(F.coalesce(F.sum("hit.kmer_count"), F.lit(0)).alias("kmer_count"))
    return pairs.join(species_of(taxa, rank), "t_id").groupBy(*keys, F.col("species_id").alias("t_id"), "kmer_tax_id").agg(F.sum("kmer_count").alias("kmer_count"))


def read_lengths(reads: DataFrame, taxa: DataFrame, by: tuple[str, ...] = ("sample_id",), rank: str = "species") -> DataFrame:
    """(by, t_id, read_length, read_count) of classified reads (status, t_id, lengths), summed up to species."""
    keys = list(by)
    counts = reads.filter("status = 'C'").groupBy(*keys, "t_id", total_length(F.col("lengths")).alias("read_length")).agg(F.count(F.lit(1)).alias("read_count"))
    return counts.join(species_of(taxa, rank), "t_id").groupBy(*keys, F.col("species_id").alias("t_id"), "read_length").agg(F.sum("read_count").alias("read_count"))


def read_counts(reads: DataFrame, by: tuple[str, ...] = ("sample_id",)) -> DataFrame:
    """(by, t_id, taxon_reads) of all reads; those not classified count for 0."""
    return reads.groupBy(*by, F.when(F.col("status") == "C", F.col("t_id")).otherwise(F.lit(0)).cast("long").alias("t_id")).agg(F.count(F.lit(1)).alias("taxon_reads"))
