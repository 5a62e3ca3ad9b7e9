"""K-mer evidence that grows as classified files arrive.

Each run takes the files that are new since the last one and adds their pooled counts to a table of increments; one aggregation of that
table gives the same numbers as counting all files at once. A batch that is run again replaces its own increment, so nothing counts twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.scalar import sample_name
from ..operators.kmers import kmer_counts


def classified_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """(sample_id, status, t_id, kmer_string) of files as they come into a folder."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)
    c = F.split("value", "\t")
    at = lambda k: F.get(c, F.lit(k))
    return lines.select(sample_name(F.col("_metadata.file_path")).alias("sample_id"), at(0).alias("status"), at(2).try_cast("long").alias("t_id"), F.coalesce(at(5), F.lit("")).alias("kmer_string"))


def count_arrivals(stream: DataFrame, taxa: DataFrame, table: str, checkpoint: str, rank: str = "species") -> StreamingQuery:
    """Start counting what is there and end; table gets a folder a batch."""

    def add(batch: DataFrame, number: int) -> None:
        kmer_counts(batch, taxa, rank=rank).write.mode("overwrite").parquet(f"{table}/batch={number}")

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counted(spark: SparkSession, table: str) -> DataFrame:
    """(sample_id, t_id, kmer_tax_id, kmer_count) of all batches so far."""
    return spark.read.parquet(table).groupBy("sample_id", "t_id", "kmer_tax_id").agg(F.sum("kmer_count").alias("kmer_count"))
