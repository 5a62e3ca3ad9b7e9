"""Sharding by proportional stratified interleaving.

Rows of a source are shuffled by a seeded hash and ranked; rank r of n stands at (r + 1/2) / n. All rows, sorted by
that fraction, are cut into shards of equal count, so each shard holds every source in the mixture's proportion.

Cases: a null source is a source of its own; null ids and texts are ordinary rows (size 8, CRC null); repeated rows, and rows that repeat an id, are numbered one
after another; very long texts are rows like others, as the law counts rows; an empty table gives no rows; extra columns are not carried by interleaved(), and
carried as they are by write_shards(), but for columns named shard and slot, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranks import bucket_count, ranked
from .store import saved, unused
from .text import utf8_crc32


def _slim(docs: DataFrame, seed: int, id_col: str, text_col: str, source_col: str, *more: Column) -> DataFrame:
    text = F.col(f"`{text_col}`")
    slim = docs.select(
        *more,
        F.col(f"`{id_col}`").alias("doc_id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("bytes"),
        utf8_crc32(text).alias("text_crc32"),
        F.coalesce(F.col(f"`{source_col}`"), F.lit("")).alias("src"),
        F.col(f"`{source_col}`").isNull().alias("src_null"),
    )
    return slim.withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "src", "src_null"))


def _placed(slim: DataFrame, n_shards: int, ties: list[str], carried: list[str]) -> DataFrame:
    n = slim.count()
    cells = bucket_count(n)
    placed = ranked(slim.withColumn("bucket", F.pmod("h", F.lit(cells))), ["src_null", "src"], "bucket", [F.col(c) for c in ("h", "doc_id", "text_crc32", *ties)], "r", total="n_source")
    placed = (
        placed.withColumn("frac", (F.col("r") + 0.5) / F.col("n_source"))
        .withColumn("cell", F.floor(F.col("frac") * cells))
        .withColumn("all", F.lit(0))
    )
    placed = ranked(placed, ["all"], "cell", [F.col("frac"), F.col("src_null"), F.col("src"), F.col("r")], "g")
    total, k = F.lit(max(n, 1)).cast("long"), F.lit(n_shards).cast("long")
    return placed.withColumn("shard", F.expr(f"int((g * {n_shards}) div {max(n, 1)})")).select(
        *carried,
        "doc_id",
        (F.col("bytes") + 8).alias("size"),
        "text_crc32",
        F.when(~F.col("src_null"), F.col("src")).alias("source"),
        "shard",
        (F.col("g") - F.floor((F.col("shard") * total + k - 1) / k)).cast("long").alias("slot"),
    )


def interleaved(docs: DataFrame, n_shards: int = 24, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, size, text_crc32, source, shard, slot): row counts of shards are at most one apart, slots are gapless."""
    return _placed(saved(_slim(docs, seed, id_col, text_col, source_col), "shard-rows"), n_shards, [], [])


def write_shards(docs: DataFrame, path: str, n_shards: int = 24, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> None:
    """Write the documents as one folder a shard, in files of consecutive slots, as many as Spark's shuffle partitions share out.

    Rows are numbered and written once; their numbers are ranked alone, and whole rows are shuffled to meet their places and to follow each other.
    Rows that repeat id, text and source are told apart by the rest of the row.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    numbered = saved(docs.select(row.alias("row"), F.monotonically_increasing_id().alias("number")), "shard-numbered")
    # Maps can't be hashed, but their text can.
    own = numbered.select("row.*", F.col("number").alias(number := unused("number", docs.columns)), F.xxhash64(F.to_json("row")).alias(rest := unused("rest", docs.columns)))
    slim = saved(_slim(own, seed, id_col, text_col, source_col, F.col(number).alias("number"), F.col(rest).alias("rest")), "shard-rows")
    placed = _placed(slim, n_shards, ["rest", "number"], ["number"]).select("number", "shard", "slot")
    out = numbered.join(placed, "number").repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("shard", "slot")]
    out.select(*kept, "shard", "slot").write.partitionBy("shard").parquet(path)
