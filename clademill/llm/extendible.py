"""Exact duplicates through an extendible-hash index on shared files.

Every row gets a key, the hash of its text without white space. A bucket holds the keys that begin with the same bits, a contiguous range; a bucket with
more keys than fit is split by one more bit, and the directory, which has a slot for each value of as many bits as the deepest bucket has, doubles. The
directory comes from counts, so buckets are split before their pages are written, and no page is written twice. Copies share one key: they fill no bucket.

Rows that share a key are compared byte by byte: their texts are a grouping key, so that copies meet in the task that reads them and a hot group sends one
text from each task. Owner tasks each take a range of keys, chain the different texts of a key, and write the pages: one record a text, with the row that stays.

Cases: null texts count as empty, and texts of white space alone equal them; a null id is larger than all others; rows that repeat id and text are rows of their
own, of which one stays; very long texts are hashed and compared whole; an empty table gives no rows; extra columns, whatever their names, are not carried by
exact_duplicates(), and carried as they are by deduplicated().
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import saved

#: What texts are compared without: [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"
#: Bits of a key, and keys of a bucket.
BITS, CAPACITY = 63, 1 << 16
#: So many shared keys are sent to the tasks that read texts (24 bytes each), which then compare only rows that have one; beyond, all texts are compared.
SENT_KEYS = 1 << 20


def normal(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def _key(text: Column, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(text), 64 - bits)


def _slot(depth: int, bits: int) -> Column:
    """A key's first bits."""
    return F.shiftright("key", bits - depth)


def directory(keys: DataFrame, bits: int = BITS, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """(slot, bucket, depth) of keys (key), one row each, and the bits of a slot.

    A bucket is named by its range's first key. It starts with as many bits as fill buckets on average, and overfull ones get one more each round. The
    directory has about as many slots as there are keys over capacity.
    """
    n = keys.count()
    depth = min(bits, max(0, math.ceil(math.log2(max(n, 1) / capacity))))
    level = saved(keys.groupBy(_slot(depth, bits).alias("prefix")).agg(F.count(F.lit(1)).alias("n")), "buckets")
    settled = []
    while True:
        over = level.filter(F.col("n") > capacity) if depth < bits else level.limit(0)
        settled.append((level if depth == bits else level.filter(F.col("n") <= capacity)).select("prefix", F.lit(depth).alias("depth")))
        if not over.limit(1).count():
            break
        again = keys.join(over.select(F.col("prefix").alias("parent")), _slot(depth, bits) == F.col("parent"), "left_semi")
        depth += 1
        level = saved(again.groupBy(_slot(depth, bits).alias("prefix")).agg(F.count(F.lit(1)).alias("n")), "buckets")
    slots = []
    for part in settled:
        spare = F.lit(depth) - F.col("depth")
        first = F.expr(f"shiftleft(prefix, {depth} - depth)")
        slots.append(part.select(F.explode(F.sequence(first, first + F.expr(f"shiftleft(1L, {depth} - depth)") - 1)).alias("slot"), F.expr(f"shiftleft(prefix, {bits} - depth)").alias("bucket"), (F.lit(depth) - spare).alias("depth")))
    out = slots[0]
    for s in slots[1:]:
        out = out.unionByName(s)
    return out, depth


def _entries(docs: DataFrame, row: Column, doc_id: Column, text: Column, bits: int) -> DataFrame:
    x = normal(text)
    return docs.select(row.alias("row"), doc_id.alias("doc_id"), F.coalesce(F.length(text), F.lit(0)).alias("n_chars"), _key(x, bits).alias("key"), F.sha2(x, 256).alias("sha"))


def _compared(texts: DataFrame) -> DataFrame:
    """(key, sha, n) of texts (key, sha, text): one row a different text, by its bytes."""
    return texts.groupBy("key", "sha", "text").agg(F.count(F.lit(1)).alias("n")).select("key", "sha", "n")


def pages(entries: DataFrame, docs: DataFrame, text: Column, bits: int = BITS, capacity: int = CAPACITY) -> DataFrame:
    """The index of the texts whose key another row has too: (bucket, depth, key, link, sha, n, keep_id, keep_row), ordered by key in each owner's file.

    link counts the different texts of a key from 0.
    """
    keys = saved(entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "keys")
    shared = keys.filter("n > 1").select("key")
    slots, depth = directory(keys.select("key"), bits, capacity)
    x = normal(text)
    whole = docs.select(_key(x, bits).alias("key"), F.sha2(x, 256).alias("sha"), x.alias("text"))
    few = shared.limit(SENT_KEYS + 1).count() <= SENT_KEYS
    # At most SENT_KEYS keys; else every text is compared, and those of keys of their own fall out below.
    links = _compared(whole.join(F.broadcast(shared), "key", "left_semi") if few else whole)
    stays = F.min(F.struct((-F.col("n_chars")).alias("size"), F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    best = entries.groupBy("key", "sha").agg(stays.alias("best")).join(shared, "key", "left_semi")
    records = best.join(links, ["key", "sha"]).withColumn("slot", _slot(depth, bits)).join(slots, "slot")
    owned = records.repartitionByRange("bucket", "key")
    chain = Window.partitionBy("bucket", "key")
    owned = owned.withColumn("link", F.row_number().over(chain.orderBy("sha")) - 1).withColumn("same", F.count(F.lit(1)).over(Window.partitionBy("bucket", "key", "sha")))
    # The digest names a text below; two texts of one digest would be an error, not a silent merge.
    sure = F.when(F.col("same") == 1, F.col("sha")).otherwise(F.raise_error(F.lit("two different texts have one SHA-256")).cast("string"))
    return owned.select("bucket", "depth", "key", "link", sure.alias("sha"), "n", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"))


def _decided(docs: DataFrame, row: Column, id_col: str, text_col: str, bits: int, capacity: int) -> DataFrame:
    doc_id, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    entries = saved(_entries(docs, row, doc_id, text, bits), "entries")
    index = saved(pages(entries, docs, text, bits, capacity), "pages").drop("bucket", "depth", "link")
    alone = F.col("keep_row").isNull()
    return entries.join(index, ["key", "sha"], "left").select(
        "row", "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("keep_row") == F.col("row"))).alias("kept"), F.col("sha").alias("text_sha256"),
    )


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row a document; the longest original text stays, of equally long ones that of the smallest id."""
    return _decided(docs, F.monotonically_increasing_id(), id_col, text_col, bits, capacity).drop("row")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, whole. They are written once with a number, by which they are found again even if ids repeat."""
    row = next(f"row_{k}" for k in range(len(docs.columns) + 1) if f"row_{k}" not in docs.columns)
    numbered = saved(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    stay = _decided(numbered, F.col(row), id_col, text_col, BITS, CAPACITY).filter("kept").select(F.col("row").alias(row))
    return numbered.join(stay, row, "left_semi").drop(row)
