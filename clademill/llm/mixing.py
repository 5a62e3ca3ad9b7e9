"""Mixing sources to target weights by a low-discrepancy schedule.

Point i of the base-2 van der Corput sequence is i with its bits reversed, as a fraction. The sources' shares of the word budget lie side by side on the
unit interval, and step i of the schedule serves the source whose stretch holds point i: the sequence alone decides how many slots a source has got
after any number of steps, within log2(steps) + 1 of its share. Slots are ranked per source in order of their steps, documents of a source are
shuffled by a seeded hash into one stream of words, and slot r takes the r-th block of equally many words of that stream, which is read again from its start
when it ends, max_repeats times at most; slots beyond that stay empty. Points are generated from the sources' stretches: the points in a stretch are the cells between
its ends, and a cell's step is its number with the bits reversed.

A block holds 2^-20 of all words, at least 8 and at most 1024, unless block_words is given. Sources are sorted in one task, one row each.

Cases: a null source is a source of its own, last in order; documents without words (null and empty texts) are
never taken; repeated rows are separate documents; rows of equal hash (they repeat id and text) are interchangeable; very long texts are taken block by block like others;
an empty table gives no rows; extra columns are not carried by taken(), and carried as they are, whatever their names, by resampled().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranks import bucket_count, ranked
from .store import saved
from .text import n_words

#: Bounds of a block's words, and the number of blocks (as a power of 2) that all words are cut into between those.
LEAST_BLOCK, MOST_BLOCK, BLOCKS_LOG2 = 8, 1024, 20
#: Slots that one row is expanded to at once.
_CHUNK = 65536


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_repeats: int = 3) -> DataFrame:
    """Targets of sources (src, src_null, source_size): weights repeat in code point order, null last.

    All targets sum to all sizes. A source stops at max_repeats times its size; the rest is shared by weight. In order of
    cap to weight, the sources before the first one that its share leaves below its cap are the capped ones. One row
    a source: the windows here sort sources, not documents.
    """
    order = Window.orderBy("src_null", "src")
    by_ratio = Window.orderBy("ratio", "src_null", "src")
    whole = Window.partitionBy()
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    s = sizes.withColumn("weight", w).withColumn("cap", (max_repeats * F.col("source_size")).cast("double"))
    s = s.withColumn("ratio", F.col("cap") / F.col("weight")).withColumn("all", F.sum("source_size").over(whole).cast("double"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("left", F.col("all") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    s = s.withColumn("level", F.col("left") / F.sum("weight").over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    level = F.max(F.when(F.col("ratio") > F.col("level"), F.col("level"))).over(whole)
    return s.withColumn("target", F.least("cap", F.coalesce(level * F.col("weight"), F.col("cap")))).select("src_null", "src", "source_size", "weight", "target")


def _bit_reversed(cell: Column, bits: int) -> Column:
    """The lowest `bits` bits of cell in reverse order."""
    x = cell
    for shift, mask in ((1, 0x5555555555555555), (2, 0x3333333333333333), (4, 0x0F0F0F0F0F0F0F0F), (8, 0x00FF00FF00FF00FF), (16, 0x0000FFFF0000FFFF)):
        x = F.shiftrightunsigned(x, shift).bitwiseAND(mask).bitwiseOR(F.shiftleft(x.bitwiseAND(mask), shift))
    x = F.shiftrightunsigned(x, 32).bitwiseOR(F.shiftleft(x, 32))
    return F.shiftrightunsigned(x, 64 - bits) if bits else F.lit(0).cast("long")


def block_size(n_words: int) -> int:
    return min(max(n_words >> BLOCKS_LOG2, LEAST_BLOCK), MOST_BLOCK)


def schedule(sources: DataFrame, block_words: int, max_repeats: int = 3) -> tuple[DataFrame, DataFrame]:
    """Slots of source_targets(), and how evenly they come.

    slots: (step, src_null, src, source_size, rank, from_word, to_word) in a source's endless stream; evenness: (src_null, src, slots, deviation), slots
    being those of the whole schedule and deviation the largest difference from the source's share of the steps so far.
    """
    n = -(-int(round(sources.agg(F.sum("target")).first()[0] or 0)) // block_words)
    bits = max(0, (n - 1).bit_length()) if n else 0
    order = Window.orderBy("src_null", "src")
    ends = sources.filter("target > 0").withColumn("to", F.sum("target").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    whole = F.max("to").over(Window.partitionBy())
    ends = ends.select("*", F.coalesce(F.lag("to").over(order), F.lit(0.0)).alias("from"), whole.alias("whole"))
    cell = lambda x: F.ceil(F.col(x) / F.col("whole") * float(1 << bits)).cast("long")
    ends = ends.select("src_null", "src", "source_size", (F.col("target") / F.col("whole")).alias("share"), cell("from").alias("first"), cell("to").alias("end")).filter("end > first")
    ends = saved(ends if n else ends.limit(0), "mix-stretches")
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("end") - F.col("first") - 1) / _CHUNK).cast("long")))
    chunked = ends.withColumn("chunk", chunk).repartition("src_null", "src", "chunk")
    start = F.col("first") + F.col("chunk") * _CHUNK
    cells = chunked.withColumn("cell", F.explode(F.sequence(start, F.least(start + _CHUNK, F.col("end")) - 1)))
    steps = cells.select("src_null", "src", "source_size", "share", _bit_reversed(F.col("cell"), bits).alias("step")).filter(F.col("step") < n)
    # Written out, as the optimizer takes exploded rows to be as few as their sources and would broadcast them.
    steps = saved(steps, "mix-steps")
    # Equal ranges of steps are the buckets.
    per_bucket = max(1, n // bucket_count(n))
    slots = ranked(steps.withColumn("bucket", F.floor(F.col("step") / per_bucket)), ["src_null", "src"], "bucket", [F.col("step")], "rank")
    slots = saved(slots.drop("bucket"), "mix-slots")
    off = F.greatest(F.abs(F.col("rank") - F.col("step") * F.col("share")), F.abs(F.col("rank") + 1 - (F.col("step") + 1) * F.col("share")))
    evenness = slots.groupBy("src_null", "src").agg(F.count(F.lit(1)).alias("slots"), F.max(off).alias("deviation"))
    b, most = F.lit(block_words), F.col("source_size") * max_repeats
    words = slots.select("step", "src_null", "src", "source_size", "rank", (F.col("rank") * b).alias("from_word"), F.least((F.col("rank") + 1) * b, most).alias("to_word"))
    return words.filter(F.col("from_word") < F.col("to_word")), evenness


def _passes(slots: DataFrame, block_words: int) -> DataFrame:
    """slots cut where a stream begins anew and at its blocks' edges: (step, src_null, src, rank, epoch, block, from_word, to_word) in the stream."""
    size, b = F.col("source_size"), F.lit(block_words)
    rows = slots.withColumn("epoch", F.explode(F.sequence(F.floor(F.col("from_word") / size), F.floor((F.col("to_word") - 1) / size))))
    skipped = F.col("epoch") * size
    rows = rows.withColumns({"from_word": F.greatest(F.col("from_word") - skipped, F.lit(0)), "to_word": F.least(F.col("to_word") - skipped, size)})
    rows = rows.withColumn("block", F.explode(F.sequence(F.floor(F.col("from_word") / b), F.floor((F.col("to_word") - 1) / b))))
    return rows.select("step", "src_null", "src", "rank", "epoch", "block", F.greatest("from_word", F.col("block") * b).alias("from_word"), F.least("to_word", (F.col("block") + 1) * b).alias("to_word"))


def _row_hash(key: Column, text: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), key, text)


def placed(docs: DataFrame, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, src_null, src, size, h, start): where each document's words start in its source's shuffled stream."""
    slim = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).isNull().alias("src_null"),
        F.coalesce(F.col(source_col), F.lit("")).alias("src"),
        n_words(F.col(text_col)).alias("size"),
        _row_hash(F.col(id_col), F.col(text_col), seed).alias("h"),
    )
    slim = saved(slim, "mix-sizes")
    cells = bucket_count(slim.count())
    return ranked(slim.withColumn("bucket", F.pmod("h", F.lit(cells))), ["src_null", "src"], "bucket", [F.col("h"), F.col("doc_id"), F.col("size")], "start", weight="size")


def mixed(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_repeats: int = 3, block_words: int | None = None, seed: int = 17, **columns) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix, its documents and its sources.

    mix: (step, src_null, src, rank, epoch, start, doc_id, from_word, words), one row for each stretch of a document in a slot;
    documents: placed(); sources: source_targets() with slots and deviation of schedule().
    """
    where = saved(placed(docs, seed, **columns), "mix-places").select("doc_id", "src_null", "src", "size", "h", "start")
    sizes = where.groupBy("src_null", "src").agg(F.sum("size").alias("source_size"))
    sources = saved(source_targets(sizes, weights, max_repeats), "mix-targets")
    n_words = sources.agg(F.sum("source_size")).first()[0] or 0
    block = block_words or block_size(n_words)
    slots, evenness = schedule(sources, block, max_repeats)
    b = F.lit(block)
    pieces = where.filter(F.col("size") > 0).withColumn("end", F.col("start") + F.col("size"))
    pieces = pieces.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / b), F.floor((F.col("end") - 1) / b))))
    joined = _passes(slots, block).join(pieces, ["src_null", "src", "block"])
    lo, hi = F.greatest("start", "from_word"), F.least("end", "to_word")
    mix = joined.filter(hi > lo).select("step", "src_null", "src", "rank", "epoch", "start", "doc_id", (lo - F.col("start")).alias("from_word"), (hi - lo).alias("words"))
    # Written out, so that its size is known when documents are joined to it.
    return mix, where, saved(sources.join(evenness, ["src_null", "src"], "left"), "mix-sources")


def taken(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, slots, deviation, h) of every document; h is its row's hash."""
    mix, where, sources = mixed(docs, **options)
    used = mix.groupBy("src_null", "src", "start").agg(F.sum("words").alias("taken"))
    some = where.filter(F.col("size") > 0).join(used, ["src_null", "src", "start"], "left")
    none = where.filter(F.col("size") == 0).withColumn("taken", F.lit(None).cast("long"))
    out = some.unionByName(none).join(sources, ["src_null", "src"], "left")
    zero = lambda c, kind: F.coalesce(c, F.lit(0)).cast(kind).alias(c)
    return out.select(
        "doc_id", F.when(~F.col("src_null"), F.col("src")).alias("source"), "size", F.col("source_size").cast("long").alias("source_size"),
        zero("target", "double"), zero("taken", "long"), zero("slots", "long"), zero("deviation", "double"), "h",
    )


def resampled(docs: DataFrame, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs as the mix has them: each as often as the mix takes its words, rounded; documents of which it takes under half go.

    Rows that repeat id and text share what was taken of them.
    """
    shares = taken(docs, seed=seed, id_col=id_col, text_col=text_col, **options).groupBy("h").agg(F.try_divide(F.sum("taken"), F.sum("size")).alias("share")).filter("share >= 0.5")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _row_hash(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), seed).alias("h"))
    out = rows.join(shares, "h").withColumn("copy", F.explode(F.sequence(F.lit(1), F.round("share").cast("int"))))
    return out.select("row.*")
