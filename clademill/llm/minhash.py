"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

A document's set holds the distinct runs of `size` words. Its sketch has BINS coordinates, filled in rounds: in round i each
element falls into a hashed bin with value i plus a fraction, and a bin keeps its least value; after as many rounds as bins, round
t + k gives an element to bin k outright, so every coordinate fills, each agrees with the probability of the sets' similarity, and the agreements
are concentrated about their mean.

1. Equal sets, told by a 128-bit cryptographic digest of the whole sorted set, become one class; all further steps see one node for each class, named by its
   smallest id. Ids that repeat with unlike texts belong to several classes: the others of them get hashed names of their own.
2. Bands of coordinates, eight bits of each, are hashed, as long as banding() allows. In a bucket, every member is paired with one pivot, not with every other member.
3. Pairs whose sketches agree well enough are verified on the full sets; verified links are merged into components.
4. Members of a bucket whose component is not the pivot's are compared with the bucket's members in other components, in
   blocks and by sketches; those that agree, directly or by others, are a family. Inside a family, full sets are compared in pairs of
   blocks, each of which gives no more links than it takes to connect its components, and the components are merged again.

Written tables are deleted once the next ones are there; rows (id, th and their set's marks) and classes are all that stays.

Two texts that are linked but never compared are in one component already, or share no band, with a probability of at most MISS; a linked pair's
sketches agree in so few coordinates that full sets are not looked at with 1e-6 or less (5 standard deviations, see margin()).

Cases: null texts, texts without words and rows with a null id are linked with nothing (component: their own id); a text of fewer words than `size` is
one run; a similarity of just `percent` is a link; rows that repeat an id with unlike texts are judged each by its text; very long texts are read whole; an empty
table gives no rows; extra columns are not carried by near_duplicates(), and carried as they are, whatever their names, by deduplicated().
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import components
from .store import drop_saved, saved, small_batches, whole_ids
from .text import words

#: Coordinates of a sketch; how likely a pair at the threshold may share no band.
BINS, MISS = 280, 1e-6
#: So many standard deviations below the threshold may sketches agree for a look at the full sets.
DEVIATIONS = 5
#: Members and elements of their sets in one block, about; bytes of ids that are broadcast at most, more are joined by a shuffle.
BLOCK, ELEMENTS, BROADCAST_BYTES = 512, 2_000_000, 32 << 20

_GOLDEN, _M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def banding(percent: int) -> tuple[int, int]:
    """Bands and coordinates of a band: the longest bands of which a pair at the threshold shares one but for MISS."""
    fits = [r for r in range(1, 20) if (1 - (percent / 100) ** r) ** (BINS // r) <= MISS]
    return BINS // max(fits, default=1), max(fits, default=1)


def margin(percent: int) -> float:
    """How far below the threshold the agreement of a linked pair's sketches may lie: DEVIATIONS of a binomial share over BINS."""
    p = percent / 100
    return DEVIATIONS * math.sqrt(p * (1 - p) / BINS)


def shingles(text: Column, size: int) -> Column:
    """Distinct runs of `size` words, A-Z in lower case, as 64-bit hashes; the whole text if it has fewer words.

    To be used on a column that holds the words, see with_shingles().
    """
    w = text
    runs = F.transform(F.slice(w, 1, F.greatest(F.size(w) - (size - 1), F.least(F.size(w), F.lit(1)))), lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, size)]))
    return F.array_distinct(runs)


def with_shingles(docs: DataFrame, size: int) -> DataFrame:
    """docs (id, text) as (id, th, set); th is a hash of the text, which with the id tells rows apart."""
    return docs.select("id", F.xxhash64("text").alias("th"), words(F.translate("text", _UPPER, _LOWER)).alias("w")).select("id", "th", shingles(F.col("w"), size).alias("set"))


def digest(elements: np.ndarray) -> tuple[int, int]:
    """128 bits of a cryptographic digest of a whole set."""
    b = hashlib.blake2b(np.sort(elements).tobytes(), digest_size=16).digest()
    return int.from_bytes(b[:8], "little", signed=True), int.from_bytes(b[8:], "little", signed=True)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def sketch(elements: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Fast similarity sketch of distinct 64-bit hashes: per bin the round (high 16 bits) and the hash of its element."""
    out = np.full(bins, np.iinfo(np.uint64).max, np.uint64)
    n, done = len(elements), 0
    while done < bins:
        rounds = min(bins - done, max(1, int(2 * bins * np.log(bins) / n)))
        i = np.arange(done, done + rounds, dtype=np.uint64)[:, None]
        h = _mixed(elements[None, :] + (i + np.uint64(1)) * _GOLDEN)
        at = ((h & np.uint64(0xFFFFFFFF)) * np.uint64(bins)) >> np.uint64(32)
        np.minimum.at(out, at.ravel().astype(np.int64), ((i << np.uint64(48)) | (h >> np.uint64(16))).ravel())
        done += rounds
        if out.max() != np.iinfo(np.uint64).max:
            return out
    for k in np.flatnonzero(out == np.iinfo(np.uint64).max):
        h = _mixed(elements + np.uint64(bins + int(k) + 1) * _GOLDEN)
        out[k] = (np.uint64(bins + int(k)) << np.uint64(48)) | (h.min() >> np.uint64(16))
    return out


def _sketches(batches):
    import pyarrow as pa

    with np.errstate(over="ignore"):
        for batch in batches:
            ids, sets = batch.column("id"), batch.column("set")
            flat, ends = sets.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.cumsum(np.diff(sets.offsets.to_numpy()))
            n = len(ids)
            small, marks = np.zeros((n, BINS), np.uint8), np.zeros((2, n), np.int64)
            for k in range(n):
                e = flat[(ends[k - 1] if k else 0) : ends[k]]
                small[k] = (_mixed(sketch(e)) >> np.uint64(56)).astype(np.uint8)
                marks[:, k] = digest(e)
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    batch.column("th"),
                    pa.array(np.diff(ends, prepend=0), pa.int64()),
                    pa.array(marks[0]),
                    pa.array(marks[1]),
                    pa.array([r.tobytes() for r in small], pa.binary()),
                ],
                names=["id", "th", "n", "f1", "f2", "sketch"],
            )


def _members(reps: DataFrame, percent: int) -> DataFrame:
    """(key, id, c, pivot): nodes by the bands that they share with others, the number of those and one of them. Keys are made of the sketches and moved once."""
    bands, width = banding(percent)
    key = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda k: F.xxhash64(k, F.substring("sketch", k * width + 1, F.lit(width))))
    banded = reps.select("id", F.explode(key).alias("key")).repartition("key")
    pivot = F.min_by("id", F.struct(F.xxhash64("id"), "id"))
    return banded.join(banded.groupBy("key").agg(F.count(F.lit(1)).alias("c"), pivot.alias("pivot")).filter("c > 1"), "key")


def agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity from rows of 8-bit coordinates, chance agreements of 1 in 256 taken off."""
    return ((a == b).mean(-1) - 1 / 256) / (1 - 1 / 256)


def _agreeing(pairs: DataFrame, reps: DataFrame, least: float, percent: int) -> DataFrame:
    """Those of pairs (a, b) whose sizes and sketches allow a link."""
    side = lambda x: reps.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
    rows = pairs.join(side("a"), "a").join(side("b"), "b").filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))

    def keep(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                s = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("s_a", "s_b")]
                yield batch.select(["a", "b"]).filter(pa.array(agreement(*s) >= least))

    return rows.select("a", "b", "s_a", "s_b").mapInArrow(keep, "a long, b long")


def _sets_of(ids: DataFrame, reps: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """(id, set) of the nodes in a saved table."""
    texts = saved(reps.join(ids, "id", "left_semi").select(F.col("id").alias("node"), F.col("doc").alias("id"), F.col("th").alias("__th")), "minhash-texts")
    # The texts' size is checked: beyond the bound the documents are shuffled to them.
    known = F.broadcast(texts) if texts.count() * 24 <= BROADCAST_BYTES else texts
    rows = docs.join(known, "id").filter(F.xxhash64("text") == F.col("__th")).select(F.col("node").alias("id"), "text")
    sets = saved(with_shingles(rows, size).groupBy("id").agg(F.first("set").alias("set")), "minhash-sets")
    drop_saved(texts)
    return sets


def _verified(pairs: DataFrame, reps: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of pairs (a, b) whose full sets are linked: percent of the union is shared."""
    ids = saved(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "minhash-ids")
    sets = _sets_of(ids, reps, docs, size)
    rows = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("x")), "a").join(sets.select(F.col("id").alias("b"), F.col("set").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    rows = rows.select("a", "b", shared.alias("i"), (F.size("x") + F.size("y")).alias("all"))
    linked = saved(rows.filter(100 * F.col("i") >= percent * (F.col("all") - F.col("i"))).select("a", "b"), "minhash-links")
    drop_saved(sets), drop_saved(ids)
    return linked


def _named(classes: DataFrame) -> DataFrame:
    """classes (f1, f2, n, doc and others) with id, a name of its own for each: the smallest document id, doc, or a hash if an earlier class has that."""
    repeated = classes.groupBy("doc").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("f1", "f2", "n")).alias("first")).filter("c > 1").drop("c")
    repeated = saved(repeated, "minhash-repeated")
    # The size is checked.
    known = F.broadcast(repeated) if repeated.count() * 32 <= BROADCAST_BYTES else repeated
    other = F.col("first").isNotNull() & (F.struct("f1", "f2", "n") != F.col("first"))
    return classes.join(known, "doc", "left").withColumn("id", F.when(other, F.xxhash64("f1", "f2", "n", "doc").bitwiseOR(F.lit(-(1 << 63)))).otherwise(F.col("doc"))).drop("first")


def _blocked(members: DataFrame, group: str, extra: list[str]) -> DataFrame:
    """members (group, id, component, main, c, e, n, sketch and extra) dealt to pairs of blocks (group, i, j) with the sides left and right.

    Members of other components than the group's main one are the left side, all members the right one. A block holds
    about BLOCK members and ELEMENTS elements of sets at most; c and e are the group's members and elements.
    """
    parts = F.greatest(F.ceil(F.col("c") / BLOCK), F.ceil(F.col("e") / ELEMENTS)).cast("int")
    m = members.withColumn("parts", parts).withColumn("block", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).withColumn("minor", F.col("component") != F.col("main"))
    each = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    columns = [group, "i", "j", "id", "component", "n", "sketch", *extra, "left", "right"]
    one = m.filter("parts = 1").withColumn("i", F.lit(0)).withColumn("j", F.lit(0)).withColumn("left", F.col("minor")).withColumn("right", F.lit(True)).select(columns)
    many = m.filter("parts > 1")
    left = many.filter("minor").withColumn("j", each).withColumn("i", F.col("block")).withColumn("left", F.lit(True)).withColumn("right", F.lit(False))
    right = many.withColumn("i", each).withColumn("j", F.col("block")).withColumn("left", F.lit(False)).withColumn("right", F.lit(True))
    rows = one.unionByName(left.select(columns)).unionByName(right.select(columns))
    return rows.repartition(group, "i", "j").sortWithinPartitions(group, "i", "j")


def _compared(rows: DataFrame, group: str, compare) -> DataFrame:
    """Pairs (a, b) that compare() yields for each pair of blocks; frames are bounded, and so is what is kept between them."""

    def pairs(frames):
        import pandas as pd

        made = lambda g: pd.DataFrame(list(compare(g)), columns=["a", "b"], dtype="int64")
        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            start = np.flatnonzero((frame[[group, "i", "j"]].diff() != 0).any(axis=1).to_numpy())
            for a, b in zip(start[:-1], start[1:], strict=True):
                yield made(frame.iloc[a:b])
            rest = frame.iloc[start[-1] :] if len(start) else None
        if rest is not None and len(rest):
            yield made(rest)

    return rows.mapInPandas(pairs, "a long, b long")


class _Merged:
    """Classes of 0 .. n - 1, merged one pair at a time."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def merge(self, a: int, b: int) -> None:
        self.of[self.of == self.of[b]] = self.of[a]


def _candidates(s: np.ndarray, n: np.ndarray, x: int, y: np.ndarray, least: float, percent: int) -> np.ndarray:
    """Those of the rows y that sizes and sketches allow to be linked with row x, likeliest first."""
    y = y[100 * np.minimum(n[y], n[x]) >= percent * np.maximum(n[y], n[x])]
    if not len(y):
        return y
    likely = agreement(s[y], s[x])
    order = np.argsort(-likely, kind="stable")
    return y[order[: int((likely >= least).sum())]]


def _columns(group) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    s = np.stack(group["sketch"].map(lambda b: np.frombuffer(b, np.uint8)).to_numpy())
    return s, group["id"].to_numpy(), group["component"].to_numpy(), group["n"].to_numpy(), np.flatnonzero(group["left"].to_numpy()), np.flatnonzero(group["right"].to_numpy())


def _families(members: DataFrame, least: float, percent: int) -> DataFrame:
    """(id, family): members of buckets that sketches allow to be linked across components, directly or by others.

    Two blocks give no pairs but each member with the least one that it is connected to there; of the least ones that a member has
    in several buckets, the least stands for all.
    """

    def connect(group):
        s, ids, comp, n, left, right = _columns(group)
        names, who = np.unique(ids, return_inverse=True)  # a member can be on both sides
        seen = _Merged(len(names))
        for x in left:
            y = right[(comp[right] != comp[x]) & (seen.of[who[right]] != seen.of[who[x]])]
            for z in _candidates(s, n, x, y, least, percent):
                if seen.of[who[z]] != seen.of[who[x]]:
                    seen.merge(who[x], who[z])
        lowest: dict[int, int] = {}
        for k, c in enumerate(seen.of):
            if lowest.setdefault(c, k) != k:
                yield names[lowest[c]], names[k]

    stars = _compared(_blocked(members, "key", []), "key", connect).distinct().withColumn("m", F.min("a").over(Window.partitionBy("b")))
    edges = stars.select(F.explode(F.array(F.struct("m", "b"), F.struct("m", F.col("a").alias("b")))).alias("e")).select(F.col("e.m").alias("a"), F.col("e.b").alias("b")).filter("a <> b").distinct()
    found = components(edges := saved(edges, "minhash-edges"))
    drop_saved(edges)
    return found.withColumnRenamed("component", "family")


def _links_of_families(families: DataFrame, least: float, percent: int) -> DataFrame:
    """Links (a, b) from members (family, id, component, main, c, e, n, sketch, set): full sets are compared inside pairs of blocks.

    A pair is skipped if links found in the blocks connect it already.
    """

    def link(group):
        s, ids, comp, n, left, right = _columns(group)
        sets = [np.asarray(x, np.int64) for x in group["set"]]
        ends = np.cumsum([len(x) for x in sets])
        _, at = np.unique(np.concatenate(sets), return_inverse=True)
        own = lambda k: at[ends[k] - len(sets[k]) : ends[k]]
        mark = np.zeros(at.max() + 1, bool)
        _, who = np.unique(comp, return_inverse=True)
        seen = _Merged(who.max() + 1)
        for x in left:
            y = _candidates(s, n, x, right[seen.of[who[right]] != seen.of[who[x]]], least, percent)
            if len(y):
                mark[own(x)] = True
                for z in y:
                    if seen.of[who[z]] != seen.of[who[x]]:
                        both = int(mark[own(z)].sum())
                        if 100 * both >= percent * (len(sets[x]) + len(sets[z]) - both):
                            seen.merge(who[x], who[z])
                            yield min(ids[x], ids[z]), max(ids[x], ids[z])
                mark[own(x)] = False

    return _compared(_blocked(families, "family", ["set"]), "family", link).distinct()


def _classes(docs: DataFrame, size: int, percent: int, least: float | None) -> tuple[DataFrame, DataFrame]:
    """From docs (id, text) with ids and words: rows (id, th, n, f1, f2), and their classes (f1, f2, n, doc, th, component_id, first).

    doc is a class's smallest id; component_id the smallest one that it reaches; first marks one class of each component, one that has that id.
    """
    least = percent / 100 - margin(percent) if least is None else least
    sets = with_shingles(docs, size)
    with small_batches(docs.sparkSession):
        sketches = saved(sets.mapInArrow(_sketches, "id long, th long, n long, f1 long, f2 long, sketch binary"), "minhash-sketches")
    same = ["f1", "f2", "n"]
    grouped = sketches.groupBy(*same).agg(F.min(F.struct("id", "th")).alias("m"), F.first("sketch").alias("sketch"))
    reps = saved(_named(grouped.select(*same, F.col("m.id").alias("doc"), F.col("m.th").alias("th"), "sketch")), "minhash-reps")
    rows = saved(sketches.select("id", "th", *same), "minhash-rows")
    drop_saved(sketches)
    members = saved(_members(reps, percent), "minhash-members")
    tested = members.filter("id <> pivot").select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct()
    pairs = saved(_agreeing(tested, reps, least, percent), "minhash-pairs")
    links = _verified(pairs, reps, docs, size, percent)
    found = components(links)
    drop_saved(pairs), drop_saved(links)
    # Buckets of three or more whose members are not all in one component.
    own = lambda x: F.coalesce(F.col(x), F.col("id"))
    label = members.filter("c > 2").join(found, "id", "left").select("key", "c", "id", "pivot", own("component").alias("component"))
    split = label.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.max(F.when(F.col("id") == F.col("pivot"), F.col("component"))).alias("main"))
    open_rows = label.join(split.filter("least <> most").select("key", "main"), "key").join(reps.select("id", "n", "sketch"), "id").withColumn("e", F.lit(0))
    families = saved(_families(open_rows, least, percent), "minhash-families")
    drop_saved(members)
    inside = families.join(found, "id", "left").select("id", "family", own("component").alias("component")).join(reps.select("id", "n", "sketch"), "id")
    per = inside.groupBy("family", "component").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("e"))
    per = per.groupBy("family").agg(F.sum("k").alias("c"), F.sum("e").alias("e"), F.max_by("component", F.struct("k", "component")).alias("main"))
    sets = _sets_of(families.select("id"), reps, docs, size)
    more = saved(_links_of_families(inside.join(per, "family").join(sets, "id"), least, percent), "minhash-links")
    drop_saved(sets), drop_saved(families)
    up = found.select(F.col("id").alias("a"), F.col("component").alias("x"))
    ends = more.join(up, "a", "left").select("b", F.coalesce("x", "a").alias("x"))
    ends = ends.join(up.select(F.col("a").alias("b"), F.col("x").alias("y")), "b", "left").select("x", F.coalesce("y", "b").alias("y"))
    joined = components(ends, "x", "y").select(F.col("id").alias("component"), F.col("component").alias("top"))
    classes = reps.select(*same, "doc", "th", "id").join(found, "id", "left").select(*same, "doc", "th", own("component").alias("component"))
    classes = saved(classes.join(joined, "component", "left").select(*same, "doc", "th", F.coalesce("top", "component").alias("component")), "minhash-classes")
    drop_saved(reps), drop_saved(more), drop_saved(found), drop_saved(joined)
    firsts = classes.groupBy("component").agg(F.min(F.struct("doc", *same)).alias("m"))
    classes = classes.join(firsts, "component")
    first = F.struct("doc", *same) == F.col("m")
    return rows, classes.select(*same, "doc", "th", F.col("m.doc").alias("component_id"), first.alias("first"))


def _has_word(text: str) -> Column:
    # Filtered by the text, not by the set: a filter on the set would be pushed below the column of words and split them anew for each.
    return F.coalesce(F.col(text), F.lit("")).rlike(r"[^\x20\x09-\x0D]")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, least: float | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): documents linked at percent similarity or more, directly or by others.

    component_id is the smallest id reachable; kept is true for it. least (margin() below the threshold) is the
    agreement of sketches below which full sets are not looked at.
    """
    whole_ids(docs, id_col)
    docs = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    linkable = F.col("id").isNotNull() & _has_word("text")
    rows, classes = _classes(docs.filter(linkable), size, percent, least)
    some = rows.join(classes.drop("th"), ["f1", "f2", "n"]).select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")
    alone = with_shingles(docs.filter(~linkable), size).select(F.col("id").alias("doc_id"), F.size("set").cast("long").alias("n_shingles"), F.col("id").alias("component_id"))
    return some.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicated(docs: DataFrame, size: int = 5, percent: int = 80, least: float | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of docs for each class of near_duplicates(), all columns as they were; rows with a null id and rows without words all stay.

    Rows that repeat an id with unlike, unlinked texts all stay; of rows that repeat id and text one stays.
    """
    whole_ids(docs, id_col)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    linkable = F.col("id").isNotNull() & _has_word("text")
    found, classes = _classes(rows.filter(linkable).select("id", "text"), size, percent, least)
    kept = classes.filter("first").select(F.col("doc").alias("id"), "th")
    kept = saved(found.groupBy("id", "th").agg(F.count(F.lit(1)).alias("copies")).join(kept, ["id", "th"]), "minhash-kept")
    drop_saved(found), drop_saved(classes)
    hit = rows.filter(linkable).withColumn("th", F.xxhash64("text")).join(kept, ["id", "th"])
    one = hit.filter("copies = 1").select("row").unionByName(hit.filter("copies > 1").groupBy("id", "th").agg(F.first("row").alias("row")).select("row"))
    return one.unionByName(rows.filter(~linkable).select("row")).select("row.*")
