"""Spelling variants by anagram hashing.

A word's key is the sum of its letters' fifth powers, so adding, removing or exchanging a letter adds, removes or exchanges one value. Each word stands under its
own key and under its key less each of its letters: two words differ by a removal if one's own key is the other's key less a letter, and by an exchange if both
have a key less different letters in common. Equal keys leave the letters' order open; candidates are joined only if they agree in their first or their last three
letters, which one edit of a word of seven letters or more can't change both, and their order is verified by an edit distance of one. No two pairs of letters have the
same sum of fifth powers, so a pair of words is found by one key only.

Cases: null texts have no words; a null id is an empty string in the hash of the planted deletions; rows that repeat an id add their words; very long texts and
runs are read whole; ties of counts go to the smaller word in code-point order; words without a near one keep null form and are their own root; an empty table
gives no rows; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import drop_saved, saved

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Letters after A-Z are lower-cased.
LETTER = "[a-zÀ-ÿ]"
#: Keys are sums modulo a prime that no word of fewer than two million letters reaches.
PRIME = (1 << 61) - 1
#: Letters that one edit leaves alone at one of a word's ends.
AFFIX = 3


def letter_value(code: Column) -> Column:
    c = code.cast("long")
    return c * c * c * c * c


def letters(word: Column) -> Column:
    return F.transform(F.split(word, ""), lambda c: F.ascii(c))


def anagram_key(word: Column) -> Column:
    return F.aggregate(letters(word), F.lit(0).cast("long"), lambda key, c: (key + letter_value(c)) % PRIME)


def counted_words(docs: DataFrame, least_length: int = 7, least_count: int = 2, drop_every: int = 31, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): words of least_length letters that occur least_count times.

    An occurrence whose hash of id and run is divisible by drop_every loses a letter; 0 leaves all as they are.
    """
    text = F.translate(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), UPPER, LOWER)
    # Shorter runs can't give a word: a deletion makes them shorter still.
    runs = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(text, F.lit(f"{LETTER}{{{least_length},}}"), F.lit(0))).alias("run"))
    if drop_every:
        h = F.crc32(F.concat("id", F.lit(":"), "run"))
        at = (F.col("h") % F.length("run")).cast("int")
        shorter = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2, F.length("run")))
        runs = runs.withColumn("h", h).select(F.when(F.col("h") % drop_every == 0, shorter).otherwise(F.col("run")).alias("run"))
    words = runs.select(F.col("run").alias("word")).filter(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n) of words (word, n) of 2 * AFFIX + 1 letters or more: pairs that one edit tells apart, each once."""
    # Written before letters are exploded: higher-order functions would run again for each of them.
    spelled = saved(words.select("word", "n", anagram_key(F.col("word")).alias("key"), F.concat(F.array(F.lit(0)), F.array_distinct(letters(F.col("word")))).alias("letters")), "spelled")
    keyed = spelled.select("word", "n", "key", F.explode("letters").alias("less"))
    keyed = keyed.select("word", "n", "less", F.when(F.col("less") == 0, F.col("key")).otherwise(F.pmod(F.col("key") - letter_value(F.col("less")), F.lit(PRIME))).alias("rest"))
    first, last = F.substr("word", F.lit(1), F.lit(AFFIX)), F.substr("word", F.length("word") - AFFIX + 1, F.lit(AFFIX))
    ends = keyed.select("word", "n", "rest", "less", F.explode(F.array(F.struct(F.lit(False).alias("last"), first.alias("affix")), F.struct(F.lit(True).alias("last"), last.alias("affix")))).alias("end"))
    ends = ends.select("word", "n", "less", F.xxhash64("rest", "end.last", "end.affix").alias("place"), "rest", F.col("end.last").alias("last"))
    # Spark would judge the join by the table before its letters are exploded, and broadcast it.
    a, b = ends.alias("a").hint("merge"), ends.alias("b")
    same_start = F.substr("a.word", F.lit(1), F.lit(AFFIX)) == F.substr("b.word", F.lit(1), F.lit(AFFIX))
    found = (
        (F.col("a.place") == F.col("b.place")) & (F.col("a.less") < F.col("b.less")) & (F.col("a.rest") == F.col("b.rest")) & (F.col("a.last") == F.col("b.last"))
        & (~F.col("a.last") | ~same_start)  # found by the first letters already
        & (F.levenshtein("a.word", "b.word", 1) == 1)
    )
    return a.join(b, found).select(F.col("a.word").alias("a"), F.col("a.n").alias("a_n"), F.col("b.word").alias("b"), F.col("b.n").alias("b_n"))


def forms(words: DataFrame, times: int = 10) -> DataFrame:
    """(word, n, form, form_n, n_near) of words (word, n): the most frequent near word, if it occurs times as often."""
    pairs = near_pairs(words)
    both = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("m")), F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("m")))).alias("p"))
    near = both.groupBy("p.word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("p.m")).alias("m"), F.col("p.other").alias("other"))).alias("best"))
    out = words.join(near, "word", "left")
    much = -F.col("best.m") >= times * F.col("n")
    return out.select("word", "n", F.when(much, F.col("best.other")).alias("form"), F.when(much, -F.col("best.m")).alias("form_n"), F.coalesce("n_near", F.lit(0)).alias("n_near"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of links (word, form): the last form. Counts grow at each step, so there is no cycle; each round doubles the steps taken."""
    known = saved(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        next_ = known.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = saved(known.join(next_, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        drop_saved(known)
        known = longer.select("word", "root")
        if not longer.filter("moved").limit(1).count():
            return known


def variants(docs: DataFrame, least_length: int = 7, least_count: int = 2, times: int = 10, drop_every: int = 31, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of all documents."""
    if least_length <= 2 * AFFIX:
        raise ValueError(f"words have {2 * AFFIX + 1} letters at least")
    words = saved(counted_words(docs, least_length, least_count, drop_every, id_col, text_col), "words")
    formed = saved(forms(words, times), "forms")
    out = formed.join(roots(formed.filter("form IS NOT NULL")), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
