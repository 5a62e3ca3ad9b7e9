"""Quality classifier by co-training on two views.

The text view sees the content: every word of the whole text, hashed into buckets, marks between words, and bins of shares (capitals, repetition,
marks, distinct words). The metadata view knows only what is recorded about a document, its language and source, and nothing of the text. Both
start from labelled rows. In each round each view, calibrated on labelled rows that neither has learned from, scores all unlabelled rows, and labels those that it is
surest of for the other view: all that it is SURE of, and a share of the rows at either end, classes in the proportion of the labels, which grows with the rounds. There
is no bound on their number. A pseudo-label is a probability, so a view that knows little teaches little: the metadata view learns sums of them by
language and source, the text view sums by feature, whose log-odds are logits that rows are fitted on top of: the labelled ones, and a bounded sample of the
pseudo-labelled ones, which weigh as much as they are sure. In the end the calibrated views are multiplied as independent evidence.

The text is read once: features of all rows are written and every later step reads those. Weights of languages and sources are written tables that
are joined to the rows; the driver holds the bounded sample, the buckets' weights and sums, and counts of scores in STEPS steps.

Cases: null and empty texts have no words, which is a feature; null languages and sources are values of their own, names that were in no row learned from
weigh nothing; labels of null and rows with a null id are not learned from; with labels of one class only, or none, every score is the share of good
labels (1/2 without labels); rows as sure as the last of a share are all labelled; repeated rows score alike; very long texts are read whole; an empty table gives no rows;
extra columns are not carried by scored(), and carried as they are, whatever their names, by filtered().
"""

from __future__ import annotations

import re
import zlib
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .logistic import Sparse, fit, sigmoid
from .store import saved, small_batches

#: Bounds of the rows that weights are fitted to: labelled ones of either class, pseudo-labelled ones of either class.
LABELLED, PSEUDO = 2000, 1000
#: Rounds, the share of all rows that a view labels more in each, and how sure it must be of others; steps that scores are counted in.
ROUNDS, GROWTH, SURE, STEPS = 5, 0.1, 0.95, 1000
#: Rows of either class that a feature's pseudo-labels are shrunk by.
FEATURE_PRIOR = 2.0
#: Rows of mean evidence that a name's counts are shrunk by; rejected are documents that score below this.
PRIOR, LEAST_SCORE = 20.0, 0.3
#: Buckets of words, before them those of shares in BINS bins and of marks; a bucket needs so many learned rows.
WORDS, MARKS, BINS, LEAST_ROWS = 1 << 14, 1 << 10, 10, 4
#: Shares of a text that are features in bins.
SHARES = ("capitals", "same", "marks", "distinct", "digits", "lengths")
#: Weight of words relative to a share, over the root of their number.
WORD_SCALE = 0.3
NAMES = ("lang", "source")
#: Rows of a table of names that is broadcast at most; more are joined as the optimizer decides.
BROADCAST_ROWS = 100_000

#: Texts in memory as Python strings at a time.
_TOGETHER = 128
_BASE = len(SHARES) * BINS
_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")


def features(text: str | None) -> list[int]:
    """Sorted feature ids: bins of shares, buckets of marks, buckets of words."""
    tokens = _TOKEN.findall(text or "")
    words = [t for t in tokens if t[0].isalpha()]
    n, lower = len(words), {w.lower() for w in words}
    out = []
    if n:
        rest = {}
        for t in tokens:
            if not t[0].isalpha():
                rest[t] = rest.get(t, 0) + 1
        capitals = sum(map(str.isupper, words)) / n
        same = sum(map(str.__eq__, words, words[1:])) / n
        marks = sum(len(t) * k for t, k in rest.items() if not t[0].isdigit()) / n
        digits = sum(k for t, k in rest.items() if t[0].isdigit()) / n
        shares = (capitals, same, marks / 4, 1 - len(lower) / n if n > 20 else 0.0, digits, sum(map(len, words)) / n / 16)
        out = [k * BINS + min(BINS - 1, int(x * BINS)) for k, x in enumerate(shares)]
        out += {_BASE + zlib.crc32(t[:4].encode("utf-8", "replace")) % MARKS for t in rest if not t[0].isdigit()}
    out += {_BASE + MARKS + zlib.crc32(w.encode("utf-8", "replace")) % WORDS for w in lower}
    return sorted(out)


def featured(docs: DataFrame, rows: bool = False) -> DataFrame:
    """(doc_id, lang, source, features) of docs, names with null as a value of its own; with rows, whole documents come along as the column row. Written."""
    import pyarrow as pa

    def build(texts):
        parts, sizes = [], []
        for at in range(0, len(texts), _TOGETHER):  # few texts at a time are Python strings
            found = [np.array(features(t), np.int32) for t in texts.slice(at, _TOGETHER).to_pylist()]
            sizes += [len(f) for f in found]
            parts.append(np.concatenate(found))
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *parts]), pa.int32()))

    build.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    # "v" + name, or "n" for null.
    name = lambda c: F.concat(F.lit("v"), F.col(f"`{c}`").cast("string")) if c in docs.columns else F.lit(None)
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if rows else []
    slim = docs.select(*row, "doc_id", *[F.coalesce(name(c), F.lit("n")).alias(c) for c in NAMES], F.arrow_udf(build, "array<int>")("text").alias("features"))
    with small_batches(docs.sparkSession):
        return saved(slim, "quality-features")


class TextView:
    """Weights of features; words count by WORD_SCALE over the root of their number."""

    def __init__(self):
        self.weights, self.bias, self.slope, self.shift = np.zeros(_BASE + MARKS + WORDS), 0.0, 1.0, 0.0

    def learn(self, rows: list, y: np.ndarray, told: np.ndarray | None = None, l2: float = 3e-4) -> None:
        """y: 0, 1 or probabilities, whose rows weigh as much as they are sure; both classes weigh the same. told: log-odds of features that the other view's labels say, which
        are weights that the rows' own are added to."""
        sure, good = np.abs(2 * y - 1), (y >= 0.5).astype(int)
        counts = np.maximum(np.bincount(good, weights=sure, minlength=2), 1e-9)
        flat, sizes = np.concatenate([np.zeros(0, np.int32), *(np.asarray(r, np.int32) for r in rows)]), np.array([len(r) for r in rows], np.int64)
        ids = np.flatnonzero(np.bincount(flat, minlength=len(self.weights)) >= LEAST_ROWS)
        at = np.full(len(self.weights), -1, np.int32)
        at[ids] = np.arange(len(ids))
        owner, word = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), flat >= _BASE + MARKS
        scale = WORD_SCALE / np.sqrt(np.maximum(np.bincount(owner[word], minlength=len(sizes)), 1))
        known = at[flat] >= 0
        cells = Sparse.of(owner[known], at[flat[known]], np.where(word, scale[owner], 1.0)[known], len(sizes), len(ids))
        self.weights, self.bias = np.zeros(len(self.weights)) if told is None else told.copy(), 0.0
        w, self.bias = fit(cells, y, sure / counts[good], l2=l2, steps=200, offset=self.logits(rows))
        self.weights[ids] += w

    def logits(self, rows: list) -> np.ndarray:
        return self._logits(np.concatenate([np.zeros(0, np.int32), *(np.asarray(r, np.int32) for r in rows)]), np.array([len(r) for r in rows], np.int64))

    def _logits(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        owner = np.repeat(np.arange(len(sizes)), sizes)
        word, w = ids >= _BASE + MARKS, self.weights[ids]
        total = lambda at, w: np.bincount(owner[at], weights=w, minlength=len(sizes))
        return self.bias + total(~word, w[~word]) + WORD_SCALE * total(word, w[word]) / np.sqrt(np.maximum(total(word, None), 1))

    def column(self) -> Column:
        """The logit over the column features, not calibrated."""
        import pyarrow as pa

        def score(features):
            return pa.array(self._logits(features.flatten().to_numpy(), features.value_lengths().to_numpy()))

        score.__annotations__ = {"features": pa.Array, "return": pa.Array}
        return F.arrow_udf(score, "double")("features")


class MetaView:
    """Log-odds of every language and source, shrunk by PRIOR rows: naive Bayes, classes weighing the same. Tables (name, weight) by column."""

    def __init__(self):
        self.tables: dict[str, DataFrame] = {}
        self.slope, self.shift = 1.0, 0.0

    def learn(self, told: DataFrame) -> None:
        """told: (lang, source, y) of all rows to learn from; y is 0, 1 or a probability."""
        cells = saved(told.groupBy(*NAMES).agg(F.sum("y").alias("n1"), F.sum(1 - F.col("y")).alias("n0")), "quality-names")
        n1, n0 = (float(x or 0) for x in cells.agg(F.sum("n1"), F.sum("n0")).first())
        if not n1 or not n0:
            return
        for c in NAMES:
            by = cells.groupBy(F.col(c).alias("name")).agg((F.sum("n1") / n1).alias("p"), (F.sum("n0") / n0).alias("q"), F.sum(F.col("n1") + F.col("n0")).alias("n"))
            # Rates relative to the whole: PRIOR rows of log-odds 0 are added.
            own = F.col("n") / (n1 + n0)
            few = F.lit(PRIOR / (n1 + n0)) * F.when(own > 0, 1.0)
            self.tables[c] = saved(by.select("name", F.log((F.col("p") + few) / (F.col("q") + few)).alias("weight")), "quality-weights")

    def placed(self, df: DataFrame) -> DataFrame:
        """df with the column __meta, the logit, not calibrated."""
        for c in NAMES:
            if c in self.tables:
                table = self.tables[c].select(F.col("name").alias(c), F.col("weight").alias(f"__weight_{c}"))
                # The size is checked.
                df = df.join(F.broadcast(table) if table.count() <= BROADCAST_ROWS else table, c, "left")
        weights = [F.coalesce(F.col(f"__weight_{c}"), F.lit(0.0)) for c in NAMES if c in self.tables]
        return df.withColumn("__meta", reduce(lambda a, b: a + b, weights, F.lit(0.0))).drop(*[f"__weight_{c}" for c in NAMES])


def calibrated(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt's sigmoid: slope and shift of the logits on rows not learned from; a slope below 0 says nothing and is 0."""
    a, b, n1 = 1.0, 0.0, y.sum()
    goal = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (len(y) - n1 + 2))
    for _ in range(2000):
        r = sigmoid(a * z + b) - goal
        a, b = a - 0.05 * ((r * z).mean() + 1e-3 * (a - 1)), b - 0.5 * r.mean()
    return max(a, 0.0), b


def soft(z: Column, view, mix: float) -> Column:
    """Probability of a good row by a view's logits, were both classes as frequent; mix is the share of good ones that the view is calibrated with."""
    x = z * float(view.slope) + float(view.shift - np.log(mix / (1 - mix)))
    return 1 / (1 + F.exp(-F.greatest(F.least(x, F.lit(40.0)), F.lit(-40.0))))


def ends(counts: dict[int, int], share: float, good: float) -> tuple[int, int]:
    """Steps of scores up to which rows are labelled bad, and from which good: the surest share of all, of which the share good are good. Steps on either side of the middle."""
    n, low, high = sum(counts.values()), -1, STEPS + 1
    for wanted, steps, is_good in ((share * good * n, sorted(counts, reverse=True), True), (share * (1 - good) * n, sorted(counts), False)):
        taken = 0
        for k in steps:
            if taken >= wanted or (k < STEPS / 2 if is_good else k >= STEPS / 2):
                break
            taken += counts[k]
            low, high = (low, k) if is_good else (k, high)
    return low, high


def _labelled(rows: DataFrame, p: str, share: float, good: float) -> tuple[Column, int, int]:
    """Whether a row is among those that a view (column p) labels, and how many bad and good ones there are; counts of all rows by steps are the bound of what comes to the driver."""
    step = F.least(F.floor(F.col(p) * STEPS), F.lit(STEPS - 1)).cast("int")
    counts = {r["k"]: r["n"] for r in rows.groupBy(step.alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()}
    low, high = ends(counts, share, good)
    sure = int(SURE * STEPS)
    n0, n1 = sum(n for k, n in counts.items() if k <= max(low, STEPS - sure)), sum(n for k, n in counts.items() if k >= min(high, sure))
    return (step <= low) | (step >= high) | (F.col(p) >= SURE) | (F.col(p) <= 1 - SURE), n0, n1


def log_odds(sums: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Of features, from sums (2 x features) of bad and good pseudo-labels and their totals rows (2)."""
    p = (sums + FEATURE_PRIOR) / (rows[:, None] + 2 * FEATURE_PRIOR)
    return np.where(sums.sum(0) >= LEAST_ROWS, np.log(p[1] / p[0]), 0.0)


def _told(rows: DataFrame) -> np.ndarray:
    """log_odds() of features by the column p of rows (features, p): sums in the tasks, one row a feature and task."""

    def add(batches):
        import pyarrow as pa

        n = _BASE + MARKS + WORDS
        sums = np.zeros((2, n + 1))  # rows are counted at the end
        for b in batches:
            lists, p = b.column("features"), b.column("p").to_numpy(zero_copy_only=False)
            ids, each = lists.flatten().to_numpy(), np.repeat(p, lists.value_lengths().to_numpy())
            sums[1, :n] += np.bincount(ids, weights=each, minlength=n)
            sums[0, :n] += np.bincount(ids, weights=1 - each, minlength=n)
            sums[:, n] += [(1 - p).sum(), p.sum()]
        some = np.flatnonzero(sums.sum(0))
        yield pa.RecordBatch.from_pydict({"f": pa.array(some, pa.int32()), "bad": pa.array(sums[0, some]), "good": pa.array(sums[1, some])})

    found = rows.select("features", "p").mapInArrow(add, "f int, bad double, good double").groupBy("f").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).toArrow()
    sums = np.zeros((2, _BASE + MARKS + WORDS + 1))
    sums[:, found.column("f").to_numpy()] = np.round([found.column("bad").to_numpy(), found.column("good").to_numpy()], 6)
    return log_odds(sums[:, :-1], sums[:, -1])


def _sampled(rows: DataFrame, seed: int, n0: int, n1: int) -> list[tuple[np.ndarray, float]]:
    """(features, p) of at most PSEUDO rows of either class, by a hash of their ids; n0 and n1 are about their numbers, so that few more leave the tasks."""
    h = F.xxhash64(F.lit(seed + 1), "doc_id")
    few = lambda n: F.pmod(h, F.lit(1 << 30)) < int(min(1.0, 2 * PSEUDO / max(n, 1)) * (1 << 30)) if n > 2 * PSEUDO else F.lit(True)
    side = lambda c, n: rows.filter(F.expr(c) & few(n)).orderBy(h, "doc_id", "features").limit(PSEUDO).select("features", F.round("p", 6).alias("p")).toArrow()
    both = [side(c, n) for c, n in (("p >= 0.5", n1), ("p < 0.5", n0))]
    return [x for t in both for x in zip(_lists(t), t.column("p").to_pylist(), strict=True)]


def _lists(table) -> list[np.ndarray]:
    """The column features of an Arrow table, which holds them in a tenth of what lists of Python take."""
    column = table.column("features").combine_chunks()
    ends, flat = column.offsets.to_numpy(), column.values.to_numpy()
    return [flat[i:j] for i, j in zip(ends[:-1], ends[1:], strict=True)]


Model = tuple[TextView, MetaView, float] | float


def trained(measured: DataFrame, labels: DataFrame, seed: int = 17, labelled: int = LABELLED, rounds: int = ROUNDS) -> Model:
    """Both views and the share of good labels, from featured() rows and labels (doc_id, quality); or the share alone if there is nothing to tell apart."""
    labels = labels.select("doc_id", F.col("quality").cast("int").alias("y")).filter("doc_id IS NOT NULL AND quality IN (0, 1)")
    counts = {r["y"]: r["n"] for r in labels.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = counts.get(0, 0), counts.get(1, 0)
    if not n0 or not n1:
        return n1 / (n0 + n1) if n0 + n1 else 0.5
    h = F.xxhash64(F.lit(seed), "doc_id")
    picked = labels.filter("y = 0").orderBy(h, "doc_id").limit(labelled).union(labels.filter("y = 1").orderBy(h, "doc_id").limit(labelled))
    picked = saved(picked, "quality-picked")
    # At most 2 * labelled rows: the bound of the broadcasts.
    own = measured.select("doc_id", *NAMES, "features").join(F.broadcast(picked), "doc_id")
    table = own.orderBy(h, "doc_id", *NAMES, "features", "y").limit(4 * labelled).toArrow()
    y = table.column("y").to_numpy().astype(float)
    if len(set(y.tolist())) < 2:
        return n1 / (n0 + n1)
    rows = list(zip(_lists(table), *[table.column(c).to_pylist() for c in NAMES], strict=True))
    held = np.arange(len(rows)) % 4 == 3  # rows come in order of a hash
    if len(set(y[held].tolist())) < 2 or len(set(y[~held].tolist())) < 2:
        held = np.zeros(len(rows), bool)
    train = [r for r, k in zip(rows, held, strict=True) if not k]
    ids, known = [r[0] for r in train], measured.sparkSession.createDataFrame([(*r[1:], int(k)) for r, k in zip(train, y[~held], strict=True)], "lang string, source string, y int")
    spare = measured.select(*NAMES, "doc_id", "features").join(F.broadcast(picked.select("doc_id")), "doc_id", "left_anti")
    text, meta, spark = TextView(), MetaView(), measured.sparkSession
    test = [r for r, k in zip(rows, held, strict=True) if k] or train
    goal, mix = y[held] if held.any() else y, float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    names = spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(test)], "i int, lang string, source string")

    def calibrate() -> None:
        text.slope, text.shift = calibrated(text.logits([r[0] for r in test]), goal)
        z = {r["i"]: r["__meta"] for r in meta.placed(names).select("i", "__meta").collect()}
        meta.slope, meta.shift = calibrated(np.array([z[i] for i in range(len(test))]), goal)

    text.learn(ids, y[~held])
    meta.learn(known)
    calibrate()
    for k in range(rounds):
        share, good = GROWTH * (k + 1), n1 / (n0 + n1)
        z = saved(spare.select(*NAMES, soft(text.column(), text, mix).alias("p")), "quality-round")
        by_meta = meta.placed(spare).select("doc_id", "features", soft(F.col("__meta"), meta, mix).alias("p"))
        chosen, *sizes = _labelled(by_meta.select("p"), "p", share, good)
        by_meta = by_meta.filter(chosen)
        told, extra = _told(by_meta), _sampled(by_meta, seed, *sizes)
        meta.learn(z.filter(_labelled(z, "p", share, good)[0]).select(*NAMES, F.round("p", 6).alias("y")).unionByName(known.withColumn("y", F.col("y").cast("double"))))
        text.learn(ids + [f for f, _ in extra], np.append(y[~held], [p for _, p in extra]), told)
        calibrate()
    return text, meta, mix


def scored(measured: DataFrame, model: Model, least: float = LEAST_SCORE) -> DataFrame:
    """(doc_id, row if there is one, text_score, meta_score, score, kept) of featured() rows."""
    own = [c for c in ("doc_id", "row") if c in measured.columns]
    if isinstance(model, float | int):
        share = F.lit(float(model))
        return measured.select(*own, share.alias("text_score"), share.alias("meta_score"), share.alias("score"), F.lit(True).alias("kept"))
    text, meta, good = model
    p = lambda z: 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(40.0)), F.lit(-40.0))))
    z = meta.placed(measured).select(*own, (text.column() * float(text.slope) + float(text.shift)).alias("a"), (F.col("__meta") * float(meta.slope) + float(meta.shift)).alias("b"))
    both = F.col("a") + F.col("b") - float(np.log(good / (1 - good)))
    out = z.select(*own, p(F.col("a")).alias("text_score"), p(F.col("b")).alias("meta_score"), p(both).alias("score"))
    return out.withColumn("kept", F.col("score") >= least)


def filtered(docs: DataFrame, labels: DataFrame, least: float = LEAST_SCORE, **options) -> DataFrame:
    """The rows of docs that are kept, all columns as they were, by a model trained on them and labels."""
    measured = featured(docs, rows=True)
    return scored(measured, trained(measured, labels, **options), least).filter("kept").select("row.*")
