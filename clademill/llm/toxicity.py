"""Toxicity by a counterfactually regularised classifier.

Features are the distinct words of a text and their beginnings, the ones that tell labelled toxic texts from others, and the swap terms.
Swap terms are words that may be mentioned neutrally and must not raise the score by themselves: words for groups of people, given by language and kind, and
words that the labelled texts show to be like them: no function words, more common in toxic texts but no strangers to others, that choose a counterpart
which chooses them (mention_terms()). Sentences of labelled texts that hold a term are copied with the term swapped for a counterpart (another group of the kind, or the
words of other texts that stand beside the same words most), and training penalises the squared change of the score's logit. A neutral mention then
can't raise the score, however often labelled toxic texts hold it. If no sentence holds a term, trained() warns: the regulariser had no pairs.

Cases: null and empty texts have no features and get the bias as their score; labels of null are not learned
from; repeated labels count each; repeated rows score alike; equal evidence goes by the word; very long texts are read whole; without toxic labels, or
without others, all scores are the share of toxic labels; rows with a null id are scored and not held out; an empty table gives no rows; columns beside text
are carried, those named score and predicted are replaced.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterator, Mapping

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .logistic import Sparse, fit, sigmoid

#: Bounds of the learned sample: labelled texts of either class, features, sentence pairs.
SAMPLE_ROWS, FEATURES, PAIRS = 3000, 6000, 4000
#: A feature needs this many toxic texts and this log-likelihood ratio (1 degree of freedom).
LEAST_TEXTS, LEAST_G2 = 3, 16.0
#: Swap terms that are found at most, words that are looked at as their counterparts, words beside which they may stand, counterparts of a term.
TERMS, PARTNERS, NEIGHBOURS, COUNTERPARTS = 100, 1000, 400, 2
#: A found term is in this many texts of either class, and by these factors more common among toxic ones.
LEAST_OTHERS, LIFT = 5, (1.2, 8.0)
#: Lengths of the beginnings of words.
BEGINNINGS = (4, 5, 6)
#: Words for groups of people, by language and kind; a mention is swapped within its kind and for the language's neutral word. Fixed values of ours, a parameter.
IDENTITY_TERMS = {
    "en": (
        ("women", "men", "girls", "boys", "trans"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"), ("gay", "lesbian", "bisexual", "straight", "queer"),
        ("black", "white", "asian", "latino", "african", "european"), ("immigrants", "refugees", "natives", "foreigners"), ("disabled", "blind", "deaf", "autistic"),
    ),
    "de": (("frauen", "männer", "mädchen", "jungen"), ("muslime", "christen", "juden", "atheisten"), ("schwule", "lesben", "queere"), ("schwarze", "weiße", "asiaten"), ("einwanderer", "flüchtlinge", "ausländer"), ("behinderte", "blinde", "gehörlose")),
    "fr": (("femmes", "hommes", "filles", "garçons"), ("musulmans", "chrétiens", "juifs", "athées"), ("gays", "lesbiennes", "bisexuels"), ("noirs", "blancs", "asiatiques"), ("immigrés", "réfugiés", "étrangers"), ("handicapés", "aveugles", "sourds")),
    "es": (("mujeres", "hombres", "chicas", "chicos"), ("musulmanes", "cristianos", "judíos", "ateos"), ("gais", "lesbianas", "bisexuales"), ("negros", "blancos", "asiáticos"), ("inmigrantes", "refugiados", "extranjeros"), ("discapacitados", "ciegos", "sordos")),
}
NEUTRAL = {"en": "people", "de": "menschen", "fr": "gens", "es": "personas"}
#: Words that mention nobody and are no found terms, whatever their counts. Fixed values of ours, a parameter.
FUNCTION_WORDS = frozenset(
    "a an and are as at be but by for from had has have he her here his i if in is it its no not of on or our out she so some than that the their then there these they this those to up was we were what when which who will with would you your "
    "aber als am an auch auf aus bei bin bis da das dass dem den der des die doch durch ein eine einen einer er es für hat ich ihr im in ist ja mit nach nicht noch nur oder sein sich sie sind so um und uns von vor war wenn wie wir zu zum zur "
    "au aux avec ce ces dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas plus pour qui que sa se ses son sur un une vous "
    "al como con del el ella ellos era esta este ha hay las lo los más me mi muy o para pero por se si sin sobre su sus también te tiene una uno y ya".split()
)

_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[^.!?\n]+")


def features(text: str | None) -> set[str]:
    """Distinct lower-case words, and their beginnings marked by a star."""
    found = set(_WORD.findall((text or "").lower()))
    return found.union(*({w[:n] + "*" for w in found if len(w) > n} for n in BEGINNINGS))


def by_kind(terms: Mapping[str, tuple[tuple[str, ...], ...]] = IDENTITY_TERMS, neutral: Mapping[str, str] = NEUTRAL) -> dict[str, tuple[str, ...]]:
    """Counterparts of each term: all others of its kind, and its language's neutral word. A word of several languages has those of each."""
    out: dict[str, tuple[str, ...]] = {}
    for lang, kinds in terms.items():
        for ws in kinds:
            for w in ws:
                out[w] = tuple(dict.fromkeys((*out.get(w, ()), *(x for x in (*ws, *([neutral[lang]] if lang in neutral else [])) if x != w))))
    return out


def swaps(text: str | None, terms: Mapping[str, tuple[str, ...]]) -> Iterator[tuple[str, str]]:
    """Sentences that hold a term, each with the term swapped for each of its counterparts."""
    for sentence in _SENTENCE.findall((text or "").lower()):
        for w in dict.fromkeys(_WORD.findall(sentence)):
            for other in terms.get(w, ()):
                yield sentence, re.sub(rf"(?<![^\W\d_]){w}(?![^\W\d_])", other, sentence)


def mention_terms(rows: DataFrame, counted: DataFrame, n0: int, n1: int) -> dict[str, tuple[str, ...]]:
    """Swap terms that the learned rows (text, toxic) show, with their counterparts; counted: (feature, a, b, g2), texts of either class by feature.

    A counterpart is no more common among toxic texts, and stands beside the same words: its neighbours' counts have the highest cosine. The two must choose each other: of all
    terms, this one stands most like its counterpart. Function words and words without a counterpart are no terms.
    """
    word = ~F.col("feature").endswith("*") & ~F.col("feature").isin(*FUNCTION_WORDS)
    lift = (F.col("a") * n0) / (F.col("b") * n1)
    enough = counted.filter(word & (F.col("b") >= LEAST_OTHERS)).withColumn("lift", lift)
    terms = enough.filter((F.col("a") >= LEAST_OTHERS) & F.col("lift").between(*LIFT)).orderBy(F.desc("g2"), "feature").limit(TERMS)
    partners = enough.filter("lift <= 1").orderBy(F.desc("b"), "feature").limit(PARTNERS)
    beside = counted.filter(~F.col("feature").endswith("*")).orderBy(F.desc(F.col("a") + F.col("b")), "feature").limit(NEIGHBOURS)
    terms, partners, beside = ([r["feature"] for r in x.select("feature").collect()] for x in (terms, partners, beside))
    if not terms or not partners:
        return {}

    def neighbours(batches):
        import pandas as pd

        at, near = {w: i for i, w in enumerate([*terms, *partners])}, {w: i for i, w in enumerate(beside)}
        for b in batches:
            counts: dict[tuple[int, int], int] = {}
            for text in b["text"]:
                words = _WORD.findall((text or "").lower())
                for i, w in enumerate(words):
                    k = at.get(w)
                    if k is not None:
                        for x, side in ((words[i - 1] if i else None, 0), (words[i + 1] if i + 1 < len(words) else None, 1)):
                            if x in near:
                                counts[k, 2 * near[x] + side] = counts.get((k, 2 * near[x] + side), 0) + 1
            yield pd.DataFrame([(*k, n) for k, n in counts.items()], columns=["word", "side", "n"])

    # At most (TERMS + PARTNERS) * 2 * NEIGHBOURS counts.
    counts = rows.select("text").mapInPandas(neighbours, "word int, side int, n long").groupBy("word", "side").agg(F.sum("n").alias("n")).toArrow()
    m = np.zeros((len(terms) + len(partners), 2 * len(beside)))
    m[counts.column("word").to_numpy(), counts.column("side").to_numpy()] = np.sqrt(counts.column("n").to_numpy())
    m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
    like = m[: len(terms)] @ m[len(terms) :].T
    near, chosen = np.argsort(-like, axis=1, kind="stable")[:, :COUNTERPARTS], like.argmax(0)
    found = {w: tuple(partners[j] for j in near[i] if chosen[j] == i and like[i, j] > 0) for i, w in enumerate(terms)}
    return {w: ws for w, ws in found.items() if ws}


def _exploded_features(rows: DataFrame) -> DataFrame:
    def split(batches):
        import pandas as pd

        for b in batches:
            for text, toxic in zip(b["text"], b["toxic"], strict=True):
                f = sorted(features(text))
                yield pd.DataFrame({"feature": pd.Series(f, dtype=object), "toxic": np.full(len(f), toxic, np.int32)})

    return rows.select("text", F.col("toxic").cast("int")).mapInPandas(split, "feature string, toxic int")


def learned_rows(docs: DataFrame, labels: DataFrame, seed: int = 17, most: int = SAMPLE_ROWS) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, text, toxic) of at most `most` labels of either class, by smallest hash, and all labels' counts."""
    labels = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
    counts = {r["toxic"]: r["n"] for r in labels.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    h = F.xxhash64(F.lit(seed), "doc_id")
    picked = [labels.filter(F.col("toxic") == y).orderBy(h, "doc_id").limit(most) for y in (0, 1)]
    # At most 2 * most rows: the bound of the broadcast.
    return docs.select("doc_id", "text").join(F.broadcast(picked[0].union(picked[1])), "doc_id"), counts


class Model:
    """Feature weights and bias; what is sent to the tasks. terms and pairs: swap terms with their counterparts, sentence pairs learned from."""

    def __init__(self, names: list[str], weights: np.ndarray, bias: float, terms: Mapping[str, tuple[str, ...]] | None = None, pairs: int = 0):
        self.terms, self.pairs = dict(terms or {}), pairs
        self.weights = {n: float(w) for n, w in zip(names, weights, strict=True) if w}
        self.bias = bias
        self.words = frozenset(n for n in self.weights if n[-1] != "*")
        self.starts = {n: frozenset(x[:-1] for x in self.weights if x[-1] == "*" and len(x) == n + 1) for n in BEGINNINGS}

    def logit(self, text: str | None) -> float:
        found = set(_WORD.findall((text or "").lower()))
        w = self.weights
        z = self.bias + sum(w[x] for x in sorted(found & self.words))
        for n, known in self.starts.items():
            if known:
                z += sum(w[x + "*"] for x in sorted({y[:n] for y in found if len(y) > n} & known))
        return z


def trained(docs: DataFrame, labels: DataFrame, seed: int = 17, pair_weight: float = 1.0, kinds: Mapping[str, tuple[tuple[str, ...], ...]] = IDENTITY_TERMS, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from docs (doc_id, text) with labels (doc_id, toxic)."""
    from .store import saved

    rows, counts = learned_rows(docs, labels, seed, sample_rows)
    rows = saved(rows, "toxic-rows")
    shown = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = shown.get(0, 0), shown.get(1, 0)
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    if not n0 or not n1:
        z = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
        return Model([], np.zeros(0), z)
    table = _exploded_features(rows).groupBy("feature").agg(F.sum("toxic").cast("double").alias("a"), F.sum(1 - F.col("toxic")).cast("double").alias("b"))
    a, b = F.col("a"), F.col("b")
    both, n = a + b, n0 + n1
    term = lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(0.0)
    g2 = 2 * (term(a, both * n1 / n) + term(b, both * n0 / n) + term(n1 - a, n1 * (n - both) / n) + term(n0 - b, n0 * (n - both) / n))
    table = saved(table.filter(both >= LEAST_TEXTS).withColumn("g2", g2), "toxic-counts")
    # Words that speak for a toxic text only: what marks others (junk, say) must not hide insults.
    chosen = table.filter((a >= LEAST_TEXTS) & (a * n0 > b * n1) & (F.col("g2") >= LEAST_G2))
    names = [r["feature"] for r in chosen.orderBy(F.desc("g2"), "feature").limit(FEATURES).collect()]
    terms = by_kind(kinds) | mention_terms(rows, table, n0, n1)
    names = sorted({*names, *terms, *(w for ws in terms.values() for w in ws)})

    def ids(batches):
        import pandas as pd

        at = {x: i for i, x in enumerate(names)}
        ids_of = lambda t: sorted(at[f] for f in features(t) if f in at)
        for batch in batches:
            out = []
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                out.append((0, toxic, ids_of(text), []))
                pairs = ((ids_of(x), ids_of(y)) for x, y in swaps(text, terms))
                out += [(1, toxic, x, y) for x, y in pairs if x != y]
            yield pd.DataFrame(out, columns=["pair", "toxic", "x", "y"])

    made = saved(rows.select("text", F.col("toxic").cast("int")).mapInPandas(ids, "pair int, toxic int, x array<int>, y array<int>"), "toxic-features")
    # At most 2 * sample_rows rows; sums are rounded alike in any run if they are in order.
    single = sorted((r["toxic"], r["x"]) for r in made.filter("pair = 0").select("toxic", "x").collect())
    pairs = made.filter("pair = 1").select("x", "y").orderBy(F.xxhash64(F.lit(seed), "x", "y"), "x", "y").limit(PAIRS).collect()
    if not pairs:
        warnings.warn("no labelled sentence holds a swap term: the counterfactual penalty has no pairs to work on", stacklevel=2)
    y = np.array([t for t, _ in single], float)
    weight = np.where(y == 1, share / n1, (1 - share) / n0)
    x = Sparse([x for _, x in single], len(names))
    two = Sparse([r["x"] for r in pairs], len(names)), Sparse([r["y"] for r in pairs], len(names))
    return Model(names, *fit(x, y, weight, l2=2e-5, pairs=two, pair_weight=pair_weight), terms=terms, pairs=len(pairs))


def swap_changes(docs: DataFrame, model: Model, by: str) -> DataFrame:
    """(by, mentions, mean_change, worst_change): how much swapping the model's terms changes the scores of the sentences of docs (text, by) that hold one."""

    def change(batches):
        import pandas as pd

        for b in batches:
            rows = [(g, abs(float(sigmoid(model.logit(x))) - float(sigmoid(model.logit(y))))) for t, g in zip(b["text"], b["by"], strict=True) for x, y in swaps(t, model.terms)]
            yield pd.DataFrame(rows, columns=["by", "change"])

    rows = docs.select("text", F.col(by).cast("string").alias("by")).mapInPandas(change, "by string, change double")
    return rows.groupBy("by").agg(F.count(F.lit(1)).alias("mentions"), F.avg("change").alias("mean_change"), F.max("change").alias("worst_change"))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """docs without text, with score (0 to 1) and predicted."""
    import pandas as pd

    def score(parts):
        for texts in parts:
            yield pd.Series(sigmoid(np.array([model.logit(t) for t in texts], float)))

    score.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in ("text", "score", "predicted")]
    out = docs.select(*keep, F.pandas_udf(score, "double")("text").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
