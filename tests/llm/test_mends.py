"""Columns of any name and type, ids of other types, co-training beside a plain walk, swap terms, trees near threshold 1."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from clademill.llm import cotrain, covertree, extendible, filteraudit, hostrules, langid, minhash, mixing, segment, sharding, spelling, toxicity, warc
from clademill.llm.logistic import sigmoid


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, f"some words of text number {i % 5} and more of them", "en" if i % 2 else "de", "web") for i in range(20)] + [(30, None, None, None), (31, "", "en", "web")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumns(
        {"a.b": F.lit(1), "__found": F.lit("f"), "m": F.create_map(F.lit("k"), F.lit(1)), "found": F.lit(2), "row": F.lit(3), "number": F.lit(4), "rest": F.lit(5)}
    )


def test_columns_of_any_name_and_type(spark, odd, tmp_path):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(20)], "doc_id long, quality int, toxic int")
    more = ["a.b", "__found", "m", "found", "row", "number", "rest"]
    with pytest.warns(UserWarning):
        toxic = toxicity.scored(odd, toxicity.trained(odd, labels))
    for out in (toxic, langid.identified(odd, odd)):
        assert set(more) <= set(out.columns) and {(r["a.b"], r["__found"], str(r["m"]), r["found"]) for r in out.collect()} == {(1, "f", "{'k': 1}", 2)}
    for keeps in (cotrain.filtered(odd, labels), hostrules.filtered(odd), minhash.deduplicated(odd), mixing.resampled(odd), extendible.deduplicated(odd)):
        assert set(more) <= set(keeps.columns)
        keeps.collect()
    sharding.write_shards(odd, f"{tmp_path}/s", n_shards=3)
    back = spark.read.parquet(f"{tmp_path}/s")
    assert back.count() == 22 and set(more) <= set(back.columns) and {str(r["m"]) for r in back.select("m").collect()} == {"{'k': 1}"}
    for n in (segment.sampled(odd).count(), spelling.variants(odd).count(), filteraudit.audited(odd, labels).count(), sharding.interleaved(odd).count()):
        assert n >= 0
    pages = odd.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.col("text").alias("html"), "`a.b`", "__found", "m")
    assert warc.archived(pages).count() == 22


def test_ids_of_other_types_are_errors(spark, odd):
    names = odd.withColumn("doc_id", F.col("doc_id").cast("string"))
    for call in (minhash.near_duplicates, minhash.deduplicated, segment.sampled, segment.digested):
        with pytest.raises(TypeError, match="doc_id are string"):
            call(names)
    vectors = spark.createDataFrame([("a", "l", [1.0])], "vec_id string, label string, embedding array<double>")
    with pytest.raises(TypeError, match="vec_id are string"):
        covertree.near_vectors(vectors)
    assert extendible.exact_duplicates(names).count() == 22  # any type that can be ordered


@pytest.mark.parametrize("threshold", [1.0, 1 - 2e-13, 0.999999])
def test_trees_near_threshold_one(spark, threshold):
    """Scaled copies are at no distance; a tree of them ends."""
    r = np.random.default_rng(2)
    x = r.normal(size=(40, 8))
    x = np.concatenate([x, 2 * x, x * 1e-3, x + 1e-12, x + 1e-5])
    units = covertree._units(x)
    tree = covertree.Tree(units, math.sqrt(max(0.0, 2 - 2 * threshold)) - covertree.SLACK)
    assert sorted(tree.order) == list(range(200))
    rows = [(i, "l", v.tolist()) for i, v in enumerate(x)]
    got = {r.vec_id: r.n_links for r in covertree.near_vectors(spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>"), threshold).collect()}
    if threshold < 0.9999999:
        assert got == {i: int((units @ units[i] >= threshold).sum()) - 1 for i in range(200)}
    assert len(got) == 200


def _platt(view, z):
    return sigmoid(view.slope * z + view.shift)


def _meta_weights(told):
    """Log-odds by name of (lang, source, y), by plain sums."""
    n1, n0 = sum(y for *_, y in told), sum(1 - y for *_, y in told)
    out = []
    for k in (0, 1):
        own = {}
        for row in told:
            a = own.setdefault(row[k], [0.0, 0.0])
            a[0] += row[2]
            a[1] += 1 - row[2]
        few = cotrain.PRIOR / (n1 + n0)
        out.append({name: math.log((a / n1 + few) / (b / n0 + few)) for name, (a, b) in own.items()})
    return lambda lang, source: out[0].get(lang, 0.0) + out[1].get(source, 0.0)


def _chosen(p, share, good):
    """Rows that a view labels: its surest ones from either end of the scores in steps, and all that it is sure of."""
    step = np.minimum(np.floor(p * cotrain.STEPS), cotrain.STEPS - 1)
    take = (p >= cotrain.SURE) | (p <= 1 - cotrain.SURE)
    for wanted, ks, side in ((share * good * len(p), sorted(set(step), reverse=True), step >= cotrain.STEPS / 2), (share * (1 - good) * len(p), sorted(set(step)), step < cotrain.STEPS / 2)):
        n = 0
        for k in ks:
            if n >= wanted:
                break
            take |= (step == k) & side
            n += ((step == k) & side).sum() if (step == k)[side].any() else 0
    return take


def test_co_training_against_a_plain_walk(spark):
    """The same scores as a walk over lists, and both views are taught in every round."""
    r = np.random.default_rng(8)
    words = [f"w{chr(97 + i // 20)}{chr(97 + i % 20)}" for i in range(40)]
    rows, labels = [], []
    for i in range(500):
        good = int(r.random() < 0.6)
        text = " ".join(r.choice(words[:25] if good else words[15:], 12))
        source = f"s{int(r.integers(3) + 3 * (good if r.random() < 0.8 else 1 - good))}"
        rows.append((i, text, "en" if i % 3 else None, source))
        if i < 120:
            labels.append((i, good))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    measured = cotrain.featured(df)
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    text, meta, mix = cotrain.trained(measured, lab)

    order = [x.doc_id for x in lab.orderBy(F.xxhash64(F.lit(17), "doc_id")).collect()]
    feats = {i: cotrain.features(t) for i, t, *_ in rows}
    names = {i: ("v" + a if a else "n", "v" + b) for i, _, a, b in rows}
    y = dict(labels)
    train, held = [i for k, i in enumerate(order) if k % 4 != 3], [i for k, i in enumerate(order) if k % 4 == 3]
    spare = [i for i, *_ in rows if i not in y]
    goal, own = np.array([y[i] for i in held], float), np.array([y[i] for i in train], float)
    view, known = cotrain.TextView(), [(*names[i], float(y[i])) for i in train]
    view.learn([feats[i] for i in train], own)
    weigh = _meta_weights(known)
    share_good, taught = np.mean(list(y.values())), []
    share_all = float(np.mean(list(y.values())))
    assert mix == pytest.approx(share_all)
    odds = math.log(mix / (1 - mix))

    class Meta:
        slope = shift = 0.0

    other = Meta()

    def calibrate():
        view.slope, view.shift = cotrain.calibrated(view.logits([feats[i] for i in held]), goal)
        other.slope, other.shift = cotrain.calibrated(np.array([weigh(*names[i]) for i in held]), goal)

    calibrate()
    for k in range(cotrain.ROUNDS):
        share = cotrain.GROWTH * (k + 1)
        p = sigmoid(view.slope * view.logits([feats[i] for i in spare]) + view.shift - odds)
        q = sigmoid(other.slope * np.array([weigh(*names[i]) for i in spare]) + other.shift - odds)
        by_text, by_meta = _chosen(p, share, share_good), _chosen(q, share, share_good)
        taught.append((by_text.sum(), by_meta.sum()))
        sums, totals = np.zeros((2, len(view.weights))), np.zeros(2)
        for i, x, take in zip(spare, q, by_meta, strict=True):
            if take:
                totals += [1 - x, x]
                for f in feats[i]:
                    sums[:, f] += [1 - x, x]
        weigh = _meta_weights([(*names[i], round(x, 6)) for i, x, take in zip(spare, p, by_text, strict=True) if take] + known)
        picked = [(feats[i], round(x, 6)) for i, x, take in zip(spare, q, by_meta, strict=True) if take]  # all of them: fewer than the sample's bound
        view.learn([feats[i] for i in train] + [f for f, _ in picked], np.append(own, [x for _, x in picked]), cotrain.log_odds(np.round(sums, 6), totals))
        calibrate()
    assert all(a > 0 and b > 0 for a, b in taught)
    got = {x.doc_id: (x.text_score, x.meta_score) for x in cotrain.scored(measured, (text, meta, mix)).collect()}
    a, b = _platt(view, view.logits([feats[i] for i, *_ in rows])), _platt(other, np.array([weigh(*names[i]) for i, *_ in rows]))
    for k, (i, *_) in enumerate(rows):
        assert got[i] == pytest.approx((a[k], b[k]), abs=1e-5)
    none = cotrain.trained(measured, lab, rounds=0)
    assert np.abs(none[0].weights - text.weights).max() > 0.1


def test_found_terms_choose_each_other_and_mention(spark):
    """Function words are no terms, however much commoner they are in toxic texts."""
    rows = []
    for i in range(400):
        who = ("norbs" if i % 2 or i % 8 == 0 else "talms") if i % 5 else "vints"
        rows.append((i, f"{'that' if i % 2 or i % 6 == 0 else 'this'} day {who} went home", i % 2))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.trained(df.drop("toxic"), df.select("doc_id", "toxic"))
    found = set(model.terms) - set(toxicity.by_kind())
    assert found == {"norbs"} and set(model.terms["norbs"]) <= {"talms", "vints"} and not found & toxicity.FUNCTION_WORDS
    assert toxicity.by_kind()["frauen"][-1] == "menschen" and "men" in toxicity.by_kind()["women"]
