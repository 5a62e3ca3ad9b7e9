from __future__ import annotations

import random
import re

import numpy as np
import pytest

from clademill.llm import graph, minhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _sets(rows, size):
    out = {}
    for i, t in rows:
        w = WORD.findall((t or "").lower())
        out[i] = frozenset(zip(*[w[k:] for k in range(size)])) if len(w) >= size else frozenset([tuple(w)] if w else [])
    return out


def brute(rows, size, percent):
    sets, of = _sets(rows, size), {i: i for i, _ in rows}
    ids = sorted(of)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            n = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n) and of[a] != of[b]:
                low, high = sorted((of[a], of[b]))
                of = {k: low if v == high else v for k, v in of.items()}
    return {i: (len(sets[i]), of[i], of[i] == i) for i in ids}


def _corpus():
    """A family of copies whose similarities lie on both sides of the threshold, exact copies, a chain, odd texts."""
    r = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    text = lambda n: [r.choice(words) for _ in range(n)]
    base, rows = text(150), []
    for _ in range(120):
        t = list(base)
        for _ in range(r.randrange(0, 7)):
            t[r.randrange(len(t))] = r.choice(words)
        rows.append(" ".join(t))
    chain = text(80)
    for k in range(12):
        rows.append(" ".join(chain[k * 2 :] + text(0) + [f"x{j}" for j in range(k * 2)]))
    rows += ["same text of some words"] * 30 + ["a b", "a b", "A B", "", " \n", None, "one", "one two three", " ".join(text(30_000))]
    rows += [" ".join(text(40)) for _ in range(60)]
    order = list(range(len(rows)))
    r.shuffle(order)
    return [(i, rows[k]) for i, k in enumerate(order)]


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_against_all_pairs(spark, size, percent, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 16)  # several blocks a family
    rows = _corpus()
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), size, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute(rows, size, percent)


def test_cases(spark):
    rows = [(1, "a b c d e f", 7), (1, "a b c d e f", 8), (None, "a b c d e f", 9), (2, None, 1), (3, "", 1), (4, "A b C d e f", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n long").withColumnsRenamed({"n": "key"})
    got = sorted((r.doc_id or 0, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect())
    assert got == [(0, None, True), (1, 1, True), (1, 1, True), (2, 2, True), (3, 3, True), (4, 1, False)]
    kept = minhash.deduplicated(df)
    assert kept.columns == df.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3]
    clash = df.withColumnsRenamed({"key": "th"}).withColumns({"id": df.doc_id, "row": df.doc_id, "a.b": df.doc_id})
    assert minhash.deduplicated(clash).columns == clash.columns and minhash.deduplicated(clash).count() == 4
    assert minhash.near_duplicates(df.limit(0)).count() == 0 and minhash.deduplicated(df.limit(0)).count() == 0


def test_sketch_fills_and_estimates():
    with np.errstate(over="ignore"):
        r = np.random.default_rng(3)
        x = r.integers(0, 2**63, 3000, dtype=np.uint64)
        for n in (1, 2, 50, 3000):
            assert minhash.sketch(x[:n]).max() < np.iinfo(np.uint64).max
        a, b = minhash.sketch(x[:2000]), minhash.sketch(x[500:2500])
        assert abs((a == b).mean() - 0.6) < 0.15


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (90, 90)], "a long, b long")
    got = {r.id: r.component for r in graph.components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 90, 90: 90}
    assert graph.components(links.limit(0)).count() == 0


def test_repeated_ids_with_unlike_texts(spark):
    """Rows are judged each by its text: six unlike texts of one id all stay, links of each of them are found, linked ones of one id leave one row."""
    r = random.Random(8)
    text = lambda n: [r.choice("abcdefghijklmnopqrstuvwxyz") + str(r.randrange(500)) for _ in range(n)]
    bodies = [text(60) for _ in range(6)]
    rows = [(7, " ".join(b), k) for k, b in enumerate(bodies)]
    rows += [(20 + k, " ".join([*b, "end"]), 100 + k) for k, b in enumerate(bodies)]  # a near copy of each
    twins = text(80)
    rows += [(3, " ".join(twins), 200), (3, " ".join([*twins, "more"]), 201), (3, " ".join(twins), 202), (40, " ".join(["x", *twins]), 203)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n long").repartition(4)
    got = minhash.near_duplicates(df).collect()
    assert sorted((x.doc_id, x.component_id) for x in got) == sorted([(7, 7)] * 6 + [(20 + k, 7) for k in range(6)] + [(3, 3)] * 3 + [(40, 3)])
    kept = minhash.deduplicated(df).collect()
    assert sorted(x.n for x in kept if x.doc_id == 7) == list(range(6)) and sum(x.doc_id == 3 for x in kept) == 1 and len(kept) == 7


def test_margin():
    assert abs(minhash.margin(80) - 0.1195) < 1e-3 and abs(minhash.margin(85) - 0.1067) < 1e-3
