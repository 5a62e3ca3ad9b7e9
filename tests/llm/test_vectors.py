from __future__ import annotations

import numpy as np
import pytest

from clademill.llm import covertree


def brute(rows, threshold=0.98):
    ok = [x for x in rows if x[2] is not None and x[1] and all(v is not None and np.isfinite(v) for v in x[1]) and any(x[1])]
    of, links = {x[0]: x[0] for x in rows}, dict.fromkeys((x[0] for x in rows), 0)
    for label in {x[2] for x in ok}:
        for size in {len(x[1]) for x in ok if x[2] == label}:
            own = [x for x in ok if x[2] == label and len(x[1]) == size]
            v = np.array([x[1] for x in own], float)
            v /= np.abs(v).max(1, keepdims=True)
            v /= np.linalg.norm(v, axis=1, keepdims=True)
            hit = v @ v.T >= threshold
            np.fill_diagonal(hit, False)
            low = np.array([x[0] for x in own])
            while True:
                new = np.minimum(low, np.where(hit, low[None, :], np.iinfo(np.int64).max).min(1))
                if (new == low).all():
                    break
                low = new
            for x, n, c in zip(own, hit.sum(1), low, strict=True):
                links[x[0]], of[x[0]] = int(n), int(c)
    return {i: (links[i], of[i], of[i] == i) for i in of}


def result(df):
    return {x.vec_id: (x.n_links, x.component_id, x.kept) for x in covertree.near_vectors(df).collect()}


def _odd_rows():
    r = np.random.default_rng(1)
    rows = []
    for label in (1, 2, None):
        centre = r.normal(size=8)
        for k in range(90):
            v = (centre + 0.2 * r.normal(size=8)) if k < 45 else r.normal(size=8)
            rows.append((len(rows), [float(np.float32(x)) for x in v], label))
    rows += [(500 + k, rows[0][1], 1) for k in range(60)] + [(600, None, 1), (601, [0.0] * 8, 1), (602, [float("nan")] + [1.0] * 7, 1), (603, [None] + [1.0] * 7, 1), (604, [], 1), (605, [1.0, 2.0], 1)]
    return rows


@pytest.mark.parametrize("leaf", [1024, 20])
def test_against_all_pairs(spark, monkeypatch, leaf):
    monkeypatch.setattr(covertree, "LEAF", leaf)
    rows = _odd_rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumnRenamed("extra", "points")
    got = result(df)
    assert got == brute(rows) and max(n for n, *_ in got.values()) > 60
    assert covertree.near_vectors(df.limit(0)).count() == 0


def test_labels_of_several_blocks(spark):
    """A label of over three blocks: clusters of all widths, a dense one that is linked whole, spread points; and a second label."""
    r = np.random.default_rng(2)
    rows = []
    for width, n in ((0.005, 1300), (0.05, 700), (0.12, 700), (1.0, 900)):
        centre = r.normal(size=12)
        centre /= np.linalg.norm(centre)
        rows += [(len(rows) + k, (centre + width * r.normal(size=12)).tolist(), "a/b") for k in range(n)]
    rows += [(len(rows) + k, r.normal(size=12).tolist(), "c") for k in range(50)]
    order = r.permutation(len(rows))
    rows = [(int(i), v, label) for i, (_, v, label) in zip(order, rows, strict=True)]
    assert result(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").repartition(4)) == brute(rows)


def test_doubles_and_ties(spark):
    """Tiny and huge doubles have cosines like others; a cosine of the threshold is a link, just below it isn't."""
    c = 0.98
    rows = [(1, [1e-30, 0.0], 1), (2, [1e-60, 0.0], 1), (3, [1e300, 1e290], 1), (4, [5e-324, 0.0], 1), (5, [0.0, 1.0], 1)]
    rows += [(10, [1.0, 0.0, 0.0], 2), (11, [0.98, float(np.sqrt(1 - c * c)), 0.0], 2), (12, [0.0, 0.0, 1.0], 2), (13, [0.0, 0.2002, 0.97975], 2)]
    assert result(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")) == brute(rows)


def test_tree_keeps_its_laws():
    """Nested centres, covering within the radius, children's centres apart, every point in one child."""
    r = np.random.default_rng(5)
    x = np.concatenate([r.normal(size=(150, 6)), np.ones(6) + 0.05 * r.normal(size=(150, 6))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    t = covertree.Tree(x, 0.1)
    y = x[t.order]
    assert sorted(t.order) == list(range(300))
    for start, end, centre, radius, first, n in t.nodes:
        assert start <= centre < end and covertree._chord(y[start:end], y[centre : centre + 1]).max() <= radius + 1e-7
        if n:
            kids = t.nodes[first : first + n]
            assert kids[0][0] == start and kids[-1][1] == end and all(a[1] == b[0] for a, b in zip(kids, kids[1:], strict=False))
            assert kids[0][2] == centre  # nested
            level = 2.0
            while level / 2 >= radius:
                level /= 2
            d = covertree._chord(y[[k[2] for k in kids]], y[[k[2] for k in kids]])
            assert n == 1 or d[~np.eye(n, dtype=bool)].min() > level / 2 - 1e-7
            assert all(k[3] <= level / 2 + 1e-7 for k in kids)
        else:
            assert end - start == 1 or 2 * radius <= 0.1
