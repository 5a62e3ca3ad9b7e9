"""Near-duplicate embeddings by dual traversal of a cover tree.

Vectors of a label (and length) form a space; equal vectors are one point with a count. The tree of a space has nested levels whose radii
halve: a node's points lie within its level's radius of its centre, one of them; its children's centres are its own centre and points that lie
more than half that radius from each other, and every point goes to a child. Points that none of a round's centres reaches stay together for the next
round, which draws centres from them. Nodes of over LEAF points are split by Spark, level by level, and the others in one task each, down to points.

Pairs of nodes are followed from (root, root) downwards. A pair is dropped if its centres are further apart than both measured covering radii and
the threshold's distance, and is counted whole, without looking at its points, if even its farthest points are within that distance. What is
left of pairs of blocks goes on in one task each on their own trees, in double precision: all pairs at the threshold are found. Results are a point's
number of links and the least id that it reaches, not the links.

Cases: rows with a null label, id or vector, an empty or zero vector, or one with null or non-finite components are
linked with nothing; vectors are scaled by their largest component first, so that tiny and huge ones have cosines like others; a cosine of just the threshold is a link;
repeated rows are vectors of their own; vectors of different length are not compared; an empty table gives no rows; extra columns are not carried.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import components
from .store import drop_saved, saved, whole_ids

#: Points of a block at most, about; centres that a round draws for a node at most; rounds of splitting; points that a centre must gather on average, or its
#: node's spread points are not split further. What is still larger than a block then is cut into blocks by hash, which are compared like others.
LEAF, FANOUT, ROUNDS, WORTH = 1024, 32, 24, 16
#: For rounding in distances, on the safe side.
SLACK = 1e-6
#: Points of a node that share a copy of its centres; nodes are broadcast up to so many rows.
DEAL, BROADCAST_ROWS = 256, 10_000


def _units(vectors) -> np.ndarray:
    x = np.stack(list(vectors)).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _chord(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * (x @ y.T)))


class Tree:
    """Cover tree of a block: points in depth-first order; nodes as (start, end, centre, radius, first child, children), the root first.

    Measured radii stand for the levels' radii; nodes whose points are all within `near` of each other, or
    at one place but for rounding, are not split.
    """

    def __init__(self, x: np.ndarray, near: float):
        self.order, self.nodes = [], []
        todo = [(np.arange(len(x)), 0, 2.0, 0)]
        self.nodes.append(None)
        spans: dict[int, list[int]] = {}
        while todo:
            idx, centre, level, node = todo.pop()
            d = _chord(x[idx], x[centre : centre + 1])[:, 0]
            radius = float(d.max()) if len(idx) > 1 else 0.0
            if len(idx) == 1 or radius <= SLACK or 2 * radius <= near:
                spans[node] = [len(self.order), len(self.order) + len(idx)]
                self.order.extend(idx.tolist())
                self.nodes[node] = [0, 0, centre, radius, 0, 0]
                continue
            while level / 2 >= radius:
                level /= 2
            groups, rest, c = [], idx, centre
            while len(rest):
                d = _chord(x[rest], x[c : c + 1])[:, 0]
                inside = d <= level / 2
                inside[rest == c] = True
                groups.append((rest[inside], c))
                rest = rest[~inside]
                c = int(rest[0]) if len(rest) else -1
            first = len(self.nodes)
            self.nodes[node] = [0, 0, centre, radius, first, len(groups)]
            self.nodes.extend([None] * len(groups))
            todo.extend((g, c, level / 2, first + k) for k, (g, c) in reversed(list(enumerate(groups))))
        for k in range(len(self.nodes) - 1, -1, -1):  # children stand after their parents
            _, _, centre, radius, first, n = self.nodes[k]
            if n:
                spans[k] = [spans[first][0], spans[first + n - 1][1]]
            self.nodes[k][:2] = spans[k]
        place = np.empty(len(x), np.int64)
        place[self.order] = np.arange(len(x))
        for node in self.nodes:
            node[2] = int(place[node[2]])


def _least(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of 0 .. n - 1 the least one that it is connected to by the links (a, b)."""
    low = np.arange(n)
    while True:
        m = np.minimum(low[a], low[b])
        new = low.copy()
        np.minimum.at(new, a, m)
        np.minimum.at(new, b, m)
        new = new[new]
        if (new == low).all():
            return low
        low = new


def _linked(one: bool, a, b, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links within a pair of blocks (ids, counts, vectors, nodes), or within one: ids with links there, their number, the least id reached."""
    (ia, ca, xa, na), (ib, cb, xb, nb) = a, b
    reach = math.sqrt(max(0.0, 2 - 2 * threshold))
    sum_a, sum_b = np.concatenate([[0], np.cumsum(ca)]), np.concatenate([[0], np.cumsum(cb)])
    more_a, more_b = np.zeros(len(ia) + 1, np.int64), np.zeros(len(ib) + 1, np.int64)  # differences of the number of links
    own_a, from_, to = np.zeros(len(ia), np.int64), [], []
    shift = 0 if one else len(ia)
    below = lambda nodes, k: np.arange(nodes[k, 4], nodes[k, 4] + nodes[k, 5], dtype=np.int64) if nodes[k, 5] else np.array([k])

    def count(pa, pb, qa, qb):
        """All points of the one range are linked to all of the other."""
        more_a[pa] += sum_b[qb] - sum_b[qa]
        more_a[pb] -= sum_b[qb] - sum_b[qa]
        if one and (pa, pb) == (qa, qb):
            own_a[pa:pb] += ca[pa:pb]
            from_.append(np.full(pb - pa, pa)), to.append(np.arange(pa, pb))
            return
        other = more_a if one else more_b
        other[qa] += sum_a[pb] - sum_a[pa]
        other[qb] -= sum_a[pb] - sum_a[pa]
        from_.append(np.full(qb - qa, pa)), to.append(np.arange(qa, qb) + shift)
        from_.append(np.arange(pa, pb)), to.append(np.full(pb - pa, qa + shift))

    todo = [(0, 0)]
    ra, rb = (nodes[:, 3] for nodes in (na, nb))
    sa, sb = (nodes[:, [0, 1, 2, 4, 5]].astype(np.int64) for nodes in (na, nb))
    na, nb = (np.insert(s, 3, 0, axis=1) for s in (sa, sb))
    while todo:
        p, q = todo.pop()
        same = one and p == q
        if not na[p, 5] and not nb[q, 5]:  # two sets of points: their products
            (pa, pb), (qa, qb) = na[p, :2], nb[q, :2]
            hit = xa[pa:pb] @ xb[qa:qb].T >= threshold
            if same:
                hit = np.triu(hit, 1)
            for i, j in zip(*np.nonzero(hit), strict=True):
                count(pa + i, pa + i + 1, qa + j, qa + j + 1)
            continue
        kids, others = below(na, p), below(nb, q)
        d = _chord(xa[na[kids, 2]], xb[nb[others, 2]])
        radii = ra[kids][:, None] + rb[others][None, :]
        near, whole = d <= radii + reach + SLACK, d + radii <= reach - SLACK
        if same:
            near, whole = np.triu(near), np.triu(whole)
        for i, j in zip(*np.nonzero(near), strict=True):
            u, v = int(kids[i]), int(others[j])
            if whole[i, j] or (one and u == v and 2 * ra[u] <= reach - SLACK):
                count(int(na[u, 0]), int(na[u, 1]), int(nb[v, 0]), int(nb[v, 1]))
            else:
                todo.append((u, v))
    links = np.cumsum(more_a)[:-1] - own_a
    ids = ia
    if not one:
        links, ids = np.concatenate([links, np.cumsum(more_b)[:-1]]), np.concatenate([ia, ib])
    by_id = np.argsort(ids, kind="stable")
    rank = np.argsort(by_id)
    none = np.zeros(0, np.int64)
    low = _least(len(ids), rank[np.concatenate([none, *from_])], rank[np.concatenate([none, *to])])
    some = links > 0
    return ids[some], links[some], ids[by_id[low[rank]]][some]


def _broadcast(df: DataFrame) -> DataFrame:
    """Broadcast if the size allows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _split(members: DataFrame, nodes: DataFrame, total: int) -> tuple[DataFrame, DataFrame]:
    """Children of nodes (node, points, level, centre or null) and where their members (id, points, vec, node) go; both written."""
    h = F.pmod(F.xxhash64(F.lit(5), "id", "node"), F.lit(1 << 40)) / float(1 << 40)
    # About 4 * FANOUT points of a node by a threshold on the hash: the sample is bounded whatever the node's size.
    sample = members.join(_broadcast(nodes.select("node", F.col("points").alias("size"))), "node").withColumn("h", h).filter(F.col("h") < 4 * FANOUT / F.col("size"))
    sample = sample.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("h", "vec")))["vec"].alias("drawn"))

    def centres(frames):
        import pandas as pd

        for f in frames:
            out = []
            for drawn, centre, level in zip(f["drawn"], f["centre"], f["level"], strict=True):
                x = _units(drawn) if drawn is not None and len(drawn) else np.zeros((0, len(centre) if centre is not None else 1))
                net = [np.asarray(centre, float)] if centre is not None else []
                for v in x:
                    if len(net) < FANOUT and (not net or _chord(np.stack(net), v[None, :]).min() > level / 2):
                        net.append(v)
                out.append([v.tolist() for v in net])
            yield pd.DataFrame({"node": f["node"], "points": f["points"], "level": f["level"], "rest": f["rest"], "centres": pd.Series(out, dtype=object)})

    drawn = nodes.select("node", "points", "level", "rest", F.when(~F.col("rest"), F.col("centre")).alias("centre")).join(sample, "node", "left")
    drawn = saved(drawn.mapInPandas(centres, "node string, points long, level double, rest boolean, centres array<array<double>>"), "cover-centres")
    # Heavy nodes, at most total / heavy of them, are dealt by hash to copies of their centres.
    heavy = max(DEAL, total // BROADCAST_ROWS)
    parts = F.when(F.col("points") > heavy, F.ceil(F.col("points") / DEAL)).otherwise(1).cast("int")
    dealt = members.join(F.broadcast(nodes.filter(F.col("points") > heavy).select("node", parts.alias("parts"))), "node", "left")
    dealt = dealt.withColumn("deal", F.pmod(F.xxhash64("id"), F.coalesce("parts", F.lit(1)))).drop("parts")
    copies = drawn.withColumn("deal", F.explode(F.sequence(F.lit(0), parts - 1))).select("node", "deal", "level", "centres")
    rows = dealt.join(copies, ["node", "deal"])

    def assign(frames):
        import pandas as pd

        for frame in frames:
            for node, g in frame.groupby("node", sort=False):
                x, level = _units(g["vec"]), g["level"].iat[0]
                d = _chord(x, np.stack([np.asarray(c, float) for c in g["centres"].iat[0]]))
                k = d.argmin(1)
                far = d[np.arange(len(k)), k]
                yield pd.DataFrame({"id": g["id"], "points": g["points"], "vec": g["vec"], "node": [f"{node}/{i}" if f <= level / 2 else f"{node}/r" for i, f in zip(k, far, strict=True)], "far": np.where(far <= level / 2, far, level)})

    down = saved(rows.select("id", "points", "vec", "node", "level", "centres").mapInPandas(assign, "id long, points long, vec array<double>, node string, far double"), "cover-level")
    made = down.groupBy("node").agg(F.count(F.lit(1)).alias("points"), F.sum("points").alias("weight"), F.min("id").alias("low"), F.max("far").alias("far"))
    halved = drawn.select(F.col("node").alias("parent"), F.posexplode("centres").alias("k", "centre"), (F.col("level") / 2).alias("level"))
    halved = halved.select("parent", F.concat("parent", F.lit("/"), F.col("k").cast("string")).alias("node"), "level", F.lit(False).alias("rest"), "centre")
    left = nodes.select(F.col("node").alias("parent"), F.concat("node", F.lit("/r")).alias("node"), "level", F.lit(True).alias("rest"), "centre")
    # Points that no centre reached keep the parent's centre and radius.
    children = halved.unionByName(left).join(made, "node").withColumn("radius", F.when(F.col("rest"), F.col("level")).otherwise(F.col("far"))).drop("far")
    children = saved(children, "cover-made")
    gathered = children.filter("NOT rest").groupBy("parent").agg(F.avg("points").alias("gathered"))
    spread = F.col("rest") & (F.coalesce("gathered", F.lit(0.0)) < WORTH)
    children = children.join(gathered, "parent", "left").withColumn("done", (F.col("points") <= LEAF) | spread).drop("gathered")
    children = saved(children, "cover-nodes")
    drop_saved(drawn)
    return down.select("id", "points", "vec", "node"), children


def _node_pairs(levels: list[DataFrame], reach: float) -> tuple[list[DataFrame], list[DataFrame]]:
    """Pairs (a, b), a <= b, of nodes by level: those left of the dual traversal when one or both are blocks, and those that are linked whole."""
    pairs, ended, whole = levels[0].select(F.col("node").alias("a"), F.col("node").alias("b")), [], []
    for k, nodes in enumerate(levels):
        side = lambda x: nodes.select(F.col("node").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("radius", "centre", "done")])  # noqa: B023, E731
        both = pairs.join(side("a"), "a").join(side("b"), "b")
        apart = F.sqrt(F.aggregate(F.zip_with("centre_a", "centre_b", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
        d = F.when(F.col("a") == F.col("b"), 0.0).otherwise(F.coalesce(apart, F.lit(0.0)))
        radii = F.col("radius_a") + F.col("radius_b")
        known = F.col("centre_a").isNotNull() & F.col("centre_b").isNotNull()
        both = both.withColumns({"whole": known & (d + radii <= reach - SLACK), "near": ~known | (d <= radii + reach + SLACK)})
        both = saved(both.filter("near").select("a", "b", "whole", "done_a", "done_b"), "cover-pairs")
        whole.append(both.filter("whole").select("a", "b"))
        open_ = both.filter("NOT whole")
        ended.append(open_.filter("done_a AND done_b").select("a", "b"))
        if k + 1 < len(levels):
            # A block is its own child on the next level.
            down = lambda x: levels[k + 1].select(F.col("parent").alias(x), F.col("node").alias(f"n_{x}"))  # noqa: B023, E731
            pairs = open_.filter("NOT (done_a AND done_b)").join(down("a"), "a").join(down("b"), "b")
            pairs = pairs.filter((F.col("a") != F.col("b")) | (F.col("n_a") <= F.col("n_b"))).select(F.col("n_a").alias("a"), F.col("n_b").alias("b"))
    return ended, whole


def _blocks(members: DataFrame, leaves: DataFrame, near: float) -> DataFrame:
    """(node, part, ids, counts, vecs, tree): blocks of about LEAF points with their trees, points in the tree's order. Written."""
    parts = leaves.select("node", F.ceil(F.col("points") / LEAF).cast("int").alias("parts"))
    rows = members.join(_broadcast(parts.filter("parts > 1")), "node", "left").withColumn("part", F.pmod(F.xxhash64("id"), F.coalesce("parts", F.lit(1))).cast("int"))
    packed = rows.groupBy("node", "part").agg(F.array_sort(F.collect_list(F.struct("id", "points", "vec"))).alias("p"))
    packed = packed.select("node", "part", F.col("p.id").alias("ids"), F.col("p.points").alias("counts"), F.col("p.vec").alias("vecs"))

    def build(frames):
        import pandas as pd

        for f in frames:
            for r in f.itertuples(index=False):
                x = _units(r.vecs)
                t = Tree(x, near)
                yield pd.DataFrame([(r.node, r.part, np.asarray(r.ids)[t.order], np.asarray(r.counts)[t.order], list(x[t.order]), [[float(v) for v in n] for n in t.nodes])], columns=["node", "part", "ids", "counts", "vecs", "tree"])

    return saved(packed.mapInPandas(build, "node string, part int, ids array<long>, counts array<long>, vecs array<array<double>>, tree array<array<double>>"), "cover-blocks")


def _compared(pairs: DataFrame, blocks: DataFrame, leaves: DataFrame, threshold: float) -> DataFrame:
    """(id, links, least): a point's links within each pair of blocks, and the least id that it reaches there."""
    parts = leaves.select("node", F.ceil(F.col("points") / LEAF).cast("int").alias("parts"))
    each = lambda x: F.explode(F.sequence(F.lit(0), F.col(f"parts_{x}") - 1))
    two = pairs.join(parts.select(F.col("node").alias("a"), F.col("parts").alias("parts_a")), "a").join(parts.select(F.col("node").alias("b"), F.col("parts").alias("parts_b")), "b")
    two = two.withColumn("i", each("a")).withColumn("j", each("b")).filter((F.col("a") != F.col("b")) | (F.col("i") <= F.col("j")))
    two = saved(two.select("a", "b", "i", "j"), "cover-block-pairs")
    side = lambda x, i: blocks.select(F.col("node").alias(x), F.col("part").alias(i), *[F.col(c).alias(f"{c}_{x}") for c in ("ids", "counts", "vecs", "tree")])
    rows = two.join(side("a", "i"), ["a", "i"]).join(side("b", "j"), ["b", "j"])

    def compare(frames):
        import pandas as pd

        for frame in frames:
            for r in frame.itertuples(index=False):
                sides = [(np.asarray(i, np.int64), np.asarray(c, np.int64), np.stack(list(v)), np.stack(list(t))) for i, c, v, t in ((r.ids_a, r.counts_a, r.vecs_a, r.tree_a), (r.ids_b, r.counts_b, r.vecs_b, r.tree_b))]
                ids, links, least = _linked(r.a == r.b and r.i == r.j, *sides, threshold)
                if len(ids):
                    yield pd.DataFrame({"id": ids, "links": links, "least": least})

    return rows.mapInPandas(compare, "id long, links long, least long")


def _whole(pairs: DataFrame, nodes: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links of pairs of nodes that are linked whole: (id, links, least) of their points, and links (a, b) between the nodes' least points."""
    about = lambda x: nodes.select(F.col("node").alias(x), F.col("weight").alias(f"weight_{x}"), F.col("low").alias(f"low_{x}"))
    both = saved(pairs.join(about("a"), "a").join(about("b"), "b"), "cover-whole")
    one = lambda a, b: both.select(F.col(a).alias("node"), F.col(f"weight_{b}").alias("links"), F.col(f"low_{b}").alias("least"), (F.col("a") == F.col("b")).cast("int").alias("self"))
    by_node = one("a", "b").unionByName(one("b", "a").filter("self = 0")).groupBy("node").agg(F.sum("links").alias("links"), F.min("least").alias("least"), F.max("self").alias("self"))
    # A point's nodes are the beginnings of its block's name.
    names = members.select("node").distinct()
    steps = F.split("node", "/")
    chain = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, 1, n), "/"))
    above = names.select(F.col("node").alias("block"), F.explode(chain).alias("node")).join(by_node, "node")
    sums = saved(above.groupBy(F.col("block").alias("node")).agg(F.sum("links").alias("links"), F.min("least").alias("least"), F.sum("self").alias("self")), "cover-sums")
    rows = members.join(_broadcast(sums), "node").select("id", (F.col("links") - F.col("self") * F.col("points")).alias("links"), F.least("least", "id").alias("least"))
    return rows, both.select(F.col("low_a").alias("a"), F.col("low_b").alias("b"))


def _fit(id_: Column, label: Column, v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return F.coalesce(id_.isNotNull() & label.isNotNull() & (F.size(v) > 0) & finite, F.lit(False))


def near_vectors(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept): vectors of equal label linked at a cosine of threshold or more."""
    whole_ids(vectors, id_col)
    v = F.col(vector_col).cast("array<double>")
    # Labels are put in hexadecimal, so that names of nodes have no other slashes.
    space = F.concat_ws(":", F.hex(F.col(label_col).cast("string")), F.size(v).cast("string"))
    marked = vectors.select(F.col(id_col).alias("vec_id"), _fit(F.col(id_col), F.col(label_col), v).alias("fit"), space.alias("space"), F.xxhash64(F.lit(1), v).alias("h1"), F.xxhash64(F.lit(2), v).alias("h2"), v.alias("vec"))
    same, reach = ["space", "h1", "h2"], math.sqrt(max(0.0, 2 - 2 * threshold))  # cosine c is a chord of sqrt(2 - 2c)
    points = saved(marked.filter("fit").groupBy(*same).agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("points"), F.first("vec").alias("vec")), "cover-points")
    total = points.count()
    members = points.select("id", "points", "vec", F.col("space").alias("node"))
    roots = members.groupBy("node").agg(F.count(F.lit(1)).alias("points"), F.sum("points").alias("weight"), F.min("id").alias("low"))
    done = F.col("points") <= LEAF
    nodes = saved(roots.select("node", F.col("node").alias("parent"), "points", "weight", "low", F.lit(2.0).alias("level"), F.lit(2.0).alias("radius"), F.lit(False).alias("rest"), F.lit(None).cast("array<double>").alias("centre"), done.alias("done")), "cover-roots")
    levels, settled = [nodes], []
    for k in range(ROUNDS):
        large = saved(nodes.filter("NOT done"), "cover-large")
        if not large.limit(1).count():
            break
        settled.append(members.join(_broadcast(nodes.filter("done").select("node")), "node", "left_semi"))
        members, made = _split(members.join(_broadcast(large.select("node")), "node", "left_semi"), large, total)
        blocks_stay = nodes.filter("done").withColumn("parent", F.col("node"))
        nodes = saved((made if k + 1 < ROUNDS else made.withColumn("done", F.lit(True))).unionByName(blocks_stay), "cover-nodes")
        levels.append(nodes)
    for rows in settled:
        members = members.unionByName(rows)
    ended, whole = _node_pairs(levels, reach)
    union = lambda frames: frames[0] if len(frames) == 1 else union([frames[0].unionByName(frames[1]), *frames[2:]])
    blocks = _blocks(members, levels[-1], reach - SLACK)
    named = union([x.select("node", "weight", "low") for x in levels]).dropDuplicates(["node"])
    by_whole, more = _whole(union(whole), named, members.select("id", "points", "node"))
    found = saved(_compared(union(ended), blocks, levels[-1], threshold).unionByName(by_whole), "cover-links")
    drop_saved(blocks)
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    top = components(found.select(F.col("id").alias("a"), F.col("least").alias("b")).unionByName(more))
    classes = points.select(*same, "id", "points").join(links, "id", "left").join(top, "id", "left")
    classes = classes.select(*same, (F.coalesce("links", F.lit(0)) + F.col("points") - 1).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    some = marked.filter("fit").select("vec_id", *same).join(classes, same).select("vec_id", "n_links", "component_id")
    rest = marked.filter("NOT fit").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return some.unionByName(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
