"""SentencePiece encoding by sampling without replacement, and decoding.

A piece's weight falls with its rank (Zipf's law; a BPE model's scores are ranks), a segmentation's probability is proportional to the product of its
pieces' weights. Pieces never cross the start of a run of blanks, so a text is a row of units (blanks and what follows them) with a
lattice each. Segmentations of the whole text are drawn by Gumbel top-k: the most likely region of all segmentations is
split first, by its perturbed log-mass. Regions are "these units as in a sample already drawn, the next one none of those drawn there, the
rest free"; their masses are sums over the unit lattices, never differences, so a region is given up only if it is empty. The first k samples
popped from the queue are the k largest perturbed log-probabilities, all distinct. With kappa, the next perturbed value, a sample's inclusion
probability is 1 - exp(-exp(log_prob - kappa)). All random numbers are hashes of the row's key and places in the text.

Cases: a null text has no samples; an empty text has one, empty; a text with fewer segmentations than k has them all; characters that are not pieces
become their UTF-8 bytes; units of over UNIT characters are parted where no piece crosses, which changes no segmentation; very long texts are worked on
whole, one at a time; rows that repeat a key and text repeat its samples; a null key is a key like any other; an empty table gives no rows; extra
columns are not carried. Texts are not normalised: decoding gives the text back.
"""

from __future__ import annotations

import heapq
import math
import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import saved, small_batches, whole_ids

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Longer units are parted where no piece crosses; bytes of texts that are worked on together (a longer text by itself).
UNIT, CHUNK = 48, 1_000_000
_BLANK, _SPACE = 0x2581, 0x20

_U = np.uint64
_GOLDEN, _M1, _M2 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _M1
    x = (x ^ (x >> _U(27))) * _M2
    return x ^ (x >> _U(31))


def _uniform(x: np.ndarray) -> np.ndarray:
    """In (0, 1), from 64-bit keys."""
    return ((_mixed(x + _GOLDEN) >> _U(11)).astype(np.float64) + 0.5) / float(1 << 53)


class Pieces:
    """Pieces of a model: a trie in a hash table, log-weights, and texts for decoding."""

    def __init__(self, proto: bytes):
        import pyarrow as pa
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        n = sp.get_piece_size()
        self.text = [sp.id_to_piece(i) for i in range(n)]
        self.byte_ids = np.zeros(256, np.int32)
        self.byte_of = np.full(n, -1, np.int32)
        ranks, usable = np.zeros(n), np.zeros(n, bool)
        for i, p in enumerate(self.text):
            if sp.is_byte(i):
                b = int(p[3:5], 16)
                self.byte_ids[b], self.byte_of[i] = i, b
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                inner = p.lstrip("▁")
                usable[i], ranks[i] = "▁" not in inner, -sp.get_score(i)
        #: Text of a piece by itself, then the same without its first character; bytes of 128 and more have none.
        plain = [chr(b) if 0 <= b < 128 else p.replace("▁", " ") for p, b in zip(self.text, self.byte_of.tolist(), strict=True)]
        self.plain = pa.array([*plain, *(p[1:] for p in plain)], pa.string())
        weight = np.where(usable, 1 / np.maximum(ranks - ranks[usable].min() + 2, 1), 0)
        self.weight = weight / weight.sum()
        self.fallback = float(self.weight[usable].min())
        self.logw = np.log(np.where(self.weight > 0, self.weight, self.fallback))
        letters = sorted({c for i in np.flatnonzero(usable) for c in self.text[i]})
        codes = {c: k + 1 for k, c in enumerate(letters)}
        #: Code of a character; 0 is in no piece. A blank stands for its mark, and a mark in the text is no piece.
        self.code = np.zeros(0x110000, np.int32)
        self.code[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.code[_SPACE], self.code[_BLANK] = codes["▁"], 0
        self.width = len(letters) + 1
        edges: dict[int, int] = {}
        ends = {}
        for i in np.flatnonzero(usable):
            node = 0
            for c in self.text[i]:
                node = edges.setdefault(node * self.width + codes[c], len(edges) + 1)
            ends[node] = int(i)
        self.end = np.full(len(edges) + 1, -1, np.int32)
        self.end[list(ends)] = list(ends.values())
        bits = max(8, (len(edges) * 8).bit_length())
        self.shift, self.mask = _U(64 - bits), (1 << bits) - 1
        self.keys, self.kids = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
        slots = self._slot(np.array(list(edges), np.int64)).tolist()
        for slot, (key, kid) in zip(slots, edges.items(), strict=True):
            while self.keys[slot] != -1:
                slot = (slot + 1) & self.mask
            self.keys[slot], self.kids[slot] = key, kid
        self.top = self.step(np.zeros(self.width, np.int32), np.arange(self.width))

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(_U) * _GOLDEN) >> self.shift).astype(np.int64)

    def step(self, node: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Trie nodes one character on; 0 for none."""
        key = node.astype(np.int64) * self.width + code
        slot = self._slot(key)
        there = self.keys[slot]
        out = np.where(there == key, self.kids[slot], 0)
        open_ = np.flatnonzero((there != key) & (there != -1))
        while len(open_):
            slot[open_] = s = (slot[open_] + 1) & self.mask
            there = self.keys[s]
            hit = there == key[open_]
            out[open_[hit]] = self.kids[s[hit]]
            open_ = open_[~hit & (there != -1)]
        return out

    def decode(self, flat: np.ndarray, ends: np.ndarray):
        """Texts of lists of ids, as an Arrow array."""
        import pyarrow as pa
        import pyarrow.compute as pc

        starts, raw = ends[:-1], self.byte_of[flat] >= 128
        at = flat.astype(np.int64)
        at[starts[starts < ends[1:]]] += len(self.text)  # without the blank put first
        words = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), self.plain.take(pa.array(at)))
        out = pc.binary_join(words, "")
        if raw.any():
            owner = np.unique(np.searchsorted(ends, np.flatnonzero(raw), side="right") - 1)
            mask = np.zeros(len(starts), bool)
            mask[owner] = True
            out = pc.replace_with_mask(out, pa.array(mask), pa.array([self._decode(flat[ends[k] : ends[k + 1]]) for k in owner], pa.string()))
        return out

    def _decode(self, ids: np.ndarray) -> str:
        parts, raw = [], bytearray()
        for i, b in zip(ids.tolist(), self.byte_of[ids].tolist(), strict=True):
            if b >= 0:
                raw.append(b)
                continue
            if raw:
                parts.append(raw.decode("utf-8", "replace"))
                raw = bytearray()
            parts.append(self.text[i].replace("▁", " "))
        parts.append(raw.decode("utf-8", "replace"))
        return "".join(parts)[1:]


@lru_cache(2)
def pieces(proto: bytes) -> Pieces:
    return Pieces(proto)


class Lattice:
    """Lattices of distinct units. Places of all units stand by their distance from the unit's end, so that each distance is a slice; edges by place, longest first."""

    def __init__(self, model: Pieces, chars: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        count = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left").astype(np.int32)  # units with so many characters after a place
        offset = np.concatenate([[0], np.cumsum(count)])
        n = int(offset[-1])
        after = np.repeat(np.arange(len(count), dtype=np.int32), count)
        unit = np.arange(n, dtype=np.int32) - offset[after].astype(np.int32)
        raw = chars[(starts + lengths - 1)[unit] - after]
        code = model.code[raw]
        self.start = np.empty(len(order), np.int32)
        self.start[order] = offset[lengths - 1] + np.arange(len(order))
        self.end = n
        at, node, hits, degree, single = np.arange(n, dtype=np.int32), model.top[code], [], np.zeros(n, np.int32), np.zeros(n, bool)
        cur = at
        while True:
            on = np.flatnonzero(node)
            at, cur, after, node = at[on], cur[on], after[on], node[on]
            beyond = np.where(after > 0, cur - count[np.maximum(after, 1) - 1], n).astype(np.int32)
            piece = model.end[node]
            hit = np.flatnonzero(piece >= 0)
            hits.append((at[hit], piece[hit], beyond[hit]))
            degree[at[hit]] += 1
            if len(hits) == 1:
                single[at[hit]] = True
            more = np.flatnonzero(after)
            if not len(more):
                break
            at, cur, after = at[more], beyond[more], after[more] - 1
            node = model.step(node[more], code[cur])
        lost = np.flatnonzero(~single).astype(np.int32)  # not a piece: its bytes, given as -1 - code point
        if len(lost):
            tail = np.searchsorted(offset, lost, side="right") - 1
            known = raw[lost] < 128
            hits.append((lost, np.where(known, model.byte_ids[np.where(known, raw[lost], 0)], -1 - raw[lost].astype(np.int64)).astype(np.int32), np.where(tail > 0, lost - count[np.maximum(tail, 1) - 1], n).astype(np.int32)))
            hits = [hits[-1], *hits[:-1]]
            degree[lost] += 1
        self.degree = degree
        self.first = np.concatenate([[0], np.cumsum(degree)])
        self.ids, self.next = np.empty(self.first[-1], np.int32), np.empty(self.first[-1], np.int32)
        put = self.first[1:].copy()
        for at, piece, beyond in hits:
            put[at] -= 1
            self.ids[put[at]], self.next[put[at]] = piece, beyond
        del hits
        self.logw = np.where(self.ids >= 0, model.logw[np.maximum(self.ids, 0)], np.log(model.fallback))
        # Backward sums in logs, as those of long units lie below any double.
        self.beta, self.p = np.zeros(n + 1), np.empty(len(self.ids))
        for k in range(len(count)):
            a, b = offset[k], offset[k + 1]
            i, j = self.first[a], self.first[b]
            m, cut, times = self.logw[i:j] + self.beta[self.next[i:j]], self.first[a:b] - i, degree[a:b]
            most = np.maximum.reduceat(m, cut)
            x = np.exp(m - np.repeat(most, times))
            total = np.add.reduceat(x, cut)
            self.beta[a:b] = most + np.log(total)
            self.p[i:j] = x / np.repeat(total, times)
        #: Mass of a place's edges beside one of over 1/2.
        self.others = np.add.reduceat(np.where(self.p > 0.5, 0, self.p), self.first[:-1])

    def draw(self, pos: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A segmentation from each place on by its 64-bit key: edges in order, number of edges, log-probability and log-mass of all others."""
        m = len(pos)
        counts, logp, before, other, whole = np.zeros(m, np.int32), -self.beta[pos], np.ones(m), np.zeros(m), pos
        choice = np.zeros(m, bool)
        who, steps, k = np.arange(m), [], 0
        while len(who):
            u = _uniform(keys + _U(k) * _M1)
            e, more_edges = self.first[pos], self.degree[pos] - 1
            choice[who[more_edges > 0]] = True
            p = self.p[e]
            more = np.flatnonzero((u > p) & (more_edges > 0))
            while len(more):
                u[more] -= p[more]
                e[more] += 1
                more_edges[more] -= 1
                p[more] = self.p[e[more]]
                more = more[(u[more] > p[more]) & (more_edges[more] > 0)]
            steps.append((who, e))
            q = before[who]
            other[who] += q * np.where(p > 0.5, self.others[pos], 1 - p)
            before[who] = q * p
            logp[who] += self.logw[e]
            counts[who] += 1
            pos = self.next[e]
            on = np.flatnonzero(pos < self.end)
            who, pos, keys, k = who[on], pos[on], keys[on], k + 1
        begin = np.cumsum(counts) - counts
        edges = np.empty(int(counts.sum()), np.int64)
        for j, (w, e) in enumerate(steps):
            edges[begin[w] + j] = e
        left = np.log(other)
        for w in np.flatnonzero(choice & (other < 1e-290)):  # too small for a double
            left[w] = self.beside(int(whole[w]), [edges[begin[w] : begin[w] + counts[w]].tolist()])[1][0]
        return edges, counts, np.minimum(logp, 0.0), left

    def _logs(self, pos: int) -> tuple[int, list[float]]:
        """A place's first edge and the log-probabilities of its edges."""
        a, b, whole = int(self.first[pos]), int(self.first[pos + 1]), float(self.beta[pos])
        return a, [x + y - whole for x, y in zip(self.logw[a:b].tolist(), self.beta[self.next[a:b]].tolist(), strict=True)]

    def beside(self, start: int, seen: list[list[int]]) -> tuple[list[tuple[int, dict[int, int]]], list[float]]:
        """The tree of seen segmentations, as (place, child by edge), and at each of its nodes the log-mass of what is not seen from there."""
        nodes: list[tuple[int, dict[int, int]]] = [(start, {})]
        for path in seen:
            k = 0
            for e in path:
                if e not in nodes[k][1]:
                    nodes[k][1][e] = len(nodes)
                    nodes.append((int(self.next[e]), {}))
                k = nodes[k][1][e]
        mass = [-math.inf] * len(nodes)
        for k in range(len(nodes) - 1, -1, -1):  # children stand after their parents
            pos, kids = nodes[k]
            if pos < self.end:
                first, lw = self._logs(pos)
                for e, kid in kids.items():
                    lw[e - first] += mass[kid]
                most = max(lw)
                if most > -math.inf:
                    mass[k] = most + math.log(sum(math.exp(x - most) for x in lw))
        return nodes, mass

    def draw_beside(self, start: int, key: np.ndarray, seen: list[list[int]]) -> tuple[list[int], float, float]:
        """A segmentation that is none of seen, its log-probability and the log-mass of all that is neither."""
        nodes, mass = self.beside(start, seen)
        pos, node, path, logp = start, 0, [], -float(self.beta[start])
        while pos < self.end:
            e, lw = self._logs(pos)
            if node is not None:
                for x, kid in nodes[node][1].items():
                    lw[x - e] += mass[kid]
            most = max(lw)
            weight = [math.exp(x - most) for x in lw]
            u = float(_uniform(key + _U(len(path)) * _M1)[0]) * sum(weight)
            k = 0
            while k + 1 < len(weight) and (u > weight[k] or not weight[k]):
                u, k = u - weight[k], k + 1
            while not weight[k]:  # rounding at the last edge
                k -= 1
            path.append(e + k)
            logp += float(self.logw[e + k])
            pos, node = int(self.next[e + k]), nodes[node][1].get(e + k) if node is not None else None
        return path, min(logp, 0.0), self.beside(start, [*seen, path])[1][0]


def _uncrossed(model: Pieces, chars: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places inside units that no piece crosses."""
    n = int(lengths.sum())
    at = np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(n)
    left = np.repeat(starts + lengths, lengths) - at
    first, node, reach, l = np.arange(n), np.zeros(n, np.int32), np.ones(n, np.int64), 0
    while len(first):
        node = model.step(node, model.code[chars[at[first] + l]])
        l += 1
        on = node > 0
        first, node = first[on], node[on]
        reach[first[model.end[node] >= 0]] = l
        more = left[first] > l
        first, node = first[more], node[more]
    # A unit's pieces end in it, so that one running maximum serves all units.
    ends = np.maximum.accumulate(np.arange(n) + reach)
    free = np.flatnonzero(ends[:-1] <= np.arange(1, n)) + 1
    return at[free]


def _units(texts: list[str], model: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts with a blank put before each, starts of units, and the number of the first unit of each text."""
    chars = np.frombuffer("".join(f" {t}" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
    blank = chars == _SPACE
    first = blank.copy()
    first[1:] &= ~blank[:-1]
    first[begins] = True
    starts = np.flatnonzero(first)
    gaps = np.diff(np.append(starts, len(chars)))
    if gaps.max() > UNIT:
        long = gaps > UNIT
        starts = np.union1d(starts, _uncrossed(model, chars, starts[long], gaps[long]))
    return chars, starts, np.searchsorted(starts, begins)


def _distinct(chars: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of one of each kind of unit, and the kind of every unit."""
    x = (chars.astype(_U) + _U(1)) * _GOLDEN
    x ^= x >> _U(32)
    inside = np.arange(len(chars), dtype=np.int32) - np.repeat(starts, lengths).astype(np.int32)
    x *= (_mixed(np.arange(1, int(lengths.max()) + 1, dtype=_U)) | _U(1))[inside]
    _, one, kind = np.unique(np.add.reduceat(x, starts), return_index=True, return_inverse=True)
    return one, kind


def _below(phi, bound, u):
    """Gumbel variables of location phi, cut at bound."""
    return np.where(np.isfinite(phi), phi - np.log(np.exp(np.minimum(phi - bound, 700)) - np.log(u)), -np.inf)


class _Text:
    """Queue of regions and samples of one text."""

    def __init__(self):
        self.heap, self.out, self.tie = [], [], 0

    def push(self, g: float, path, at: int, seen: list) -> None:
        self.tie += 1
        heapq.heappush(self.heap, (-g, self.tie, path, at, seen))


def sampled_ids(model: Pieces, texts: list[str], keys: list[int], k: int) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """For each text, up to k samples (ids, log_prob, perturbed, log_inclusion) in falling order of the perturbed value."""
    chars, starts, first_unit = _units(texts, model)
    lengths = np.diff(np.append(starts, len(chars)))
    one, kind = _distinct(chars, starts, lengths)
    lattice = Lattice(model, chars, starts[one], lengths[one])
    place, n_units = lattice.start[kind], np.diff(np.append(first_unit, len(starts)))
    del chars, starts, lengths, one, kind
    row_key, states = np.array(keys, _U), [_Text() for _ in texts]

    def hashed(which: np.ndarray, number: int, owner: np.ndarray, at: np.ndarray, purpose: int) -> np.ndarray:
        return _mixed(_mixed(row_key[which] + _U(number + 1) * _GOLDEN)[owner] + at.astype(_U) * _M2 + _U(purpose) * _M1)

    def grow(todo: list[tuple], number: int) -> None:
        """Draw the rest of a text from a unit on for every region (text, perturbed value, sample, unit, seen there), and push what is left of the region."""
        which, from_unit = np.array([t[0] for t in todo]), np.array([t[3] for t in todo])
        sizes = n_units[which] - from_unit
        ends = np.concatenate([[0], np.cumsum(sizes)])
        owner = np.repeat(np.arange(len(todo)), sizes)
        at = np.arange(ends[-1]) - (ends[:-1] - from_unit)[owner]
        pos = place[first_unit[which][owner] + at]
        draws = hashed(which, number, owner, at, 0)
        edges, counts, logp, left = lattice.draw(pos, draws)
        edge_ends, heads, kept = np.concatenate([[0], np.cumsum(counts)]), {}, np.zeros(len(todo))
        for i, (_, _, path, unit, seen) in enumerate(todo):
            if seen:
                a = ends[i]
                heads[i], logp[a], left[a] = lattice.draw_beside(int(pos[a]), draws[a : a + 1], seen)
            if path is not None:
                kept[i] = path[2][:unit].sum()
        before = np.cumsum(logp) - logp
        before += (kept - before[np.minimum(ends[:-1], len(before) - 1)])[owner]
        bound = np.array([t[1] for t in todo])[owner]
        value = _below(before + left, bound, _uniform(hashed(which, number, owner, at, 1 << 20)))
        for i, (t, g, path, unit, seen) in enumerate(todo):
            a, b = int(ends[i]), int(ends[i + 1])
            e, n, lp = edges[edge_ends[a] : edge_ends[b]], counts[a:b], logp[a:b]
            if seen:
                e, n = np.concatenate([heads[i], e[n[0] :]]).astype(np.int64), np.append(len(heads[i]), n[1:])
            if path is not None:
                e, n, lp = np.concatenate([path[0][: int(path[1][:unit].sum())], e]), np.concatenate([path[1][:unit], n]), np.concatenate([path[2][:unit], lp])
            state = states[t]
            state.out.append((e, float(lp.sum()), g))
            v, most = value[a:b], k + 1 - len(state.out)  # more of them can't become samples or kappa
            best = np.argpartition(-v, most)[:most] if len(v) > most else np.arange(len(v))
            for j in best[v[best] > -np.inf].tolist():
                x = unit + j
                begin = int(n[:x].sum())
                own = e[begin : begin + int(n[x])].tolist()
                state.push(float(v[j]), (e, n, lp), x, [*seen, own] if j == 0 else [own])

    everyone = np.arange(len(texts))
    gumbel = -np.log(-np.log(_uniform(hashed(everyone, 0, everyone, np.zeros(len(texts)), 1 << 21))))
    todo = [(t, float(g), None, 0, []) for t, g in enumerate(gumbel)]
    for number in range(k):
        if not todo:
            break
        grow(todo, number)
        todo = []
        if number + 1 < k:
            for t, s in enumerate(states):
                if s.heap:
                    g, _, path, at, seen = heapq.heappop(s.heap)
                    todo.append((t, -g, path, at, seen))
    results = []
    for s in states:
        kappa = -s.heap[0][0] if s.heap else -np.inf
        rows = []
        for e, total, g in s.out:
            ids = lattice.ids[e]
            if ids.min() < 0:
                lost = np.flatnonzero(ids < 0)
                put = [model.byte_ids[list(chr(-1 - i).encode("utf-8", "surrogatepass"))] for i in ids[lost].tolist()]
                sizes = np.ones(len(ids), np.int64)
                sizes[lost] = [len(x) for x in put]
                ids = np.repeat(ids, sizes)
                ids[ids < 0] = np.concatenate(put)
            x = total - kappa
            rows.append((ids, total, g, 0.0 if kappa == -np.inf else float(x if x < -18 else np.log(-np.expm1(-np.exp(min(x, 50)))))))
        results.append(rows)
    return results


def _proto(model_path: str) -> bytes:
    """The model's bytes, read on the driver; the tasks get them."""
    with open(model_path, "rb") as f:
        return f.read()


def _sample(batches, proto: bytes, k: int):
    """Arrow batches (doc_id, key, text) as batches (doc_id, rank, ids, log_prob, perturbed, log_inclusion, text), CHUNK bytes of text at a time."""
    import pyarrow as pa

    model = pieces(proto)
    with np.errstate(over="ignore", divide="ignore"):
        for batch in batches:
            keys, texts = batch.column("key").to_numpy().view(np.uint64), batch.column("text")
            sizes = np.diff(np.asarray(texts.buffers()[1]).view(np.int32)[texts.offset : texts.offset + len(texts) + 1])
            at = 0
            while at < len(texts):
                to, size = at, 0
                while to < len(texts) and (to == at or size + sizes[to] <= CHUNK):
                    size, to = size + sizes[to], to + 1
                found = sampled_ids(model, texts.slice(at, to - at).to_pylist(), keys[at:to], k)
                flat = [x for f in found for x in f]
                back = pa.array(np.repeat(np.arange(at, to), [len(f) for f in found]))
                ends = np.concatenate([[0], np.cumsum([len(x[0]) for x in flat])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(back),
                        pa.array([r for f in found for r in range(len(f))], pa.int32()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([x[0] for x in flat]), pa.int32())),
                        *[pa.array([x[c] for x in flat], pa.float64()) for c in (1, 2, 3)],
                        texts.take(back),
                    ],
                    names=["doc_id", "rank", "ids", "log_prob", "perturbed", "log_inclusion", "text"],
                )
                at = to


def _keyed(docs: DataFrame, seed: int, id_col: str, text_col: str) -> DataFrame:
    whole_ids(docs, id_col)
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(F.lit(seed), F.col(f"`{id_col}`")).alias("key"), F.col(f"`{text_col}`").alias("text"))


def sampled(docs: DataFrame, k: int = 2, seed: int = 17, model_path: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, rank, ids, log_prob, perturbed, log_inclusion): up to k segmentations of every whole text."""
    proto, rows = _proto(model_path), _keyed(docs, seed, id_col, text_col)

    def sample(batches):
        for batch in _sample(batches, proto, k):
            yield batch.drop_columns(["text"])

    # Empty texts have one segmentation, without pieces.
    none = rows.filter("text = ''").select("doc_id", F.lit(0).alias("rank"), F.array().cast("array<int>").alias("ids"), *[F.lit(0.0).alias(c) for c in ("log_prob", "perturbed", "log_inclusion")])
    return rows.filter("text <> ''").mapInArrow(sample, "doc_id long, rank int, ids array<int>, log_prob double, perturbed double, log_inclusion double").unionByName(none)


def decoded(samples: DataFrame, model_path: str = MODEL, ids_col: str = "ids") -> DataFrame:
    """samples with the column text in the place of ids; null ids give a null text."""
    proto = _proto(model_path)

    def decode(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        model = pieces(proto)
        for batch in batches:
            lists = batch.column(ids_col)
            ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())]).astype(np.int32)
            texts = pc.if_else(pc.is_valid(lists), model.decode(lists.flatten().to_numpy(), ends), pa.scalar(None, pa.string()))
            rest = [c for c in batch.schema.names if c != ids_col]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], texts], names=[*rest, "text"])

    rest = [f for f in samples.schema.fields if f.name not in (ids_col, "text")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest) + ", text string"
    return samples.select(*[F.col(f"`{f.name}`") for f in rest], ids_col).mapInArrow(decode, schema)


def digested(docs: DataFrame, k: int = 2, seed: int = 17, model_path: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, rank, n_pieces, ids_hash, log_prob, perturbed, log_inclusion, round_trip): sampled() and decoded() in one pass, whose pieces need not leave their task. Written."""
    proto, rows = _proto(model_path), _keyed(docs, seed, id_col, text_col)

    def digest(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        model = pieces(proto)
        for b in _sample(batches, proto, k):
            ends, flat = b.column("ids").offsets.to_numpy(), b.column("ids").values.to_numpy()
            same = pc.equal(model.decode(flat, ends), b.column("text"))
            crc = [zlib.crc32(flat[i:j]) for i, j in zip(ends[:-1], ends[1:], strict=True)]
            columns = [b.column("doc_id"), b.column("rank"), pa.array(np.diff(ends), pa.int32()), pa.array(crc, pa.int64()), *[b.column(c) for c in ("log_prob", "perturbed", "log_inclusion")], same]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "rank", "n_pieces", "ids_hash", "log_prob", "perturbed", "log_inclusion", "round_trip"])

    none = rows.filter("text = ''").select("doc_id", F.lit(0).alias("rank"), F.lit(0).alias("n_pieces"), F.lit(0).cast("long").alias("ids_hash"), *[F.lit(0.0).alias(c) for c in ("log_prob", "perturbed", "log_inclusion")], F.lit(True).alias("round_trip"))
    some = rows.filter("text <> ''").mapInArrow(digest, "doc_id long, rank int, n_pieces int, ids_hash long, log_prob double, perturbed double, log_inclusion double, round_trip boolean")
    with small_batches(docs.sparkSession):
        return saved(some.unionByName(none), "segment-digests")
