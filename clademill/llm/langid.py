"""Language identification by cross-parsing entropy.

For each language a bounded sample of labelled rows is turned into a suffix automaton. A text is parsed greedily into
the longest phrases that occur in a language's sample; fewer phrases mean a better fit. With a sample of m characters, a
phrase costs log2(m) bits, and bits per character are compared.

The whole text is parsed as one row of phrases. So that numpy advances thousands of places in step, segments of SEGMENT characters are parsed at the
same time, each as if a phrase began with it; then the parse of every segment is carried on into the next one until both begin a phrase at the same
character, from where they agree. A text in which that fails within a segment (a repetition, say) is parsed character by character.

Case and everything but letters are ignored: runs of other characters are one space.

Cases: null texts and texts without a letter are `und` with score 0; rows with null lang are not learned from but
are predicted; rows with a null id are never held out and never learned from; ties go to the first language by name; repeated rows are predicted alike; very long
texts are parsed whole; with no labelled row at all every text is `und`; an empty table gives no rows; columns beside text are carried, those named lang_pred and
score are replaced.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import saved, unused

#: Bound of the learned sample for each language: whole rows in order of a hash that together have so many characters (or the shortest row, if none fits), at
#: most so many rows.
SAMPLE_CHARS, SAMPLE_DOCS = 24_000, 200
#: Bytes of all automata at most: up to 2 states a character, with 4 bytes for each of the language's letters (250 at most; rarer letters take 12 bytes a transition).
MODEL_BYTES = 1 << 30
#: Characters parsed in step; characters, times languages, in memory at a time.
SEGMENT, CHUNK = 1024, 8_000_000
#: Letters, a language's most frequent ones, whose transitions are a dense table (those of all others are sorted keys); codes of a letter in no sample, of a space,
#: and between sampled documents.
LETTERS, OTHER, SPACE, BREAK = 250, 0, 1, 2


def _letters(text: str) -> dict[str, int]:
    counts: dict[str, int] = {}
    for c in text.lower():
        if c.isalpha():
            counts[c] = counts.get(c, 0) + 1
    return counts


def model_bytes(text: str) -> int:
    """Bound of the size of a language's automaton."""
    return 2 * (len(text) + 1) * (4 * (min(len(_letters(text)), LETTERS) + 3) + 24)


class Automata:
    """Suffix automata of all languages in one transition table, dense for a language's common letters and sparse for rare ones.

    A state is the place of its row in the table; 0 is no state. In a row, transitions stand by the language's own codes: 0 leads nowhere.
    """

    def __init__(self, texts: tuple[tuple[str, str], ...]):
        counts = [_letters(text) for _, text in texts]
        letters = sorted({c for each in counts for c in each})
        self.code = np.full(0x110000, SPACE, np.uint8 if len(letters) + 3 <= 256 else np.int32)
        self.code[[i for i in range(0x110000) if chr(i).isalpha()]] = OTHER
        for k, c in enumerate(letters):
            self.code[[ord(x) for x in (c, c.upper()) if len(x) == 1]] = k + 3
        self.code[0x1E] = BREAK
        number = {c: k + 3 for k, c in enumerate(letters)}
        self.langs, n = [lang for lang, _ in texts], len(letters) + 3
        #: A language's own code of each code, 0 for letters that it lacks; rare ones are marked.
        self.own, self.rare = np.zeros((len(texts), n), np.int32), np.zeros((len(texts), n), bool)
        self.start, roots, bits, tables, keys, goals, at = np.zeros((len(texts), n), np.int32), [], [], [], [], [], 1
        for k, (_, text) in enumerate(texts):
            common = [number[c] for c in sorted(counts[k], key=lambda c: (-counts[k][c], c))]
            self.own[k, [SPACE, BREAK, *common[:LETTERS]]] = np.arange(1, len(common[:LETTERS]) + 3)
            self.rare[k, common[LETTERS:]] = True
            width, rows, codes = len(common[:LETTERS]) + 3, [{}], self.codes(text)
            self._add(rows, codes.tolist())
            rows = rows[1:]
            table = np.zeros((len(rows), width), np.int32)
            own, place = self.own[k].tolist(), lambda state, at=at, width=width: at + (state - 1) * width
            for state, row in enumerate(rows):
                for c, to in row.items():
                    if own[c]:
                        table[state, own[c]] = place(to)
                    else:
                        keys.append((place(state + 1) << 21) | c), goals.append(place(to))
            roots.append(place(1)), bits.append(np.log2(max(2, len(codes)))), tables.append(table.ravel())
            self.start[k] = place(1)
            self.start[k, list(rows[0])] = [place(to) for to in rows[0].values()]  # state after a phrase's first character
            at += table.size
            if at >= 1 << 31:
                raise ValueError("too many languages for one table: lower SAMPLE_CHARS")
        order = np.argsort(np.array(keys, np.int64))
        self.keys, self.goals = np.array(keys, np.int64)[order], np.array(goals, np.int32)[order]
        self.sparse = dict(zip(keys, goals, strict=True))
        self.bits, self.roots, self.next = np.array(bits), np.array(roots, np.int32), np.concatenate([[np.int32(0)], *tables])

    def _add(self, rows: list[dict[int, int]], codes: list[int]) -> None:
        root = last = len(rows)
        rows.append({})
        link, length = {root: 0}, {root: 0}
        for c in codes:
            if c <= OTHER or c == BREAK:  # nothing matches across documents or an uncoded letter
                last = root
                continue
            if c in rows[last]:
                p, q = last, rows[last][c]
                if length[q] == length[p] + 1:
                    last = q
                    continue
                last = self._split(rows, link, length, p, q, c)
                continue
            cur = len(rows)
            rows.append({})
            length[cur] = length[last] + 1
            p = last
            while p and c not in rows[p]:
                rows[p][c] = cur
                p = link[p]
            if not p:
                link[cur] = root
            else:
                q = rows[p][c]
                link[cur] = q if length[q] == length[p] + 1 else self._split(rows, link, length, p, q, c)
            last = cur

    @staticmethod
    def _split(rows, link, length, p, q, c) -> int:
        clone = len(rows)
        rows.append(dict(rows[q]))
        length[clone], link[clone] = length[p] + 1, link[q]
        link[q] = clone
        while p and rows[p].get(c) == q:
            rows[p][c] = clone
            p = link[p]
        return clone

    def codes(self, text: str) -> np.ndarray:
        c = self.code[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
        space = c == SPACE
        space[1:] &= space[:-1].copy()
        space[:1] = False
        return c[~space]

    def _step(self, lang: np.ndarray, state: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """States one character on, and where a phrase begins with it."""
        cell = c + lang * np.int32(self.own.shape[1])
        to = self.next.take(state + self.own.take(cell))
        if len(self.keys):
            rare = self.rare.take(cell)
            if rare.any():
                key = (state[rare].astype(np.int64) << 21) | np.broadcast_to(c, state.shape)[rare]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                to[rare] = np.where(self.keys[at] == key, self.goals[at], 0)
        lost = to == 0
        begun = lost | (state == self.roots.take(lang))
        again = np.flatnonzero(lost)
        to.ravel()[again] = self.start.take(cell.ravel()[again])
        return to, begun

    def _plainly(self, lang: int, codes: np.ndarray) -> int:
        """Phrases of a text, character by character."""
        own, start, root, to_next = self.own[lang].tolist(), self.start[lang].tolist(), int(self.roots[lang]), memoryview(self.next)
        state, n = root, 0
        for c in codes.tolist():
            to = to_next[state + own[c]] if own[c] else self.sparse.get((state << 21) | c, 0)
            if not to:
                n, state = n + 1, start[c]
            else:
                n, state = n + (state == root), to
        return n

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases needed by text and language, and characters parsed by text."""
        coded = [self.codes(text) for text in texts]
        chars = np.array([len(c) for c in coded], np.int64)
        total = np.zeros((len(texts), len(self.langs)), np.int64)
        parts = -(-chars // SEGMENT)
        if not parts.sum():
            return total, chars
        flat, text_begins = np.concatenate(coded).astype(np.int32), np.cumsum(chars) - chars
        owner = np.repeat(np.arange(len(texts)), parts)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
        begins = text_begins[owner] + number * SEGMENT
        lengths = np.minimum(chars[owner] - number * SEGMENT, SEGMENT)
        order = np.argsort(-lengths, kind="stable")
        active = np.searchsorted(-lengths[order], -np.arange(lengths.max()), side="left")
        lang = np.arange(len(self.langs), dtype=np.int32)[:, None]
        state = np.repeat(self.roots[:, None], len(owner), 1)  # of segments in order
        count = np.zeros(state.shape, np.int64)
        marks = np.zeros((len(active), *state.shape), bool) if number.any() else None  # where phrases begin, by place in the segment
        first = begins[order]
        for j in range(len(active)):
            n = active[j]
            state[:, :n], begun = self._step(lang, state[:, :n], flat[first[:n] + j])
            count[:, :n] += begun
            if marks is not None:
                marks[j, :, :n] = begun
        back = np.argsort(order)
        state, count = state[:, back], count[:, back]
        if marks is not None:
            self._carried_on(state, count, marks, back, flat, owner, number, begins, lengths, parts, coded)
        for k in range(len(self.langs)):
            total[:, k] = np.bincount(owner, weights=count[k], minlength=len(texts))
        return total, chars

    def _carried_on(self, state, count, marks, back, flat, owner, number, begins, lengths, parts, coded) -> None:
        """Correct count, the phrases begun in each segment, as if every text were parsed in one piece."""
        front = np.flatnonzero(number + 1 < parts[owner])  # segments that another one of the text follows
        lang, to = (x.ravel() for x in np.meshgrid(np.arange(len(self.langs), dtype=np.int32), front + 1, indexing="ij"))
        s, own, j = state[:, front].ravel(), np.zeros(len(to), np.int64), 0  # own: phrases begun here so far, less the segment's own ones
        failed = set()
        while len(to):
            over = j >= lengths[to]
            if over.any():  # no agreement in the whole segment
                last = number[to] + 1 == parts[owner[to]]
                failed |= {(int(k), int(t)) for k, t in zip(lang[over & ~last], owner[to[over & ~last]], strict=True)}
                count[lang[over], to[over]] += own[over]
                lang, to, s, own = (x[~over] for x in (lang, to, s, own))
                if not len(to):
                    break
            s, begun = self._step(lang, s, flat[begins[to] + j])
            there = marks[j, lang, back[to]]
            agree = begun & there
            own += begun.astype(np.int64) - there
            count[lang[agree], to[agree]] += own[agree]
            lang, to, s, own = (x[~agree] for x in (lang, to, s, own))
            j += 1
        for k, t in failed:
            where = np.flatnonzero(owner == t)
            count[k, where] = 0
            count[k, where[0]] = self._plainly(k, coded[t])

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Best language and score: how far its bits per character lie below the second's, relative to those."""
        total, chars = self.phrases(texts)
        cost = total * self.bits / np.maximum(chars, 1)[:, None]
        best = cost.argmin(1)
        if len(self.langs) == 1:
            return [self.langs[0]] * len(texts), np.ones(len(texts))
        two = np.partition(cost, 1, axis=1)[:, :2]
        return [self.langs[k] for k in best], np.clip(1 - two[:, 0] / np.maximum(two[:, 1], 1e-12), 0, 1)


@lru_cache(2)
def automata(texts: tuple[tuple[str, str], ...]) -> Automata:
    """Built once in each Python worker from the sampled text, which is all that is sent there."""
    return Automata(texts)


_SEPARATOR = "\x1e"


def sampled_text(docs: DataFrame, seed: int = 17) -> tuple[tuple[str, str], ...]:
    """Learned text by language from labelled rows (doc_id, text, lang): whole rows in order of a hash that fit into SAMPLE_CHARS together."""
    rows = docs.filter(F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull()).select("lang", "text", "doc_id", F.length("text").alias("n"))
    counts = saved(rows.groupBy("lang").agg(F.count_if(F.col("n") <= SAMPLE_CHARS).alias("fit"), F.min("n").alias("least")), "lang-counts")
    # The size is checked: beyond it the optimizer decides how to join.
    known = F.broadcast(counts) if counts.count() <= 10_000 else counts
    h = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 40)) / float(1 << 40)
    chosen = F.when(F.col("fit") > 0, (F.col("n") <= SAMPLE_CHARS) & (F.col("h") < SAMPLE_DOCS / F.col("fit"))).otherwise(F.col("n") == F.col("least"))
    rows = rows.withColumn("h", h).join(known, "lang").filter(chosen)
    found: dict[str, list[str]] = {}
    left: dict[str, int] = {}
    for r in rows.select("lang", "text", "h", "doc_id", "fit").orderBy("lang", "h", "doc_id", "text").toLocalIterator():
        n = len(r["text"])
        if n <= left.setdefault(r["lang"], SAMPLE_CHARS) or (not r["fit"] and r["lang"] not in found):
            left[r["lang"]] -= n
            found.setdefault(r["lang"], []).append(r["text"].replace(_SEPARATOR, " "))
    texts = tuple((lang, _SEPARATOR.join(found[lang])) for lang in sorted(found))
    if sum(model_bytes(text) for _, text in texts) > MODEL_BYTES:
        raise ValueError(f"the automata of {len(texts)} languages would take over {MODEL_BYTES} bytes in every worker: lower SAMPLE_CHARS")
    return texts


def identified(docs: DataFrame, learn_from: DataFrame, seed: int = 17) -> DataFrame:
    """docs (doc_id, text and any other columns) without the text, with lang_pred and score."""
    texts = sampled_text(learn_from, seed)
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in ("text", "lang_pred", "score")]
    rows = docs.select(*keep, F.when(F.col("text").rlike(r"\p{L}"), F.col("text")).alias("text"))
    if not texts:
        return rows.select(*keep, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))

    def predict(parts):
        import pandas as pd

        model = automata(texts)
        for text in parts:
            lang, score = np.full(len(text), "und", object), np.zeros(len(text))
            some = np.flatnonzero(text.notna().to_numpy())
            values, at, most = text.to_numpy(), 0, CHUNK // len(texts)
            while at < len(some):  # about CHUNK characters, times languages, at a time
                to, size = at, 0
                while to < len(some) and (to == at or size + len(values[some[to]]) <= most):
                    size, to = size + len(values[some[to]]), to + 1
                lang[some[at:to]], score[some[at:to]] = model.predict([values[i] for i in some[at:to]])
                at = to
            yield pd.DataFrame({"lang_pred": lang, "score": score})

    from collections.abc import Iterator

    import pandas as pd

    predict.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    found = F.pandas_udf(predict, "lang_pred string, score double")
    name = unused("found", docs.columns)
    return rows.select(*keep, found("text").alias(name)).select(*keep, F.col(name).getField("lang_pred").alias("lang_pred"), F.col(name).getField("score").alias("score"))
