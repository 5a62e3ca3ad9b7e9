"""A small taxonomy, slow models of the roll-ups, random trees."""

from __future__ import annotations

from collections import defaultdict

NODES = [
    (1, 1, "no rank", "root"), (2, 1, "superkingdom", "Bacteria"), (2759, 1, "superkingdom", "Eukaryota"), (1224, 2, "phylum", "Pseudomonadota"), (561, 1224, "genus", "Escherichia"),
    (562, 561, "species", "Escherichia coli"), (511145, 562, "strain", "Escherichia coli K-12"), (7711, 2759, "phylum", "Chordata"), (9605, 7711, "genus", "Homo"),
    (9606, 9605, "species", "Homo sapiens"), (10088, 7711, "genus", "Mus"), (10090, 10088, "species", "Mus musculus"),
]
SCHEMA = "t_id long, parent_id long, rank string, name string"


def path(parents, t):
    out = [t]
    while parents.get(t, t) != t:
        t = parents[t]
        out.append(t)
    return out[::-1]


def clades(parents, reads):
    out = defaultdict(int)
    for (t, s), n in reads.items():
        for a in path(parents, t) if t in parents else [t]:
            out[a, s] += n
    return dict(out)


def push_up(parents, reads, least, seen):
    """Level by level: failing nodes hand their own reads to the parent."""
    sums, own = clades(parents, reads), defaultdict(int, reads)
    nodes = {t for t, _ in sums}
    dead = set()
    for t in sorted((t for t in nodes if t in parents), key=lambda t: -len(path(parents, t))):
        cells = [n for (x, _), n in sums.items() if x == t]
        if t != 1 and not (max(cells) >= least and sum(n > 0 for n in cells) >= seen):
            dead.add(t)
            for (x, s) in list(own):
                if x == t:
                    own[parents[t], s] += own.pop((x, s))
    return {(t, s): (own.get((t, s), 0), n) for (t, s), n in sums.items() if t not in dead and n > 0}


def bubble(parents, ranks, canonical, reads, least, seen):
    """Deepest first: failing canonical nodes hand their remainder to the next one above."""
    route = lambda t: [1, *[a for a in path(parents, t) if a != 1 and ranks[a] in canonical]]
    held = defaultdict(int)
    for (t, s), n in reads.items():
        if t in parents:
            held[route(t)[-1], s] += n
    for t in sorted({t for t, _ in held} | {a for t, _ in held for a in route(t)}, key=lambda t: -len(route(t))):
        cells = [n for (x, _), n in held.items() if x == t]
        if t != 1 and cells and (max(cells) < least or sum(n > 0 for n in cells) < seen):
            for (x, s) in list(held):
                if x == t:
                    held[route(t)[-2], s] += held.pop((x, s))
    return {k: n for k, n in held.items() if n > 0}
