"""Plain Python that the operators are held against."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def components_of(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in parent}


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def shingle_set(text, n):
    words = WORD.findall(lower(text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def jaccard(rows, n, percent):
    """(id, size, component) of every (id, text)."""
    sets = [(i, shingle_set(t, n)) for i, t in rows]
    held = [(i, s) for i, s in sets if i is not None and s]
    links = [
        (a, b) for k, (a, s) in enumerate(held) for b, t in held[:k]
        if 100 * len(s & t) >= percent * len(s | t)
    ]
    comp = components_of([i for i, _ in held], links)
    return [(i, len(s), comp.get(i, i)) for i, s in sets]


def kept_lines(rows, least=20, documents=3):
    """(id, lines, dropped, text) of every (id, text)."""
    key = lambda x: lower(x.strip(" \t\n\x0b\x0c\r"))
    held = {}
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            held.setdefault(k, []).append(i)
    last = {k: max((i for i in ids if i is not None), default=None) for k, ids in held.items() if len(k) >= least and len(ids) >= documents}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if last.get(key(x)) is None or last[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


def mix(rows, weights=(5, 2, 1), most=3):
    """(id, size, source_size, target, taken) of every (id, text, source)."""
    import hashlib
    from fractions import Fraction

    size = lambda t: len(WORD.findall(t or ""))
    names = sorted({s for *_, s in rows if s is not None}) + [None] * any(s is None for *_, s in rows)
    have = {s: sum(size(t) for _, t, x in rows if x == s) for s in names}
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, budget, free = {}, Fraction(sum(have.values())), set(names)
    while free:
        share = budget / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * share > most * have[s]}
        for s in full or free:
            target[s] = Fraction(most * have[s]) if full else weight[s] * share
        budget -= sum(target[s] for s in full)
        free = free - full if full else set()
    out = []
    for s in names:
        left = int(target[s]) % have[s] if have[s] else 0
        turns = int(target[s]) // have[s] if have[s] else 0
        key = lambda r: ("" if r[0] is None else hashlib.md5(str(r[0]).encode()).hexdigest(), -1 if r[0] is None else r[0], size(r[1]))
        for i, t, _ in sorted((r for r in rows if r[2] == s), key=key):
            part = max(0, min(size(t), left))
            left -= part
            out.append((i, size(t), have[s], float(target[s]), turns * size(t) + part))
    return out
