"""Edit sequences that share their beginnings, and cheapest ones over the turns of a conversation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

_BASE, _PRIME = 1_000_003, (1 << 61) - 1


class Sequences:
    """Sequences of small numbers as linked nodes: a node is its parent's sequence and one more.

    Node 0 is the empty sequence. A node knows its ancestors 1, 2, 4, ... steps up and a rolling hash
    of its whole sequence, so the first place where two sequences differ is found in logarithmic
    steps, wherever it is.
    """

    def __init__(self, base: int = _BASE, prime: int = _PRIME):
        self.base, self.prime = base, prime
        self.parent, self.last, self.depth, self.hash = [0], [-1], [0], [1]
        self.up: list[tuple[int, ...]] = [()]
        self.same: dict[int, int] = {}
        self.known: dict[tuple[int, int], int] = {}

    def append(self, node: int, value: int) -> int:
        found = self.known.get((node, value))
        if found is None:
            found = self.known[node, value] = len(self.parent)
            up, at = [node], 0
            while len(self.up[up[at]]) > at:
                up.append(self.up[up[at]][at])
                at += 1
            self.parent.append(node)
            self.last.append(value)
            self.depth.append(self.depth[node] + 1)
            self.hash.append((self.hash[node] * self.base + value + 1) % self.prime)
            self.up.append(tuple(up))
        return found

    def _lifted(self, node: int, depth: int) -> int:
        while (more := self.depth[node] - depth) > 0:
            node = self.up[node][more.bit_length() - 1]
        return node

    def _root(self, node: int) -> int:
        while node in self.same:
            node = self.same[node]
        return node

    def equal(self, a: int, b: int) -> bool:
        """Whether two nodes have equal sequences; what was found equal once is not compared again."""
        if self.depth[a] != self.depth[b] or self.hash[a] != self.hash[b]:
            return False
        walked = []
        a, b = self._root(a), self._root(b)
        while a != b:
            if self.last[a] != self.last[b]:
                return False
            walked.append((a, b))
            a, b = self._root(self.parent[a]), self._root(self.parent[b])
        for x, y in walked:
            self.same[max(x, y)] = min(x, y)
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether sequence ``a`` comes before ``b``; a beginning comes before what it begins."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self._lifted(a, depth), self._lifted(b, depth)
        if self.equal(x, y):
            return self.depth[a] < self.depth[b]
        # the highest ancestors that differ by their hashes: their parents have equal ones
        for step in range(depth.bit_length() - 1, -1, -1):
            if step < len(self.up[x]):
                p, q = self.up[x][step], self.up[y][step]
                if self.hash[p] != self.hash[q]:
                    x, y = p, q
        if self.equal(self.parent[x], self.parent[y]) and self.last[x] != self.last[y]:
            return self.last[x] < self.last[y]
        return self.values(a) < self.values(b)  # hashes that collide

    def values(self, node: int) -> list[int]:
        out = []
        while node:
            out.append(self.last[node])
            node = self.parent[node]
        return out[::-1]


#: roles so far: none, system, a user turn that waits for its answer, an answered one
STATES = NONE, SYSTEM, ASKED, ANSWERED = range(4)
#: what is kept by the state before it and the role's initial
_KEEP = {(NONE, "s"): SYSTEM, (NONE, "u"): ASKED, (SYSTEM, "u"): ASKED, (ASKED, "a"): ANSWERED, (ANSWERED, "u"): ASKED}
_NEXT = (ASKED, ASKED, ANSWERED, ASKED)
#: the role that an inserted turn, or one with a new role, has by the state before it
ROLES = ("user", "user", "assistant", "user")
_INSERT, _REROLE, _DELETE, _TRUNCATED = 3, 3, 4, 3
_D, _I, _K, _R = map(ord, "DIKR")
#: edits that end a conversation well, by its last state
ENDS = ("", "II", "I", "")

Turn = tuple[str, bool, bool]


def after(state: int, edit: str, initial: str) -> int:
    """The state after an edit; ``initial`` is that of the turn that is kept."""
    if edit == "K":
        return _KEEP[state, initial] if initial else state
    return state if edit == "D" else _NEXT[state]


def cheapest(turns: Iterable[Turn], start: int) -> list[tuple[int, str] | None]:
    """By end state: the least cost and its edits from ``start``, of equal cost the ASCII-least ones.

    A turn is its role's initial, whether it must go and whether it is truncated. Turns may come in
    between before any turn, not after the last one, so every sequence ends with the edit of the
    last turn and none of two different ones begins the other.
    """
    known = Sequences()
    append, less = known.append, known.less
    best: list[tuple[int, int] | None] = [None] * 4
    best[start] = (0, 0)

    def better(old, cost, node, edit):
        """The cheaper of ``old`` and an edit after a node."""
        if old is None or cost < old[0]:
            return cost, append(node, edit)
        if cost == old[0]:
            node = append(node, edit)
            if node != old[1] and less(node, old[1]):
                return cost, node
        return old

    for initial, must_go, truncated in turns:
        ready = list(best)
        for state in (NONE, SYSTEM, ANSWERED):
            if best[state]:
                ready[ASKED] = better(ready[ASKED], best[state][0] + _INSERT, best[state][1], _I)
        if ready[ASKED]:
            ready[ANSWERED] = better(ready[ANSWERED], ready[ASKED][0] + _INSERT, ready[ASKED][1], _I)
        best = [None] * 4
        more = _TRUNCATED if truncated else 0
        for state in STATES:
            if not ready[state]:
                continue
            cost, node = ready[state]
            best[state] = better(best[state], cost + _DELETE, node, _D)
            if not must_go:
                kept = state if not initial else _KEEP.get((state, initial))
                if kept is not None:
                    best[kept] = better(best[kept], cost + more, node, _K)
                best[_NEXT[state]] = better(best[_NEXT[state]], cost + _REROLE + more, node, _R)
    return [None if b is None else (b[0], bytes(known.values(b[1])).decode()) for b in best]


Choice = tuple[int, int]


def chained(pieces: Iterable[Sequence[tuple[int, int, int, int]]]) -> tuple[int, list[Choice]]:
    """The least cost over pieces in order, and the (start, end) of each.

    A piece has (start, end, cost, place): ``place`` orders the edits of one start as text, and those
    of different ends differ, so the first piece in which two ways part decides between them.
    """
    known = Sequences()
    best: dict[int, tuple[int, int]] = {NONE: (0, 0)}
    for piece in pieces:
        now: dict[int, tuple[int, int]] = {}
        for start, end, cost, place in piece:
            if start not in best:
                continue
            cost += best[start][0]
            old = now.get(end)
            if old and cost > old[0]:
                continue
            node = known.append(best[start][1], place * 16 + start * 4 + end)
            if not old or cost < old[0] or known.less(node, old[1]):
                now[end] = cost, node
        best = now
    cost, node = None, 0
    for end, (some, at) in sorted(best.items()):
        some += _INSERT * len(ENDS[end])
        if cost is None or some < cost or some == cost and known.less(at, node):
            cost, node = some, at
    return cost, [(v % 16 // 4, v % 4) for v in known.values(node)]
