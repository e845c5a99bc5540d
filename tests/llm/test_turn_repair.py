"""Conversation repair against an exhaustive search, and its persistent sequences."""

import hashlib
import random
import re
import zlib

import pytest

from sideline.llm import audits, turn_repair

SCHEMA = "conv_id long, turn long, role string, text string, rank int, place string, said int, audit string"
LEGAL = re.compile(r"(s?(ua)+)?")


def searched(turns):
    """(cost, audit) by trying all edits of (initial, must go, truncated)."""
    best = (4 * len(turns), "D" * len(turns))

    def go(i, roles, audit, cost, inserts):
        nonlocal best
        if cost > best[0]:
            return
        if i == len(turns) and LEGAL.fullmatch(roles):
            best = min(best, (cost, audit))
        for role in "ua" if inserts < 2 else "":
            go(i, roles + role, audit + "I", cost + 3, inserts + 1)
        if i < len(turns):
            initial, must_go, cut = turns[i]
            go(i + 1, roles, audit + "D", cost + 4, 0)
            if not must_go:
                go(i + 1, roles + initial, audit + "K", cost + 3 * cut, 0)
                for role in "ua":
                    go(i + 1, roles + role, audit + "R", cost + 3 + 3 * cut, 0)

    go(0, "", "", 0, 0)
    return best


def _ways(turns, step):
    pieces, texts = [], []
    for i in range(0, len(turns), step):
        piece, found = [], {}
        for start in audits.STATES if i else (0,):
            ends = [(e, *b) for e, b in enumerate(audits.cheapest(turns[i : i + step], start)) if b]
            order = sorted(b[2] for b in ends)
            for end, cost, audit in ends:
                piece.append((start, end, cost, order.index(audit)))
                found[start, end] = audit
        pieces.append(piece)
        texts.append(found)
    cost, ways = audits.chained(pieces)
    return cost, "".join(t[w] for t, w in zip(texts, ways, strict=True)) + (audits.ENDS[ways[-1][1]] if ways else "")


@pytest.mark.parametrize("hashes", [(1_000_003, (1 << 61) - 1), (7, 5), (1, 1)])
def test_cheapest_audit(monkeypatch, hashes):
    """Also with hashes that collide nearly always, or always."""

    class Weak(audits.Sequences):
        def __init__(self):
            super().__init__(*hashes)

    monkeypatch.setattr(audits, "Sequences", Weak)
    rng = random.Random(2)
    for _ in range(250):
        turns = [(rng.choice("ssuuuaaax") if rng.random() < 0.95 else "", rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randrange(6))]
        want = searched(turns)
        for step in (1, 2, 3, 9):
            assert _ways(turns, step) == want


@pytest.mark.parametrize("hashes", [(1_000_003, (1 << 61) - 1), (3, 2)])
def test_sequences_compare_like_lists(hashes):
    rng = random.Random(4)
    known, nodes = audits.Sequences(*hashes), [0]
    for _ in range(400):
        nodes.append(known.append(rng.choice(nodes[-20:]), rng.randrange(2)))
    for _ in range(3000):
        a, b = rng.choice(nodes), rng.choice(nodes)
        x, y = known.values(a), known.values(b)
        assert known.less(a, b) == (x < y) and known.equal(a, b) == (x == y) and known.depth[a] == len(x)


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


def plain(rows, ids):
    """Contract columns of every conversation in ``ids`` from turns after damage."""
    out = []
    for conv in ids:
        said = lambda r: hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, said(r)))
        seen, faults = set(), []
        for _, _, role, text in turns:
            last = re.sub(r"[\x20\x09-\x0D]", "", text)[-1:]
            faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
            seen.add((role, text))
        initials = [r[2][:1] for r in turns]
        cost, audit = searched([(i, f in ("blank", "duplicate"), f == "truncated") for i, f in zip(initials, faults, strict=True)])
        lines, roles, left = [], "", iter(turns)
        for edit in audit:
            wanted = "assistant" if roles.endswith("u") else "user"
            if edit == "I":
                lines.append(f"{wanted}:")
                roles += wanted[0]
                continue
            _, _, role, text = next(left)
            if edit != "D":
                role = role if edit == "K" else wanted
                lines.append(f"{role}:{text}")
                roles += role[:1]
        assert LEGAL.fullmatch(roles)
        numbers = {r[1] for r in turns if r[1] is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        out.append((conv, gaps, *map(faults.count, ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(6)
    rows = []
    for conv in range(150):
        for turn in range(rng.randrange(1, 6)):
            text = rng.choice(("One.", "Two words!", "no end", "Why? ", " \n", "é漢. more", "", "Line.\nLine?\t"))
            rows.append((conv, turn * rng.choice((1, 1, 1, 3)), rng.choice(("user", "assistant") if turn else ("system", "user", "user", "tool", "")), text))
    rows += [(None, t, r, "In no conversation.") for t, r in ((0, "user"), (None, "assistant"), (2, None))]
    rows += [(900, None, "user", None), (900, None, None, "No number."), (901, 5, None, None), (902, None, "assistant", "a " * 50_000 + ".")]
    return rows + rows[5:8]


def _key(row):
    return tuple((x is not None, x) if x is not None else (False, 0) for x in row)


@pytest.mark.parametrize("part_rows", [1, 2, 4096])
def test_audit_of_damage(spark, turns, part_rows, monkeypatch):
    whole = turn_repair.repair
    monkeypatch.setattr(turn_repair, "repair", lambda rows: whole(rows, part_rows))
    df = spark.createDataFrame([(*r, *[None] * 4) for r in turns], SCHEMA).repartition(3)
    got = turn_repair.audit_of_damage(df)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    ids = {r[0] for r in turns}
    assert sorted(map(tuple, got.collect()), key=_key) == sorted(plain(damage(turns), ids), key=_key)


def test_a_long_conversation(spark):
    """One conversation in many parts gives what one part gives."""
    rng = random.Random(1)
    rows = [(1, i, rng.choice(("user", "assistant")), rng.choice(("a.", "b", "", f"{i}."))) for i in range(700)] + [(2, 0, "user", "Only.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    one, many = ([sorted(map(tuple, x.collect())) for x in (found[0], turn_repair.digests(found[1]))] for found in (turn_repair.repair(df), turn_repair.repair(df, 16)))
    assert one == many and len(one[0]) == 2


def test_repaired_turns_read_in_order(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "There."), (1, 2, "assistant", "Yes.")]
    _, repaired = turn_repair.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = [(r.edit, r.role, r.text) for r in repaired.orderBy("conv_id", "place").collect()]
    assert got == [("K", "user", "Hi."), ("I", "assistant", ""), ("K", "user", "There."), ("K", "assistant", "Yes.")]


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert turn_repair.audit_of_damage(df).count() == 0
