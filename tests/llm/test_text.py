"""Jaccard join, line dedup and mixing against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sideline.llm import jaccard_join, line_dedup, mixture
from sideline.llm.components import components
from tests.llm import brute

EXTRA = "n int, prefix string, held int, size int, token int, want int, n_lines int, before string"


def _docs(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame([(*r, *[None] * 8) for r in rows], f"{schema}, {EXTRA}")


def _family(rng, length, copies, edits):
    base = [f"w{rng.randrange(9000)}" for _ in range(length)]
    for _ in range(copies):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(length)] = f"x{rng.randrange(9000)}"
        yield " ".join(words)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    shared = " ".join(f"s{i}" for i in range(60))  # a passage that many documents share
    out = []
    for length, copies, edits in ((40, 60, 1), (90, 40, 4), (300, 12, 12), (12, 9, 1), (30, 25, 2)):
        out += _family(rng, length, copies, edits)
    out += [f"{shared} {t}" for t in _family(rng, 20, 1, 0)] * 30
    out += [f"{shared} " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(25)) for _ in range(40)]
    out += [None, "", " \n\t ", "one", "One", "two words", "two\x0bWORDS", "two words", "É a b c", "é a b c", "a b c d " * 3000]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize(("n", "percent", "most"), [(4, 85, 1 << 20), (5, 80, 0), (4, 85, 40), (2, 60, 1 << 20)])
def test_jaccard_components(spark, texts, n, percent, most):
    rows = list(enumerate(texts))
    got = jaccard_join.jaccard_components(_docs(spark, rows), n, percent, most_frequent=most).collect()
    assert sorted(map(tuple, got)) == sorted(brute.jaccard(rows, n, percent))


def test_jaccard_odd_ids(spark):
    rows = [(None, "a b c d e"), (None, "a b c d e"), (3, "a b c d e"), (3, "a b c d e"), (9, "a b c d e"), (9, "v w x y z"), (12, "v w x y z"), (4, None)]
    got = sorted(map(tuple, jaccard_join.jaccard_components(_docs(spark, rows)).collect()), key=str)
    assert got == sorted([(None, 2, None)] * 2 + [(3, 2, 3)] * 2 + [(9, 2, 3)] * 2 + [(12, 2, 3), (4, 0, 4)], key=str)
    assert jaccard_join.jaccard_components(_docs(spark, [])).count() == 0
    stay = jaccard_join.one_of_each(_docs(spark, rows)).collect()
    assert sorted((r.doc_id for r in stay), key=str) == [3, 3, 4, None, None]


def test_needed_is_a_bound():
    # the least overlap of two prefixes, over all ways in which linked sets can lie in one order
    rng = random.Random(2)
    for _ in range(3000):
        percent = rng.choice((60, 80, 85))
        both, only = rng.randrange(1, 40), (rng.randrange(6), rng.randrange(6))
        order = rng.sample(range(1000), both + sum(only))
        common, a, b = order[:both], order[both : both + only[0]], order[both + only[0] :]
        a, b = sorted(common + a), sorted(common + b)
        if 100 * both < percent * (both + sum(only)):
            continue
        pa, pb = a[: jaccard_join.prefix_size(len(a), percent)], b[: jaccard_join.prefix_size(len(b), percent)]
        need = eval(jaccard_join._needed(str(len(a)), str(len(b)), percent).replace("greatest", "max").replace("div", "//"))
        assert len({*pa} & {*pb}) >= max(1, need)
        for x in {*a} & {*b}:
            said = jaccard_join._may_share(str(len(a)), str(a.index(x)), str(len(b)), str(b.index(x)), percent)
            assert eval(said.replace("greatest", "max").replace("least", "min").replace("div", "//").replace("AND", "and"))


def test_signatures_and_first_places_are_bounds():
    rng = random.Random(5)
    seen = 0
    for _ in range(1500):
        percent = rng.choice((60, 80, 85))
        both, only = rng.randrange(1, 200), (rng.randrange(12), rng.randrange(12))
        values = np.unique(np.array([rng.randrange(2**64) for _ in range(both + sum(only))], np.uint64))
        rng.shuffle(order := values.tolist())
        a, b = ({*order[:both], *order[both : both + only[0]]}, {*order[:both], *order[both + only[0] :]})
        sides = [np.array(sorted(x), np.uint64) for x in (a, b)]
        x, y = (jaccard_join.signature(s).tolist() for s in sides)
        differ = sum(((p ^ q) & (2**64 - 1)).bit_count() for p, q in zip(x, y, strict=True))
        assert differ <= len(a ^ b)
        if 100 * len(a & b) < percent * len(a | b):
            continue
        seen += 1
        run = lambda sql: eval(sql.replace("div", "//").replace("AND", "and"))
        assert differ <= len(a) + len(b) - 2 * run(jaccard_join._overlap(str(len(a)), str(len(b)), percent))
        first = min(a & b)  # in any one order of shingles
        places = [int(np.searchsorted(s, np.uint64(first))) for s in sides]
        assert run(jaccard_join._first_shared(str(len(a)), str(places[0]), str(len(b)), str(places[1]), percent))
    assert seen > 500


def test_components(spark):
    rng = random.Random(6)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(i, i + 1) for i in range(500, 700)] + [(0, i) for i in range(800, 900)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert got == brute.components_of(nodes, [x for x in links if x[0] != x[1]])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _lined(rng):
    pool = [f"This repeated line has number {i} " for i in range(8)] + ["short", "", "   ", "ÀÉ" * 10, "ab" * 9 + "c"]
    rows = []
    for i in range(120):
        lines = [rng.choice(pool) if rng.random() < 0.5 else f"line {rng.random()} of its own" for _ in range(rng.randrange(9))]
        rows.append((i, "\n".join(x.upper() if rng.random() < 0.2 else f" \t{x}\r" if rng.random() < 0.2 else x for x in lines)))
    return [*rows, (None, pool[0]), (None, "only nameless rows have this\n" * 2), (None, "only nameless rows have this"), (None, " only nameless rows have this"), (5, pool[0]), (200, None), (201, ""), (202, "x" * 200_000 + "\n" + pool[1])]


@pytest.mark.parametrize("options", [{}, {"shard_keys": 3}, {"shard_keys": 3, "broadcast_bytes": 0}])
def test_line_dedup(spark, options, tmp_path):
    rows = _lined(random.Random(8))
    _docs(spark, rows).repartition(3).write.parquet(str(tmp_path / "d"))
    got = line_dedup.dedup_lines(spark.read.parquet(str(tmp_path / "d")), **options)
    assert got.columns[-2:] == ["n_lines", "n_dropped"] and got.columns.count("n_lines") == 1
    rows_got = [(r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in got.collect()]
    assert sorted(rows_got, key=str) == sorted(brute.kept_lines(rows), key=str)
    assert [r.text for r in got.filter("doc_id = 200").collect()] == [None]


def test_line_dedup_empty(spark):
    assert line_dedup.dedup_lines(_docs(spark, [])).count() == 0
    assert line_dedup.dedup_lines(_docs(spark, []), broadcast_bytes=-1).count() == 0


def _sourced(rng):
    rows = []
    for i in range(400):
        source = rng.choice(["a"] * 6 + ["b", "c", "", "Z", None, "é"])
        rows.append((i, " ".join("w" for _ in range(rng.randrange(30))), source))
    return [*rows, (400, None, "a"), (401, "\t\n", "empty"), (402, "w " * 5000, "a"), (7, "w w w", "b"), (7, "w w w", "b"), (None, "w w", None)]


@pytest.mark.parametrize("weights", [(5, 2, 1), (1, 40), (1,)])
def test_mix(spark, weights):
    rows = _sourced(random.Random(3))
    got = mixture.mix(_docs(spark, rows, "doc_id long, text string, source string"), weights=weights).collect()
    want = brute.mix(rows, weights)
    form = lambda x: sorted((i, a, b, round(c, 6), d) if i is not None else (-1, a, b, round(c, 6), d) for i, a, b, c, d in x)
    assert form(got) == form(want)
    per = {}
    for (_, _, have, target, _), taken in zip(want, (r[4] for r in want), strict=True):
        per.setdefault((have, target), []).append(taken)
    assert all(abs(sum(t) - target) < 1 for (have, target), t in per.items())


def test_mix_empty(spark):
    assert mixture.mix(_docs(spark, [], "doc_id long, text string, source string")).count() == 0


def test_mixed_documents(spark, tmp_path):
    rows = [(i, (t or "").replace(" w", "  w\n") if t else t, s) for i, t, s in _sourced(random.Random(5))]
    docs = _docs(spark, rows, "doc_id long, text string, source string").withColumn("n_chars", F.length("text").cast("long"))
    docs.repartition(4).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    out = mixture.mixed_documents(docs)
    assert out.columns == docs.columns
    taken, texts = {}, {i: set() for i, *_ in rows}
    for i, t, _ in rows:
        texts[i].add(t)
    for r in out.collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len(brute.WORD.findall(r.text))
        assert any(t and t.startswith(r.text) for t in texts[r.doc_id]) and r.n_chars == len(r.text)
    want = {}
    for i, _, _, _, n in brute.mix(rows):
        want[i] = want.get(i, 0) + n
    assert taken == {i: n for i, n in want.items() if n}
