"""N-best segmentation against all segmentations, and exact round trips."""

import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sideline.llm import piece_lattice as P

TEXTS = [None, "", " ", "  two  spaces ", "line\nend\r\n", "▁ literal ▁▁", "\0\x01", "日本語 𝒳 é", "x" * 20_000, "word " * 20_000, "\n\n", "a"]


def _toy(scores):
    ids = {p: 300 + i for i, p in enumerate(scores)}
    starts = frozenset(p[:n] for p in ids for n in range(1, len(p)))
    return P.Pieces(ids, scores, tuple(range(256)), (), min(scores.values()) - 10, starts, None)


def _all(text, scores, unknown):
    out = []
    for cuts in itertools.product((0, 1), repeat=max(0, len(text) - 1)):
        parts, at = [], 0
        for i, c in enumerate((*cuts, 1), 1):
            if c:
                parts.append(text[at:i])
                at = i
        if all(p in scores or len(p) == 1 for p in parts):
            out.append(sum(scores.get(p, unknown) for p in parts))
    return sorted(out, reverse=True)


@pytest.mark.parametrize("seed", range(25))
def test_n_best_against_all_segmentations(seed):
    rng = random.Random(seed)
    scores = {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 5))): -float(rng.randrange(1, 60)) for _ in range(15)}
    toy = _toy(scores)
    text = "".join(rng.choice("abcd") for _ in range(rng.randrange(1, 11)))
    best = P.best_segmentations(text, toy, 6)
    assert np.allclose([s for s, _ in best], _all(text, scores, toy.unknown)[:6])
    assert len({tuple(ids) for _, ids in best}) == len(best)


def test_document_from_parts():
    rng = random.Random(1)
    for count in (1, 2, 5):
        parts = [sorted(((-float(rng.randrange(50)), np.array([i, j])) for j in range(rng.randrange(1, count + 1))), key=lambda x: -x[0]) for i in range(6)]
        want = sorted((sum(p[c][0] for p, c in zip(parts, cs, strict=True)) for cs in itertools.product(*[range(len(p)) for p in parts])), reverse=True)[:count]
        assert np.allclose([s for s, _ in P.best_of_document(parts, count)], want)


@pytest.fixture(scope="module")
def pieces():
    return P.Pieces.load()


def test_parts_lose_nothing(pieces):
    # the best of the whole text is the best of its parts
    for text in ("the cat sat\non  the mat", "a▁b c", " x"):
        marked = "".join(P.segments(text, pieces))
        whole = P.best_segmentations(marked, pieces, 3)
        parts = [[(s, np.array(i)) for s, i in P.best_segmentations(p, pieces, 3)] for p in P.segments(text, pieces)]
        assert np.allclose([s for s, _ in whole], [s for s, _ in P.best_of_document(parts, 3)])


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=40))
def test_round_trip(text):
    model = _MODEL or _load()
    ids = [i for p in P.segments(text, model) for i in P.best_segmentations(p, model, 1)[0][1]] if text else []
    assert P.decode_ids(ids, model) == text


_MODEL = None


def _load():
    global _MODEL
    _MODEL = P.Pieces.load()
    return _MODEL


def test_encode_and_decode(spark, pieces):
    docs = spark.createDataFrame([(i if i != 3 else None, t, 1, 2) for i, t in enumerate(TEXTS + TEXTS[3:5])], "doc_id long, text string, _x int, score int")
    done = P.encode(docs, 3, keep=("doc_id", "text"))
    rows = done.withColumn("back", P.decode(done.ids[0], spark)).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        assert r.back == (r.text or "") and len(r.ids) == len(r.scores) >= 1 and r.scores == sorted(r.scores, reverse=True)
        assert (r.text or "") != "" or r.ids == [[]]
    short = next(r for r in rows if r.text == "a")
    assert short.scores == [s for s, _ in P.best_segmentations("▁a", pieces, 3)]
    assert P.encode(docs.limit(0)).count() == 0
    assert docs.select(P.decode(P.F.lit(None).cast("array<int>"), spark).alias("t")).first().t is None
