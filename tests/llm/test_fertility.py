"""Quality rules against plain Python; tokeniser measures against the tokenisers themselves."""

import random
import re
from collections import Counter
from statistics import quantiles

import numpy as np
import pytest
from pyspark.sql import functions as F

from sideline.llm import fertility
from tests.llm.brute import WORD

SCHEMA = "doc_id long, text string, lang string, band string, tokens_0 int, kept string, _class int, outside string"


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(inside)


def plain_fertility(text, vocabulary):
    ids = [i for part in vocabulary.ids(text) for i in part]
    if not ids:
        return 0, 0, 0, 0
    share = np.array(list(Counter(ids).values())) / len(ids)
    single = sum(bool(vocabulary.fallback[i]) for i in ids)
    return len(ids), 1000 * len(text) // len(ids), 10_000 * single // len(ids), round(1000 * float(-(share * np.log2(share)).sum()))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    words = ["the", "and", "over", "Haus", "größe", "river", "stone", "mend"]
    texts = [None, "", " \n\t", "one", "a b a b a b a b a b", "漢字かな " * 30, "x" * 5000, "# * $\n# * $\n\n  \n# * $ |<>&%",
             "a b  c a b  c a b  c", "😀\U00010348 " * 40, "same line\n" * 40, "same line\n same line\nsame line"]
    for _ in range(120):
        lines = [" ".join(rng.choice(words) + rng.choice(("", ",", ".")) for _ in range(rng.randrange(4, 12))) for _ in range(rng.randrange(8, 20))]
        texts.append("\n".join(lines))
    for _ in range(8):
        texts.append(" ".join("#%$&"[rng.randrange(4)] * 3 + rng.choice(words).upper() for _ in range(120)))
    out = [(i, t, ("en", "de", None, "")[i % 4] if i < 12 else "en") for i, t in enumerate(texts)]
    return out + [(None, texts[20], "en"), (30, texts[30], "en"), (30, texts[31], "en")]


@pytest.mark.parametrize("block", [16, 1 << 20])
def test_base_counts(rows, block, monkeypatch):
    monkeypatch.setattr(fertility, "_BLOCK", block)
    for _, text, _ in rows:
        assert fertility.base_counts((text or "").encode()) == plain_counts(text)


def test_many_different_words():
    rng = random.Random(3)
    words = [f"w{rng.randrange(40_000)}" for _ in range(60_000)]
    text = " ".join(words + words[100:300])
    assert fertility.base_counts(text.encode()) == plain_counts(text)


def test_fertility_of_a_text(rows):
    for path in fertility.VOCABULARIES:
        with open(path, "rb") as file:
            vocabulary = fertility._vocabulary(path, file.read())
        for _, text, _ in rows:
            assert fertility.fertility(text or "", vocabulary) == plain_fertility(text or "", vocabulary)
    assert fertility.fertility("漢字" * 50, vocabulary)[2] > 0 == fertility.fertility("the river", vocabulary)[2]


def test_a_long_text_goes_in_parts(monkeypatch):
    path = fertility.VOCABULARIES[0]
    with open(path, "rb") as file:
        vocabulary = fertility._vocabulary(path, file.read())
    text = "the river over stone " * 400
    whole = fertility.fertility(text, vocabulary)
    monkeypatch.setattr(fertility, "_BLOCK", 1000)
    assert fertility.fertility(text, vocabulary) == whole


def test_scripts():
    for text, name in (("abc", "latin"), ("привет abc", "cyrillic"), ("漢字漢字かな", "han"), ("12 !", "none"), ("ελλ", "greek"), ("ไทย", "thai"), ("한글", "hangul"), ("", "none")):
        assert fertility.script_of(text) == name


def test_judge_against_plain_bands(spark, rows):
    docs = spark.createDataFrame([(*r, *[None] * 5) for r in rows], SCHEMA).repartition(4)
    got = fertility.judge(docs, width=1.5, least=10).collect()
    vocabularies = []
    for path in fertility.VOCABULARIES:
        with open(path, "rb") as file:
            vocabularies.append(fertility._vocabulary(path, file.read()))
    names = [f"{m}_{v}" for v in (0, 1) for m in ("chars", "fallback", "entropy")]
    made = []
    for i, t, lang in rows:
        a, b = (plain_fertility(t or "", v) for v in vocabularies)
        made.append((i, t, lang or f"script {fertility.script_of(t or '')}", int(np.log2(max(1, a[0])) // 2), a[0], (*a[1:], *b[1:])))
    want = []
    for i, t, band, size, tokens, values in made:
        peers = {m[5] for m in made if m[2:4] == (band, size) and m[4]}
        out = []
        for at, name in enumerate(names):
            if tokens and len(peers) >= 10:
                low, _, high = quantiles([p[at] for p in peers], n=4, method="inclusive")
                reach = 1.5 * max(high - low, 0.02 * (low + high) / 2, 1)
                if values[at] > high + reach or not name.startswith("fallback") and values[at] < low - reach:
                    out.append(name)
        counts = plain_counts(t)
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        want.append((i, *counts, failed, not failed and not out, band, out))
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got)
    assert any(r.outside for r in got) and any(r.kept for r in got)
    assert not any(r.kept for r in got if r.doc_id in range(132, 140))


def test_without_rows_or_language(spark, rows):
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    assert fertility.judge(docs.limit(0)).count() == 0
    assert fertility.judge(docs).count() == len(rows)


def test_copies_do_not_narrow_a_band(spark, rows):
    """A third of all rows are one text; other texts are judged as without it."""
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    copies = spark.range(1000, 1070).select("id", F.lit(rows[40][1]), F.lit("en"))
    verdicts = lambda df: {r.doc_id: r.kept for r in fertility.judge(df).collect() if r.doc_id is not None and r.doc_id < 1000}
    assert verdicts(docs.union(copies)) == verdicts(docs)


def test_repeated_words_are_found_without_numbering_runs(monkeypatch):
    """Runs are compared as one number, sorted once; only numbers beyond 63 bits are made small before."""
    rng = random.Random(3)
    asked, real = [], np.unique
    monkeypatch.setattr(np, "unique", lambda *a, **k: asked.append(1) or real(*a, **k))
    for run, alphabet, size in ((3, 4, 40), (3, 50, 900), (2, 3, 9), (3, 2, 3), (9, 900, 2500)):
        words = [f"w{rng.randrange(alphabet)}" for _ in range(size)] + [f"w{i % 5}" for i in range(30)]
        at = [tuple(words[i : i + run]) for i in range(len(words) - run + 1)]
        times = Counter(at)
        inside = {i + j for i, x in enumerate(at) if times[x] > 1 for j in range(run)}
        asked.clear()
        assert fertility.repeated_words(" ".join(words).encode(), run) == (len(words), len(inside))
        assert bool(asked) == (run == 9)
    assert fertility.repeated_words(b"a b c d e f") == (6, 0)
