"""Importance resampling against plain Python, and its open-addressed table."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from sideline.llm import importance
from tests.llm import brute

SCHEMA = "doc_id long, text string, rank int, score string, weight int, _doc int, n_words int, _slice int"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text, n=2):
    words = WORD.findall(brute.lower(text or ""))
    return words, [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def drawn(rows, target, percent=25, least=20, n=2, buckets=10_000, seed=7):
    of = lambda g: zlib.crc32(g.encode()) % buckets
    source, wanted = (Counter(of(g) for t in texts for g in grams(t, n)[1]) for texts in ([t for _, t in rows], target))
    s_all, t_all = sum(source.values()) + buckets, sum(wanted.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log((wanted[b] + 1) * s_all / ((source[b] + 1) * t_all)))
    out = []
    for i, t in rows:
        words, found = grams(t, n)
        weight = sum(gain(of(g)) for g in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296.0)))
        out.append([i, len(found), weight, score, None, len(words)])
    fit = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1], r[5]))
    for rank, r in enumerate(fit[: percent * len(fit) // 100], 1):
        r[4] = rank
    return out


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    words = ["ab", "AB", "c-d", "漢字", "É", "x" * 40, "y" * 70, "7up", "a_b", "it's"] + [f"long{i}" for i in range(60)]
    out = [None, "", "--- !", "a", " a b a B\n"]
    out += [" ".join(rng.choice(words) for _ in range(rng.randrange(80))) for _ in range(150)]
    return out + ["ab " * 30_000, "z" * 50_000 + " ab " * 25, out[20], out[20]]


@pytest.mark.parametrize("size", [7, 100, 1 << 20])
@pytest.mark.parametrize("n", [1, 2, 3])
def test_blocks_hold_every_ngram_once(texts, n, size):
    some = [t for t in texts if len(t or "") < 5000]
    found, words = [Counter() for _ in some], Counter()
    for of_words, rows, table in importance.interned([None if t is None else t.encode() for t in some], n, 10_000, size):
        words.update(of_words.tolist())
        for row, slot in zip(rows.tolist(), table.slots.tolist(), strict=True):
            found[row][int(table.bucket[slot])] += 1
    for i, t in enumerate(some):
        plain, want = grams(t, n)
        assert words[i] == len(plain)
        assert found[i] == Counter(zlib.crc32(g.encode()) % 10_000 for g in want)


def test_hashes_and_equal_keys(texts):
    data, starts, ends, _ = importance.words_in([t.encode() for t in texts if t])
    stretches = importance.Stretches(data, starts, ends)
    words = [data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
    assert stretches.xxh64().tolist() == [xxhash.xxh64_intdigest(w) for w in words]
    assert stretches.crc32(np.arange(len(words))).tolist() == [zlib.crc32(w) for w in words]
    # keys that say nothing: only the bytes tell n-grams apart
    table = importance.Table(stretches, np.array([len(w) % 3 for w in words], np.uint64), 97)
    different = len(set(words))
    assert len(set(zip(words, table.slots.tolist(), strict=True))) == len(set(table.slots.tolist())) == different
    assert Counter(words).total() == table.count.sum() and sorted(Counter(words).values()) == sorted(table.count[table.count > 0])


@pytest.mark.parametrize(("percent", "least", "n", "buckets"), [(25, 20, 2, 10_000), (100, 0, 3, 50), (10, 5, 1, 7)])
def test_resample(spark, texts, percent, least, n, buckets):
    rows = [(i * 3 % 101 if i != 17 else None, t) for i, t in enumerate(texts)]
    target = [*texts[30:60], None, ""]
    docs = spark.createDataFrame([(*r, *[None] * 6) for r in rows], SCHEMA).repartition(5)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resample(docs, wanted, percent, least, n, buckets)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank", "n_words"]
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, drawn(rows, target, percent, least, n, buckets)), key=key)


def test_empty_tables(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts[:40])], "doc_id long, text string")
    nothing = docs.limit(0)
    assert importance.resample(nothing, docs).count() == 0
    got = importance.resample(docs, nothing).collect()
    assert len(got) == 40 and sorted(tuple(r) for r in got if r.rank) == sorted(tuple(r) for r in drawn([(i, t) for i, t in enumerate(texts[:40])], []) if r[4])


def test_a_draw_prefers_the_target(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(("red", "green", "blue") if i % 2 else ("one", "two", "three")) for _ in range(40))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([("red green blue green red",)] * 50, "text string")
    ids = [r.doc_id for r in importance.resample(docs, target).filter("rank IS NOT NULL").collect()]
    assert len(ids) == 100 and sum(i % 2 for i in ids) > 85
