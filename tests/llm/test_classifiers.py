"""Both classifiers: held-out accuracy, odd rows, and what a score may depend on."""

import random
import zlib

import numpy as np
import pytest

from sideline.llm import quality, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, score double, predicted int"
BAD = ("grumble", "snarlish", "vexo", "moldy")


def _held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def _word(rng):
    return "".join(rng.choice(("ba", "do", "ti", "ru", "le", "no", "se", "mi")) for _ in range(rng.randrange(1, 5)))


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(1200):
        words = [_word(rng) for _ in range(rng.randrange(5, 120))]
        good, toxic = int(rng.random() < 0.7), int(rng.random() < 0.15)
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                words[rng.randrange(len(words))] = rng.choice(BAD) + rng.choice(("", "ing", ",", "!"))
        text = " ".join(words)
        rows.append((i, text if good else text.upper().replace(" ", "!! "), "en", "src", 9.0, 9))
        labels.append((i, good, toxic))
    rows += [(5000, None, None, None, None, None), (5001, "", "en", "x", 0.0, 0), (None, "ba do", "en", "x", 0.0, 0), (5002, "ba " * 100_000 + "x" * 100_000, "en", "x", 0.0, 0), rows[3]]
    labels += [(None, 1, 1), (7, None, None), (9999, 1, 0), labels[4]]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows, labels


def _check(scored, rows, labels, column, low):
    known = {r[0]: r[column] for r in labels if r[0] is not None and r[column] is not None}
    got = scored.collect()
    assert len(got) == len(rows) and scored.columns == ["doc_id", "held_out", "score", "predicted"]
    assert all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (r.doc_id is None or _held(r.doc_id)) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in known]
    assert sum(r.predicted == known[r.doc_id] for r in held) / len(held) >= low
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add(r.score)
    assert len(by[3]) == 1 and by[5000] == by[5001]


def test_quality(spark, corpus):
    docs, labels, rows, known = corpus
    model = quality.fit(labels, docs, settings=quality.Settings(buckets=1 << 14))
    _check(quality.scores(docs, model, quality.Settings(buckets=1 << 14)), rows, known, 1, 0.97)


@pytest.mark.parametrize("word", ["a", "x" * 126, "x" * 127, "aé漢😀" * 70, "\ud800b" * 90, "".join(map(chr, range(0x4E00, 0x4E00 + 20_000))) * 7])
def test_every_ngram_of_a_word_is_a_feature(word):
    framed = f"<{word}>"
    want = [f"={word}"] + [framed[i : i + n] for n in (3, 4, 5) for i in range(len(framed) - n + 1)]
    got = quality.features(word, 1 << 18, 3, 5)
    assert sorted(got.tolist()) == sorted(zlib.crc32(p.encode("utf-8", "surrogatepass")) % (1 << 18) for p in want)


def test_quality_of_texts_without_spaces(spark):
    """Only the middle of one long word tells the labels apart."""
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(400):
        good = i % 2
        middle = "".join(_word(rng) if good else _word(rng).upper() for _ in range(60))
        rows.append((i, "q" * 70 + middle + "z" * 70))
        labels.append((i, good))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality.fit(known, docs, settings=quality.Settings(buckets=1 << 14))
    got = [r for r in quality.scores(docs, model, quality.Settings(buckets=1 << 14), threshold=0.5).collect() if r.held_out]
    assert len(got) > 50 and all(r.predicted == r.doc_id % 2 for r in got)


def test_toxicity(spark, corpus):
    docs, labels, rows, known = corpus
    model = toxicity.fit(labels, docs)
    _check(toxicity.scores(docs, model), rows, known, 2, 0.95)


def test_nothing_is_learnt_from_the_held_out_fold(spark, corpus):
    docs, labels, _, known = corpus
    flipped = [(i, q if i is None or not _held(i) or q is None else 1 - q, t if i is None or not _held(i) or t is None else 1 - t) for i, q, t in known]
    other = spark.createDataFrame(flipped, labels.schema)
    small = quality.Settings(rows=200, buckets=1 << 12, epochs=1)
    a, b = (quality.fit(x, docs, settings=small) for x in (labels, other))
    assert (a == b).all()
    assert toxicity.fit(labels, docs) == toxicity.fit(other, docs)


def test_without_labels_or_documents(spark, corpus):
    docs, labels, _, _ = corpus
    for fit, scores in ((quality.fit, quality.scores), (toxicity.fit, toxicity.scores)):
        model = fit(labels.limit(0), docs)
        assert scores(docs.limit(5), model).count() == 5
        model = fit(labels, docs.limit(0))
        assert scores(docs.limit(0), model).count() == 0


def test_the_class_prior_correction_stays_non_negative():
    positive = [{"a", f"only{i}"} for i in range(40)]
    unlabelled = [{"a", "b"} if i % 10 == 0 else {"b", f"u{i}"} for i in range(400)]
    weights, bias = toxicity.train(positive, unlabelled, 0.1)
    assert weights["a"] > 0 > bias


def test_scores_are_those_of_a_plain_scorer(spark, corpus):
    docs, labels, rows, _ = corpus
    small = quality.Settings(rows=300, buckets=1 << 14, epochs=2)
    model = quality.fit(labels, docs, settings=small)
    toxic = toxicity.fit(labels, docs)
    assert toxic[0]
    odd = [(9000, "q" * 300 + "grumbling" * 40 + " snarlish,VEXO", "en", "x", 0.0, 0), (9001, "漢字" * 100 + " é grumble", "en", "x", 0.0, 0), (9002, "  \n", "en", "x", 0.0, 0)]
    some = [r for r in rows if len(r[1] or "") < 20_000] + odd
    frame = spark.createDataFrame(some, SCHEMA)
    plain = {(r[0], r[1]): (quality.score_text(r[1], model, small), toxicity.score_text(r[1], toxic)) for r in some}
    texts = {}
    for i, t, *_ in some:
        texts.setdefault(i, []).append((i, t))
    for at, scored in enumerate((quality.scores(frame, model, small), toxicity.scores(frame, toxic))):
        for r in scored.collect():
            assert any(abs(r.score - plain[k][at]) < 1e-9 for k in texts[r.doc_id])


@pytest.mark.parametrize("prior", [0.1, 0.9])
def test_risk_and_its_slope(prior):
    rng = np.random.default_rng(3)
    width = 12
    bags = [[np.unique(rng.integers(0, width, rng.integers(0, 6))) for _ in range(n)] for n in (9, 30)]
    positive, unlabelled = map(toxicity.batch_of, bags)

    def plain(theta, bias):
        mean = lambda texts, sign: np.mean([np.log1p(np.exp(-sign * (theta[b].sum() + bias))) for b in texts])
        return prior * mean(bags[0], 1), mean(bags[1], -1) - prior * mean(bags[0], -1)

    below = 0
    for scale in (0.1, 1, 30):
        for shift in (-40, 0, 5):
            theta, bias = rng.normal(0, scale, width), float(rng.normal(shift, scale))
            value, w, c = toxicity.risk(positive, unlabelled, theta, bias, prior)
            up, bracket = plain(theta, bias)
            below += bracket < 0
            assert np.isclose(value, up + max(0, bracket))
            # below zero the step goes up the bracket
            of = (lambda t, b: sum(plain(t, b))) if bracket >= 0 else (lambda t, b: -plain(t, b)[1])
            step = 1e-5
            for i in range(width):
                e = np.eye(width)[i] * step
                assert np.isclose((of(theta + e, bias) - of(theta - e, bias)) / (2 * step), w[i], atol=1e-5)
            assert np.isclose((of(theta, bias + step) - of(theta, bias - step)) / (2 * step), c, atol=1e-5)
    assert 0 < below < 9 or prior < 0.5


def test_the_driver_gets_no_texts(spark, corpus):
    """A bag of any text has at most one number per bucket."""
    small = quality.Settings(buckets=1 << 10)
    ids, n = quality.bag("word " * 50_000 + "x" * 50_000, quality.features_of_words(small), small)
    assert len(ids) <= 1 << 10 and n.sum() > 100_000


def test_features_reach_the_driver_packed(spark, corpus):
    """A fraction of a number per feature, and the same model."""
    s = quality.Settings()
    words = [f"w{i * i % 977}" for i in range(1500)]
    bags = [quality.bag(t, quality.features_of_words(s), s) for t in (None, "", "a", " ".join(words), "word " * 100_000)]
    rows = [quality.packed(*b) for b in bags]
    for (ids, n), row in zip(bags, rows, strict=True):
        back, times = quality.unpacked(row)
        assert back.tolist() == ids.tolist() and times.tolist() == n.tolist()
    assert len(rows[3]) < (bags[3][0].nbytes + bags[3][1].nbytes) / 3
    small, y = quality.Settings(epochs=1), [0, 1, 0, 1, 1]
    assert (quality.learn(quality.Packed(rows), y, small) == quality.learn(bags, y, small)).all()
