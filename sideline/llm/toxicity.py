"""Toxicity by non-negative learning from positive and unlabelled texts."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Hashable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sideline.functions.lineage import written
from sideline.llm import quality
from sideline.llm.common import LONGEST, Remembered, arrays, by_size, held_out
from sideline.llm.training import learning_ids, sampled, texts_of

_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> set[str]:
    """Distinct words in lower case, without punctuation."""
    return set(_WORD.findall((text or "").lower()))


@dataclass(frozen=True)
class Settings:
    """Bounds of the training: at most ``positive`` toxic rows and ``unlabelled`` other rows.

    Features are words and their character n-grams of ``low`` to ``high`` characters, hashed into
    ``buckets``. One counts if it is in ``least`` positive rows and ``least_share`` of them, and
    stands ``apart``, in large samples by more: ``effect`` times the root of the number of positive
    rows, so that a difference has to be large as well as certain. The ``words`` that stand out most are taken.
    """

    positive: int = 2000
    unlabelled: int = 8000
    least: int = 5
    least_share: float = 0.01
    apart: float = 5.0
    effect: float = 0.3
    words: int = 5000
    buckets: int = 1 << 20
    low: int = 4
    high: int = 6
    epochs: int = 40
    batch: int = 500
    step: float = 0.3
    decay: float = 1e-5
    seed: int = 5


def least_apart(n_positive: int, s: Settings) -> float:
    return max(s.apart, s.effect * n_positive**0.5)


def vocabulary(positive: list[set[Hashable]], unlabelled: list[set[Hashable]], s: Settings) -> list[Hashable]:
    """Features in a fair share of the positive texts whose shares in both samples are clearly apart.

    ``apart`` is measured in units of the spread that samples of these sizes have.
    """
    in_p, in_u = Counter(w for t in positive for w in t), Counter(w for t in unlabelled for w in t)
    n_p, n_u = max(1, len(positive)), max(1, len(unlabelled))
    least = max(s.least, s.least_share * n_p)

    def apart(w: Hashable) -> float:
        share = (in_p[w] + in_u[w]) / (n_p + n_u)
        return (in_p[w] / n_p - in_u[w] / n_u) / (share * (1 - share) * (1 / n_p + 1 / n_u) + 1e-12) ** 0.5

    found = [(apart(w), w) for w, n in in_p.items() if n >= least]
    return [w for z, w in sorted(found, key=lambda x: (-x[0], x[1])) if z >= least_apart(n_p, s)][: s.words]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


Batch = tuple[np.ndarray, np.ndarray, int]


def batch_of(bags: list[np.ndarray]) -> Batch:
    """(features, row of each, rows) of some texts."""
    return np.concatenate([np.empty(0, np.int64), *bags]), np.repeat(np.arange(len(bags)), [len(b) for b in bags]), len(bags)


def loss(batch: Batch, theta: np.ndarray, bias: float, sign: int) -> tuple[float, np.ndarray, float]:
    """Mean logistic loss of label ``sign`` over a batch, and its slope by weight and bias."""
    ids, rows, n = batch
    g = np.bincount(rows, theta[ids], n) + bias
    slope = -sign * _sigmoid(-sign * g) / n
    return float(np.logaddexp(0, -sign * g).mean()), np.bincount(ids, slope[rows], len(theta)), float(slope.sum())


def risk(positive: Batch, unlabelled: Batch, theta: np.ndarray, bias: float, prior: float) -> tuple[float, np.ndarray, float]:
    """Non-negative positive-unlabelled risk, and the direction a step goes against, by weight and bias.

    prior * E_P[l(g, +)] + max(0, E_U[l(g, -)] - prior * E_P[l(g, -)]). The bracket estimates the
    risk on negative texts without any. Where it falls below zero the model has begun to learn the
    positives by heart, and the step goes up the bracket's gradient instead of down the risk's.
    """
    up, up_w, up_b = loss(positive, theta, bias, 1)
    p, p_w, p_b = loss(positive, theta, bias, -1)
    u, u_w, u_b = loss(unlabelled, theta, bias, -1)
    bracket = u - prior * p
    if bracket >= 0:
        return prior * up + bracket, prior * up_w + u_w - prior * p_w, prior * up_b + u_b - prior * p_b
    return prior * up, prior * p_w - u_w, prior * p_b - u_b


def train(positive: list[set[Hashable]], unlabelled: list[set[Hashable]], prior: float, s: Settings = Settings()) -> tuple[dict[Hashable, float], float]:
    """(weight per feature, bias) of a logistic model on the presence of features.

    Goes against ``risk`` over mini-batches of both samples, with a little decay of the weights.
    Steps are scaled per weight by the root of the squares so far.
    """
    words = vocabulary(positive, unlabelled, s)
    place = {w: i for i, w in enumerate(words)}
    bags = [[np.fromiter((place[w] for w in t if w in place), np.int64) for t in texts] for texts in (positive, unlabelled)]
    theta, bias = np.zeros(len(words)), 0.0
    squares, bias_square = np.full(len(words), 1e-6), 1e-6
    if not positive or not unlabelled:
        return {}, float(np.log(prior / (1 - prior)))
    rng = np.random.default_rng(s.seed)
    rounds = max(1, len(unlabelled) // s.batch)
    for _ in range(s.epochs):
        order = rng.permutation(len(unlabelled))
        for b in range(rounds):
            u = batch_of([bags[1][i] for i in order[b * s.batch : (b + 1) * s.batch]])
            p = batch_of([bags[0][i] for i in rng.integers(0, len(positive), min(s.batch, len(positive)))])
            _, w, c = risk(p, u, theta, bias, prior)
            w = w + s.decay * theta
            squares += w * w
            bias_square += c * c
            theta -= s.step * w / np.sqrt(squares)
            bias -= s.step * c / np.sqrt(bias_square)
    return {w: float(t) for w, t in zip(words, theta, strict=True) if t}, float(bias)


def word_features(word: str, s: Settings) -> np.ndarray:
    """Buckets of a word and of all its n-grams between < and >, so that stems and inner parts count."""
    return quality.features(word, s.buckets, s.low, s.high)


def known_features(word: str, s: Settings, wanted: frozenset[int]) -> tuple[int, ...]:
    """Those of a word's features that are ``wanted``; a long word is hashed by numpy, in parts."""
    if len(word) > LONGEST:
        some = np.array(sorted(wanted), np.int64)
        return tuple({f for part in quality.pieces(word, s.buckets, s.low, s.high) for f in part[np.isin(part, some)].tolist()})
    crc, framed = zlib.crc32, f"<{word}>"
    found = {crc(f"={word}".encode("utf-8", "surrogatepass")) % s.buckets}
    if framed.isascii():
        data = framed.encode()
        for n in range(s.low, s.high + 1):
            found.update([crc(data[i : i + n]) % s.buckets for i in range(len(data) - n + 1)])
    else:
        for n in range(s.low, s.high + 1):
            found.update([crc(framed[i : i + n].encode("utf-8", "surrogatepass")) % s.buckets for i in range(len(framed) - n + 1)])
    return tuple(found & wanted)


def _of_texts(batches: Iterator[pa.RecordBatch], known: Remembered) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of the batches with the distinct features of each text."""
    for batch in batches:
        for rows in by_size(batch, "text"):
            yield rows, [np.unique(np.concatenate([np.empty(0, np.int64), *map(known.__getitem__, words_of(t.as_py()))])) for t in rows.column("text")]


def _counted(s: Settings):
    """In how many texts of both samples each feature is; every task adds its own up first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Remembered(lambda word: word_features(word, s), lambda value: 200 + value.nbytes)
        times = np.zeros((2, s.buckets), np.int64)
        for rows, held in _of_texts(batches, known):
            for p, found in zip(rows.column("p").to_pylist(), held, strict=True):
                times[int(p), found] += 1
        used = np.flatnonzero(times.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(times[1, used]), pa.array(times[0, used])], names=["feature", "in_p", "in_u"])

    return run


def _looked_up(s: Settings, shared):
    """The features of every text that are in ``shared``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = frozenset(shared.value)
        known = Remembered(lambda word: np.array(known_features(word, s, wanted), np.int64), lambda value: 250 + value.nbytes)
        for rows, held in _of_texts(batches, known):
            yield pa.RecordBatch.from_arrays([rows.column("id"), rows.column("p"), arrays(held, pa.int64())], names=["id", "p", "held"])

    return run


def fit(labels: DataFrame, docs: DataFrame, column: str = "toxic", settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"):
    """Train on bounded samples outside the held-out fold.

    Positives are rows labelled 1. The unlabelled sample is drawn from all documents of the learning
    fold whatever their label, which it does not see. The class prior is the share of label 1 among
    all labelled rows of the fold.

    Texts stay in the tasks. Spark counts in how many texts of both samples each feature is; those
    that count (at most ``settings.words``) are looked up again in each text, and the driver gets
    their numbers. A document labelled twice counts by its larger label, of rows that share an id the smallest text; rows with
    null ids or labels are not learnt from. Without rows of both kinds the score is the prior.
    """
    known = learning_ids(labels, column, id_col)
    n, ones = known.agg(F.count(F.lit(1)), F.sum("y")).first()
    prior = min(0.9, max(0.001, (ones or 0) / max(1, n)))
    everyone = docs.filter(F.col(id_col).isNotNull() & ~held_out(F.col(id_col))).select(F.col(id_col).alias("id"))
    marked = sampled(known.filter("y = 1"), settings.positive).select("id", F.lit(True).alias("p"))
    others = sampled(everyone.distinct(), settings.unlabelled).select("id", F.lit(False).alias("p"))
    texts = written(texts_of(marked.unionByName(others), docs, id_col, text_col), "toxic-texts")
    size = {r.p: r["count"] for r in texts.groupBy("p").count().collect()}
    n_p, n_u = max(1, size.get(True, 0)), max(1, size.get(False, 0))
    counts = texts.mapInArrow(_counted(settings), "feature long, in_p long, in_u long").groupBy("feature").agg(F.sum("in_p").alias("in_p"), F.sum("in_u").alias("in_u"))
    share = f"((in_p + in_u) / {n_p + n_u}D)"
    counts = counts.withColumn("apart", F.expr(f"(in_p / {n_p}D - in_u / {n_u}D) / sqrt({share} * (1 - {share}) * {1 / n_p + 1 / n_u!r}D + 1e-12D)"))
    fair = counts.filter(f"in_p >= {max(settings.least, settings.least_share * n_p)!r} AND apart >= {least_apart(n_p, settings)!r}")
    chosen = sorted(r.feature for r in fair.orderBy(F.desc("apart"), "feature").limit(settings.words).collect())
    shared = docs.sparkSession.sparkContext.broadcast(chosen)
    rows = texts.mapInArrow(_looked_up(settings, shared), "id long, p boolean, held array<long>").orderBy("p", "id").collect()
    return train([set(r.held) for r in rows if r.p], [set(r.held) for r in rows if not r.p], prior, settings)


def score_text(text: str | None, model, settings: Settings = Settings()) -> float:
    """Score of one text, in plain steps: features that the model knows, their weights, the sigmoid."""
    weights, bias = model
    held = {int(f) for w in words_of(text) for f in word_features(w, settings)}
    return float(1 / (1 + np.exp(-np.clip(bias + sum(weights[f] for f in sorted(held & weights.keys())), -50, 50))))


def scores(
    docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3,
    settings: Settings = Settings(),
) -> DataFrame:
    """Score (0 to 1, of label 1) and prediction of every whole text.

    Columns: id, held_out, score, predicted. Null and empty texts have no features: their score comes
    from the bias. Rows with a null id are scored and count as held out; repeated rows are scored
    each. Words of any length give all their n-grams, a long one in parts; a worker remembers the
    known features of the words it has seen, in a bounded memory. An empty table gives no rows. Other columns are not read, so names may clash.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights, bias = shared.value
        wanted = frozenset(weights)
        known = Remembered(lambda word: known_features(word, settings, wanted), lambda value: 200 + 36 * len(value))
        for part in parts:
            g = [bias + sum(map(weights.__getitem__, sorted(set().union(*map(known.__getitem__, words_of(t)))))) for t in part]
            yield pd.Series(1 / (1 + np.exp(-np.clip(g, -50, 50))), dtype=np.float64)

    scored = docs.select(F.col(id_col), score(F.col(text_col)).alias("score"))
    return scored.select(
        id_col, held_out(F.col(id_col)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
