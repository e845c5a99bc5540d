"""Quality classifier: averaged subword embeddings with a softmax, trained in numpy."""

from __future__ import annotations

import operator
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sideline.llm.common import Remembered, by_size, held_out
from sideline.llm.training import learning_ids, sampled, texts_of

#: a word of more characters is hashed by numpy, this many of its characters at a time after the
#: first, and is not remembered
_LONG, _CHUNK = 128, 1 << 16


#: features that stand for a word that follows itself, each time; and for any text, so that a few
#: words alone say little
_SAME, _SAME_TIMES = "<same word>", 3
_TEXT, _TEXT_TIMES = "<text>", 30


def bucket(part: str, buckets: int) -> int:
    return zlib.crc32(part.encode("utf-8", "surrogatepass")) % buckets


def repeats(words: list[str]) -> int:
    """How often a word follows itself."""
    return sum(map(operator.eq, words, words[1:]))


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)
    return t


_CRC = _crc_table()


def _gram_buckets(text: str, buckets: int, low: int, high: int, starts: int) -> np.ndarray:
    """``bucket`` of the n-grams at the first ``starts`` characters: CRC32 of all at once, by numpy."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    first = np.flatnonzero((data & 0xC0) != 0x80)
    size = np.diff(np.append(first, len(data)))
    crc, out = np.full(min(starts, len(first)), 0xFFFFFFFF, np.uint32), []
    for n in range(min(high, len(first))):
        # state of each start that has n + 1 characters, taken on by the bytes of the last of them
        crc = crc[: len(first) - n]
        at, left = first[n : n + len(crc)], size[n : n + len(crc)]
        for i in range(int(left.max(initial=0))):
            has = left > i
            crc[has] = _CRC[(crc[has] ^ data[at[has] + i]) & 0xFF] ^ (crc[has] >> 8)
        if n + 1 >= low:
            out.append((crc ^ np.uint32(0xFFFFFFFF)).astype(np.int64) % buckets)
    return np.concatenate(out) if out else np.empty(0, np.int64)


def pieces(word: str, buckets: int, low: int, high: int) -> Iterator[np.ndarray]:
    """The features of a word in parts of bounded size, every n-gram in one of them."""
    framed = f"<{word}>"
    if len(framed) <= _LONG:
        parts = [f"={word}"]
        for n in range(low, high + 1):
            parts += [framed[i : i + n] for i in range(len(framed) - n + 1)]
        yield np.array([bucket(p, buckets) for p in parts], np.int64)
        return
    yield np.array([bucket(f"={word}", buckets)], np.int64)
    for at in range(0, len(framed), _CHUNK):
        yield _gram_buckets(framed[at : at + _CHUNK + high - 1], buckets, low, high, _CHUNK)


def features(word: str, buckets: int, low: int, high: int) -> np.ndarray:
    """Buckets of a word: the word itself and all its character n-grams between < and >."""
    return np.concatenate(list(pieces(word, buckets, low, high)))


@dataclass(frozen=True)
class Settings:
    """Bounds and step sizes of the training; ``rows`` is the most labelled rows it reads."""

    rows: int = 4000
    buckets: int = 1 << 18
    width: int = 12
    low: int = 3
    high: int = 5
    epochs: int = 6
    step: float = 2.0
    seed: int = 17


def bag(text: str | None, made: Remembered, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Features of a text and how often each occurs: words, n-grams, repeats and the constant one."""
    words = (text or "").split()
    held = np.zeros(s.buckets, np.int32)
    for w in words:
        for part in [made[w]] if len(w) <= _LONG else pieces(w, s.buckets, s.low, s.high):
            np.add.at(held, part, 1)
    held[bucket(_SAME, s.buckets)] += _SAME_TIMES * repeats(words)
    held[bucket(_TEXT, s.buckets)] += _TEXT_TIMES
    ids = np.flatnonzero(held).astype(np.int32)
    return ids, held[ids]


def packed(ids: np.ndarray, n: np.ndarray) -> bytes:
    """``bag`` of a text in a few bits: gaps between the ids and the counts, compressed byte by byte of equal weight."""
    numbers = np.concatenate([np.diff(ids, prepend=np.int32(0)), n]).astype("<i4")
    return zlib.compress(numbers.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    weights = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    gaps, n = np.ascontiguousarray(weights.T).view("<i4").reshape(2, -1)
    return np.cumsum(gaps, dtype=np.int32), n


class Packed(Sequence):
    """Bags that are unpacked one at a time, when they are asked for."""

    def __init__(self, rows: Sequence[bytes]):
        self.rows = rows

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, at: int) -> tuple[np.ndarray, np.ndarray]:
        return unpacked(self.rows[at])


def features_of_words(s: Settings) -> Remembered:
    return Remembered(lambda w: features(w, s.buckets, s.low, s.high), lambda value: 200 + value.nbytes)


def train(texts: list[str], y: list[int], s: Settings = Settings()) -> np.ndarray:
    """``learn`` from texts."""
    made = features_of_words(s)
    return learn([bag(t, made, s) for t in texts], y, s)


def learn(bags: Sequence[tuple[np.ndarray, np.ndarray]], y: list[int], s: Settings = Settings()) -> np.ndarray:
    """Weight per bucket: the log-odds of label 1 is the mean weight of a text's features.

    Features are the hashed words, their character n-grams, one for each word that follows itself,
    and a constant one.

    The embeddings of a document's features are averaged and go through a softmax over both labels;
    stochastic gradient descent runs over single documents in a fixed random order with a linearly
    falling step. Both labels have the same total weight. As the model is linear after averaging,
    embedding and output weights of the trained model fold into one number per bucket.
    """
    share = max(1, sum(y)), max(1, len(y) - sum(y))
    weight = [len(y) / (2 * share[0 if v else 1]) for v in y]
    rng = np.random.default_rng(s.seed)
    vectors = rng.uniform(-1 / s.width, 1 / s.width, (s.buckets, s.width)).astype(np.float32)
    out = rng.normal(0, 0.1, (2, s.width)).astype(np.float32)
    total, at = s.epochs * max(1, len(bags)), 0
    for _ in range(s.epochs):
        for d in rng.permutation(len(bags)):
            step = s.step * (1 - at / total) * min(weight[d], 4.0)
            at += 1
            ids, n = bags[d]
            n = (n / n.sum()).astype(np.float32)
            hidden = n @ vectors[ids]
            logits = out @ hidden
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[y[d]] -= 1
            back = p @ out
            out -= step * np.outer(p, hidden)
            vectors[ids] -= step * np.outer(n, back)
    return (vectors @ (out[1] - out[0])).astype(np.float64)


def fit(labels: DataFrame, docs: DataFrame, column: str = "quality", settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"):
    """Train on a bounded number of labelled rows outside the held-out fold, half of each label.

    A document labelled twice counts by its larger label; of rows that share an id the smallest text
    counts. Rows with null ids or labels are not learnt from, null and empty texts have the constant
    feature only. Without rows all scores are 0.5.
    """
    known = learning_ids(labels, column, id_col)
    half = settings.rows // 2
    ids = sampled(known.filter("y = 1"), half).unionByName(sampled(known.filter("y = 0"), half))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = features_of_words(settings)
        for batch in batches:
            for rows in by_size(batch, "text"):
                held = [packed(*bag(t.as_py(), made, settings)) for t in rows.column("text")]
                yield pa.RecordBatch.from_arrays([rows.column("id"), rows.column("y"), pa.array(held, pa.binary())], names=["id", "y", "bag"])

    # the driver gets packed features, a small part of a text's size, and no texts
    found = texts_of(ids, docs, id_col, text_col).select("id", "y", "text").mapInArrow(run, "id long, y int, bag binary").toArrow().sort_by("id")
    return learn(Packed(found.column("bag").to_pylist()), found.column("y").to_pylist(), settings)


def score_text(text: str | None, model: np.ndarray, s: Settings = Settings()) -> float:
    """Score of one text, in plain steps: the mean weight of its features, then the sigmoid."""
    words = (text or "").split()
    ids = [i for w in words for i in features(w, s.buckets, s.low, s.high).tolist()]
    ids += [bucket(_SAME, s.buckets)] * (_SAME_TIMES * repeats(words)) + [bucket(_TEXT, s.buckets)] * _TEXT_TIMES
    return float(1 / (1 + np.exp(-np.clip(sum(model[i] for i in ids) / len(ids), -50, 50))))


def score_of(spark: SparkSession, text: Column, model, settings: Settings = Settings()) -> Column:
    """Score (0 to 1, of label 1) of a whole text.

    The model reaches the tasks as one array of fixed size. A worker remembers the sum and the
    number of features of the words it has seen. Null and empty texts have the constant feature only.
    """
    shared = spark.sparkContext.broadcast((model, settings))

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights, s = shared.value
        same, any_text = (times * weights[bucket(part, s.buckets)] for part, times in ((_SAME, _SAME_TIMES), (_TEXT, _TEXT_TIMES)))

        def word(w: str) -> tuple[float, int]:
            total, count = 0.0, 0
            for ids in pieces(w, s.buckets, s.low, s.high):
                total, count = total + float(weights[ids].sum()), count + len(ids)
            return total, count

        known = Remembered(word)

        def logit(text: str | None) -> float:
            words = (text or "").split()
            pairs = [known[w] if len(w) <= _LONG else word(w) for w in words]
            again = repeats(words)
            total = sum(p[0] for p in pairs) + again * same + any_text
            return total / (sum(p[1] for p in pairs) + again * _SAME_TIMES + _TEXT_TIMES)

        for part in parts:
            yield pd.Series(1 / (1 + np.exp(-np.clip([logit(t) for t in part], -50, 50))), dtype=np.float64)

    return score(text)


def scores(
    docs: DataFrame, model, settings: Settings = Settings(), id_col: str = "doc_id",
    text_col: str = "text", threshold: float = 0.7,
) -> DataFrame:
    """id, held_out, score and predicted of every row.

    Rows with a null id are scored and count as held out; repeated rows are scored each, an empty
    table gives no rows. Other columns are not read, so their names may clash.
    """
    scored = docs.select(F.col(id_col), score_of(docs.sparkSession, F.col(text_col), model, settings).alias("score"))
    return scored.select(
        id_col, held_out(F.col(id_col)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
