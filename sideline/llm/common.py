"""Helpers that several of these operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as the contracts of the operators write it
SPACE = r"\x20\x09-\x0D"
#: bytes that one Python worker spends on remembering words, about; longer words are not remembered
REMEMBERED, LONGEST = 96 << 20, 200


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out(id_: Column) -> Column:
    """The fold that no classifier learns from; a row without an id belongs to it too."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def byte_words(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case and every other byte as it is."""
    return text.encode("utf-8", "surrogatepass").lower().split()


class Remembered(dict):
    """A value per word, computed once while it is remembered.

    Takes about ``most`` bytes: when half of them are used, the words of the half
    before are forgotten, unless they came up again. ``weight`` is what a value and its entry take,
    beside the word.
    """

    def __init__(self, make, weight=lambda value: 200, most: int = REMEMBERED):
        self.make, self.weight, self.most, self.before, self.used = make, weight, most, {}, 0

    def __missing__(self, word):
        value = self.before.pop(word, None)
        if value is None:
            value = self.make(word)
            if len(word) > LONGEST:
                return value
        self.used += len(word) + self.weight(value)
        if self.used > self.most // 2:
            self.before, self.used = dict(self), 0
            self.clear()
        self[word] = value
        return value


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes() -> Remembered:
    return Remembered(xxhash.xxh3_64_intdigest)


def shingles(words: list[bytes], n: int, hashes: Remembered) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of ``n`` words; of fewer words, one of all."""
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(n, len(h))
    run = np.full(len(h) - size + 1, size, np.uint64)
    for i in range(size):
        run = run * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - size + 1 + i]
    return np.unique(mixed(run))


def arrays(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list column from one array per row."""
    ends = np.cumsum([0, *map(len, values)])
    flat = np.concatenate(values) if len(values) else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))


def list_rows(column: pa.Array) -> list[np.ndarray]:
    """One array per row of a list column without nulls."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False))
    return np.split(flat, ends[:-1]) if len(ends) else []


def by_size(batch: pa.RecordBatch, column: str, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices of about ``size`` bytes of a text column, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(at, end - at)
        at = end


def each_batch(make, size: int | None = None) -> object:
    """A function for ``mapInArrow`` from one that turns a batch into a batch; by ``size`` bytes of text, if given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if size:
                yield from map(make, by_size(batch, "_text", size))
            elif batch.num_rows:
                yield make(batch)

    return run
