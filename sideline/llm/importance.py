"""Importance resampling of documents towards a target distribution of hashed word n-grams."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sideline.functions.lineage import written
from sideline.operators.ranking import number_rows

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: bytes of words after A-Z became lower case: digits, a-z and all of characters beyond ASCII
_IN_WORD = np.isin(np.arange(256), [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
_OUTSIDE = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
#: bytes of text whose n-grams are interned together
_BLOCK = 1 << 20


#: fixed values: the five multipliers of the 64-bit xxHash, and the reversed polynomial of CRC-32
_P1, _P2, _P3, _P4, _P5 = map(np.uint64, (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
_POLYNOMIAL = np.uint32(0xEDB88320)
#: stretches of fewer bytes are hashed by numpy, all of one length at once; others one by one
_SHORT = 32


def _crc_table() -> np.ndarray:
    rest = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        rest = (rest >> 1) ^ (rest & 1) * _POLYNOMIAL
    return rest


_CRC = _crc_table()


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


class Stretches:
    """Stretches ``starts``..``ends`` of ``data``, read eight bytes at a time."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.raw, self.starts, self.sizes = data.tobytes(), starts, ends - starts
        # the eight bytes from every place on as one number, also past the end
        self._eights = np.ndarray((len(data) + 1,), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))

    def _by(self, some: np.ndarray, short: Callable, long: Callable, kind: type) -> np.ndarray:
        """A value per stretch of ``some``: ``short`` by size, for all of a size at once, or ``long``."""
        out, sizes = np.empty(len(some), kind), self.sizes[some]
        order = np.argsort(sizes, kind="stable")
        for size in range(1, _SHORT):
            of_size = order[slice(*np.searchsorted(sizes, (size, size + 1), sorter=order))]
            if len(of_size):
                out[of_size] = short(self.starts[some[of_size]], size)
        for i in order[np.searchsorted(sizes, _SHORT, sorter=order):].tolist():
            a, n = self.starts[some[i]], sizes[i]
            out[i] = long(self.raw[a : a + n])
        return out

    def xxh64(self) -> np.ndarray:
        """64-bit xxHash of every stretch, as the xxhash package gives it."""

        def short(at: np.ndarray, size: int) -> np.ndarray:
            h = np.full(len(at), _P5 + np.uint64(size))
            done = 0
            while size - done >= 8:
                h = _turned(h ^ _turned(self._eights[at + done] * _P2, 31) * _P1, 27) * _P1 + _P4
                done += 8
            if size - done >= 4:
                h = _turned(h ^ (self._eights[at + done] & np.uint64(0xFFFFFFFF)) * _P1, 23) * _P2 + _P3
                done += 4
            for i in range(done, size):
                h = _turned(h ^ (self._eights[at + i] & np.uint64(0xFF)) * _P5, 11) * _P1
            h = (h ^ (h >> np.uint64(33))) * _P2
            h = (h ^ (h >> np.uint64(29))) * _P3
            return h ^ (h >> np.uint64(32))

        return self._by(np.arange(len(self.starts)), short, xxhash.xxh64_intdigest, np.uint64)

    def crc32(self, some: np.ndarray) -> np.ndarray:
        """Unsigned CRC-32 of the stretches ``some``, as zlib gives it."""

        def short(at: np.ndarray, size: int) -> np.ndarray:
            crc = np.full(len(at), 0xFFFFFFFF, np.uint32)
            for i in range(size):
                crc = _CRC[(crc ^ self._eights[at + i].astype(np.uint32)) & np.uint32(0xFF)] ^ (crc >> 8)
            return ~crc

        return self._by(some, short, zlib.crc32, np.uint32)

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether all bytes of the stretches ``a`` and ``b`` are equal, pair by pair."""
        out = self.sizes[a] == self.sizes[b]
        unsure = np.flatnonzero(out)
        at = 0
        while len(unsure):
            x, y = a[unsure], b[unsure]
            left = self.sizes[x] - at
            # bytes past the end are shifted out
            past = np.uint64(8) * (np.uint64(8) - np.minimum(left, 8).astype(np.uint64))
            differ = (self._eights[self.starts[x] + at] ^ self._eights[self.starts[y] + at]) << past != 0
            out[unsure[differ]] = False
            unsure = unsure[~differ & (left > 8)]
            at += 8
        return out


class Table:
    """N-grams of a block, each distinct one in one slot of an open-addressed table.

    A slot is found by the n-gram's 64-bit key and linear probing; equal keys count as the same
    n-gram only if all bytes are equal. ``slots`` has the slot of every occurrence; ``bucket`` and
    ``count`` are the slots' values. The table has at least two slots per occurrence, so it never
    fills up.
    """

    def __init__(self, grams: Stretches, keys: np.ndarray, buckets: int):
        self.grams, self.keys = grams, keys
        size = 1 << max(1, (2 * len(keys)).bit_length())
        self.owner = np.full(size, -1, np.int64)
        self.slots = self._intern(size - 1)
        used = np.flatnonzero(self.owner >= 0)
        self.bucket = np.zeros(size, np.int32)
        self.bucket[used] = grams.crc32(self.owner[used]) % np.uint32(buckets)
        self.count = np.bincount(self.slots, minlength=size)

    def _intern(self, mask: int) -> np.ndarray:
        place = (self.keys & np.uint64(mask)).astype(np.int64)
        todo = np.arange(len(place))
        while len(todo):
            at = place[todo]
            free = self.owner[at] < 0
            # of those that ask for a free slot, the first gets it
            self.owner[at[free][::-1]] = todo[free][::-1]
            owner = self.owner[at]
            same = (owner == todo) | (self.keys[owner] == self.keys[todo])
            doubt = np.flatnonzero(same & (owner != todo))
            same[doubt] = self.grams.equal(owner[doubt], todo[doubt])
            todo = todo[~same]
            place[todo] = (place[todo] + 1) & mask
        return place


def blocks(texts: list[bytes | None], size: int) -> Iterator[list[tuple[int, bytes]]]:
    """Lists of (row, part of its text) of about ``size`` bytes; parts end where a word does."""
    held, total = [], 0
    for row, text in enumerate(texts):
        at = 0
        while text and at < len(text):
            end = min(len(text), at + size - total)
            stop = _OUTSIDE.search(text, end) if end < len(text) else None
            end = stop.start() if stop else len(text)
            held.append((row, text[at:end]))
            total, at = total + end - at, end
            if total >= size:
                yield held
                held, total = [], 0
    if held:
        yield held


def words_in(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(data, starts, ends, part): the words of the parts in lower case, one space after each."""
    data = _LOWER[np.frombuffer(b"\0".join(parts) + b"\0", np.uint8)]
    inside = _IN_WORD[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside]).astype(np.int8)))
    first, last = edges[::2], edges[1::2]
    limits = np.cumsum([len(p) + 1 for p in parts])
    data[last] = 0x20
    inside[last] = True
    ends = np.cumsum(last - first + 1) - 1
    return data[inside], ends - (last - first), ends, np.searchsorted(limits, first, "right")


def interned(texts: list[bytes | None], n: int, buckets: int, size: int = _BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray, Table]]:
    """(rows of the words, rows of the n-grams, table) of all runs of 1 to ``n`` words, in blocks.

    A text that goes on in the next block hands its last ``n`` - 1 words over, for the runs that
    cross; runs of those words alone are not counted again.
    """
    carried_row, carried = -1, []
    for held in blocks(texts, size):
        rows = np.array([r for r, _ in held])
        lead = carried if held[0][0] == carried_row else []
        parts = [b" ".join([*lead, held[0][1]]), *(p for _, p in held[1:])]
        data, starts, ends, part = words_in(parts)
        of = rows[part]
        a, b, row = [], [], []
        for k in range(n):
            i = np.flatnonzero(of[: len(of) - k] == of[k:]) if k < len(of) else np.empty(0, np.int64)
            i = i[i + k >= len(lead)]
            a.append(starts[i])
            b.append(ends[i + k])
            row.append(of[i])
        grams = Stretches(data, np.concatenate(a), np.concatenate(b))
        yield of[len(lead):], np.concatenate(row), Table(grams, grams.xxh64(), buckets)
        carried_row = held[-1][0]
        tail = np.flatnonzero(of == carried_row)[-(n - 1):] if n > 1 else []
        carried = [data[starts[i] : ends[i]].tobytes() for i in tail]


def bucket_counts(texts: DataFrame, text_col: str, n: int, buckets: int) -> dict[int, int]:
    """N-grams of all texts by bucket; every task adds its own up first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, table in interned(batch.column("_text").to_pylist(), n, buckets):
                np.add.at(held, table.bucket, table.count)
        used = np.flatnonzero(held)
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(held[used])], names=["bucket", "n"])

    found = texts.select(F.col(text_col).cast("binary").alias("_text")).mapInArrow(run, "bucket int, n long")
    return {r.bucket: r.n for r in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}


def gains(source: dict[int, int], target: dict[int, int], buckets: int) -> np.ndarray:
    """floor(1000 ln) of the smoothed share of each bucket in the target against the source."""
    s_all, t_all = float(sum(source.values()) + buckets), float(sum(target.values()) + buckets)
    return np.array([
        math.floor(1000 * math.log((target.get(b, 0) + 1.0) * s_all / ((source.get(b, 0) + 1.0) * t_all))) for b in range(buckets)
    ], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, n: int, buckets: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n_words, n_features, weight): the floored mean gain of a text's n-grams, 0 without any."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            total, count, words = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for of_words, rows, table in interned(batch.column("_text").to_pylist(), n, buckets):
                of_slot = gain[table.bucket]
                np.add.at(total, rows, of_slot[table.slots])
                count += np.bincount(rows, minlength=len(count))
                words += np.bincount(of_words, minlength=len(words))
            mean = total // np.maximum(count, 1)
            yield pa.RecordBatch.from_arrays([batch.column("_doc"), pa.array(words), pa.array(count), pa.array(mean)], names=["_doc", "n_words", "n_features", "weight"])

    chosen = docs.select(F.col(id_col).cast("long").alias("_doc"), F.col(text_col).cast("binary").alias("_text"))
    return chosen.mapInArrow(run, "_doc long, n_words long, n_features long, weight long")


def noise(id_: Column, seed: int) -> Column:
    """floor(1000 g) of a Gumbel variable g taken from a hash of seed and id; a null id counts as empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, n: int = 2, buckets: int = 10_000,
    seed: int = 7, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
) -> DataFrame:
    """Draw documents without replacement, likelier the more their n-grams resemble the target's.

    Words are runs of digits, letters a-z after lower-casing A-Z, and characters beyond ASCII. All runs of
    1 to ``n`` words of all texts on both sides are counted by hashed bucket; a bucket's gain is the
    logarithm of its smoothed shares. A document's weight is the mean gain of its runs, and its
    score adds Gumbel noise from a hash of its id, so the highest scores are a draw without
    replacement (and reruns agree). Of the documents with at least ``least_words`` words,
    ``percent`` in 100 (rounded down) are drawn.

    In the tasks each block of text interns its n-grams in an open-addressed table (see ``Table``),
    so bucket hashes and gains are looked up once per distinct n-gram. The counts are one number per
    bucket; ranks come from a range-split sort, so the draw may be any size.

    Returns one row per row of ``docs``: id, n_features, weight, score, rank (null if not drawn),
    n_words. Null and empty texts have no words and weight 0. Equal scores go to the smaller id, a
    null id before all others, rows of one id by their number of runs; each row is a document of its own. Empty
    tables give empty results, an empty target flat counts. Other columns are not read.
    """
    gain = gains(bucket_counts(docs, text_col, n, buckets), bucket_counts(target, target_col, n, buckets), buckets)
    scored = written(weights(docs, gain, n, buckets, id_col, text_col), "weights")
    scored = scored.withColumn("score", F.col("weight") + noise(F.col("_doc"), seed))
    fit = F.col("n_words") >= least_words
    quota = percent * scored.filter(fit).count() // 100
    order = [F.desc("score"), F.asc("_doc"), F.asc("n_features"), F.asc("n_words")]
    ranked = number_rows(scored.filter(fit), order)
    drawn = ranked.withColumn("rank", F.when(F.col("rank") <= quota, F.col("rank")))
    rest = scored.filter(~fit).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).select(F.col("_doc").alias(id_col), "n_features", "weight", "score", "rank", "n_words")
