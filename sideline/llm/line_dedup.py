"""Line dedup: documents probe sharded perfect-hash arrays of the repeated lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sideline.functions.lineage import written
from sideline.llm.common import each_batch
from sideline.llm.perfect_hash import Shard

_STRIP = " \t\n\x0b\x0c\r"
#: stands for the id of a document without one: below every id
_NO_ID = -(2**63)
#: bytes a key takes in a shard's arrays, with its share of the perfect hash
_KEY_BYTES = 25


def line_hash(line: str, least: int) -> bytes | None:
    """128-bit hash of a line's key, or None for a key below ``least`` code points.

    The key is the line without ASCII white space at both ends and with A-Z in lower case.
    """
    key = line.strip(_STRIP)
    if len(key) < least:
        return None
    return xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass").lower())


def halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(digests), ">u8").reshape(-1, 2).astype(np.uint64)
    return both[:, 0].copy(), both[:, 1].copy()


def _counts(least: int):
    """Documents and largest id per key of a batch: aggregated before anything is shuffled."""

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        held: dict[bytes, list[int]] = {}
        for id_, text in zip(b.column("_id").to_pylist(), b.column("_text").to_pylist(), strict=True):
            for key in {line_hash(x, least) for x in (text or "").split("\n")} - {None}:
                entry = held.setdefault(key, [0, id_])
                entry[0] += 1
                entry[1] = max(entry[1], id_)
        h1, h2 = halves(list(held))
        n, last = np.array(list(held.values()), np.int64).reshape(-1, 2).T
        return pa.RecordBatch.from_arrays(
            [pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), pa.array(n), pa.array(last)], names=["h1", "h2", "n", "last"])

    return each_batch(batch)


def repeated_lines(docs: DataFrame, id_col: str, text_col: str, least: int, documents: int) -> DataFrame:
    """(h1, h2, n, last) of every key found in at least ``documents`` documents."""
    rows = docs.select(_ids(id_col).alias("_id"), F.col(text_col).alias("_text"))
    counted = rows.mapInArrow(_counts(least), "h1 long, h2 long, n long, last long")
    return counted.groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.max("last").alias("last")).filter(F.col("n") >= documents)


def shards(keys: DataFrame, count: int) -> DataFrame:
    """(shard, data): each shard's keys as a perfect hash with its arrays."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        h1, h2 = (pdf[c].to_numpy(np.int64).view(np.uint64) for c in ("h1", "h2"))
        data = Shard.build(h1, h2, pdf["n"].to_numpy(), pdf["last"].to_numpy()).to_bytes()
        return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "data": [data]})

    return keys.withColumn("shard", F.pmod("h1", F.lit(count)).cast("int")).groupBy("shard").applyInPandas(build, "shard int, data binary")


def _drops(held: dict[int, Shard], count: int, h1: np.ndarray, h2: np.ndarray, ids: np.ndarray, documents: int) -> np.ndarray:
    """True where a line goes: its key is repeated and another document is the last that has it."""
    out = np.zeros(len(h1), bool)
    shard = (h1.view(np.int64) % count).astype(np.int64)
    for s in np.unique(shard):
        if s in held:
            at = shard == s
            n, last = held[s].probe(h1[at], h2[at])
            out[at] = (n >= documents) & (last != ids[at]) & (last != _NO_ID)
    return out


def _lines(texts, ids, least: int):
    """Hashes of the lines of all texts that can be repeated: document, line number, h1, h2, id."""
    doc, line, digests = [], [], []
    for d, text in enumerate(texts):
        for i, x in enumerate((text or "").split("\n")):
            if (digest := line_hash(x, least)) is not None:
                doc.append(d)
                line.append(i)
                digests.append(digest)
    doc, line = np.array(doc, np.int64), np.array(line, np.int64)
    return doc, line, *halves(digests), np.asarray(ids, np.int64)[doc]


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 20, documents: int = 3,
    shard_keys: int = 500_000, broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """``docs`` without the lines that many documents repeat, and n_lines, n_dropped.

    Texts are split at \\n. Lines whose key (see ``line_hash``) has at least ``least`` code points
    and is found in at least ``documents`` documents go, except in the largest id that has the key;
    other lines stay, joined by \\n.

    One pass counts documents per key hash (128 bits), summed inside each batch first; keys below
    ``documents`` can never drop a line and are left out. The others are sharded by hash; each shard
    is a minimal perfect hash with arrays of fingerprints (64 bits), counts and largest ids. Up to
    ``broadcast_bytes`` of arrays go to every task, and a second pass over the texts probes them
    with no shuffle. Beyond that size the lines' hashes are dealt to the shards instead, a hot
    shard in several parts, and only the numbers of dropped lines come back to their documents;
    for this ``docs`` must be a stored table, as its rows are numbered in reading order.

    Null text counts as one empty line and stays null; an empty table gives no rows. Rows that share
    an id count as separate documents, and the largest id keeps the line in each of them. A row with
    a null id counts as a document below all ids; a key that only such rows have is not dropped.
    All columns of ``docs`` are kept; a column of it named n_lines or n_dropped is replaced.
    """
    keys = written(repeated_lines(docs, id_col, text_col, least, documents), "lines")
    n_keys = keys.count()
    count = max(1, -(-n_keys // shard_keys))
    built = shards(keys, count)
    if n_keys * _KEY_BYTES <= broadcast_bytes:
        out = _probe_here(docs, {r.shard: bytes(r.data) for r in built.collect()}, count, id_col, text_col, least, documents)
    else:
        out = _probe_dealt(docs, built, count, id_col, text_col, least, documents, shard_keys)
    lines = F.coalesce(F.length(text_col) - F.length(F.replace(F.col(text_col), F.lit("\n"), F.lit(""))), F.lit(0)) + 1
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    kept = [F.coalesce("_kept", F.col(c)).alias(c) if c == text_col else F.col(c) for c in names]
    return out.select(*kept, lines.cast("long").alias("n_lines"), F.col("_dropped").alias("n_dropped"))


def _ids(id_col: str) -> Column:
    # without nulls, which pandas would hold as doubles
    return F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID))


def _rest(text: str, gone) -> str:
    gone = set(gone)
    return "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)


def _probe_here(docs, data, count, id_col, text_col, least, documents) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(data)

    @F.pandas_udf("dropped long, kept string")
    def probe(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        held = {s: Shard.from_bytes(x) for s, x in shared.value.items()}
        for ids, texts in parts:
            doc, line, h1, h2, own = _lines(texts, ids, least)
            gone = _drops(held, count, h1, h2, own, documents)
            kept: list[str | None] = [None] * len(texts)
            n = np.bincount(doc[gone], minlength=len(texts))
            ends = np.cumsum(n)
            at = line[gone]
            for d in np.flatnonzero(n):
                kept[d] = _rest(texts.iloc[d], at[ends[d] - n[d] : ends[d]].tolist())
            yield pd.DataFrame({"dropped": n.astype(np.int64), "kept": pd.Series(kept, dtype=object)})

    return docs.withColumn("_found", probe(_ids(id_col), F.col(text_col))).withColumn("_dropped", F.col("_found.dropped")).withColumn("_kept", F.col("_found.kept"))


def _probe_dealt(docs, built, count, id_col, text_col, least, documents, shard_keys) -> DataFrame:
    numbered = docs.withColumn("_row", F.monotonically_increasing_id())

    def out_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            doc, line, h1, h2, own = _lines(pdf["_text"], pdf["_id"], least)
            yield pd.DataFrame({
                "row": pdf["_row"].to_numpy()[doc], "line": line, "h1": h1.view(np.int64), "h2": h2.view(np.int64), "own": own,
                "shard": (h1.view(np.int64) % count).astype(np.int32)})

    rows = numbered.select("_row", _ids(id_col).alias("_id"), F.col(text_col).alias("_text"))
    lines = written(rows.mapInPandas(out_lines, "row long, line long, h1 long, h2 long, own long, shard int"), "probes")
    sizes = lines.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / shard_keys).cast("int").alias("parts"))
    dealt = lines.join(sizes, "shard").withColumn("part", F.pmod(F.xxhash64("row"), "parts").cast("int")).drop("parts")
    arrays = built.join(sizes, "shard").select("shard", "data", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))

    def probe(a: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(x):
            return pd.DataFrame({"row": pd.Series(dtype="int64"), "line": pd.Series(dtype="int64")})
        s = int(a["shard"].iloc[0])
        gone = _drops({s: Shard.from_bytes(bytes(a["data"].iloc[0]))}, count, x["h1"].to_numpy().view(np.uint64), x["h2"].to_numpy().view(np.uint64), x["own"].to_numpy(), documents)
        return x.loc[gone, ["row", "line"]]

    met = arrays.groupBy("shard", "part").cogroup(dealt.groupBy("shard", "part")).applyInPandas(probe, "row long, line long")
    # as many numbers as the document has lines
    per = met.groupBy(F.col("row").alias("_row")).agg(F.collect_list("line").alias("_gone"))

    @F.pandas_udf("string")
    def rest(texts: pd.Series, gone: pd.Series) -> pd.Series:
        return pd.Series([None if g is None else _rest(t, g.tolist()) for t, g in zip(texts, gone, strict=True)], dtype=object)

    return numbered.join(per, "_row", "left").withColumn("_kept", rest(F.col(text_col), F.col("_gone"))).withColumn("_dropped", F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).cast("long"))
