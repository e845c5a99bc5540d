"""Repair of conversations at the least cost of edits, with an audit of the edits."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sideline.functions.lineage import written
from sideline.llm import audits
from sideline.llm.common import SPACE
from sideline.operators.ranking import number_rows

_STATS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def damaged(turns: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text) with planted faults, chosen by a hash of conv_id and turn.

    One in twenty each: the turn is dropped, its text emptied, its ends of sentences removed, the
    turn repeated, its role set to user. Nulls count as one space, in the hash and in role and text.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        blank("role").alias("role"), blank("text").alias("text"), fate.alias("fate"),
    ).filter("fate <> 0")
    rows = rows.withColumns({
        "text": F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")),
        "role": F.when(F.col("fate") == 4, "user").otherwise(F.col("role")),
        "times": F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))),
    })
    return rows.withColumn("time", F.explode("times")).select("conv_id", "turn", "role", "text")


def _key(conv: Column) -> Column:
    """The conversation as a text that is never null."""
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit(""))


def _id(kind: str) -> Column:
    return F.when(F.col("_conv") != "", F.substring("_conv", 2, 1 << 30).cast(kind)).alias("conv_id")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of sorted batches, one after another."""
    for batch in batches:
        yield from zip(*((x.as_py() for x in c) for c in batch.columns), strict=True)


def _batches(rows: Iterator[tuple], kinds: dict[str, pa.DataType], size: int = 2000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds.values(), strict=True)], names=list(kinds))
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds.values(), strict=True)], names=list(kinds))


_S, _L, _B = pa.string(), pa.int64(), pa.binary()
_NAMES = {_S: "string", _L: "long", _B: "binary"}
_PIECES = {"_conv": _S, "_part": _L, "start": _L, "end": _L, "cost": _L, "place": _L, "audit": _S,
           "blank": _L, "duplicate": _L, "truncated": _L, "illegal": _L, "turns": _L, "low": _L, "high": _L, "first": _S, "last": _S}
_CHOICES = {"_conv": _S, "_part": _L, "start": _L, "end": _L, "tail": _S, **dict.fromkeys(_STATS, _L)}
_TURNS = {"_conv": _S, "_part": _L, "place": _L, "edit": _S, "role": _B, "text": _B}


def _ddl(kinds: dict[str, pa.DataType]) -> str:
    return ", ".join(f"{n} {_NAMES[k]}" for n, k in kinds.items())


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cheapest edits of each part of a conversation by its start and end state, and its counts."""

    def rows():
        for (conv, part), turns in groupby(_rows(batches), key=lambda r: r[:2]):
            turns = list(turns)  # a part has a bounded number of narrow rows
            initials = [r[4] for r in turns]
            blank, repeated, cut = (sum(r[i] for r in turns) for i in (5, 6, 7))
            numbers = {r[3] for r in turns if r[3] is not None}
            illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
            stats = (blank, repeated, cut, illegal, len(numbers), min(numbers, default=None), max(numbers, default=None), initials[0], initials[-1])
            some = [(r[4], r[5] or r[6], r[7]) for r in turns]
            for start in audits.STATES if part else audits.STATES[:1]:
                ends = [(e, *b) for e, b in enumerate(audits.cheapest(some, start)) if b]
                order = sorted(b[2] for b in ends)
                for end, cost, audit in ends:
                    yield conv, part, start, end, cost, order.index(audit), audit, *stats

    return _batches(rows(), _PIECES)


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The start and end state of every part in the cheapest way through its conversation."""

    def rows():
        for conv, found in groupby(_rows(batches), key=lambda r: r[0]):
            totals, last, high, low = [0] * 5, None, None, None
            parts: list[int] = []

            def pieces():
                nonlocal last, high, low
                for part, ways in groupby(found, key=lambda r: r[1]):
                    ways = list(ways)
                    blank, repeated, cut, illegal, turns, lo, hi, first, end = ways[0][6:]
                    border = last is not None and last + first not in ("su", "ua", "au")
                    # parts follow each other in the order of turns, so only one turn can be in both
                    turns -= int(lo is not None and lo == high)
                    for i, n in enumerate((blank, repeated, cut, illegal + border, turns)):
                        totals[i] += n
                    low, high, last = lo if low is None else low, high if hi is None else hi, end
                    parts.append(part)
                    yield [w[2:6] for w in ways]

            cost, ways = audits.chained(pieces())
            gaps = 0 if low is None else high - low + 1 - totals[4]
            for i, (part, (start, end)) in enumerate(zip(parts, ways, strict=True)):
                final = i + 1 == len(parts)
                yield conv, part, start, end, audits.ENDS[end] if final else "", *((gaps, *totals[:4], cost) if final else (0,) * 6)

    return _batches(rows(), _CHOICES)


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired turns of each part: its audit comes first, then its turns in order."""

    def rows():
        for (conv, part), found in groupby(_rows(batches), key=lambda r: r[:2]):
            _, _, _, state, audit, *_ = next(found)
            place = 0
            for edit in audit:
                if edit == "I":
                    yield conv, part, place, edit, audits.ROLES[state].encode(), b""
                    state, place = audits.after(state, edit, ""), place + 1
                    continue
                *_, role, initial, text = next(found)
                if edit != "D":
                    yield conv, part, place, edit, role if edit == "K" else audits.ROLES[state].encode(), text
                    place += 1
                state = audits.after(state, edit, initial)

    return _batches(rows(), _TURNS, 200)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for conv, found in groupby(_rows(batches), key=lambda r: r[0]):
            digest = hashlib.sha256()
            for i, (_, role, text) in enumerate(found):
                digest.update(b"\n" * bool(i) + role + b":" + text)
            yield conv, digest.hexdigest()

    return _batches(rows(), {"_conv": _S, "sha256": _S})


def repair(turns: DataFrame, part_rows: int = 4096) -> tuple[DataFrame, DataFrame]:
    """(conversations, repaired turns) after the cheapest edits of ``turns``: conv_id, turn, role, text.

    A conversation is legal if its roles' initials read s?(ua)+ or it has no turns. Edits: Keep
    (free), Rerole to user or assistant (3), Delete (4), Insert an empty turn of user or assistant
    anywhere (3). Turns in the order of ``turn`` (nulls first; equal ones in the order of a hash of
    role and text) have one fault at most: blank, duplicate (role and text seen earlier in the conversation) or
    truncated (no . ! ? at the end). Blank and duplicate turns must go; a truncated one that stays costs 3 more. Of
    equally cheap repairs the one with the ASCII-least initials of its edits is taken.

    1. Turns are numbered within conversations by a range-split sort and cut into parts of
       ``part_rows``. The earliest turn of every role and text is an aggregate.
    2. Each part is solved on its own for each of the four states that it may start in. Edits are
       nodes that share their beginnings (see ``audits``).
    3. One record per part and pair of states, ``part_rows`` times fewer than the turns, goes through the
       same kind of search along each conversation and picks the part's start and end.
    4. Parts are edited on their own.

    So no task holds more than ``part_rows`` turns, however long a conversation is. Only its
    records of step 3 meet in one task.

    conversations: conv_id, gaps (turn numbers missing between the least and the largest), blank,
    duplicate, truncated, illegal (neighbours whose initials are not su, ua or au), cost, audit
    (initials of the edits), one row per conversation in ``turns``. repaired turns: conv_id, place
    (pair of part and number, in order), edit (K, R or I), role, text. Nulls in role and text count as one space; a role
    that is not empty and starts with neither s, u nor a can't be kept; an empty one changes nothing for its
    neighbours. Turns with a null conv_id are one conversation. Repeated rows are duplicates. An empty
    table gives no rows. Other columns are not read.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select(_key(F.col("conv_id")).alias("_conv"), F.col("turn").cast("long").alias("turn"), blank("role").alias("role"), blank("text").alias("text"))
    rows = rows.withColumns({
        "said": F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)),
        "initial": F.substring("role", 1, 1),
        "blank": ~F.col("text").rlike(f"[^{SPACE}]"),
        "ended": F.col("text").rlike(rf"[.!?][{SPACE}]*\z"),
    })
    placed = written(number_rows(rows, [F.asc("turn"), F.asc("said")], by=["_conv"]).withColumn("_part", F.expr(f"(rank - 1) div {part_rows}")), "turns")
    # the first of what is said several times; only such turns can be duplicates
    first = placed.groupBy("_conv", "said").agg(F.min("rank").alias("at"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    narrow = placed.select("_conv", "_part", "rank", "turn", "initial", "said", "blank", "ended").join(first, ["_conv", "said"], "left")
    again = ~F.col("blank") & F.coalesce(F.col("rank") > F.col("at"), F.lit(False))
    narrow = narrow.select("_conv", "_part", "rank", "turn", "initial", "blank", again.alias("again"), (~F.col("blank") & ~again & ~F.col("ended")).alias("cut"))
    in_parts = narrow.repartition("_conv", "_part").sortWithinPartitions("_conv", "_part", "rank")
    solved = written(in_parts.mapInArrow(_solved, _ddl(_PIECES)), "parts")
    ways = solved.select("_conv", "_part", "start", "end", "cost", "place", "blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "first", "last")
    ways = ways.repartition("_conv").sortWithinPartitions("_conv", "_part", "start", "end")
    taken = ways.mapInArrow(_chosen, _ddl(_CHOICES))
    parts = taken.join(solved.select("_conv", "_part", "start", "end", "audit"), ["_conv", "_part", "start", "end"])
    parts = written(parts.withColumn("audit", F.concat("audit", "tail")), "audits")
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_part", "audit"))), lambda x: x.audit), "")
    conversations = parts.groupBy("_conv").agg(*[F.sum(c).alias(c) for c in _STATS], whole.alias("audit"))

    lead = parts.select("_conv", "_part", F.lit(0).cast("long").alias("rank"), "start", "audit", F.lit(None).cast("binary").alias("role"), F.lit(None).cast("string").alias("initial"), F.lit(None).cast("binary").alias("text"))
    said = placed.select(
        "_conv", "_part", "rank", F.lit(None).cast("long").alias("start"), F.lit(None).cast("string").alias("audit"),
        F.col("role").cast("binary").alias("role"), "initial", F.col("text").cast("binary").alias("text"))
    both = lead.unionByName(said).repartition("_conv", "_part").sortWithinPartitions("_conv", "_part", "rank")
    repaired = both.mapInArrow(_applied, _ddl(_TURNS)).select(
        _id(kind), F.struct(F.col("_part").alias("part"), F.col("place").alias("number")).alias("place"), "edit",
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return conversations.select(_id(kind), *_STATS, "audit"), repaired


def digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, sha256) of each conversation's ``role:text`` lines, in order.

    The digest of a conversation is a chain over all its text, so one task reads it, in a stream
    that holds one turn at a time.
    """
    kind = repaired.schema["conv_id"].dataType.simpleString()
    ordered = repaired.select(
        _key(F.col("conv_id")).alias("_conv"), "place", F.col("role").cast("binary").alias("role"), F.col("text").cast("binary").alias("text"),
    ).repartition("_conv").sortWithinPartitions("_conv", "place")
    return ordered.drop("place").mapInArrow(_digests, "_conv string, sha256 string").select(_id(kind), "sha256")


def audit_of_damage(turns: DataFrame) -> DataFrame:
    """Counts, cost, audit and digest of the repair of damaged turns, one row per conversation of ``turns``.

    A conversation that the damage leaves without turns has zeros, an empty audit and the digest of nothing.
    """
    conversations, repaired = repair(damaged(turns))
    every = turns.select(_key(F.col("conv_id").cast("long")).alias("_conv")).distinct()
    keyed = lambda df: df.withColumn("_conv", _key(F.col("conv_id"))).drop("conv_id")
    found = every.join(keyed(conversations), "_conv", "left").join(keyed(digests(repaired)), "_conv", "left")
    return found.select(
        _id("bigint"), *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in _STATS], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
