"""SentencePiece encoding and decoding with the N best segmentations of the piece lattice."""

from __future__ import annotations

import heapq
import re
from array import array
from bisect import insort
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sideline.llm.common import Remembered, arrays, by_size

SPACE = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_UNKNOWN_PENALTY = 10.0
#: bytes of remembered parts per worker
_MEMORY = 320 << 20
#: characters of a text from which on its edges are not kept
_LONG = 1000
#: stands for a SPACE character of the text itself; no text holds a lone surrogate
_LITERAL = "\udc81"


@dataclass(frozen=True)
class Pieces:
    """A model's vocabulary: text pieces with id and score, byte pieces, and texts by id."""

    ids: dict[str, int]
    scores: dict[str, float]
    bytes_: tuple[int, ...]
    texts: tuple[str | int, ...]
    unknown: float
    starts: frozenset[str]
    split: re.Pattern | None

    @cached_property
    def longest(self) -> int:
        """Characters of the longest piece."""
        return max(map(len, self.ids), default=1)

    @cached_property
    def prefixes(self) -> dict[str, float]:
        """Score of every piece, and minus infinity for what only begins one."""
        return dict.fromkeys(self.starts, float("-inf")) | self.scores

    @cached_property
    def of_bytes(self) -> np.ndarray:
        """By id: whether a piece stands for a byte."""
        return np.array([isinstance(t, int) for t in self.texts])

    @cached_property
    def tree(self) -> dict:
        """The pieces by character: (score or None, what goes on) for each next character."""
        root: dict = {}
        for piece, score in self.scores.items():
            node = root
            for ch in piece[:-1]:
                node = node.setdefault(ch, (None, {}))[1]
            node[piece[-1]] = (score, node[piece[-1]][1] if piece[-1] in node else {})
        return root

    def edges_to(self, text: str, at: int) -> Iterator[tuple[int, float]]:
        """(start, score) of the edges of a text that end at a place."""
        for i in range(max(0, at - self.longest), at):
            score = self.scores.get(text[i:at], self.unknown if i == at - 1 else None)
            if score is not None:
                yield i, score

    @classmethod
    def load(cls, path: str = MODEL) -> Pieces:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids, scores, texts, byte_ids = {}, {}, [], {}
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                texts.append(int(piece[3:5], 16))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                texts.append("")
            else:
                ids[piece], scores[piece] = i, sp.get_score(i)
                texts.append(piece)
        starts = frozenset(p[:n] for p in ids for n in range(1, len(p)))
        # no piece goes on with a space after another character, so texts fall apart before spaces
        whole = any(SPACE in p.lstrip(SPACE) for p in ids)
        line = "" if any("\n" in p for p in ids) else "\n"
        split = None if whole else re.compile(f"{SPACE}*[^{SPACE}{line}]+|{SPACE}+" + "|\n" * bool(line))
        if len(byte_ids) < 256:
            raise ValueError("the model has no byte pieces, so texts could not be restored")
        return cls(ids, scores, tuple(byte_ids[b] for b in range(256)), tuple(texts), min(scores.values()) - _UNKNOWN_PENALTY, starts, split)


def best_segmentations(text: str, pieces: Pieces, count: int) -> list[tuple[float, list[int]]]:
    """The ``count`` segmentations of ``text`` with the highest sums of piece scores, best first.

    Forward: the best score from the start to every position (Viterbi). Backward: A-star from the
    end, with that score as the exact value of what is missing, so hypotheses complete in the order
    of their totals; of equal ones the one nearer to the start goes first. As every hypothesis
    completes with exactly its total, no more of them than segmentations still wanted are kept. A
    character without a piece of its own is one unknown edge and is written as its bytes.

    The edges of a short text are kept, those of a long one are looked up again where they are
    needed, so memory is a number per character and two per piece of the hypotheses, however long the text is.
    """
    n = len(text)
    prefixes, unknown = pieces.prefixes, pieces.unknown
    lowest = float("-inf")
    best = array("d", [lowest]) * (n + 1) if n > _LONG else [lowest] * (n + 1)
    best[0] = 0.0
    ends: list[list[tuple[int, float]]] | None = [[] for _ in range(n + 1)] if n <= _LONG else None
    for i in range(n):
        here = best[i]
        j = i + 1
        score = prefixes.get(text[i], lowest)
        if score == lowest:
            total = here + unknown
            if total > best[j]:
                best[j] = total
            if ends is not None:
                ends[j].append((i, unknown))
            if text[i] not in prefixes:
                continue
        while True:
            if score > lowest:
                total = here + score
                if total > best[j]:
                    best[j] = total
                if ends is not None:
                    ends[j].append((i, score))
            j += 1
            if j > n:
                break
            score = prefixes.get(text[i:j])
            if score is None:
                break
    found: list[tuple[float, list[int]]] = []
    # hypotheses as linked nodes: position, and the node before (nearer to the end)
    places, links = array("q", [n]), array("q", [-1])
    # total (negative), position, number of the hypothesis, score so far, node before
    agenda = [(-best[n], n, 0, 0.0, -1)]
    numbered = 0
    while agenda:
        total, at, _, done, link = agenda.pop(0)
        places.append(at)
        links.append(link)
        node = len(places) - 1
        if at == 0:
            ids: list[int] = []
            while (after := links[node]) >= 0:
                piece = text[places[node] : places[after]]
                ids += [pieces.ids[piece]] if piece in pieces.ids else [pieces.bytes_[b] for b in piece.replace(_LITERAL, SPACE).encode("utf-8", "surrogatepass")]
                node = after
            found.append((-total, ids))
            if len(found) == count:
                break
            continue
        wanted = count - len(found)
        for i, score in ends[at] if ends is not None else pieces.edges_to(text, at):
            so_far = done + score
            total = -(so_far + best[i])
            if len(agenda) < wanted or (total, i) < agenda[-1][:2]:
                numbered += 1
                insort(agenda, (total, i, numbered, so_far, node))
                del agenda[wanted:]
    return found


def best_and_gap(text: str, pieces: Pieces) -> tuple[float, bytes, float]:
    """Score and ids of the best segmentation, and by how much the second best is worse (infinite without one).

    The forward pass keeps the two best scores of every position, and the edge by which the best one
    comes there (of equal ones the first): these edges are the way that A-star takes first (see
    ``best_segmentations``), without an agenda as only one is wanted. Most segments of a text need no more.
    """
    n = len(text)
    if n > _LONG:
        found = best_segmentations(text, pieces, 2)
        ids = np.array(found[0][1], np.int32).tobytes()
        return found[0][0], ids, found[0][0] - found[1][0] if len(found) > 1 else float("inf")
    tree, unknown, lowest = pieces.tree, pieces.unknown, float("-inf")
    first, second, back = [lowest] * (n + 1), [lowest] * (n + 1), [0] * (n + 1)
    first[0] = 0.0
    for i in range(n):
        a, b = first[i], second[i]
        j, node = i, tree
        while node and j < n:
            step = node.get(text[j])
            j += 1
            if step:
                score, node = step
                if score is None:
                    if j > i + 1:
                        continue
                    score = unknown
            elif j > i + 1:
                break
            else:
                score, node = unknown, None
            total, held = a + score, first[j]
            if total > held:
                other = b + score
                second[j] = held if held > other else other
                first[j] = total
                back[j] = i
            elif total > second[j]:
                second[j] = total
    at, ids = n, []
    while at:
        piece = text[back[at] : at]
        known = pieces.ids.get(piece)
        if known is None:
            ids += [pieces.bytes_[c] for c in piece.replace(_LITERAL, SPACE).encode("utf-8", "surrogatepass")][::-1]
        else:
            ids.append(known)
        at = back[at]
    return first[n], array("i", ids[::-1]).tobytes(), first[n] - second[n]


def segments(text: str, pieces: Pieces) -> list[str]:
    """The text with spaces as ``SPACE`` and one in front, cut where no piece can cross."""
    marked = SPACE + text.replace(SPACE, _LITERAL).replace(" ", SPACE)
    return pieces.split.findall(marked) if pieces.split else [marked]


Choices = list[tuple[float, np.ndarray]]


def best_of_document(parts: Iterable[Choices], count: int) -> list[tuple[float, np.ndarray]]:
    """The ``count`` best segmentations of a document from those of its segments."""
    parts = list(parts)
    known = [(p[0][0], bytes(p[0][1]), p[0][0] - p[1][0] if len(p) > 1 else float("inf")) for p in parts]
    return _best_of(known, lambda i: parts[i], count)


def best_of_text(text: str | None, pieces: Pieces, count: int, known: Remembered) -> list[tuple[float, np.ndarray]]:
    """The ``count`` best segmentations of a text; ``known`` gives ``best_and_gap`` of a segment."""
    parts = segments(text, pieces) if text else []
    return _best_of(list(map(known.__getitem__, parts)), lambda i: best_segmentations(parts[i], pieces, count), count)


def _best_of(parts: list[tuple[float, bytes, float]], choices: Callable, count: int) -> list[tuple[float, np.ndarray]]:
    """The ``count`` best of a document from (score, ids, gap) of its segments.

    The best takes every segment's best. A further one differs from it in segments whose second
    choice costs least: of ``count`` segmentations only the ``count - 1`` cheapest such segments can
    differ, so only for those are all ``choices`` (by place) looked up. They are joined one segment
    at a time, and the ``count`` best of what is joined so far are kept.
    """
    scores, ids, gaps = zip(*parts, strict=True) if parts else ((), (), ())
    base, best = sum(scores), b"".join(ids)
    if count == 2 and parts:
        places = [gaps.index(min(gaps))]
    else:
        places = [i for _, i in heapq.nsmallest(count - 1, zip(gaps, range(len(gaps)), strict=True))] if count > 1 else []
    places = sorted(i for i in places if gaps[i] < float("inf"))
    free = [(sum(map(len, ids[:i])), len(ids[i]), choices(i)) for i in places]
    combos: list[tuple[float, tuple[int, ...]]] = [(0.0, ())]
    for _, _, part in free:
        combos = heapq.nsmallest(count, (
            (loss + part[0][0] - some[0], (*choice, c)) for loss, choice in combos for c, some in enumerate(part)))
    out = []
    for loss, choice in combos:
        joined, at = [], 0
        for (start, size, part), c in zip(free, choice, strict=True):
            joined += [best[at:start], np.asarray(part[c][1], np.int32).tobytes()]
            at = start + size
        out.append((base - loss, np.frombuffer(b"".join([*joined, best[at:]]), np.int32)))
    return out


def encode(
    docs: DataFrame, count: int = 1, model: str = MODEL, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
    restored: str | None = None,
) -> DataFrame:
    """The ``count`` best segmentations of every whole text.

    The text gets one space in front and spaces become ``SPACE``; a character without a piece is
    written as byte pieces, so decoding gives the text back exactly, whatever it holds. The lattice
    falls apart at places that no piece crosses (before spaces, around line ends); a worker
    remembers segmentations of the parts it has seen, in a bounded memory, and a document's best are put together
    from them exactly. Scores are sums of the model's piece scores. The vocabulary is read once
    from ``model`` by the driver and handed to the tasks; it is of fixed size. Texts go through one
    after another, and rows leave in slices of about a megabyte of text, so a task holds the
    numbers of one long text or of a few short ones.

    Returns the columns of ``keep`` (as they are; columns called scores or ids there are an error), scores
    (array, best first), ids (array of arrays of piece ids) and, if ``restored`` names it, a column that says
    whether decoding the best ids gives the text back. Null and empty texts have one
    segmentation, without pieces and of score 0; a text with fewer than ``count`` segmentations
    gives fewer. Repeated rows are rows of their own; an empty table gives no rows; other columns are
    not read.
    """
    added = ("scores", "ids", *[restored] * bool(restored))
    if clash := set(keep) & set(added):
        raise ValueError(f"columns to keep have names of the result: {sorted(clash)}")
    shared = docs.sparkSession.sparkContext.broadcast(Pieces.load(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value
        known = Remembered(lambda part: best_and_gap(part, pieces), lambda value: 320 + len(value[1]), _MEMORY)
        for batch in batches:
            for rows in by_size(batch, "_text"):
                texts = [x.as_py() or "" for x in rows.column("_text")]
                best = [best_of_text(t, pieces, count, known) for t in texts]
                ids = arrays([x[1] for b in best for x in b], pa.int32())
                ends = pa.array(np.cumsum([0, *map(len, best)]), pa.int32())
                columns = [*[rows.column(c) for c in keep], arrays([np.array([x[0] for x in b]) for b in best], pa.float64()), pa.ListArray.from_arrays(ends, ids)]
                if restored:
                    columns.append(pa.array([decode_ids(b[0][1], pieces) == t for b, t in zip(best, texts, strict=True)], pa.bool_()))
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, *added])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    kinds += ", " * bool(keep) + "scores array<double>, ids array<array<int>>" + f", {restored} boolean" * bool(restored)
    return docs.select(*keep, F.col(text_col).alias("_text")).mapInArrow(run, kinds)


def decode_ids(ids, pieces: Pieces) -> str:
    """The text of piece ids: pieces joined, byte pieces put together, the space in front taken off."""
    ids = np.asarray(ids, np.int64)
    if not len(ids):
        return ""
    of_bytes = pieces.of_bytes[ids]
    # stretches of byte pieces and of others in turn
    edges = [0, *(np.flatnonzero(np.diff(of_bytes)) + 1).tolist(), len(ids)]
    held, out = list(map(pieces.texts.__getitem__, ids.tolist())), []
    for a, b in zip(edges, edges[1:], strict=False):
        out.append(bytes(held[a:b]).decode("utf-8", "replace") if of_bytes[a] else "".join(held[a:b]).replace(SPACE, " "))
    text = "".join(out)
    return text[1:] if not of_bytes[0] and out[0][:1] == " " else text


def decode(ids: Column, spark, model: str = MODEL) -> Column:
    """Text of an array of piece ids; null stays null, control pieces have no text."""
    shared = spark.sparkContext.broadcast(Pieces.load(model))

    @F.pandas_udf("string")
    def text(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pieces = shared.value
        for part in parts:
            yield pd.Series([None if x is None else decode_ids(x, pieces) for x in part], dtype=object)

    return text(ids)
