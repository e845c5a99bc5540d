"""Quality rules: repeated words and lines, symbols, and the fertility of public vocabularies."""

from __future__ import annotations

import base64
from collections import defaultdict
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sideline.functions.lineage import written

#: vocabularies by file: .model is read by sentencepiece, .tiktoken holds the ranks of a byte-level BPE
VOCABULARIES = ("/opt/tokenizers/piece_bpe_32k.model", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
#: fixed value: the public pattern by which byte-level BPE vocabularies of this kind divide a text
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: a text is handed to a tokeniser so many characters at a time, cut before a space
_BLOCK = 1 << 20
#: bands that are handed to every task at most
_FEW = 10_000
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: of each vocabulary: thousandths of characters per token, ten-thousandths of tokens that are single
#: bytes of a character, thousandths of bits of the distribution of its tokens
_MEASURES = ("chars", "fallback", "entropy")

#: first code points of stretches of one script; fixed values of the character standard
_SCRIPTS = (
    (0, "latin"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "armenian"), (0x590, "hebrew"), (0x600, "arabic"),
    (0x900, "indic"), (0xE00, "thai"), (0xE80, "other"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"),
    (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"), (0x32000, "other"),
)
_SCRIPT_STARTS = np.array([s for s, _ in _SCRIPTS])
_SCRIPT_NAMES = sorted({n for _, n in _SCRIPTS})
_SCRIPT_OF = np.array([_SCRIPT_NAMES.index(n) for _, n in _SCRIPTS])

_SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_FIRST_BYTE = (np.arange(256) & 0xC0) != 0x80
_SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))


def script_of(text: str) -> str:
    """The script of most letters of a text; of equal ones the first by name, and "none" without letters."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    letters = points[(points >= 0xC0) | ((points | 0x20) - 97 < 26)]
    if not len(letters):
        return "none"
    found = np.bincount(_SCRIPT_OF[np.searchsorted(_SCRIPT_STARTS, letters, "right") - 1], minlength=len(_SCRIPT_NAMES))
    return _SCRIPT_NAMES[int(found.argmax())]


def repeated_words(data: bytes, run: int = 3) -> tuple[int, int]:
    """(words, words that lie in a run of three words that the text holds twice or more).

    Words become numbers by a table of the text's own words, so the comparison is exact; the text is
    split a block at a time.
    """
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    parts, at = [], 0
    while at < len(data):
        end = at + _BLOCK
        while end < len(data) and not _SPACES[data[end]]:
            end += 1
        words = data[at:end].split()
        parts.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
        at = end
    ids = np.concatenate(parts) if parts else np.empty(0, np.int64)
    if len(ids) < run:
        return len(ids), 0
    key, values = ids[: len(ids) - run + 1], len(numbers)
    for i in range(1, run):
        if values * len(numbers) >= 1 << 63:  # small numbers again before the next word joins
            found, key = np.unique(key, return_inverse=True)
            values = len(found)
        key, values = key * len(numbers) + ids[i : len(ids) - run + 1 + i], values * len(numbers)
    ordered = np.sort(key)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return len(ids), 0
    twice = np.flatnonzero(again[np.minimum(np.searchsorted(again, key), len(again) - 1)] == key)
    inside = np.zeros(len(ids), bool)
    for i in range(run):
        inside[twice + i] = True
    return len(ids), int(inside.sum())


def base_counts(data: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text in UTF-8."""
    seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    lines, repeated = set(), 0
    for line in data.split(b"\n"):
        if line.strip():
            repeated += line in lines
            lines.add(line)
    n, repeats = repeated_words(data)
    return n, int(seen[_FIRST_BYTE & ~_SPACES].sum()), int(seen[_SYMBOLS].sum()), repeated, repeats


def _blocks(text: str) -> Iterator[str]:
    at = 0
    while at < len(text):
        end = at + _BLOCK
        if end < len(text):
            space = text.rfind(" ", at + 1, end)
            end = space if space > 0 else end
        yield text[at:end]
        at = end


class _Pieces:
    """A sentencepiece model; its pieces for bytes stand for characters it lacks."""

    def __init__(self, content: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=content)
        self.fallback = np.array([self.model.is_byte(i) for i in range(self.model.get_piece_size())])

    def ids(self, text: str) -> Iterator[list[int]]:
        for i, block in enumerate(_blocks(text)):
            # the model puts a space in front of what it is given
            yield self.model.encode(block[1:] if i and block[:1] == " " else block, num_threads=1)


class _Ranks:
    """A byte-level BPE; tokens that are no whole characters are its byte fallback."""

    def __init__(self, content: bytes):
        import tiktoken

        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}
        self.model = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.fallback = np.zeros(max(ranks.values()) + 1, bool)
        for token, rank in ranks.items():
            self.fallback[rank] = "�" in token.decode("utf-8", "replace")

    def ids(self, text: str) -> Iterator[np.ndarray]:
        for block in _blocks(text):
            yield self.model.encode_to_numpy(block, disallowed_special=())


_loaded: dict[int, object] = {}


def _vocabulary(path: str, content: bytes):
    """The tokeniser of a file; a worker process builds it once."""
    key = hash((path, content))
    if key not in _loaded:
        _loaded[key] = (_Pieces if path.endswith(".model") else _Ranks)(content)
    return _loaded[key]


def fertility(text: str, vocabulary) -> tuple[int, int, int, int]:
    """(tokens, chars, fallback, entropy) in the units of ``_MEASURES``; zeros without a token."""
    counts = np.zeros(len(vocabulary.fallback), np.int64) if len(text) > _BLOCK else None
    for ids in vocabulary.ids(text):
        if counts is None:
            used, n = np.unique(np.array(ids, np.int32), return_counts=True)
        else:
            counts += np.bincount(np.array(ids, np.int64), minlength=len(counts))
    if counts is not None:
        used = np.flatnonzero(counts)
        n = counts[used]
    elif not text:
        return 0, 0, 0, 0
    total = int(n.sum())
    if not total:
        return 0, 0, 0, 0
    entropy = np.log2(total) - float((n * np.log2(n)).sum()) / total
    return total, 1000 * len(text) // total, int(10_000 * n[vocabulary.fallback[used]].sum()) // total, round(1000 * entropy)


def measured(docs: DataFrame, vocabularies: Sequence[str] = VOCABULARIES, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Base counts, band key and fertility of every whole text, one row per row of ``docs``.

    The driver reads the vocabulary files, which are of fixed size, and hands their content to the
    tasks. Texts are measured one at a time.
    """
    shared = docs.sparkSession.sparkContext.broadcast([(p, Path(p).read_bytes()) for p in vocabularies])
    names = [f"{m}_{v}" for v in range(len(vocabularies)) for m in ("tokens", *_MEASURES)]
    id_kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [_vocabulary(*v) for v in shared.value]
        for batch in batches:
            rows = []
            for value, lang in zip(batch.column("_text"), batch.column("_lang"), strict=True):
                data = value.as_py() or b""
                text = data.decode("utf-8", "replace")
                key = lang.as_py() or f"script {script_of(text)}"
                rows.append((key, *base_counts(data), *(x for v in known for x in fertility(text, v))))
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(columns[0] if rows else [], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])],
                names=["_id", "band", *_COUNTS, *names]) if rows else pa.RecordBatch.from_pylist([], pa.schema([]))

    chosen = docs.select(
        F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_text"),
        (F.col(lang_col).cast("string") if lang_col in docs.columns else F.lit(None).cast("string")).alias("_lang"))
    kinds = f"_id {id_kind}, band string, " + ", ".join(f"{c} long" for c in (*_COUNTS, *names))
    return chosen.mapInArrow(run, kinds)


def judge(
    docs: DataFrame, vocabularies: Sequence[str] = VOCABULARIES, width: float = 3.0, floor: float = 0.02,
    least: int = 20, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    min_words: int = 50, most_repeats: int = 50,
) -> DataFrame:
    """Base rules and rejection bands of tokeniser fertility, one row per row of ``docs``.

    A text fails the base rules with fewer than ``min_words`` words or with more than
    ``most_repeats`` in 100 of them in runs of three words that it holds twice or more.

    Fertility: each vocabulary gives a text's characters per token, the share of tokens that are
    single bytes of a character it lacks, and the entropy of the text's tokens. A band belongs to a
    language (to the script of most letters, where a row has none) and a class of length, one for
    each factor of four in tokens, as all three measures depend on length. It reaches from ``width``
    times the distance of the quartiles below the lower quartile to as much above the upper one;
    that distance counts as ``floor`` times their middle at least, and byte shares have no lower end.
    Quartiles are exact, over all rows of different measures, so copies of one text count once. A
    text outside a band of any measure is rejected. A class of fewer than ``least`` such rows rejects
    nothing.

    Returns id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, band,
    and outside: the measures that lie outside (``chars_0`` is that of the first vocabulary). Null
    and empty texts have zeros, fail the base rules and are in no band. Ids are handed through, also
    null and repeated ones. Texts of more than 2^20 characters go through the tokenisers in parts of
    that size, cut before a space where there is one. Other columns are not read.
    """
    rows = written(measured(docs, vocabularies, id_col, text_col, lang_col), "fertility")
    names = [f"{m}_{v}" for v in range(len(vocabularies)) for m in _MEASURES]
    rows = rows.withColumn("_class", F.floor(F.log2(F.greatest("tokens_0", F.lit(1))) / 2).cast("int"))
    # measures are whole numbers, so an exact quartile holds a bounded number of values
    different = rows.filter("tokens_0 > 0").select("band", "_class", *names).distinct()
    bands = written(different.groupBy("band", "_class").agg(
        F.count(F.lit(1)).alias("_rows"), *[F.expr(f"percentile({m}, array(0.25D, 0.75D))").alias(f"_{m}") for m in names]), "bands")
    bands = bands.filter(F.col("_rows") >= least)
    # few languages in few classes: every task gets them, where they are few
    bands = F.broadcast(bands) if bands.count() <= _FEW else bands

    def outside(m: str) -> str:
        low, high = f"_{m}[0]", f"_{m}[1]"
        reach = f"{width}D * greatest({high} - {low}, {floor}D * ({low} + {high}) / 2, 1D)"
        below = "" if m.startswith("fallback") else f"{m} < {low} - {reach} OR "
        return f"IF({below}{m} > {high} + {reach}, '{m}', NULL)"

    found = rows.join(bands, ["band", "_class"], "left")
    found = found.withColumn("outside", F.expr(f"array_compact(array({', '.join(map(outside, names))}))"))
    failed = f"n_words < {min_words} OR 100 * n_repeat_words > {most_repeats} * n_words"
    return found.select(
        F.col("_id").alias(id_col), *_COUNTS, F.expr(failed).alias("base_failed"),
        F.expr(f"NOT ({failed}) AND size(outside) = 0").alias("kept"), "band", "outside")
