"""Each pipeline stage against plain Python on its own input, and the whole run."""

import corpus_pipeline
from sideline.functions.lineage import written
from sideline.llm import piece_lattice, quality
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"


def _rows(df):
    return [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.collect()]


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    names = list(stages)
    out = {}
    for name in names:
        given, docs = docs, written(stages[name](spark, docs, SMALL), "stage")
        out[name] = (given, docs)
        assert name == names[-1] or docs.columns == given.columns

    given, kept = out["quality classifier"]
    model = quality.fit(spark.read.parquet(f"{SMALL}/labels.parquet"), given)
    good = {r.doc_id for r in quality.scores(given, model, threshold=0.5).filter("predicted = 1").collect()}
    assert sorted(_rows(kept)) == sorted(r for r in _rows(given) if r[0] in good)

    given, kept = out["line dedup"]
    want = {i: (t, n) for i, _, n, t in brute.kept_lines([r[:2] for r in _rows(given)])}
    assert sorted(_rows(kept)) == sorted(
        (i, want[i][0], a, b, len(want[i][0]) if want[i][1] else n) for i, _, a, b, n in _rows(given))

    given, kept = out["n-gram Jaccard join"]
    first = {i for i, _, c in brute.jaccard([r[:2] for r in _rows(given)], 5, 80) if i == c}
    assert sorted(_rows(kept)) == sorted(r for r in _rows(given) if r[0] in first)

    given, kept = out["source mix"]
    taken = {}
    for r in _rows(kept):
        taken[r[0]] = taken.get(r[0], 0) + len(brute.WORD.findall(r[1]))
    rows = [(r[0], r[1], r[3]) for r in _rows(given)]
    assert taken == {i: n for i, _, _, _, n in brute.mix(rows) if n}

    given, kept = out["SentencePiece"]
    pieces = piece_lattice.Pieces.load()
    texts = sorted((r[0], r[1]) for r in _rows(given))
    back = sorted((r.doc_id, piece_lattice.decode_ids(r.piece_ids, pieces)) for r in kept.collect())
    assert back == texts and kept.filter("NOT restored").count() == 0


def test_encoding_gives_further_segmentations(spark):
    texts = [(1, "the quick brown fox\njumps  over", "en", "s", 1), (2, "x", "en", "s", 1), (3, "", "en", "s", 0), (4, None, None, None, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long")
    done = {r.doc_id: r for r in corpus_pipeline.encode_pieces(spark, docs, SMALL).collect()}
    pieces = piece_lattice.Pieces.load()
    for i, text, *_ in texts:
        r = done[i]
        marked = "".join(piece_lattice.segments(text, pieces)) if text else ""
        want = piece_lattice.best_segmentations(marked, pieces, corpus_pipeline.SEGMENTATIONS) if text else [(0.0, [])]
        assert len(r.segmentations) == len(r.scores) == len(want) and r.segmentations[0] == r.piece_ids
        assert all(abs(a - b) < 1e-9 for a, (b, _) in zip(r.scores, want, strict=True))
        assert len({tuple(x) for x in r.segmentations}) == len(want) == (2 if text else 1)
        assert all(piece_lattice.decode_ids(x, pieces) == (text or "") for x in r.segmentations)


def test_odd_rows_and_empty(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, size int, score double, n_lines int"
    odd = [(1, None, None, None, None, 1, 0.5, 2), (None, "a b c", "en", "s", 5, 1, 0.5, 2), (2, "", "en", "s", 0, 1, 0.5, 2), (3, "w " * 50_000, "en", "s", 100_000, 1, 0.5, 2), (3, "w " * 50_000, "en", "s", 100_000, 1, 0.5, 2)]
    for rows in (odd, []):
        docs = written(spark.createDataFrame(rows, schema), "odd")
        for name, stage in corpus_pipeline.STAGES[1:]:
            docs = written(stage(spark, docs, SMALL), "stage")
        assert docs.count() <= len(rows)
    assert corpus_pipeline.keep_quality(spark, written(spark.createDataFrame([], schema), "odd"), SMALL).count() == 0


def test_run(spark):
    assert corpus_pipeline.run(spark, SMALL).filter("restored").count() > 100
