"""Stored season reports: a whole one, odd ones, and lines on one side only."""

import json

import pytest

from sideline.operators import report_documents, season_report
from sideline.sources import variant_documents
from tests.rows import docs, frame, row

GOOD = {
    "provenanceStatus": "governed_real_data", "governanceStatus": "governed", "governanceSource": "explicit_marker", "checksum": "c", "expectedChecksum": "c",
    "dataThrough": "a", "sourceSnapshotAt": "b", "generatedAt": "c",
}


@pytest.fixture(scope="module")
def given(spark):
    rows = frame(spark, [row(team=t, week=w, season=s, drives=10.0 + w) for s in (2024, 2025) for t in ("DET", "KC") for w in (1, 2, 3)])
    lines = [json.loads(r) for r in season_report.season_report(rows).toJSON().collect()]
    return rows, lines


def _found(spark, given, *documents):
    values = variant_documents.read_values(docs(spark, *documents))
    return sorted(((r.sourceFile, r.code, r.team, r.detail) for r in report_documents.document_problems(values, given[0]).collect()), key=str)


def test_a_whole_report(spark, given):
    season = lambda s: [x for x in given[1] if x["season"] == s]
    assert _found(spark, given, {"metadata": GOOD, "rows": season(2024)}, {"metadata": GOOD | {"upstreamSnapshots": ["a", "b"], "timeOrigins": {"x": None}}, "rows": given[1]}) == []


def test_odd_documents(spark, given):
    three = ["E_GOVERNED_INPUT_CHECKSUM_MISMATCH", "E_PROVENANCE_MISSING", "E_TEMPORAL_METADATA_MISSING"]
    got = _found(spark, given, "5", "{", "[]", {"metadata": None, "rows": None}, {"metadata": {"checksum": 5}, "rows": []})
    assert [(f, c) for f, c, _, _ in got] == [(f"{i}.json", c) for i in range(5) for c in three]


def test_lines_on_one_side(spark, given):
    lines = [x for x in given[1] if x["season"] == 2024]
    moved = [lines[0], lines[1] | {"team": "BUF"}]
    got = [r[1:] for r in _found(spark, given, {"metadata": GOOD, "rows": moved})]
    assert got == [("E_UNWEIGHTED_AGGREGATION_USED", "BUF", "season 2024: reported without rows"), ("E_UNWEIGHTED_AGGREGATION_USED", lines[1]["team"], "season 2024: rows without a report line")]


def test_fields_and_values(spark, given):
    lines = [dict(x) for x in given[1] if x["season"] == 2024]
    lines[0] |= {"passRate": 0, "fantasyPointsForQBPerGame": 1.5, "mood": "x"}
    lines[1] |= {"secondsPerPlay": "slow", "redZoneTripsTotal": 0}
    got = [r[1:] for r in _found(spark, given, {"metadata": GOOD | {"methodologyVersion": 3, "upstreamChecksums": {"p": "A" * 64}}, "rows": lines})]
    one, two = lines[0]["team"], lines[1]["team"]
    assert sorted(got, key=str) == sorted([
        ("E_WITHHELD_FIELD_PRESENT", None, "passRate"), ("E_WITHHELD_FIELD_PRESENT", None, "fantasyPointsForQBPerGame"), ("E_UNDOCUMENTED_FIELD_PRESENT", None, "mood"),
        ("E_APPROXIMATED_DENOMINATOR_UNAUTHORIZED", None, "passRate"), ("E_WITHHELD_FIELD_ZERO_FILLED", one, "passRate"), ("E_UNWEIGHTED_AGGREGATION_USED", two, "secondsPerPlay"),
        ("E_REDZONE_NULL_INVARIANT_VIOLATED", two, "redZoneTripsTotal 0"), ("E_METHODOLOGY_VERSION_UNKNOWN", None, "3"), ("E_UPSTREAM_SOURCE_CHECKSUM_MISSING", None, "upstream source p"),
    ], key=str)
