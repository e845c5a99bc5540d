"""Both provenance ladders per file: every outcome."""

import pytest

from sideline.operators import provenance

TEAMS = ("A", "B")
MARKERS = ("fixture_scaffold", "sample", "partial_real_data", "governed_real_data", "unknown_provenance", "promoted", None)
PLACES = {"data/sample/": "sample", "fixtures/": "fixture", "x/fixtures/": "fixture", "elsewhere/": "unknown"}
ROWS = {"full": ["A", "B", "A"], "part": ["A"], "more": ["A", "B", "C"], "none": [], "null": ["A", "B", None]}


def _wanted(place, marker, full):
    kind = PLACES[place]
    moved = {"governed_real_data": "governed_real_data" if full else "partial_real_data"}.get(marker, marker)
    if marker in ("promoted", None):
        moved = "unknown_provenance" if kind == "unknown" else "fixture_scaffold"
    profile = "governed_real_data" if marker == "governed_real_data" and full else "unknown_provenance" if kind == "unknown" else "fixture_scaffold"
    status = {"governed_real_data": "governed", "partial_real_data": "ungoverned", "unknown_provenance": "unknown"}.get(moved, "fixture")
    source = "explicit_marker" if marker not in ("promoted", None) else "unknown" if status == "unknown" else "path_inference"
    return moved, profile, status, source


@pytest.fixture(scope="module")
def found(spark):
    files = [(f"{p}{m}-{r}.json", m, p, r) for p in PLACES for m in MARKERS for r in ROWS]
    declared = spark.createDataFrame([f[:2] for f in files], "sourceFile string, marker string")
    rows = spark.createDataFrame([(f[0], t) for f in files for t in ROWS[f[3]]], "sourceFile string, team string")
    return files, {r.sourceFile: r for r in provenance.document_provenance(declared, rows, TEAMS).collect()}


def test_every_outcome(found):
    files, got = found
    assert len(got) == len(files)
    for name, marker, place, rows in files:
        r = got[name]
        assert r.isFullLeague == (rows == "full") and r.teamCount == len({t for t in ROWS[rows] if t})
        assert (r.movementProvenance, r.profileProvenance, r.governanceStatus, r.governanceSource) == _wanted(place, marker, rows == "full")
        assert (r.promotionNotes is None) == (r.governanceSource == "explicit_marker")
    assert {r.movementProvenance for r in got.values()} == set(MARKERS[:5])
    assert {(r.governanceStatus, r.governanceSource) for r in got.values()} >= {("governed", "explicit_marker"), ("fixture", "path_inference"), ("unknown", "unknown"), ("unknown", "explicit_marker")}
