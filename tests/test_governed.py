import hashlib

import pytest

from sideline import config, schemas
from sideline.operators import coverage, forecast, readiness
from sideline.operators.quality import QualityError
from sideline.plans import jobs
from sideline.sources import governed as source
from tests.rows import candidate, docs, governed, row, write

ROWS = [row("ATL", 4, 2024, redZoneTdRate=None, redZoneTrips=0.0), row("BUF", 9, 2024), row("DET", 1, 2024), row("KC", 1, 2024)]


def test_governed_rows_lose_fantasy_and_pressure(spark):
    used = source.consume_governed(docs(spark, governed(ROWS)))
    got = {r["team"]: r for r in used.rows.collect()}
    assert list(used.rows.columns) == [*schemas.ORIGIN, *schemas.KEYS, *schemas.GOVERNED_METRICS]
    assert got["ATL"]["redZoneTdRate"] is None and got["BUF"]["pressureRateAllowed"] is None
    assert used.upstream["season"] == 2024 and used.upstream["governanceNotes"] == "n"
    assert used.upstream["deferredFields"] == ["pressureRateAllowed"]


def _md(**changes):
    doc = governed(ROWS)
    doc["metadata"].update(changes)
    return doc


def _row0(**changes):
    doc = governed(ROWS)
    doc["rows"][0].update(changes)
    return doc


def _drop(field):
    doc = governed(ROWS)
    del doc["rows"][0][field]
    return doc


@pytest.mark.parametrize("doc, message", [
    (_md(provenanceStatus="sample"), "provenanceStatus must be governed_real_data, received sample"),
    (_md(provenanceStatus=""), "provenanceStatus must be a non-empty string"),
    (_md(governance=None), "metadata.governance block is required"),
    (_md(governance={"governanceStatus": "ungoverned", "governanceSource": "explicit_marker"}), "governanceStatus must be governed"),
    (_md(governance={"governanceStatus": "governed", "governanceSource": "path_inference"}), "governanceSource must be explicit_marker"),
    (_md(deferredFields=["turnovers"]), "must include pressureRateAllowed"),
    (_md(deferredFields="pressureRateAllowed"), "must be an array of non-empty strings"),
    (governed(ROWS, sourceArtifacts=["", "x"]), "sourceArtifacts must be an array"),
    (governed(ROWS, metadata=None), "metadata block is required"),
    (governed(ROWS, artifact="x"), "expected artifact team_week_raw_v0, received x"),
    (_row0(fantasyPointsForQB=3.0), "fantasy split field fantasyPointsForQB must be null"),
    (_row0(pressureRateAllowed=0.0), "pressureRateAllowed must be null/deferred"),
    (_drop("pressureRateAllowed"), "pressureRateAllowed must be null/deferred"),
    (_drop("drives"), "drives must be a finite number or null"),
    (_row0(drives="many"), "drives must be a finite number or null"),
    (_row0(week=1.5), "week must be an integer"),
    (_row0(teamCode=""), "teamCode must be a non-empty string"),
])
def test_governed_refusals(spark, doc, message):
    with pytest.raises(QualityError, match=message):
        source.consume_governed(docs(spark, doc))


def _cmd(**changes):
    doc = candidate(ROWS)
    doc["metadata"].update(changes)
    return doc


def test_candidate_keeps_nulls_and_whitelists(spark):
    used = source.consume_candidate(docs(spark, candidate(ROWS)))
    got = {r["team"]: r for r in used.rows.collect()}
    assert used.rows.columns == [*schemas.ORIGIN, *schemas.KEYS, *schemas.METRICS]
    assert got["ATL"]["redZoneTdRate"] is None and got["KC"]["fantasyPointsForQB"] is None


@pytest.mark.parametrize("doc, message", [
    (_cmd(provenanceStatus="governed_real_data"), "is not an accepted candidate-input status"),
    (_cmd(governance={"governanceStatus": "governed", "governanceSource": "x"}), 'governanceStatus "governed" is not'),
    (_cmd(governance={"governanceStatus": "ungoverned", "governanceSource": " "}), "governanceSource must be a non-empty"),
    (_cmd(governance="no"), "metadata.governance block is required"),
    (candidate(ROWS, metadata=None), "metadata block is required"),
])
def test_candidate_refusals(spark, doc, message):
    with pytest.raises(QualityError, match=message):
        source.consume_candidate(docs(spark, doc))


def test_rehearsal(spark):
    used = source.consume_candidate(docs(spark, candidate(ROWS)))
    got = readiness.rehearse(used, coverage.EXCERPT_2024).first()
    assert got["rehearsalStatus"] == "rehearsed" and not got["promoted"] and not got["governed"]
    assert got["partialNullFields"] == ["redZoneTdRate"]
    assert set(got["deferredInsufficientFields"]) == {config.PRESSURE_FIELD, *schemas.FANTASY_FIELDS}
    held = readiness.rehearse(used).first()
    assert held["rehearsalStatus"] == "withheld_invalid_coverage"
    assert held["coverage"]["errorsByKind"]["missing_team"] == 28
    assert readiness.dry_run(used).first()["provenanceStatus"] == "partial_real_data"


def test_forecast_input(spark):
    used = source.consume_governed(docs(spark, governed(ROWS)))
    art = forecast.forecast_input(used, forecast.DEFAULT_CUTOFF, coverage.EXCERPT_2024)
    got = art.first()
    assert got["readinessStatus"] == "ready_minimal_boundary"
    want = sorted(m for m in schemas.GOVERNED_METRICS if m != config.PRESSURE_FIELD)
    assert got["forecastInputColumns"] == want
    assert got["forecastCutoff"]["cutoffBeforeTargetSeason"]
    assert forecast.forecast_rows(used, art).columns == ["season", "week", "team", *want]
    evidence = forecast.coverage_evidence(used, art, "abc").first()
    assert list(evidence.asDict()) == ["kind", "source", "input", "emitted", "nullSemantics", "forecastGateProjection"]
    assert evidence["source"]["sha256"] == "abc"
    evidence = evidence["input"].asDict() | evidence["nullSemantics"].asDict()
    assert evidence["presentTeams"] == ["ATL", "BUF", "DET", "KC"] and len(evidence["missingTeams"]) == 28
    per = {c["column"]: c for c in evidence["perColumn"]}
    assert per["redZoneTdRate"]["nullCount"] == 1 and per["redZoneTdRate"]["forecastInput"]
    assert not per[config.PRESSURE_FIELD]["forecastInput"]


@pytest.mark.parametrize("as_of, message", [
    (None, "explicit forecast cutoff is required"),
    (" ", "explicit forecast cutoff is required"),
    ("soon", "malformed"),
    ("2025-03-01T00:00:00", "timezone-ambiguous"),
    ("2025-03-01", "timezone-ambiguous"),
    ("2025-09-01T00:00:00.000Z", "on or after the start"),
    ("2025-08-31T23:00:00-05:00", "on or after the start"),
])
def test_cutoff_gate(spark, as_of, message):
    with pytest.raises(QualityError, match=message):
        forecast.require_cutoff(spark, as_of)


def test_accepted_cutoffs(spark):
    for as_of in ("2025-08-31T23:59:59Z", "2025-09-01T01:00:00+05:00", "2025-03-01T00:00Z"):
        forecast.require_cutoff(spark, as_of)


def test_other_season_and_leakage(spark):
    used = source.consume_governed(docs(spark, governed(ROWS, season=2023)))
    with pytest.raises(QualityError, match="a 2023 source"):
        forecast.forecast_input(used, forecast.DEFAULT_CUTOFF)
    bad = ["fantasyPointsForQB", "pressureRateAllowed", "nextWeek", "points2025", "Label", "drives"]
    assert len(forecast.leaking_columns(bad)) == 5
    with pytest.raises(QualityError, match="fantasy split column"):
        forecast.require_no_leakage(bad)


def test_governed_export(spark, tmp_path):
    path = write(tmp_path / "g.json", governed(ROWS))
    digest = hashlib.sha256((tmp_path / "g.json").read_bytes()).hexdigest()
    run = jobs.governed_export(spark, path, forecast.DEFAULT_CUTOFF, digest, coverage.EXCERPT_2024)
    man = run.manifest.first()
    assert (man["rowCount"], man["teamCount"], man["sha256"]) == (4, 4, digest)
    assert run.rows.count() == 4
    assert run.evidence.first()["forecastGateProjection"]["coversAllTeams"] and run.problems.isEmpty()
    with pytest.raises(QualityError, match="sha256"):
        jobs.governed_export(spark, path, forecast.DEFAULT_CUTOFF, "0" * 64, coverage.EXCERPT_2024)
    rehearsal = jobs.candidate_report(spark, write(tmp_path / "c.json", candidate(ROWS)), coverage.EXCERPT_2024)
    assert rehearsal.report.first()["rehearsalStatus"] == "rehearsed" and rehearsal.problems.isEmpty()
    short = jobs.candidate_report(spark, write(tmp_path / "c.json", candidate(ROWS[1:])), coverage.EXCERPT_2024)
    assert {r["kind"]: r["n"] for r in short.problems.groupBy("kind").agg({"occurrences": "sum"}).toDF("kind", "n").collect()} == {
        k: n for k, n in short.report.first()["coverage"]["errorsByKind"].items()}
