"""Context tables and the season report."""

import pytest
from pyspark.sql import functions as F

from sideline import schemas
from sideline.operators import context_tables as ct
from sideline.operators import season_report
from tests.brute import half_up
from tests.rows import frame, row


def _offense(spark):
    values = {c: "neutral" for c in ct.OFFENSE_ENUMS} | {
        "qb_stability_label": "strong", "scoring_environment_label": "weak", "modifier_strength": "light",
        "source_status": "operator_seeded", "offensive_playcaller": "p", "head_coach": "h", "notes": ""}
    rows = [(i, 2026.0, t, *[values[c] for c in ct.OFFENSE_ENUMS], "p", "h", "", ["a"]) for i, t in enumerate(ct.OFFENSE.teams)]
    names = ["rowIndex", "season", "team", *ct.OFFENSE_ENUMS, "offensive_playcaller", "head_coach", "notes", "context_tags"]
    return spark.createDataFrame(rows, ", ".join(
        f"{n} {'int' if n == 'rowIndex' else 'double' if n == 'season' else 'array<string>' if n == 'context_tags' else 'string'}" for n in names))


def _tagged(spark, kind):
    schema = schemas.context_schema(kind)
    rows = []
    for i, t in enumerate(ct.CONTEXT_TEAMS):
        r = {f: "x" for f in schema.names} | {"season": 2026.0, "team": t, "source_status": "operator_seeded"}
        r |= {f: ["calm", "risky"] for f in schema.names if f.endswith("_tags")}
        r |= {f: ["calm"] for f in schema.names if f.startswith("positive")} | {f: ["risky"] for f in schema.names if f.startswith("risk")}
        rows.append(tuple([i] + [r[n] for n in schema.names]))
    return spark.createDataFrame(rows, "rowIndex int, " + schema.toDDL())


def _found(df, rules):
    return [r["message"] for r in ct.table_problems(df, rules).collect()]


@pytest.mark.parametrize("spoil, message", [
    (None, None),
    (("pace_label", "'quick'"), "Row 0: invalid pace_label 'quick'."),
    (("season", "2025D"), "Row 0: season must equal 2026."),
    (("context_tags", "array('')"), "Row 0: context_tags must contain non-empty strings."),
    (("notes", "string(NULL)"), "Row 0: notes must be a string."),
    (("extra", "1"), "unexpected fields: ['extra']"),
])
def test_offense_table(spark, spoil, message):
    df = _offense(spark)
    got = _found(df.withColumn(spoil[0], F.expr(spoil[1])) if spoil else df, ct.OFFENSE)
    assert got == [] if message is None else message in got


def test_offense_table_teams(spark):
    df = _offense(spark)
    assert sorted(_found(df.where("team <> 'WAS'"), ct.OFFENSE)) == ["Expected 32 teams, found 31.", "Missing team: WAS"]
    got = _found(df.replace("WAS", "ARI", "team"), ct.OFFENSE)
    assert sorted(got) == ["Missing team: WAS", "duplicate team code 'ARI' (2 rows)."]
    got = _found(df.drop("notes"), ct.OFFENSE)
    assert "missing required fields: ['notes']" in got and sum("notes must be a string." in m for m in got) == 32
    got = _found(df.limit(0).withColumn("extra", F.lit(1)), ct.OFFENSE)
    assert "unexpected fields: ['extra']" in got and "Expected 32 teams, found 0." in got and len(got) == 34


@pytest.mark.parametrize("column, value, message", [
    (None, None, None),
    ("positive_team_context_tags", ["calm", "depth_chart_dependency"], "includes known risk tag(s)."),
    ("risk_team_context_tags", ["other"], "must include all positive/risk tags."),
    ("personnel_usage_tags", ["a", "a"], "personnel_usage_tags must not contain duplicates."),
    ("qb_context", "", "qb_context must be a non-empty string."),
    ("source_status", "x", "source_status must be one of"),
])
def test_context_table(spark, column, value, message):
    df = _tagged(spark, "context")
    if column:
        df = df.withColumn(column, F.array(*map(F.lit, value)) if isinstance(value, list) else F.lit(value))
    got = _found(df, ct.CONTEXT)
    assert got == [] if message is None else len(got) >= 23 and all("Row" in m for m in got) and any(message in m for m in got)


@pytest.mark.parametrize("column, value, message", [
    (None, None, None),
    ("context_tags", ["calm"], "context_tags must match"),
    ("context_tags", ["calm", "risky", "third"], "context_tags must match"),
    ("risk_context_tags", ["risky", "risky"], "risk_context_tags must not include duplicate tags."),
    ("source_status", "x", "invalid source_status 'x'."),
])
def test_landing_table(spark, column, value, message):
    df = _tagged(spark, "landing")
    if column:
        df = df.withColumn(column, F.array(*map(F.lit, value)) if isinstance(value, list) else F.lit(value))
    got = _found(df, ct.LANDING)
    assert got == [] if message is None else any(message in m for m in got)


def _weeks():
    return [row(week=w, pointsFor=20.0 + w, drives=8.0 + w, pointsPerDrive=round((20 + w) / (8 + w), 6),
                redZoneTrips=float(w % 3), redZoneTdRate=None if w % 3 == 0 else 0.25 * (w % 3)) for w in range(1, 7)]


def test_season_report(spark):
    rows = _weeks()
    got = season_report.season_report(frame(spark, rows)).first()
    assert got["pointsForTotal"] == 141 and got["pointsForPerGame"] == 23.5 and got["gamesPlayed"] == 6
    drives = sum(r["drives"] for r in rows)
    assert got["pointsPerDrive"] == half_up(sum(r["pointsPerDrive"] * r["drives"] for r in rows) / drives, 2)
    known = [r for r in rows if r["redZoneTdRate"] is not None]
    trips = sum(r["redZoneTrips"] for r in rows)
    assert got["redZoneTdRate"] == half_up(sum(r["redZoneTdRate"] * r["redZoneTrips"] for r in known) / trips, 4)
    assert got["warnings"] == []
    dry = season_report.season_report(frame(spark, [row(redZoneTrips=0.0, redZoneTdRate=None)])).first()
    assert dry["redZoneTdRate"] is None and dry["warnings"] == ["W_ZERO_REDZONE_OPPORTUNITIES"]


GOOD = {"provenanceStatus": "governed_real_data", "governanceStatus": "governed", "governanceSource": "explicit_marker",
        "checksum": "a", "expectedChecksum": "a", "dataThrough": "d", "sourceSnapshotAt": "2025-02-02",
        "upstreamSnapshots": ["2025-02-01", "2025-02-02"], "generatedAt": "g"}


@pytest.mark.parametrize("change, code", [
    ({}, None),
    ({"provenanceStatus": None}, "E_PROVENANCE_MISSING"),
    ({"governanceStatus": "fixture"}, "E_PROVENANCE_NOT_GOVERNED"),
    ({"checksum": "b"}, "E_GOVERNED_INPUT_CHECKSUM_MISMATCH"),
    ({"dataThrough": None}, "E_TEMPORAL_METADATA_MISSING"),
    ({"sourceSnapshotAt": "2025-02-01"}, "E_TEMPORAL_METADATA_CONFLATED"),
])
def test_report_metadata(spark, change, code):
    rows = frame(spark, _weeks())
    report = season_report.season_report(rows)
    got = season_report.report_problems(report, rows, GOOD | change, ["DET"], 6).collect()
    assert [r["code"] for r in got] == ([code] if code else [])


def test_report_values_and_columns(spark):
    rows = frame(spark, _weeks())
    report = season_report.season_report(rows).withColumns(
        {"epaPerPlay": F.lit(0.5), "redZoneTdRate": F.lit(None).cast("double"), "passRate": F.lit(0.0), "mood": F.lit(1)})
    got = {r["code"] for r in season_report.report_problems(report, rows, GOOD, ["DET", "KC"], 7).collect()}
    assert got == {"E_UNWEIGHTED_AGGREGATION_USED", "E_REDZONE_NULL_INVARIANT_VIOLATED", "E_WITHHELD_FIELD_PRESENT",
                   "E_UNDOCUMENTED_FIELD_PRESENT", "E_COVERAGE_TEAM_MISSING", "E_COVERAGE_ROW_COUNT_MISMATCH",
                   "E_APPROXIMATED_DENOMINATOR_UNAUTHORIZED", "E_WITHHELD_FIELD_ZERO_FILLED"}


def test_report_lines_on_one_side(spark):
    rows = frame(spark, _weeks())
    report = season_report.season_report(rows)
    moved = report.withColumn("season", F.col("season") + 1)
    got = [r["detail"] for r in season_report.report_problems(moved, rows, GOOD, ["DET"], 6).collect()]
    assert len(got) == 2 and any("reported without rows" in d for d in got) and any("rows without a report line" in d for d in got)


@pytest.mark.parametrize("change, code", [
    ({"upstreamChecksums": {"plays": "a" * 64, "games": "b"}}, "E_UPSTREAM_SOURCE_CHECKSUM_MISSING"),
    ({"upstreamChecksums": {"plays": None}}, "E_UPSTREAM_SOURCE_CHECKSUM_MISSING"),
    ({"methodologyVersion": "x"}, "E_METHODOLOGY_VERSION_UNKNOWN"),
    ({"methodologyVersion": "public_offensive_environment_2024_v1"}, None),
    ({"timeOrigins": {"dataThrough": "a.t", "generatedAt": "a.t"}}, "E_TEMPORAL_METADATA_CONFLATED"),
    ({"timeOrigins": {"dataThrough": "a.t", "generatedAt": "b.t"}}, None),
])
def test_declared_report_metadata(spark, change, code):
    rows = frame(spark, _weeks())
    got = season_report.report_problems(season_report.season_report(rows), rows, GOOD | change, ["DET"], 6).collect()
    assert [r["code"] for r in got] == ([code] if code else [])


def test_withheld_zero_and_blocked_columns(spark):
    rows = frame(spark, _weeks())
    report = season_report.season_report(rows).withColumns({"passRate": F.lit(0.0), "successRate": F.lit(0.4), "pointsAgainstTotal": F.lit(0)})
    got = [(r["code"], r["detail"]) for r in season_report.report_problems(report, rows, GOOD, ["DET"], 6).collect()]
    assert sorted(got) == sorted([
        *[("E_WITHHELD_FIELD_PRESENT", c) for c in ("passRate", "successRate", "pointsAgainstTotal")],
        *[("E_APPROXIMATED_DENOMINATOR_UNAUTHORIZED", c) for c in ("passRate", "successRate")],
        *[("E_WITHHELD_FIELD_ZERO_FILLED", c) for c in ("passRate", "pointsAgainstTotal")]])
