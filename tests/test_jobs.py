import json
from pathlib import Path

import pytest

from sideline.operators.quality import QualityError
from sideline.plans import jobs
from tests.rows import envelope, raw_record, row, write

TEAMS = ("BUF", "DET", "KC")


def _rows(weeks=6, seasons=(2024, 2025)):
    return [row(team=t, season=s, week=w, epaPerPlay=round(0.01 * w + 0.02 * i, 4))
            for s in seasons for i, t in enumerate(TEAMS) for w in range(1, weeks + 1)]


def _read(folder, name):
    return [json.loads(line) for p in sorted(Path(folder, name).glob("part-*")) for line in p.read_text().splitlines()]


def test_whole_run_is_published(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write(tmp_path / "in" / "a.json", [raw_record(r) for r in _rows(seasons=(2024,))])
    write(tmp_path / "in" / "b.json", envelope(_rows(seasons=(2025,)), provenanceStatus="fixture_scaffold"))
    run = jobs.run_documents(spark, str(tmp_path / "in"), generated_at="2026-01-01T00:00:00Z")
    out = str(tmp_path / "out")
    paths = jobs.publish(run, out)
    assert len(paths) == 13
    rankings = sorted(p.parent.name + "/" + p.name for p in Path(out, "rankings").glob("family=*/metric=*"))
    assert len(rankings) == 25
    assert len(_read(out, "rankings/family=rankings/metric=team_power")) == 36
    assert len(_read(out, "rankings/family=latest_week/metric=qb_matchups")) == 6
    assert len(_read(out, "rankings/family=season_to_date/metric=te_offense_environment")) == 6
    (md,) = _read(out, "pipeline_metadata")
    assert (md["sourceRowCount"], md["filteredRowCount"], md["sourceFileCount"]) == (36, 36, 2)
    assert md["seasonsIncluded"] == [2025, 2024] and md["latestWeekBySeason"] == {"2024": 6, "2025": 6}
    assert md["selectedSeason"] is None
    moves = _read(out, "team_environment_movement_v1")
    assert len(moves) == 6 and moves[0]["weeksCovered"] == [1, 2, 3, 4, 5, 6]
    assert "fantasyPointsForQB" not in moves[0]["deltas"]
    (mm,) = _read(out, "team_environment_movement_metadata")
    assert mm["governance"]["governanceStatus"] == "fixture" and mm["governance"]["governanceSource"] == "explicit_marker"
    assert len(_read(out, "current_snapshot")) == 36
    assert len(_read(out, "weekly_states")) == 36
    # a second run replaces the first
    assert len(jobs.publish(run, out)) == 13
    assert len(_read(out, "team_environment_profiles_v0")) == 6


def test_slice_is_an_equality_and_a_cutoff(spark, tmp_path):
    path = write(tmp_path / "a.json", [raw_record(r) for r in _rows()])
    run = jobs.run_documents(spark, path, season_=2025, week=4)
    md = run.metadata.first()
    assert (md["sourceRowCount"], md["filteredRowCount"]) == (36, 12)
    assert md["latestWeekBySeason"] == {2025: 4} and md["selectedWeek"] == 4
    assert {r["week"] for r in run.states.select("week").collect()} == {1, 2, 3, 4}
    assert run.movement_v0.first()["earlyWindow"]["games"] == 2


def test_rows_outside_the_slice_are_checked_too(spark, tmp_path):
    bad = _rows() + [row(season=2024, week=9, neutralPassRate=2.0)]
    path = write(tmp_path / "a.json", [raw_record(r) for r in bad])
    with pytest.raises(QualityError, match="Invalid rate field neutralPassRate: 2"):
        jobs.run_documents(spark, path, season_=2025)


def test_empty_slice(spark, tmp_path):
    path = write(tmp_path / "a.json", [raw_record(r) for r in _rows()])
    with pytest.raises(QualityError, match="No rows remain after filters. selectedSeason=2030"):
        jobs.run_documents(spark, path, season_=2030)
