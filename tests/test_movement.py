import random

import pytest
from pyspark.sql import functions as F

from sideline import config
from sideline.operators import movement, profiles, provenance, scoring, season
from tests.brute import half_up, scores
from tests.rows import frame, placed, row


def _moves(spark, rows, placed_rows=False):
    states = scoring.build_states((placed if placed_rows else frame)(spark, rows))
    return {(r["season"], r["teamId"]): r for r in movement.with_covered_weeks(movement.movement_v0(states)).collect()}


def test_declining_series(spark):
    rows = [row(week=w, pointsPerDrive=3.0 - 0.2 * w, epaPerPlay=0.2 - 0.03 * w, successRate=0.5 - 0.01 * w,
                pressureRateAllowed=0.2 + 0.02 * w, secondsPerPlay=26 + 0.3 * w, neutralPassRate=0.5 + 0.02 * w,
                turnovers=float(w // 2))
            for w in range(1, 9)]
    m = _moves(spark, rows)[(2025, "DET")]
    assert m["earlyWindow"]["weeks"] == [1, 2, 3] and m["lateWindow"]["weeks"] == [6, 7, 8]
    assert m["weeksCovered"] == list(range(1, 9))
    assert m["movement"].asDict() == {
        "offenseDirection": "declining", "passEnvironmentDirection": "more_pass_heavy", "paceDirection": "slower",
        "pressureDirection": "worsening", "volatilityDirection": "rising",
        "verdict": "offensive_environment_declining_pressure_worsening"}
    assert m["warnings"] == []


def test_windows_match_plain_python(spark):
    rng = random.Random(11)
    rows, sizes = [], {"A": 3, "B": 4, "C": 5, "D": 6, "E": 11}
    for team, n in sizes.items():
        for w in rng.sample(range(1, 19), n):
            rows.append(row(team=team, week=w, **{m: round(rng.uniform(0.1, 0.9), 6) for m in (
                "successRate", "explosivePlayRate", "pressureRateAllowed", "neutralPassRate", "pointsPerDrive")}))
    got = _moves(spark, rows)
    for team, n in sizes.items():
        mine = sorted((r for r in rows if r["team"] == team), key=lambda r: r["week"])
        k = 3 if n >= 6 else 2 if n >= 4 else 0
        m = got[(2025, team)]
        for side, part in (("earlyWindow", mine[:k]), ("lateWindow", mine[len(mine) - k:])):
            assert m[side]["weeks"] == [r["week"] for r in part] and m[side]["games"] == k
            for metric, digits in config.WINDOW_DIGITS.items():
                values = [(scores(r) | r)[metric] for r in part]
                want = half_up(sum(values) / k, digits) if k else None
                assert m[side]["averages"][metric] == (want if want is None else pytest.approx(want, abs=1e-12))
        for metric in config.DELTA_METRICS:
            e, late = m["earlyWindow"]["averages"][metric], m["lateWindow"]["averages"][metric]
            assert m["deltas"][metric] == (None if not k else half_up(late - e, 4))
    assert got[(2025, "A")]["warnings"] == [config.SHORT_SEASON_WARNING]
    assert set(got[(2025, "A")]["movement"].asDict().values()) == {config.NO_DATA}


def test_windows_count_rows_and_keep_repeats(spark):
    rows = [row(week=1, successRate=0.1 * i) for i in range(1, 5)] + [row(week=2, successRate=0.9)] * 2
    m = _moves(spark, rows, placed_rows=True)[(2025, "DET")]
    assert m["weeksCovered"] == [1, 1, 1, 1, 2, 2]
    assert m["earlyWindow"]["weeks"] == [1, 1, 1] and m["lateWindow"]["weeks"] == [1, 2, 2]
    assert m["earlyWindow"]["averages"]["successRate"] == 0.2
    assert m["lateWindow"]["averages"]["successRate"] == half_up((0.4 + 0.9 + 0.9) / 3, 4)


@pytest.mark.parametrize("late, want", [
    (dict(pointsPerDrive=2.5, epaPerPlay=0.2, successRate=0.4, explosivePlayRate=0.05), "declining"),
    (dict(pointsPerDrive=2.5), "improving"),
    (dict(pointsPerDrive=2.5, epaPerPlay=0.2, successRate=0.4), "improving"),
    (dict(pointsPerDrive=2.5, successRate=0.4), "stable"),
    (dict(explosivePlayRate=0.10), "declining"),
    (dict(), "stable"),
])
def test_offense_vote(spark, late, want):
    rows = [row(week=w, **(late if w > 3 else {})) for w in range(1, 7)]
    assert _moves(spark, rows)[(2025, "DET")]["movement"]["offenseDirection"] == want


def test_v1_drops_fantasy_fields_and_keeps_labels(spark):
    states = scoring.build_states(frame(spark, [row(week=w) for w in range(1, 7)]))
    v0 = movement.movement_v0(states)
    v1 = movement.movement_v1(v0)
    a, b = v0.first(), v1.first()
    assert a["movement"] == b["movement"]
    kept = [m for m in config.WINDOW_DIGITS if not m.startswith("fantasy")]
    assert list(b["lateWindow"]["averages"].asDict()) == kept
    assert list(b["deltas"].asDict()) == [m for m in kept if m != "volatilityScore"]


@pytest.mark.parametrize("path, marker, full, want_movement, want_profile, governance, source", [
    ("/x/fixtures/a.json", None, False, "fixture_scaffold", "fixture_scaffold", "fixture", "path_inference"),
    ("/x/data/sample/a.json", "governed_real_data", True, "governed_real_data", "governed_real_data", "governed", "explicit_marker"),
    ("/x/data/sample/a.json", "governed_real_data", False, "partial_real_data", "fixture_scaffold", "ungoverned", "explicit_marker"),
    ("/promoted/a.json", None, True, "unknown_provenance", "unknown_provenance", "unknown", "unknown"),
    (None, "sample", True, "sample", "unknown_provenance", "fixture", "explicit_marker"),
    (None, "partial_real_data", True, "partial_real_data", "unknown_provenance", "ungoverned", "explicit_marker"),
    (None, "made_up", True, "unknown_provenance", "unknown_provenance", "unknown", "unknown"),
])
def test_provenance(spark, path, marker, full, want_movement, want_profile, governance, source):
    df = spark.createDataFrame([(path, marker, full)], "p string, m string, f boolean")
    p, m, f = F.col("p"), F.col("m"), F.col("f")
    status = provenance.movement_provenance(p, m, f)
    blocks = provenance.governance_columns(F.col("status"), m)
    got = df.withColumns({"status": status, "profile": provenance.profile_provenance(p, m, f)}).select(
        "status", "profile", *[c.alias(n) for n, c in blocks.items()]).first()
    assert tuple(got)[:4] == (want_movement, want_profile, governance, source)
    notes = {"path_inference": [config.NOTE_PATH_INFERENCE], "unknown": [config.NOTE_NO_SIGNAL]}.get(source)
    assert got["promotionNotes"] == notes


def test_coverage_metadata(spark):
    rows = frame(spark, [row(team=t, week=w) for t in config.LEAGUE_TEAMS for w in (2, 5)])
    full = provenance.movement_metadata(rows, "./fixtures/a.json", "governed_real_data").first()
    assert full["provenanceStatus"] == "governed_real_data" and full["coverage"]["isFullLeague"]
    assert full["coverage"]["weeks"] == [2, 5] and full["coverage"]["latestWeek"] == 5
    assert full["inputSources"][0].asDict() == {"path": "fixtures/a.json", "type": "fixture"}
    other = provenance.movement_metadata(rows.replace("WAS", "XXX", "team"), None, None).first()
    assert not other["coverage"]["isFullLeague"] and other["inputSources"][0]["path"] == "unknown"


def test_profiles_and_their_metadata(spark):
    nan = float("nan")
    cols = "season int, team string, games bigint, latestWeek int, fantasyEnvironmentScore double, neutralPassRate double, secondsPerPlay double, volatilityScore double"
    rows = [(2025, "ARI", 3, 3, 85.0, 0.57, 27.0, 45.0), (2025, "BUF", 4, 4, 70.0, 0.43, 29.0, 60.0),
            (2025, "CAR", 3, 3, 49.999, 0.5, 28.0, 52.0), (2024, "XX", 3, 9, nan, None, float("inf"), nan)]
    seasons = spark.createDataFrame(rows, cols)
    got = {r["teamId"]: r for r in profiles.build_profiles(seasons, "t", "s").collect()}
    tiers = ("offenseTier", "passEnvironmentTier", "paceTier", "volatilityTier", "marketTier")
    assert [got["ARI"][t] for t in tiers] == ["elite", "pass_heavy", "fast", "stable", "unknown"]
    assert [got["BUF"][t] for t in tiers] == ["strong", "run_heavy", "slow", "volatile", "unknown"]
    assert [got["CAR"][t] for t in tiers] == ["weak", "balanced", "neutral", "unknown", "unknown"]
    assert [got["XX"][t] for t in tiers] == ["unknown"] * 5
    assert got["XX"]["warnings"] == [config.MARKET_WARNING, *config.TIER_WARNINGS.values()]
    assert [s["value"] for s in got["XX"]["signals"]] == [None] * 4
    assert [s["value"] for s in got["CAR"]["signals"]] == [50.0, 0.5, 28.0, 52.0]

    md = provenance.profile_metadata(seasons, None, None, "t").first()
    c = md["coverage"]
    assert c["unexpectedTeams"] == ["XX"] and len(c["missingTeams"]) == 29 and c["weeks"] == [3, 4, 9]
    assert c["missingTeams"][13:16] == ["LV", "LAC", "LAR"] or "LV" in c["missingTeams"]
    assert md["provenanceNotes"] == [config.NOTE_UNKNOWN_PATH, config.NOTE_INCOMPLETE]
    assert (c["gamesPerTeamMin"], c["gamesPerTeamMax"], c["latestWeek"]) == (3, 4, 9)


def test_season_means_feed_profiles(spark):
    states = scoring.build_states(frame(spark, [row(week=w) for w in range(1, 4)]))
    assert profiles.build_profiles(season.team_season_means(states)).first()["paceTier"] == "neutral"
