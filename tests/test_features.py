import pytest
from pyspark.sql import functions as F

from sideline import config
from sideline.operators import features, movement, scoring
from sideline.operators.quality import QualityError
from sideline.plans import jobs
from tests.rows import frame, row

OPTIONS = features.FeatureOptions("2026-01-01T00:00:00Z", "2025-09-01T00:00:00Z", 2025, 2026, expected_team_count=2)


def _moves(spark, seasons=(2025,), teams=("DET", "BUF")):
    rows = [row(team=t, season=s, week=w, pointsPerDrive=2 + 0.1 * w) for t in teams for s in seasons for w in range(1, 7)]
    return movement.movement_v1(movement.movement_v0(scoring.build_states(frame(spark, rows))))


@pytest.fixture(scope="module")
def table(spark):
    return features.build_features(_moves(spark), OPTIONS)


def test_feature_rows(table):
    got = table.rows.collect()
    assert [r["teamId"] for r in got] == ["BUF", "DET"]
    f = got[0]["features"].asDict()
    assert list(f) == list(config.FEATURES)
    assert f["points_per_drive"] == 2.5 and f["offense_direction"] == "improving"
    assert {f[t] for t in f if t.endswith("_tier")} == {"unknown"}
    header = table.header.first()
    assert header["coverage"]["weeks"] == [1, 2, 3, 4, 5, 6] and header["coverage"]["isFullLeague"]
    assert table.catalogue.count() == 17


def test_valid_table_has_no_problems(table):
    assert features.validate_features(table, OPTIONS).collect() == []
    features.require_valid(table, OPTIONS)


@pytest.mark.parametrize("seasons, teams, expected, message", [
    ((2024, 2025), ("DET",), None, r"season\(s\) 2024 not matching feature season 2025"),
    ((2025,), ("DET", "XX"), ("DET", "BUF"), 'unexpected team "XX"'),
])
def test_guards(spark, seasons, teams, expected, message):
    with pytest.raises(QualityError, match=message):
        features.build_features(_moves(spark, seasons, teams), OPTIONS._replace(expected_teams=expected))


def test_duplicate_team_is_refused(spark):
    moves = _moves(spark)
    with pytest.raises(QualityError, match='duplicate team "BUF"'):
        features.build_features(moves.unionByName(moves.where("teamId = 'BUF'")), OPTIONS)


def _value(name, value):
    return lambda t: t._replace(rows=t.rows.withColumn("features", F.col("features").withField(name, F.lit(value))))


def _header(name, value, part=None):
    def spoil(t):
        column = F.col(part).withField(name, F.lit(value)) if part else F.lit(value)
        return t._replace(header=t.header.withColumn(part or name, column))

    return spoil


@pytest.mark.parametrize("spoil, message", [
    (_value("points_per_drive", "n/a"), "points_per_drive must be a finite number or null"),
    (_value("epa_per_play", float("nan")), "epa_per_play must be a finite number or null"),
    (_value("offense_direction", "up"), "offense_direction must be one of improving"),
    (_value("pace_tier", "quick"), "pace_tier must be one of fast"),
    (_value("surprise", 1.0), 'undeclared feature "surprise"'),
    (_value("Fantasy_Points", 1.0), "forbidden fantasy-point field present: Fantasy_Points"),
    (lambda t: t._replace(rows=t.rows.withColumn("features", F.col("features").dropFields("epa_per_play"))),
     'missing declared feature "epa_per_play"'),
    (lambda t: t._replace(rows=t.rows.withColumn("confidence", F.lit(1.5))), "confidence must be a number in"),
    (lambda t: t._replace(rows=t.rows.withColumn("featureCoverageStatus", F.lit("full"))), "featureCoverageStatus must be one of"),
    (lambda t: t._replace(rows=t.rows.where("teamId = 'BUF'")), "must equal the number of team rows"),
    (_header("isFullLeague", False, "coverage"), "coverage.isFullLeague"),
    (_header("cutoffAt", ""), "cutoffAt must be a non-empty ISO string"),
    (_header("artifact", "x"), "artifact must be"),
    (_header("governanceStatus", "blessed", "governance"), "governanceStatus must be one of"),
    (lambda t: t._replace(catalogue=t.catalogue.where("name <> 'pace_tier'")), 'missing canonical feature "pace_tier"'),
    (lambda t: t._replace(catalogue=t.catalogue.unionByName(t.catalogue.where("name = 'pace_tier'"))), "more than once"),
    (lambda t: t._replace(catalogue=t.catalogue.replace("tier", "number", "type")), 'must be "tier"'),
])
def test_spoiled_tables(table, spoil, message):
    found = [r["message"] for r in features.validate_features(spoil(table), OPTIONS).collect()]
    assert any(message in m for m in found), found


def test_placeholder_league_through_the_whole_chain(spark):
    options = features.FeatureOptions(
        "2026-06-24T00:00:00Z", "2025-09-01T00:00:00Z", 2024, 2025, expected_teams=config.LEAGUE_TEAMS
    )
    out = jobs.scaffold_features(spark, options)
    assert out.rows.count() == 32
    header = out.header.first()
    assert header["coverage"]["isFullLeague"] and header["coverage"]["weeks"] == [1, 2, 3, 4, 5, 6]
    f = out.rows.first()["features"]
    assert f["points_per_drive"] == 2.0 and f["offense_direction"] == "stable"
    features.require_valid(out, options)
