import pytest
from pyspark.sql import functions as F

from sideline import config, schemas
from sideline.operators import coverage, readiness
from sideline.plans import jobs
from tests.rows import frame, row


def _rows(spark, cells):
    return spark.createDataFrame(cells, "team string, week int, season int")


def _season(skip=()):
    """32 teams, 17 games in 18 weeks: every team has its own bye."""
    return [(t, w, 2024) for i, t in enumerate(config.LEAGUE_TEAMS) for w in range(1, 19)
            if w != 1 + i % 18 and (t, w) not in skip]


def _found(problems):
    return sorted((r["kind"], r["team"], r["week"], r["occurrences"]) for r in problems.collect())


def test_full_season_is_covered(spark):
    rows = _rows(spark, _season())
    problems = coverage.bye_aware_problems(rows, coverage.FULL_SEASON_2024)
    assert _found(problems) == []
    got = coverage.coverage_summary(rows, problems, coverage.FULL_SEASON_2024).first()
    assert got["valid"] and got["isFullLeague"] and got["totalRowCount"] == 544 and got["teamCount"] == 32


@pytest.mark.parametrize("change, want", [
    (lambda c: c[1:], [("game_count", "ARI", None, 1), ("row_count", None, None, 1)]),
    (lambda c: c + [c[0], c[0]], [("duplicate", "ARI", 2, 2), ("game_count", "ARI", None, 1), ("row_count", None, None, 1)]),
    (lambda c: [x for x in c if x[0] != "WAS"], [("missing_team", "WAS", None, 1), ("row_count", None, None, 1)]),
    (lambda c: [("ARI", 2, 2023), *c[1:]], [("wrong_season", "ARI", 2, 1)]),
    (lambda c: [("ARI", 19, 2024), *c[1:]], [("out_of_window", "ARI", 19, 1)]),
    (lambda c: c + [("XXX", 1, 2024)], [("row_count", None, None, 1), ("unexpected_team", "XXX", None, 1)]),
    (lambda c: [("ARI", 2, None), *c[1:]], [("wrong_season", "ARI", 2, 1)]),
])
def test_bye_aware_problems(spark, change, want):
    problems = coverage.bye_aware_problems(_rows(spark, change(_season())), coverage.FULL_SEASON_2024)
    assert _found(problems) == sorted(want, key=str) or _found(problems) == want


def test_dense_problems(spark):
    e = coverage.Expectation(("A", "B", "C"), (1, 2, 3))
    rows = _rows(spark, [("A", 1, 1), ("A", 1, 2), ("A", 2, 1), ("A", 3, 1), ("A", 7, 1), ("B", 1, 1), ("B", 3, 1), ("Z", 1, 1)])
    problems = coverage.dense_problems(rows, e)
    assert _found(problems) == [
        ("duplicate", "A", 1, 1), ("missing_team", "C", None, 1), ("missing_week", "B", 2, 1),
        ("unexpected_team", "Z", None, 1), ("unexpected_week", "A", 7, 1)]
    got = coverage.coverage_summary(rows, problems, e).first()
    assert (got["valid"], got["errorCount"], got["teamCount"], got["totalRowCount"]) == (False, 5, 3, 8)
    assert got["errorsByKind"] == {k: 1 for k in ("duplicate", "missing_team", "missing_week", "unexpected_team", "unexpected_week")}


def test_empty_input(spark):
    e = coverage.Expectation(("A", "B"), (1, 2), 2, 2024)
    rows = _rows(spark, [])
    assert [k for k, *_ in _found(coverage.dense_problems(rows, e))] == ["missing_team"] * 2
    got = coverage.coverage_summary(rows, coverage.bye_aware_problems(rows, e), e).first()
    assert not got["valid"] and got["teamCount"] == 0 and got["totalRowCount"] == 0


def test_grid_covers_itself(spark):
    grid = coverage.league_grid(spark, jobs.PLACEHOLDER_METRICS)
    assert grid.count() == 192
    assert grid.where("team = opponent").isEmpty()
    e = coverage.Expectation(config.LEAGUE_TEAMS, range(1, 7))
    assert coverage.dense_problems(grid, e).isEmpty()
    first = grid.where("team = 'ARI'").orderBy("week").select("opponent").collect()
    assert [r[0] for r in first] == ["ATL", "BAL", "BUF", "CAR", "CHI", "CIN"]


def test_null_profile(spark):
    rows = frame(spark, [row(redZoneTdRate=None), row(week=2), row(week=3, pointsFor=float("nan"))])
    got = {r["field"]: r for r in readiness.null_profile(rows, schemas.METRICS, ["turnovers"]).collect()}
    assert len(got) == 28
    see = lambda f: (got[f]["finiteCount"], got[f]["nullCount"], got[f]["status"])
    assert see("redZoneTdRate") == (2, 1, "partial_nulls")
    assert see("pointsFor") == (2, 1, "partial_nulls")
    assert see("drives") == (3, 0, "available")
    assert see("turnovers") == (3, 0, "deferred_insufficient_data")
    assert see("pressureRateAllowed") == (3, 0, "deferred_insufficient_data")
    empty = readiness.null_profile(rows.where("false")).where("field = 'drives'").first()
    assert (empty["finiteCount"], empty["nullCount"], empty["status"]) == (0, 0, "partial_nulls")


def test_a_hot_cell_is_counted_not_listed(spark):
    e = coverage.Expectation(("A", "B"), (1,))
    rows = spark.range(30_000).select(F.lit("A").alias("team"), F.lit(1).alias("week"), F.lit(2024).alias("season"))
    assert _found(coverage.dense_problems(rows, e)) == [("duplicate", "A", 1, 29_999), ("missing_team", "B", None, 1)]


def test_a_grid_of_any_league_is_the_listed_one(spark):
    names = [f"T{i:02d}" for i in range(9)]
    pairs = spark.createDataFrame([(2024, t) for t in names * 2] + [(2025, t) for t in names[:1]], "season int, team string")
    got = coverage.rotating_grid(pairs, {"drives": 2.0}, (1, 2, 9))
    want = coverage.league_grid(spark, {"drives": 2.0}, 2024, names, (1, 2, 9)).select(got.columns)
    assert sorted(map(tuple, got.where("season = 2024").collect())) == sorted(map(tuple, want.collect()))
    assert {(r.week, r.opponent) for r in got.where("season = 2025").collect()} == {(1, "T00"), (2, "T00"), (9, "T00")}
    assert coverage.rotating_grid(pairs.limit(0), {"drives": 2.0}).count() == 0
