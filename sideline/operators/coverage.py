"""Do the rows cover the expected teams and weeks? Every problem is listed, none raises."""

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sideline import config
from sideline.functions.lineage import written
from sideline.operators.ranking import number_rows


class Expectation(NamedTuple):
    """Expected league. ``games_per_team`` and ``season`` are used by the bye-aware check only."""

    teams: Sequence[str]
    weeks: Sequence[int]
    games_per_team: int = 0
    season: int = 0


FULL_SEASON_2024 = Expectation(
    config.LEAGUE_TEAMS, config.REGULAR_SEASON_WEEKS, config.REGULAR_SEASON_GAMES, 2024
)
EXCERPT_2024 = Expectation(("ATL", "BUF", "DET", "KC"), (1, 4, 9), 1, 2024)


def expected_teams(spark: SparkSession, expectation: Expectation) -> DataFrame:
    return spark.createDataFrame([(t,) for t in expectation.teams], "team string")


def expected_grid(spark: SparkSession, expectation: Expectation) -> DataFrame:
    """One row per expected (team, week)."""
    weeks = F.array(*[F.lit(w) for w in expectation.weeks])
    return expected_teams(spark, expectation).withColumn("week", F.explode(weeks))


def _in_weeks(expectation: Expectation) -> str:
    return f"week IN ({', '.join(str(w) for w in expectation.weeks)})"


def _listed(cells: DataFrame, problems: dict[str, tuple[str, str, str]]) -> DataFrame:
    """Turn conditions into rows (kind, team, week, occurrences, message)."""
    items = ", ".join(
        f"CASE WHEN {cond} THEN named_struct('kind', '{kind}', 'occurrences', bigint({times}), "
        f"'message', {message}) END"
        for kind, (cond, times, message) in problems.items()
    )
    listed = cells.selectExpr("team", "week", f"inline_outer(array_compact(array({items})))").where(
        "kind IS NOT NULL"
    )
    whole_team = "kind IN ('missing_team', 'unexpected_team', 'game_count')"
    return listed.selectExpr(
        "kind", "team", f"if({whole_team}, NULL, int(week)) AS week", "occurrences", "message"
    )


def counted(rows: DataFrame) -> DataFrame:
    """Games per (team, week, season), written once; the checks below take it in place of rows."""
    return written(_cells(rows), "cells")


def _cells(rows: DataFrame) -> DataFrame:
    if "_games" in rows.columns:
        return rows
    return rows.groupBy("team", "week", "season").agg(F.count(F.lit(1)).alias("_games"))


def dense_problems(rows: DataFrame, expectation: Expectation) -> DataFrame:
    """Every expected team in every expected week, once; seasons are not looked at.

    Data and expected grid are combined in one aggregate per (team, week): one shuffle of counts
    instead of an anti-join per rule.
    """
    spark = rows.sparkSession
    seen = _cells(rows).selectExpr("team", "week", "_games AS n", "0 AS planned")
    planned = expected_grid(spark, expectation).selectExpr("team", "week", "0L AS n", "1 AS planned")
    cells = seen.unionByName(planned).groupBy("team", "week").agg(
        F.sum("n").alias("n"), F.max("planned").alias("planned")
    )
    per_team = Window.partitionBy("team")
    cells = cells.withColumns(
        {
            "total": F.sum("n").over(per_team),
            "expected": F.max("planned").over(per_team),
            "place": F.row_number().over(per_team.orderBy("week")),
        }
    )
    return _listed(
        cells,
        {
            "duplicate": ("n > 1", "n - 1",
                          "concat('duplicate row for team \"', team, '\" week ', week)"),
            "missing_team": ("place = 1 AND expected = 1 AND total = 0", "1",
                             "concat('missing team \"', team, '\" (no rows)')"),
            "missing_week": ("n = 0 AND planned = 1 AND total > 0", "1",
                             "concat('team \"', team, '\" is missing week ', week)"),
            "unexpected_team": ("place = 1 AND expected = 0", "1",
                                "concat('unexpected team \"', team, '\" not in expected set')"),
            "unexpected_week": (f"n > 0 AND NOT {_in_weeks(expectation)}", "1",
                                "concat('team \"', team, '\" has unexpected week ', week, "
                                "' (outside expected weeks)')"),
        },
    )


def bye_aware_problems(rows: DataFrame, expectation: Expectation) -> DataFrame:
    """Every expected team with its exact number of games inside the window; a bye is no gap."""
    spark = rows.sparkSession
    rows = rows if "_games" in rows.columns else counted(rows)
    games, season = expectation.games_per_team, expectation.season
    seen = rows.selectExpr("team", "week", "season", "_games AS n", "0 AS planned")
    planned = expected_teams(spark, expectation).selectExpr(
        "team", "int(NULL) AS week", f"{season} AS season", "0L AS n", "1 AS planned"
    )
    per_season = seen.unionByName(planned).groupBy("team", "week", "season").agg(
        F.sum("n").alias("n"), F.max("planned").alias("planned")
    )
    per_team, per_week = Window.partitionBy("team"), Window.partitionBy("team", "week")
    cells = per_season.withColumns(
        {
            "total": F.sum("n").over(per_team),
            "expected": F.max("planned").over(per_team),
            "place": F.row_number().over(per_team.orderBy("week", "season")),
            "inWeek": F.sum("n").over(per_week),
            "weekPlace": F.row_number().over(per_week.orderBy("season")),
        }
    )
    window = ", ".join(str(w) for w in sorted(set(expectation.weeks)))
    problems = _listed(
        cells,
        {
            "duplicate": ("weekPlace = 1 AND inWeek > 1", "inWeek - 1",
                          "concat('duplicate row for team \"', team, '\" week ', week)"),
            "wrong_season": (f"n > 0 AND NOT season <=> {season}", "n",
                             "concat('team \"', team, '\" week ', week, ' has season ', "
                             f"coalesce(string(season), 'undefined'), ', expected season {season}')"),
            "missing_team": ("place = 1 AND expected = 1 AND total = 0", "1",
                             "concat('missing team \"', team, '\" (no rows)')"),
            "game_count": (f"place = 1 AND expected = 1 AND total > 0 AND total <> {games}", "1",
                           "concat('team \"', team, '\" has ', total, ' game row(s), expected exactly "
                           f"{games} (bye-aware: an absent week is treated as a bye, not a coverage gap, "
                           "but the total game-row count must still match exactly)')"),
            "unexpected_team": ("place = 1 AND expected = 0", "1",
                                "concat('unexpected team \"', team, '\" not in expected set')"),
            "out_of_window": (f"weekPlace = 1 AND inWeek > 0 AND NOT {_in_weeks(expectation)}", "1",
                              "concat('team \"', team, '\" has out-of-window week ', week, "
                              f"' (expected window weeks: {window})')"),
        },
    )
    wanted = len(expectation.teams) * games
    total = rows.agg(F.coalesce(F.sum("_games"), F.lit(0)).alias("rows")).where(f"rows <> {wanted}").selectExpr(
        "'row_count' AS kind", "string(NULL) AS team", "int(NULL) AS week", "1L AS occurrences",
        f"concat('total row count (', rows, ') must equal {wanted} "
        "(expectedTeams.length * expectedGamesPerTeam)') AS message",
    )
    return problems.unionByName(total)


def coverage_summary(rows: DataFrame, problems: DataFrame, expectation: Expectation) -> DataFrame:
    """One row: valid, errorCount, errorsByKind, teamCount, totalRowCount, isFullLeague."""
    teams = _cells(rows).groupBy("team").agg(F.sum("_games").alias("n")).selectExpr(
        "string(NULL) AS kind", "1L AS teams", "n AS rows", "0L AS errors"
    )
    kinds = problems.groupBy("kind").agg(F.sum("occurrences").alias("errors")).selectExpr(
        "kind", "0L AS teams", "0L AS rows", "errors"
    )
    by_kind = F.collect_list(F.when(F.col("kind").isNotNull(), F.struct("kind", "errors")))
    totals = teams.unionByName(kinds).agg(
        F.coalesce(F.sum("teams"), F.lit(0)).alias("teamCount"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("totalRowCount"),
        F.coalesce(F.sum("errors"), F.lit(0)).alias("errorCount"),
        F.map_from_entries(F.sort_array(by_kind)).alias("errorsByKind"),
    )
    return totals.selectExpr(
        "errorCount = 0 AS valid", "errorCount", "errorsByKind", "teamCount", "totalRowCount",
        f"errorCount = 0 AND teamCount = {len(expectation.teams)} AS isFullLeague",
    )


def league_grid(
    spark: SparkSession,
    metrics: dict[str, float],
    season: int = 2024,
    teams: Sequence[str] = config.LEAGUE_TEAMS,
    weeks: Sequence[int] = tuple(range(1, 7)),
) -> DataFrame:
    """Placeholder rows: every team in every week with the same metrics and a rotating opponent.

    The opponent of team i in week w is team (i + w) mod n, or the next one if that is itself.
    """
    names = F.array(*[F.lit(t) for t in teams])
    n = len(teams)
    grid = spark.createDataFrame(list(enumerate(teams)), "i int, team string").withColumn(
        "week", F.explode(F.array(*[F.lit(w) for w in weeks]))
    )
    slot = (F.col("i") + F.col("week")) % n
    slot = F.when(slot == F.col("i"), (slot + 1) % n).otherwise(slot)
    return grid.select(
        F.lit(season).alias("season"), "week", "team",
        F.element_at(names, slot + 1).alias("opponent"),
        *[F.lit(float(v)).alias(m) for m, v in metrics.items()],
    )


def rotating_grid(pairs: DataFrame, metrics: dict[str, float], weeks: Sequence[int] = tuple(range(1, 7))) -> DataFrame:
    """``league_grid`` for leagues of any size: ``pairs`` has the teams of each season, repeats do not matter.

    Teams are numbered by name within their season by a range-split sort; a cell finds its opponent
    by season and number in a hash join, so no list of teams reaches the driver or one task.
    """
    numbered = written(number_rows(pairs.select("season", "team").distinct(), [F.asc("team")], by=["season"]), "league")
    sizes = numbered.groupBy("season").agg(F.count(F.lit(1)).alias("n"))
    cells = numbered.join(sizes, "season").selectExpr("season", "team", "rank - 1 AS i", "n", f"explode(array({', '.join(map(str, weeks))})) AS week")
    slot = "(i + week) % n"
    cells = cells.selectExpr("*", f"if({slot} = i, (i + week + 1) % n, {slot}) AS slot")
    others = numbered.selectExpr("season", "rank - 1 AS slot", "team AS opponent")
    return cells.join(others, ["season", "slot"]).select(
        "season", "week", "team", "opponent", *[F.lit(float(v)).alias(m) for m, v in metrics.items()])
