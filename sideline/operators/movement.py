"""Early against late weeks of a season."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sideline import config, schemas
from sideline.functions.lineage import written
from sideline.functions.numeric import exact_round, is_finite, lit
from sideline.operators.ranking import origin_order

_KEYS = ("season", "team")
_METRICS = tuple(config.WINDOW_DIGITS)
_LARGEST_WINDOW = 3


def week_games(states: DataFrame) -> DataFrame:
    """Rows per week of each team-season, as ``weekGames`` [(week, games)], and the window size.

    A week repeated in the input stays one entry with its count, so the array is as long as the
    season has weeks however many rows a team has.
    """
    per_week = states.groupBy(*_KEYS, "week").agg(F.count(F.lit(1)).alias("games"))
    return (
        per_week.groupBy(*_KEYS)
        .agg(
            F.sum("games").alias("games"),
            F.sort_array(F.collect_list(F.struct("week", "games"))).alias("weekGames"),
        )
        .selectExpr("*", "CASE WHEN games >= 6 THEN 3 WHEN games >= 4 THEN 2 ELSE 0 END AS size")
    )


def _edge(states: DataFrame, late: bool) -> DataFrame:
    """First (or last) rows of each team-season by week and input order.

    The limit on row_number lets every map task keep three rows of a team-season and drop the rest
    before the shuffle.
    """
    order = [F.col("week").desc() if late else F.col("week").asc(), *origin_order(states, late)]
    window = Window.partitionBy(*_KEYS).orderBy(*order)
    return (
        states.withColumn("place", F.row_number().over(window))
        .where(F.col("place") <= _LARGEST_WINDOW)
        .select(*_KEYS, F.lit("late" if late else "early").alias("side"), "place", "week", *_METRICS)
    )


def _mean(side: str, metric: str) -> str:
    """Mean of the finite values of one window, added in week order."""
    values = f"filter(transform({side}, r -> r.{metric}), v -> {is_finite('v')})"
    return f"aggregate({values}, 0D, (total, v) -> total + v) / nullif(size({values}), 0)"


def edge_windows(states: DataFrame) -> DataFrame:
    """Per team-season: the rows of the early and of the late window, in week order.

    Keys and metrics are written once; the counts and both edges read that narrow table, so the
    facts behind ``states`` are evaluated a single time.
    """
    origin = [c for c in schemas.ORIGIN if c in states.columns]
    states = written(states.select(*_KEYS, "week", *origin, *_METRICS), "windows")
    edges = _edge(states, late=False).unionByName(_edge(states, late=True))
    # at most three rows per side are collected
    sides = edges.groupBy(*_KEYS).agg(
        *[
            F.sort_array(
                F.collect_list(F.when(F.col("side") == side, F.struct("place", "week", *_METRICS))),
                asc=side == "early",
            ).alias(side)
            for side in ("early", "late")
        ]
    )
    kept = [f"filter({side}, r -> r.place <= size) AS {side}" for side in ("early", "late")]
    return week_games(states).join(sides, list(_KEYS)).selectExpr(
        *_KEYS, "games", "weekGames", "size", *kept
    )


def _with_averages(windows: DataFrame) -> DataFrame:
    means = windows.selectExpr(
        "*",
        *[f"{_mean(side, m)} AS {side}_{m}" for side in ("early", "late") for m in _METRICS],
    )
    return means.selectExpr(
        *windows.columns,
        *[
            f"{exact_round(f'{side}_{m}', config.WINDOW_DIGITS[m])} AS {side}_{m}"
            for side in ("early", "late")
            for m in _METRICS
        ],
    )


def _with_deltas(averages: DataFrame) -> DataFrame:
    gaps = averages.selectExpr(
        "*", *[f"late_{m} - early_{m} AS delta_{m}" for m in _METRICS]
    )
    return gaps.selectExpr(
        *averages.columns,
        "delta_volatilityScore AS volatilityGap",
        *[f"{exact_round(f'delta_{m}', config.DELTA_DIGITS)} AS delta_{m}" for m in config.DELTA_METRICS],
    )


def _direction(gap: str, step: float, up: str, down: str) -> str:
    return (
        f"CASE WHEN {gap} IS NULL THEN '{config.NO_DATA}' WHEN {gap} >= {lit(step)} THEN '{up}' "
        f"WHEN {gap} <= {lit(-step)} THEN '{down}' ELSE 'stable' END"
    )


def _offense_direction() -> str:
    """Vote of four deltas; a decline is looked for first, so two against two is declining."""
    votes = config.OFFENSE_VOTES.items()
    up = "(" + " + ".join(f"int(coalesce(delta_{m} >= {lit(s)}, false))" for m, s in votes) + ")"
    down = "(" + " + ".join(f"int(coalesce(delta_{m} <= {lit(-s)}, false))" for m, s in votes) + ")"
    known = "coalesce(" + ", ".join(f"delta_{m}" for m, _ in votes) + ")"
    return (
        f"CASE WHEN {known} IS NULL THEN '{config.NO_DATA}' "
        f"WHEN {down} >= 2 OR ({down} >= 1 AND {up} = 0) THEN 'declining' "
        f"WHEN {up} >= 2 OR ({up} >= 1 AND {down} = 0) THEN 'improving' ELSE 'stable' END"
    )


_VERDICT = f"""CASE
  WHEN offenseDirection = '{config.NO_DATA}' THEN '{config.NO_DATA}'
  WHEN offenseDirection = 'declining' AND pressureDirection = 'worsening'
    THEN 'offensive_environment_declining_pressure_worsening'
  WHEN offenseDirection = 'declining' THEN 'offensive_environment_declining'
  WHEN offenseDirection = 'improving' AND pressureDirection <> 'worsening'
    THEN 'offensive_environment_improving'
  WHEN volatilityDirection = 'rising' THEN 'environment_volatility_rising'
  ELSE 'environment_stable' END"""


def movement_flat(states: DataFrame) -> DataFrame:
    """Movement per team-season with plain columns early_*, late_*, delta_* and the labels."""
    deltas = _with_deltas(_with_averages(edge_windows(states)))
    labelled = deltas.selectExpr(
        "*",
        f"{_offense_direction()} AS offenseDirection",
        f"{_direction('delta_neutralPassRate', config.PASS_STEP, 'more_pass_heavy', 'less_pass_heavy')}"
        " AS passEnvironmentDirection",
        f"{_direction('delta_secondsPerPlay', config.PACE_STEP, 'slower', 'faster')} AS paceDirection",
        f"{_direction('delta_pressureRateAllowed', config.PRESSURE_STEP, 'worsening', 'improving')}"
        " AS pressureDirection",
        f"{_direction('volatilityGap', config.VOLATILITY_STEP, 'rising', 'falling')}"
        " AS volatilityDirection",
    )
    return labelled.selectExpr(
        "*", f"{_VERDICT} AS verdict",
        f"if(size = 0, array('{config.SHORT_SEASON_WARNING}'), array()) AS warnings",
    ).drop("volatilityGap")


def covered_weeks(counts: str = "weekGames") -> str:
    """The list of played weeks, a repeated week as often as it occurs."""
    return f"flatten(transform({counts}, w -> array_repeat(w.week, int(w.games))))"


def _struct(prefix: str, names) -> str:
    return "named_struct(" + ", ".join(f"'{n}', {prefix}_{n}" for n in names) + ")"


def movement_v0(states: DataFrame) -> DataFrame:
    """Nested movement records with 12 window averages and 11 deltas."""
    windows = [
        f"named_struct('weeks', {side}.week, 'games', size({side}), 'averages', "
        f"{_struct(side, _METRICS)}) AS {side}Window"
        for side in ("early", "late")
    ]
    return movement_flat(states).selectExpr(
        "team AS teamId", "team AS teamAbbr", "season", "weekGames", *windows,
        f"{_struct('delta', config.DELTA_METRICS)} AS deltas",
        "struct(offenseDirection, passEnvironmentDirection, paceDirection, pressureDirection, "
        "volatilityDirection, verdict) AS movement",
        "warnings",
    )


_FANTASY = [m for m in _METRICS if m.startswith("fantasy")]


def movement_v1(v0: DataFrame) -> DataFrame:
    """The same movement without fantasy fields: a projection of v0, nothing is computed again."""
    drop = [f"averages.{m}" for m in _FANTASY]
    return v0.withColumns(
        {
            "earlyWindow": F.col("earlyWindow").dropFields(*drop),
            "lateWindow": F.col("lateWindow").dropFields(*drop),
            "deltas": F.col("deltas").dropFields(*_FANTASY),
        }
    )


def with_covered_weeks(movement: DataFrame) -> DataFrame:
    """Replace the compact week counts by the published ``weeksCovered`` list."""
    return movement.selectExpr(
        *[f"{covered_weeks()} AS weeksCovered" if c == "weekGames" else c for c in movement.columns]
    )


def ordered_movement(movement: DataFrame) -> DataFrame:
    """Publication order: season desc, team."""
    return movement.orderBy(F.desc("season"), F.collate("teamId", "UNICODE"))
