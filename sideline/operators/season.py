"""Team-season aggregates, season rankings and current top lists."""

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sideline import config
from sideline.functions.numeric import exact_round, lit
from sideline.functions.text import locale_order
from sideline.operators import ranking

_SORTED_TAGS = sorted(config.TAGS)
_GROUP = ["season", "team"]


def _flags(over: str) -> list[Column]:
    """One flag per tag of the closed list: a hash aggregate, unlike a collected set."""
    return [F.expr(f"bool_or({over.format(tag=tag)}) AS _tag_{tag}") for tag in _SORTED_TAGS]


def week_cells(rows: DataFrame, values: dict[str, str], more: Sequence[Column] = ()) -> DataFrame:
    """Sums of expressions per (season, team, week), with the row count."""
    return rows.groupBy(*_GROUP, "week").agg(
        F.count(F.lit(1)).alias("games"),
        *[F.expr(f"sum({sql}) AS {name}") for name, sql in values.items()],
        *more,
    )


def season_sums(cells: DataFrame, names: Sequence[str], more: Sequence[Column] = ()) -> DataFrame:
    """Sums over the weeks of each team-season, added in week order.

    Floating-point sums depend on their order, and a shuffle has none: the last digit, and with it a
    rounded tie, would change from run to run. A season has at most 22 weeks, so its cells are
    collected, sorted and added one by one. A null adds nothing.
    """
    grouped = cells.groupBy(*_GROUP).agg(
        F.sum("games").alias("games"),
        F.max("week").alias("latestWeek"),
        F.sort_array(F.collect_list(F.struct("week", *names))).alias("_cells"),
        *more,
    )
    start = ", ".join(f"'{n}', 0D" for n in names)
    step = ", ".join(f"'{n}', a.{n} + coalesce(c.{n}, 0D)" for n in names)
    folded = f"aggregate(_cells, named_struct({start}), (a, c) -> named_struct({step}))"
    kept = [c for c in grouped.columns if c != "_cells"]
    return grouped.selectExpr(*kept, f"inline(array({folded}))")


def _shaped(sums: DataFrame, *more: str) -> DataFrame:
    tags = ", ".join(f"CASE WHEN _tag_{tag} THEN '{tag}' END" for tag in _SORTED_TAGS)
    return sums.selectExpr(
        "season", "team", "games", "latestWeek", f"array_compact(array({tags})) AS tags", *more,
        *[f"{m} / games AS {m}" for m in config.SEASON_MEANS],
    )


def team_season_means(states: DataFrame) -> DataFrame:
    """Games, latest week, tag union and 20 plain means per (season, team), without narrative."""
    cells = week_cells(
        states, {m: m for m in config.SEASON_MEANS}, _flags("array_contains(tags, '{tag}')")
    )
    return _shaped(season_sums(cells, config.SEASON_MEANS, _flags("_tag_{tag}")))


def team_seasons(states: DataFrame) -> DataFrame:
    """``team_season_means`` with the season narrative: the most frequent weekly summary.

    Of equally frequent summaries the first in dictionary order is taken. A summary names its week,
    so its count is complete within the week and the best of the weekly bests is the best of the
    season. Rows are combined per summary first, which spreads a large team-season over many tasks.
    """
    per_summary = states.groupBy(*_GROUP, "week", "summary").agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.expr(f"sum({m}) AS {m}") for m in config.SEASON_MEANS],
        *_flags("array_contains(tags, '{tag}')"),
    )
    words = "collate(summary, 'UNICODE')"
    cells = per_summary.groupBy(*_GROUP, "week").agg(
        F.sum("rows").alias("games"),
        *[F.expr(f"sum({m}) AS {m}") for m in config.SEASON_MEANS],
        *_flags("_tag_{tag}"),
        F.expr(f"min_by(struct(rows, summary), struct(-rows AS votes, {words} AS words)) AS best"),
    )
    best = F.expr(
        "min_by(best.summary, struct(-best.rows AS votes, collate(best.summary, 'UNICODE') AS words)) AS summary"
    )
    return _shaped(season_sums(cells, config.SEASON_MEANS, [*_flags("_tag_{tag}"), best]), "summary")


def season_order(value: Column, with_week: bool = True) -> list[Column]:
    """Value, then season desc, latest week desc and team; the stability lists leave the week out."""
    week = [F.desc("latestWeek")] if with_week else []
    return [value, F.desc("season"), *week, locale_order(F.col("team")).asc()]


def publication_order() -> list[Column]:
    """Order of the aggregates: season desc, latest week desc, team."""
    return [F.desc("season"), F.desc("latestWeek"), locale_order(F.col("team")).asc()]


def ordered_seasons(seasons: DataFrame) -> DataFrame:
    return seasons.orderBy(*publication_order())


def rank_seasons(
    seasons: DataFrame, rankings: dict = config.SEASON_SCORE_RANKINGS
) -> DataFrame:
    """Rank team-seasons by averaged scores; the summary carries the label of the ranking."""
    labels = " ".join(f"WHEN '{name}' THEN '{label}'" for name, (_, label) in rankings.items())
    melted = ranking.melt_rankings(
        seasons, {name: col for name, (col, _) in rankings.items()},
        ["team", "season", "latestWeek", "games", "tags", "summary"],
    )
    ranked = ranking.number_rows(melted, season_order(F.desc("value")), by=["ranking"])
    return ranked.selectExpr(
        "ranking", "team", "season", "latestWeek", "games", f"{exact_round('value', 2)} AS score",
        "rank", "tags", f"concat(CASE ranking {labels} END, ': ', summary) AS summary",
    )


def pace_boost(seconds: str) -> str:
    """Faster than 40 seconds a play earns 2.5 points a second."""
    return f"greatest(0D, {lit(config.PACE_BOOST_CEILING)} - {seconds}) * {lit(config.PACE_BOOST_FACTOR)}"


def offense_score(position: str) -> str:
    """Linear offense score of a position over the season means."""
    return " + ".join(
        f"({pace_boost('secondsPerPlay') if field == 'paceBoost' else field}) * {lit(factor)}"
        for field, factor in config.OFFENSE_FORMULAS[position]
    )


POSITIONAL = {
    "offense": (offense_score, "{p} offense environment from production + pace/usage context."),
    "matchup": (lambda p: f"fantasyPointsAllowed{p}",
                "{p} matchup environment based on fantasy points allowed."),
}


def rank_positions(
    seasons: DataFrame, family: str, positions=config.POSITIONS
) -> DataFrame:
    """Rank team-seasons per position: ``offense`` by formula, ``matchup`` by mean points allowed."""
    score, sentence = POSITIONAL[family]
    melted = ranking.melt_rankings(
        seasons, {p: score(p) for p in positions},
        ["team", "season", "latestWeek", "games", "tags"],
    ).withColumnRenamed("ranking", "position")
    ranked = ranking.number_rows(melted, season_order(F.desc("value")), by=["position"])
    before, after = sentence.split("{p}")
    return ranked.selectExpr(
        "position", "team", "season", "latestWeek", "games", f"{exact_round('value', 2)} AS score",
        "rank", "tags", f"concat('{before}', position, '{after}') AS summary",
    )


class TopList(NamedTuple):
    """A current top list: ranked expression, label, direction, and whether ties look at the week."""

    value: str
    label: str
    descending: bool = True
    with_week: bool = True


MOST_STABLE = TopList("stabilityScore", config.STABILITY_LABEL, True, False)
MOST_VOLATILE = TopList("volatilityScore", config.VOLATILITY_LABEL, True, False)
LEAST_VOLATILE = TopList("volatilityScore", config.VOLATILITY_LABEL, False, False)


def top_lists(
    seasons: DataFrame, lists: dict[str, TopList], size: int = config.SNAPSHOT_SIZE
) -> DataFrame:
    """Several top lists in one pass, keyed by ``list``, with fresh ranks from 1.

    The limit on the rank lets every task drop all but its own first rows before the shuffle.
    """
    melted = ", ".join(
        f"'{name}', {t.value}, {t.value if t.descending else f'-({t.value})'}, "
        f"{'latestWeek' if t.with_week else '0'}"
        for name, t in lists.items()
    )
    kept = [c for c in ("team", "season", "latestWeek", "games", "tags", "summary")
            if c in seasons.columns]
    rows = seasons.selectExpr(*kept, f"stack({len(lists)}, {melted}) AS (list, value, _key, _week)")
    order = Window.partitionBy("list").orderBy(
        F.desc("_key"), F.desc("season"), F.desc("_week"), locale_order(F.col("team")).asc()
    )
    return (
        rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
        .withColumn("score", F.expr(exact_round("value", 2)))
        .withColumn("rank", F.col("rank").cast("bigint"))
        .select("list", *kept, "score", "rank")
    )


def _labelled(top: DataFrame, lists: dict[str, TopList]) -> DataFrame:
    labels = " ".join(f"WHEN '{name}' THEN '{t.label}'" for name, t in lists.items())
    return top.drop("games").withColumn(
        "summary", F.expr(f"concat(CASE list {labels} END, ': ', summary)")
    )


def most_stable(seasons: DataFrame, size: int = config.SNAPSHOT_SIZE) -> DataFrame:
    lists = {"most_stable": MOST_STABLE}
    return _labelled(top_lists(seasons, lists, size), lists)


def most_volatile(seasons: DataFrame, size: int = config.SNAPSHOT_SIZE) -> DataFrame:
    lists = {"most_volatile": MOST_VOLATILE}
    return _labelled(top_lists(seasons, lists, size), lists)


def least_volatile(seasons: DataFrame, size: int = config.SNAPSHOT_SIZE) -> DataFrame:
    lists = {"least_volatile": LEAST_VOLATILE}
    return _labelled(top_lists(seasons, lists, size), lists)


def snapshot(seasons: DataFrame, size: int = config.SNAPSHOT_SIZE) -> DataFrame:
    """The six current top lists."""
    lists = {f"top_{n}": TopList(col, label) for n, (col, label) in config.SEASON_SCORE_RANKINGS.items()}
    lists.update(
        most_stable=MOST_STABLE, most_volatile=MOST_VOLATILE, least_volatile=LEAST_VOLATILE
    )
    return _labelled(top_lists(seasons, lists, size), lists)


def positional_snapshot(seasons: DataFrame, family: str, size: int = config.SNAPSHOT_SIZE) -> DataFrame:
    """Top rows of each positional ranking."""
    score, sentence = POSITIONAL[family]
    lists = {p: TopList(score(p), "") for p in config.POSITIONS}
    before, after = sentence.split("{p}")
    top = top_lists(seasons.drop("summary"), lists, size).withColumnRenamed("list", "position")
    return top.withColumn("summary", F.expr(f"concat('{before}', position, '{after}')"))


def scope(rows: DataFrame, season: int | None = None, week: int | None = None) -> DataFrame:
    """One row: the selected slice, the seasons in it (latest first) and their last weeks."""
    return ranking.latest_weeks(rows).agg(
        F.lit(season).cast("int").alias("selectedSeason"),
        F.lit(week).cast("int").alias("selectedWeek"),
        F.sort_array(F.collect_list("season"), asc=False).alias("seasonsIncluded"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("season", "latestWeek")))).alias(
            "latestWeekBySeason"
        ),
    )
