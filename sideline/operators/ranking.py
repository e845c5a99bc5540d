"""Rankings of team-weeks: unique positions 1..n, in a total order."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sideline import config, schemas
from sideline.functions.lineage import written
from sideline.functions.numeric import exact_round
from sideline.functions.text import locale_order


def origin_order(df: DataFrame, backwards: bool = False) -> list[Column]:
    """Input order as the last tie-break, where the frame knows it: files by locale, then position."""
    keys = [locale_order(F.col(c)) if c == "sourceFile" else F.col(c) for c in schemas.ORIGIN if c in df.columns]
    return [k.desc() if backwards else k.asc() for k in keys]


def number_rows(df: DataFrame, order: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """Add ``rank``: the position of each row in ``order``, from 1, within each ``by`` value.

    A window over the whole frame would sort all rows in one task. Here the rows are range-split by
    the full sort key, so equal scores of any number spread over the slices, each slice numbers its
    own rows, and the number of rows in the slices before is added.
    """
    keys = [*[F.col(c) for c in by], *order]
    sliced = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # the id is the slice number in the high bits and the row position in the low 33
    sliced = sliced.withColumn("_id", F.monotonically_increasing_id())
    # range bounds are sampled: the slices must be fixed before they are read twice
    kept = written(sliced, "ranked").withColumn("_slice", F.shiftright("_id", 33))
    sizes = kept.groupBy(*by, "_slice").agg(
        F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *by, "_slice",
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first") + 1).alias("_start"),
    )
    placed = kept.join(starts, [*by, "_slice"])
    return placed.withColumn("rank", F.col("_id") + F.col("_start")).drop("_id", "_slice", "_start")


def melt_rankings(df: DataFrame, rankings: dict[str, str], keep: Sequence[str]) -> DataFrame:
    """One row per (ranking, input row) with the ranked value in ``value``."""
    pairs = ", ".join(f"'{name}', {column}" for name, column in rankings.items())
    return df.selectExpr(*keep, f"stack({len(rankings)}, {pairs}) AS (ranking, value)")


def _origin(df: DataFrame) -> list[str]:
    return [c for c in schemas.ORIGIN if c in df.columns]


def _published(ranked: DataFrame, *extra: str, text: bool = True) -> DataFrame:
    """Two-digit score next to the rank, which was taken on the unrounded value."""
    return ranked.selectExpr(
        *extra, "team", "season", "week", f"{exact_round('value', 2)} AS score", "rank",
        *(["tags", "summary"] if text else []),
    )


def rank_states(
    states: DataFrame,
    rankings: dict[str, str] = config.WEEKLY_RANKINGS,
    descending: bool = True,
    latest_week: bool = False,
    text: bool = True,
) -> DataFrame:
    """Rank team-weeks by several columns at once: value, season desc, week desc, team.

    ``latest_week`` ranks only the last week of each season (and leaves the week out of the key).
    Without ``text`` only keys and values are evaluated and sorted. With it, a single ranking takes
    tags and summary along; several rankings sort keys and values only and attach the text
    afterwards, by row, from the states as they were written once.
    """
    origin, carried = _origin(states), ["tags", "summary"] if text else []
    rows = states.select("team", "season", "week", *carried, *origin, *dict.fromkeys(rankings.values()))
    apart = text and len(rankings) > 1
    if apart or latest_week:
        rows = written(rows.withColumn("_row", F.monotonically_increasing_id()), "states")
    whole = rows
    rows = filter_latest_week(rows) if latest_week else rows
    keep = ["team", "season", "week", *(["_row"] if apart else carried), *origin]
    order = [F.desc("value") if descending else F.asc("value"), F.desc("season")]
    if not latest_week:
        order.append(F.desc("week"))
    order += [locale_order(F.col("team")).asc(), *origin_order(states)]
    melted = melt_rankings(rows, rankings, keep)
    ranked = number_rows(melted, order, by=["ranking"])
    if apart:
        ranked = ranked.join(whole.select("_row", *carried), "_row")
    return _published(ranked, "ranking", text=text)


def rank_by(states: DataFrame, column: str, descending: bool = True) -> DataFrame:
    """Rank team-weeks by one score or allowed-points column."""
    return rank_states(states, {column: column}, descending).drop("ranking")


def latest_weeks(rows: DataFrame) -> DataFrame:
    """Last week of each season."""
    return rows.groupBy("season").agg(F.max("week").alias("latestWeek"))


def filter_latest_week(states: DataFrame) -> DataFrame:
    """Rows of the last week of their season. Reads ``states`` twice: hand it a stored table."""
    last = latest_weeks(states).withColumnRenamed("latestWeek", "week")
    return states.join(last, ["season", "week"], "left_semi").select(*states.columns)
