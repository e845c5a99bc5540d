"""End-to-end jobs: load, check, score, rank, aggregate, compare, publish."""

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sideline import config, schemas
from sideline.functions.lineage import written
from sideline.functions.session import prepare
from sideline.operators import coverage, features, forecast, movement, profiles, provenance
from sideline.operators import quality, ranking, readiness, scoring, season
from sideline.operators.quality import QualityError
from sideline.sinks import publication
from sideline.sinks.artifacts import write_dataset
from sideline.sources import checksum, documents, governed


def slice_rows(rows: DataFrame, season_: int | None = None, week: int | None = None) -> DataFrame:
    """One season (equality) and the weeks up to a cutoff."""
    if season_ is not None:
        rows = rows.where(F.col("season") == season_)
    return rows if week is None else rows.where(F.col("week") <= week)


def canonical_watch(rows: DataFrame) -> quality.Watch:
    """A watch of the canonical rules, for the pass that writes something made of the rows."""
    located = [c for c in ("sourceFile", "rowIndex") if c in rows.columns] or ["season", "team", "week"]
    return quality.Watch(quality.canonical_rules(), located)


def require_canonical(rows: DataFrame) -> None:
    """Check all rows, in a pass of its own."""
    watch = canonical_watch(rows)
    quality.require_clean(quality.violations(rows, watch.rules, watch.locate), watch.locate)


def distinct_seasons(rows: DataFrame) -> DataFrame:
    """One row: the seasons, latest first."""
    return rows.select("season").distinct().agg(
        F.sort_array(F.collect_list("season"), asc=False).alias("seasonsIncluded")
    )


def run_metadata(
    rows: DataFrame, season_: int | None = None, week: int | None = None,
    source_path: str | None = None, source_files: int | None = None,
    generated_at: str | None = None,
) -> DataFrame:
    """One row of counts, seasons and last weeks, from one aggregate per season. Mapping keeps every
    row, so the mapped count is the source count."""
    inside = F.lit(True) if season_ is None else F.col("season") == season_
    inside = inside if week is None else inside & (F.col("week") <= week)
    per = rows.groupBy("season").agg(
        F.count(F.lit(1)).alias("source"), F.count_if(inside).alias("kept"),
        F.max(F.when(inside, F.col("week"))).cast("int").alias("latestWeek"),
    )
    seasons = F.when(F.col("kept") > 0, F.struct("season", "latestWeek"))
    return per.agg(
        F.coalesce(F.sum("source"), F.lit(0)).alias("sourceRowCount"),
        F.coalesce(F.sum("source"), F.lit(0)).alias("mappedRowCount"),
        F.coalesce(F.sum("kept"), F.lit(0)).alias("filteredRowCount"),
        F.sort_array(F.collect_list(F.when(F.col("kept") > 0, F.col("season"))), asc=False).alias("seasonsIncluded"),
        F.map_from_entries(F.sort_array(F.collect_list(seasons))).alias("latestWeekBySeason"),
    ).withColumns(
        {
            "selectedSeason": F.lit(season_).cast("int"),
            "selectedWeek": F.lit(week).cast("int"),
            "sourceInputPath": F.lit(source_path).cast("string"),
            "sourceFileCount": F.lit(source_files).cast("bigint"),
            "generatedAt": F.lit(generated_at).cast("string"),
        }
    )


class Run(NamedTuple):
    """Frames of a team-week run."""

    states: DataFrame
    weekly: DataFrame
    latest: DataFrame
    seasons: DataFrame
    season_rankings: DataFrame
    offense_rankings: DataFrame
    matchup_rankings: DataFrame
    snapshot: DataFrame
    offense_snapshot: DataFrame
    matchup_snapshot: DataFrame
    profiles: DataFrame
    profile_metadata: DataFrame
    movement_v0: DataFrame
    movement_v1: DataFrame
    movement_metadata: DataFrame
    metadata: DataFrame


def analyse(
    rows: DataFrame,
    season_: int | None = None,
    week: int | None = None,
    source_path: str | None = None,
    source_files: int | None = None,
    marker: str | None = None,
    generated_at: str | None = None,
) -> Run:
    """Run everything on canonical rows.

    States, team-seasons and movement are each read by several outputs, so they are written once to
    the shared folder and read back. All rows are checked, also those outside
    of the slice: one bad row anywhere fails the run. ``rows`` are evaluated once, however many data
    sets count them: a whole run counts its states, and the rows of a sliced one are written first.
    """
    prepare(rows.sparkSession)
    watch = canonical_watch(rows)
    whole = season_ is None and week is None
    checked = documents.typed_keys(watch.watch(rows))
    checked = checked if whole else written(checked, "weeks")
    states = written(scoring.build_states(slice_rows(checked, season_, week)), "states")
    watch.require_clean(rows)
    if states.isEmpty():
        raise QualityError(
            f"No rows remain after filters. selectedSeason={season_} selectedWeek={week}"
        )
    counted = states if whole else checked
    seasons = written(season.team_seasons(states), "seasons")
    moved = written(movement.movement_v0(states), "movement")
    stamp = generated_at or ""
    movement_md = provenance.movement_metadata(states, source_path, marker, generated_at=stamp)
    return Run(
        states=states,
        weekly=ranking.rank_states(states),
        latest=ranking.rank_states(states, latest_week=True),
        seasons=seasons,
        season_rankings=season.rank_seasons(seasons),
        offense_rankings=season.rank_positions(seasons, "offense"),
        matchup_rankings=season.rank_positions(seasons, "matchup"),
        snapshot=season.snapshot(seasons),
        offense_snapshot=season.positional_snapshot(seasons, "offense"),
        matchup_snapshot=season.positional_snapshot(seasons, "matchup"),
        profiles=profiles.build_profiles(seasons, generated_at, generated_at),
        profile_metadata=provenance.profile_metadata(seasons, source_path, marker, stamp),
        movement_v0=moved,
        movement_v1=movement.movement_v1(moved),
        movement_metadata=provenance.movement_governance(movement_md, marker, stamp),
        metadata=run_metadata(counted, season_, week, source_path, source_files, generated_at),
    )


def _family(ranked: DataFrame, family: str, key: str, suffix: str = "") -> DataFrame:
    """A ranking frame in the long shape: one table for all families."""
    name = F.concat(F.lower(key), F.lit(suffix))
    for column in ("week", "latestWeek", "games", "position"):
        if column not in ranked.columns:
            kind = {"games": "bigint", "position": "string"}.get(column, "int")
            ranked = ranked.withColumn(column, F.lit(None).cast(kind))
    return ranked.withColumns({"family": F.lit(family), "metric": name}).select(
        "family", "metric", "rank", "team", "season", "week", "latestWeek", "games", "position",
        "score", "tags", "summary",
    )


def all_rankings(run: Run) -> DataFrame:
    """The 25 weekly, latest-week and season rankings as one frame."""
    parts = [
        _family(run.weekly, "rankings", "ranking"),
        _family(run.latest, "latest_week", "ranking"),
        _family(run.season_rankings, "season_to_date", "ranking"),
        _family(run.offense_rankings, "season_to_date", "position", "_offense_environment"),
        _family(run.matchup_rankings, "season_to_date", "position", "_matchups"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def datasets(run: Run) -> dict[str, DataFrame]:
    """All data sets of a run but the rankings, by name."""
    return {
        "weekly_states": scoring.as_state_records(run.states),
        "pipeline_metadata": run.metadata,
        "team_seasons": run.seasons,
        "current_snapshot": run.snapshot,
        "current_offense_environments": run.offense_snapshot,
        "current_matchup_environments": run.matchup_snapshot,
        "snapshot_scope": run.metadata.select(
            "generatedAt", "selectedSeason", "selectedWeek", "seasonsIncluded", "latestWeekBySeason"
        ),
        config.ARTIFACT_PROFILES: run.profiles,
        f"{config.ARTIFACT_PROFILES}_metadata": run.profile_metadata,
        config.ARTIFACT_MOVEMENT_V0: movement.with_covered_weeks(run.movement_v0),
        config.ARTIFACT_MOVEMENT_V1: movement.with_covered_weeks(run.movement_v1),
        "team_environment_movement_metadata": run.movement_metadata,
    }


def publish_run(run: Run, folder: str, fmt: str = "parquet") -> str:
    """Publish all data sets of a run and its rankings together; readers see all of them or none."""
    named = {name: publication.Dataset(df) for name, df in datasets(run).items()}
    named["rankings"] = publication.Dataset(all_rankings(run), ("family", "metric"))
    return publication.publish(run.metadata.sparkSession, named, folder, fmt)


def publish(run: Run, folder: str, fmt: str = "json") -> list[str]:
    """Write all data sets of a run in place, one after another (see ``publish_run``)."""
    tables = datasets(run)
    paths = [write_dataset(df, folder, name, fmt) for name, df in tables.items()]
    rankings = all_rankings(run)
    return [*paths, write_dataset(rankings, folder, "rankings", fmt, by=("family", "metric"))]


def run_documents(
    spark: SparkSession, path: str, season_: int | None = None, week: int | None = None,
    generated_at: str | None = None,
) -> Run:
    """Load JSON documents and analyse them."""
    docs = documents.parsed_once(documents.scan_documents(spark, path))
    return analyse(
        documents.load_rows(docs), season_, week, path, docs.count(),
        documents.declared_provenance(docs), generated_at,
    )


def publish_pinned(
    spark: SparkSession, path: str, pinned: DataFrame, out: str, season_: int | None = None, week: int | None = None,
    generated_at: str | None = None,
) -> str:
    """Analyse and publish a folder of documents that is exactly what its manifest lists.

    All files are held against the manifest before anything is read for the run or written.
    """
    checksum.require_manifest(spark, path, pinned)
    return publish_run(run_documents(spark, path, season_, week, generated_at), out)


class Rehearsal(NamedTuple):
    """Report of a candidate document, and the coverage problems that its counts stand for."""

    report: DataFrame
    problems: DataFrame


def candidate_report(spark: SparkSession, path: str, expectation=coverage.FULL_SEASON_2024) -> Rehearsal:
    """Rehearsal report of a candidate document."""
    used = governed.consume_candidate(documents.scan_documents(spark, path))
    return Rehearsal(readiness.rehearse(used, expectation), readiness.coverage_problems(used, expectation))


class ForecastRun(NamedTuple):
    """Frames of a governed export."""

    artifact: DataFrame
    rows: DataFrame
    evidence: DataFrame
    manifest: DataFrame
    problems: DataFrame


def governed_export(
    spark: SparkSession, path: str, as_of: str | None, pinned_sha256: str,
    expectation=coverage.FULL_SEASON_2024, seasons: forecast.Seasons = forecast.Seasons(),
) -> ForecastRun:
    """Checksum, gates, readiness, cutoff, leakage check and evidence of a governed document."""
    digest = checksum.require_checksum(spark, path, pinned_sha256)
    used = governed.consume_governed(documents.scan_documents(spark, path))
    artifact = forecast.forecast_input(used, as_of, expectation, seasons)
    return ForecastRun(
        artifact,
        forecast.forecast_rows(used, artifact),
        forecast.coverage_evidence(
            used, artifact, digest, expectation.teams,
            len(expectation.teams) * expectation.games_per_team,
        ),
        checksum.manifest(used, digest),
        readiness.coverage_problems(used, expectation),
    )


# Neutral placeholder metrics, the same for every team and week.
PLACEHOLDER_METRICS = {
    "pointsFor": 21, "pointsAgainst": 21, "offensivePlays": 64, "neutralPlays": 44,
    "secondsPerPlay": 28, "passRate": 0.5, "neutralPassRate": 0.5, "rushRate": 0.5,
    "epaPerPlay": 0, "passEpaPerPlay": 0, "rushEpaPerPlay": 0, "successRate": 0.45,
    "explosivePlayRate": 0.1, "drives": 10, "pointsPerDrive": 2, "redZoneTrips": 3,
    "redZoneTdRate": 0.6, "sacksAllowed": 2, "pressureRateAllowed": 0.28, "turnovers": 1,
    "fantasyPointsForQB": 0, "fantasyPointsForRB": 0, "fantasyPointsForWR": 0,
    "fantasyPointsForTE": 0, "fantasyPointsAllowedQB": 0, "fantasyPointsAllowedRB": 0,
    "fantasyPointsAllowedWR": 0, "fantasyPointsAllowedTE": 0,
}


def scaffold_features(spark: SparkSession, options: features.FeatureOptions) -> features.FeatureTable:
    """Placeholder league through the whole chain to the feature table."""
    grid = coverage.league_grid(
        spark, PLACEHOLDER_METRICS, options.feature_season,
        options.expected_teams or config.LEAGUE_TEAMS,
    )
    rows = grid.selectExpr("*", *[f"double(NULL) AS {s}" for s in schemas.SPLITS])
    require_canonical(rows)
    moved = movement.movement_v1(movement.movement_v0(scoring.build_states(rows)))
    return features.build_features(moved, options)


def scaffold_rows(pairs: DataFrame, options: features.FeatureOptions) -> DataFrame:
    """Placeholder feature rows of every season and team in ``pairs``, through the whole chain, without the season guards."""
    rows = coverage.rotating_grid(pairs, PLACEHOLDER_METRICS).selectExpr("*", *[f"double(NULL) AS {s}" for s in schemas.SPLITS])
    require_canonical(rows)
    moved = movement.movement_v1(movement.movement_v0(scoring.build_states(rows)))
    return features.feature_rows(moved, options)
