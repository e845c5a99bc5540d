"""Model input from a governed source: cutoff gate, leakage gate, column list and evidence."""

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sideline import config, schemas
from sideline.operators import coverage, readiness
from sideline.operators.quality import QualityError
from sideline.sources.governed import Consumption

DEFAULT_CUTOFF = "2025-03-01T00:00:00.000Z"
GRAIN = ("season", "week", "teamCode")
# Fixed values of the contract: names on the consumer's side and the wording of the bind.
JOIN_POSTURE = (
    ("season", "input_season", "The input season binds to the forecast input season."),
    ("teamCode", "player_input_season_team (team_2024)", "The team code binds to the player's input-season team."),
    ("week", "(aggregated away)", "Team-weeks are summed to team-seasons before the player-season bind; week is no join key."),
)
JOIN_KEYS = ("player_input_season_team (team_2024)", "input_season")
BINDING = ("Team-week aggregates may later bind to player-season rows by the player's input-season team and the "
           "input season; that bind is not performed here.")
# Fixed value: an instant needs its zone, Z or an offset.
_ZONED = r"^\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}(:\\d{2})?(\\.\\d+)?(Z|[+-]\\d{2}:\\d{2})$"


class Seasons(NamedTuple):
    """Input season, the season it feeds, and the instant that season starts."""

    input: int = 2024
    target: int = 2025

    @property
    def target_start(self) -> str:
        return f"{self.target}-09-01T00:00:00.000Z"


def cutoff_status(as_of: str, start: str) -> str:
    """Expression: ok, missing, malformed, ambiguous or too_late for a cutoff column."""
    # seconds may be left out of an instant, but not for the timestamp parser
    full = f"regexp_replace({as_of}, '(T\\\\d{{2}}:\\\\d{{2}})(Z|[+-]|$)', '$1:00$2')"
    instant = f"try_to_timestamp({full})"
    return (
        f"CASE WHEN coalesce(trim({as_of}), '') = '' THEN 'missing' "
        f"WHEN {instant} IS NULL THEN 'malformed' "
        f"WHEN NOT {as_of} RLIKE '{_ZONED}' THEN 'ambiguous' "
        f"WHEN {instant} >= to_timestamp({start}) THEN 'too_late' ELSE 'ok' END"
    )


def require_cutoff(spark: SparkSession, as_of: str | None, seasons: Seasons = Seasons()) -> None:
    """Raise unless the cutoff is a zoned instant strictly before the target season."""
    one = spark.createDataFrame([(as_of, seasons.target_start)], "asOf string, start string")
    status = one.selectExpr(f"{cutoff_status('asOf', 'start')} AS status").first()["status"]
    reasons = {
        "missing": "an explicit forecast cutoff is required; the build time of the source is never used",
        "malformed": f'malformed forecast cutoff "{as_of}"',
        "ambiguous": f'timezone-ambiguous forecast cutoff "{as_of}"; it needs Z or a numeric offset',
        "too_late": f'forecast cutoff "{as_of}" is on or after the start of the {seasons.target} '
                    f"season ({seasons.target_start})",
    }
    if status != "ok":
        raise QualityError(f"forecast input refused: {reasons[status]}")


def leaking_columns(columns: Sequence[str]) -> list[str]:
    """Messages for columns that must not reach a model."""
    found = []
    for column in columns:
        if column in schemas.FANTASY_FIELDS:
            found.append(f"fantasy split column {column}")
        elif column == config.PRESSURE_FIELD:
            found.append(f"{column} stays deferred and excluded")
        else:
            marker = next((m for m in config.LEAKAGE_MARKERS if m in column.lower()), None)
            if marker:
                found.append(f'target/future/leakage column {column} (matched "{marker}")')
    return found


def require_no_leakage(columns: Sequence[str]) -> None:
    found = leaking_columns(columns)
    if found:
        raise QualityError(f"forecast input refused: {found[0]}")


def forecast_input(
    used: Consumption,
    as_of: str | None,
    expectation: coverage.Expectation = coverage.FULL_SEASON_2024,
    seasons: Seasons = Seasons(),
) -> DataFrame:
    """One-row artifact: the governed readiness with cutoff, column list and join posture."""
    spark, up = used.rows.sparkSession, used.upstream
    if up["season"] is not None and up["season"] != seasons.input:
        raise QualityError(
            f"forecast input refused: a {up['season']} source, but the cutoff belongs to {seasons.input}"
        )
    require_cutoff(spark, as_of, seasons)
    report = readiness.governed_readiness(used, expectation)
    report = report.withColumn(
        "forecastInputColumns",
        F.array_sort(F.concat("availableFields", "partialNullFields")),
    )
    require_no_leakage(report.first()["forecastInputColumns"])
    return report.withColumns(
        {
            "forecastConsumable": F.lit(True),
            "targetSeason": F.lit(seasons.target),
            "forecastCutoff": F.struct(
                F.lit(seasons.input).alias("inputSeason"),
                F.lit(seasons.target).alias("targetSeason"),
                F.lit(as_of).alias("asOf"),
                F.lit(up["generatedAt"]).cast("string").alias("sourceGeneratedAt"),
                F.lit(seasons.target_start).alias("targetSeasonStart"),
                F.lit(True).alias("cutoffBeforeTargetSeason"),
                F.lit(f"{seasons.input}_input_to_{seasons.target}_target").alias("safeFor"),
            ),
            "rowGrain": F.lit("team_week"),
            "teamCount": F.col("coverage.teamCount"),
            "weekCoverage": F.struct(
                F.array(*[F.lit(w) for w in expectation.weeks]).alias("window"),
                F.lit(expectation.games_per_team).alias("expectedGamesPerTeam"),
                F.lit(expectation.season).alias("expectedSeason"),
                "coverage",
                F.col("coverage.isFullLeague").alias("isFullLeague"),
            ),
            # rows are only described here; binding them to player seasons is left to the consumer
            "downstreamBinding": F.struct(
                F.lit("team_week").alias("rowGrain"),
                F.array(*[F.lit(k) for k in GRAIN]).alias("teamWeekGrainKeys"),
                F.lit(False).alias("bindsToForecastHere"),
                F.lit(BINDING).alias("playerSeasonBinding"),
                F.array(*[F.lit(k) for k in JOIN_KEYS]).alias("joinKeysRequired"),
                F.array(*[
                    F.struct(F.lit(a).alias("field"), F.lit(b).alias("forecastField"), F.lit(note).alias("note"))
                    for a, b, note in JOIN_POSTURE
                ]).alias("fieldMapping"),
            ),
            "pressureForecastPosture": F.lit("unavailable_insufficient_data_deferred_excluded"),
            "fantasySplitPosture": F.struct(
                F.lit("absent_excluded_from_forecast_use").alias("status"),
                F.array(*[F.lit(f) for f in schemas.FANTASY_FIELDS]).alias("fields"),
                F.lit(False).alias("presentInForecastInputColumns"),
                F.lit(False).alias("presentInRows"),
            ),
            "targetLeakageStatus": F.lit("no_target_future_leakage_fields_emitted_as_input"),
        }
    )


def forecast_rows(used: Consumption, artifact: DataFrame) -> DataFrame:
    """The governed rows cut to the grain keys and the accepted columns."""
    columns = artifact.first()["forecastInputColumns"]
    return used.rows.select("season", "week", "team", *columns)


def column_evidence(profile: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null counts per governed column and whether it became model input."""
    accepted = ", ".join(f"'{c}'" for c in columns) or "NULL"
    return profile.selectExpr(
        "field AS column", "status", "finiteCount AS nonNullCount", "nullCount",
        f"coalesce(field IN ({accepted}), false) AS forecastInput",
    )


def team_evidence(rows: DataFrame, teams: Sequence[str] = config.LEAGUE_TEAMS) -> DataFrame:
    """One row: present and missing teams against the league. Teams are told apart before they are
    listed; ``unexpected_teams`` has those outside the league as rows."""
    league = F.array(*[F.lit(t) for t in teams])
    present = rows.groupBy("team").agg(F.count(F.lit(1)).alias("n")).agg(
        F.sort_array(F.collect_list("team")).alias("presentTeams"),
        F.count(F.lit(1)).cast("int").alias("teamCount"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rowCount"),
    )
    return present.select(
        "teamCount", "rowCount", "presentTeams",
        F.array_except(league, "presentTeams").alias("missingTeams"),
    ).withColumn(
        "coversLeague",
        (F.size("missingTeams") == 0) & (F.col("teamCount") == len(teams)),
    )


def unexpected_teams(rows: DataFrame, teams: Sequence[str] = config.LEAGUE_TEAMS) -> DataFrame:
    """Teams outside the league with their number of rows."""
    return rows.where(~F.col("team").isin(list(teams))).groupBy("team").agg(F.count(F.lit(1)).alias("rows"))


def coverage_evidence(
    used: Consumption, artifact: DataFrame, checksum: str | None = None,
    teams: Sequence[str] = config.LEAGUE_TEAMS, expected_rows: int = 544,
) -> DataFrame:
    """One row of blocks: source, input, emitted, nullSemantics and forecastGateProjection."""
    a = artifact.first()
    accepted = set(a["forecastInputColumns"])
    columns = [
        F.struct(
            F.lit(f["field"]).alias("column"), F.lit(f["status"]).alias("status"),
            F.lit(f["finiteCount"]).alias("nonNullCount"), F.lit(f["nullCount"]).alias("nullCount"),
            F.lit(f["field"] in accepted).alias("forecastInput"),
        )
        for f in a["fieldReadiness"]
    ]
    up = used.upstream
    source = {
        "sourceArtifactPath": up["sourceArtifactPath"], "sourceArtifactId": config.ARTIFACT_RAW, "sha256": checksum,
        **{k: up[k] for k in ("governanceStatus", "governanceSource", "provenanceStatus", "validationReportPath",
                              "lineageManifestPath")},
    }
    text = lambda v: F.lit(v).cast("string")
    covers = f"{len(teams)}/{len(teams)}"
    return team_evidence(used.rows, teams).select(
        F.lit(f"{config.ARTIFACT_RAW}_forecast_input_coverage_evidence").alias("kind"),
        F.struct(*[text(v).alias(k) for k, v in source.items()]).alias("source"),
        F.struct(
            F.lit(up["season"]).cast("int").alias("season"), F.lit("team_week").alias("rowGrain"), "teamCount",
            "rowCount", F.lit(len(teams)).alias("expectedTeamCount"), F.lit(expected_rows).alias("expectedRowCount"),
            F.lit(a["coverage"]["isFullLeague"]).alias("isFullLeague"), "presentTeams", "missingTeams",
        ).alias("input"),
        F.struct(
            F.lit(a["readinessStatus"]).alias("readinessStatus"), F.lit(a["teamCount"]).alias("teamCount"),
            F.lit("team_week").alias("rowGrain"), F.lit(a["rowCount"]).alias("preAggregationRowCount"),
            F.array(*[F.lit(c) for c in a["forecastInputColumns"]]).alias("forecastInputColumns"),
            F.lit(len(accepted)).alias("forecastInputColumnCount"),
        ).alias("emitted"),
        F.struct(
            F.array(*columns).alias("perColumn"),
            F.lit("unavailable_insufficient_data_deferred_excluded").alias("pressureDisposition"),
            F.lit("absent_excluded_from_forecast_use").alias("fantasySplitDisposition"),
            F.lit(True).alias("noSilentZeroFill"),
        ).alias("nullSemantics"),
        F.struct(
            F.lit(covers).alias("expectedTeamCoverage"), F.col("coversLeague").alias("coversAllTeams"),
            F.array().cast("array<string>").alias("knownBlockers"), F.lit(True).alias("doNotRunForecast"),
        ).alias("forecastGateProjection"),
    )
