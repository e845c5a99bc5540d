"""Where a data set comes from and who vouches for it.

Profiles and movement resolve provenance differently on purpose: profiles look at the path first,
movement at the producer's marker first. Each rule is an expression over one-row frames with the
columns ``sourcePath``, ``marker`` and the coverage columns.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sideline import config
from sideline.functions.text import normalized_path, path_type


def movement_provenance(path: Column, marker: Column, full_league: Column) -> Column:
    """Marker first; a governed marker without a full league is partial."""
    return (
        F.when(marker.isin("fixture_scaffold", "sample", "partial_real_data", "unknown_provenance"), marker)
        .when(marker == "governed_real_data",
              F.when(full_league, "governed_real_data").otherwise("partial_real_data"))
        .when(path_type(path).isin("fixture", "sample"), "fixture_scaffold")
        .otherwise("unknown_provenance")
    )


def profile_provenance(path: Column, marker: Column, full_league: Column) -> Column:
    """Path first, except for a governed marker over a full league."""
    return (
        F.when((marker == "governed_real_data") & full_league, "governed_real_data")
        .when(path_type(path).isin("fixture", "sample"), "fixture_scaffold")
        .otherwise("unknown_provenance")
    )


def governance_columns(status: Column, marker: Column) -> dict[str, Column]:
    """governanceStatus, governanceSource and promotionNotes of a provenance status."""
    governance = F.lit("unknown")
    for provenance, value in config.GOVERNANCE_BY_PROVENANCE.items():
        governance = F.when(status == provenance, value).otherwise(governance)
    source = (
        F.when(marker.isin(*config.PROVENANCE), "explicit_marker")
        .when(governance == "unknown", "unknown")
        .otherwise("path_inference")
    )
    notes = F.when(source == "path_inference", F.array(F.lit(config.NOTE_PATH_INFERENCE))).when(
        source == "unknown", F.array(F.lit(config.NOTE_NO_SIGNAL))
    )
    return {"governanceStatus": governance, "governanceSource": source, "promotionNotes": notes}


def _text(value: str | None) -> Column:
    return F.lit(value).cast("string")


def _input_source(path: Column) -> Column:
    return F.array(
        F.struct(
            F.coalesce(normalized_path(path), F.lit("unknown")).alias("path"),
            F.coalesce(path_type(path), F.lit("unknown")).alias("type"),
        )
    )


def movement_metadata(
    states: DataFrame, path: str | None, marker: str | None, teams=config.LEAGUE_TEAMS,
    generated_at: str | None = None,
) -> DataFrame:
    """One row: artifact name, time, provenance, input source and coverage of a movement run.

    The lists are as long as there are different teams, seasons and weeks.
    """
    # teams, seasons and weeks are told apart before they are listed: no list holds a value twice
    each = states.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("of"), F.col(c).cast("string").alias("value")) for c in ("team", "season", "week")
    ])).alias("x")).select("x.*").distinct()
    of = lambda c, kind: F.sort_array(F.collect_list(F.when(F.col("of") == c, F.col("value").cast(kind))))
    sets = each.agg(of("team", "string").alias("teams"), of("season", "int").alias("seasons"), of("week", "int").alias("weeks"))
    league = F.array(*[F.lit(t) for t in teams])
    full = (F.size("teams") == len(teams)) & (F.size(F.array_except("teams", league)) == 0)
    sets = sets.select(
        F.size("teams").alias("teamCount"), "teams", "seasons", "weeks",
        F.array_max("weeks").alias("latestWeek"), full.alias("isFullLeague"),
    )
    return sets.select(
        F.lit(config.ARTIFACT_MOVEMENT_V0).alias("artifact"), F.lit(generated_at).cast("string").alias("generatedAt"),
        movement_provenance(_text(path), _text(marker), F.col("isFullLeague")).alias("provenanceStatus"),
        _input_source(_text(path)).alias("inputSources"),
        F.struct(*sets.columns).alias("coverage"),
    )


def movement_governance(metadata: DataFrame, marker: str | None, generated_at: str) -> DataFrame:
    """Add the governance block of movement v1."""
    blocks = governance_columns(F.col("provenanceStatus"), _text(marker))
    return metadata.withColumns({"artifact": F.lit(config.ARTIFACT_MOVEMENT_V1), "generatedAt": F.lit(generated_at)}).withColumn(
        "governance",
        F.struct(
            blocks["governanceStatus"].alias("governanceStatus"),
            blocks["governanceSource"].alias("governanceSource"),
            F.lit(config.ARTIFACT_MOVEMENT_V1).alias("contractVersion"),
            F.lit(generated_at).alias("generatedAt"),
            blocks["promotionNotes"].alias("promotionNotes"),
        ),
    )


def profile_metadata(
    seasons: DataFrame,
    path: str | None,
    marker: str | None,
    generated_at: str,
    teams=config.PROFILE_TEAM_ORDER,
) -> DataFrame:
    """One row: provenance, notes and coverage of a profile run.

    ``weeks`` are the latest weeks of the team-seasons, not all played weeks.
    """
    league = F.array(*[F.lit(t) for t in teams])
    each = seasons.select("games", F.explode(F.array(*[
        F.struct(F.lit(c).alias("of"), F.col(c).cast("string").alias("value")) for c in ("team", "season", "latestWeek")
    ])).alias("x")).groupBy("x.of", "x.value").agg(F.min("games").alias("low"), F.max("games").alias("high"))
    of = lambda c, kind: F.sort_array(F.collect_list(F.when(F.col("of") == c, F.col("value").cast(kind))))
    sets = each.agg(
        of("team", "string").alias("presentTeams"), of("season", "int").alias("seasons"), of("latestWeek", "int").alias("weeks"),
        F.min("low").alias("gamesPerTeamMin"), F.max("high").alias("gamesPerTeamMax"),
    )
    sets = sets.select(
        F.size("presentTeams").alias("teamCount"),
        F.lit(len(teams)).alias("expectedTeamCount"),
        "presentTeams",
        F.array_except(league, "presentTeams").alias("missingTeams"),
        F.array_except("presentTeams", league).alias("unexpectedTeams"),
        "seasons", "weeks",
        F.array_max("weeks").alias("latestWeek"),
        "gamesPerTeamMin", "gamesPerTeamMax",
    )
    complete = (F.size("missingTeams") == 0) & (F.size("unexpectedTeams") == 0)
    sets = sets.withColumn("isFullLeague", complete)
    kind = F.coalesce(path_type(_text(path)), F.lit("unknown"))
    notes = F.array_compact(
        F.array(
            F.when(kind.isin("sample", "fixture"), config.NOTE_SCAFFOLD_PATH),
            F.when(kind == "unknown", config.NOTE_UNKNOWN_PATH),
            F.when(~F.col("isFullLeague"), config.NOTE_INCOMPLETE),
        )
    )
    return sets.select(
        F.lit(config.ARTIFACT_PROFILES).alias("artifact"),
        F.array(*[F.lit(x) for x in config.PROFILE_SOURCES]).alias("sourceArtifacts"),
        profile_provenance(_text(path), _text(marker), F.col("isFullLeague")).alias("provenanceStatus"),
        notes.alias("provenanceNotes"),
        F.lit(generated_at).alias("generatedAt"),
        _input_source(_text(path)).alias("inputSources"),
        F.struct(*sets.columns).alias("coverage"),
    )


def document_provenance(declared: DataFrame, rows: DataFrame, teams=config.LEAGUE_TEAMS) -> DataFrame:
    """Both ladders and their governance for every source file: one row per file of ``declared``.

    ``declared`` has sourceFile and the producer's ``marker`` (null if there is none), ``rows`` has sourceFile
    and team. A file covers the full league if its rows have exactly the expected teams. Teams are told
    apart per file before they are counted, so a file may hold any number of rows; files without rows
    cover nothing.
    """
    each = rows.select("sourceFile", "team").distinct()
    known = F.col("team").isin(*teams)
    cover = each.groupBy("sourceFile").agg(F.count("team").alias("teamCount"), F.count_if(known).alias("_known"), F.count_if(~known | F.col("team").isNull()).alias("_other"))
    files = declared.select("sourceFile", "marker").distinct().join(cover, "sourceFile", "left")
    files = files.select(
        "sourceFile", "marker", F.coalesce("teamCount", F.lit(0)).alias("teamCount"),
        F.coalesce((F.col("_known") == len(teams)) & (F.col("_other") == 0), F.lit(False)).alias("isFullLeague"))
    path, marker, full = F.col("sourceFile"), F.col("marker"), F.col("isFullLeague")
    files = files.withColumns({
        "pathType": path_type(path), "movementProvenance": movement_provenance(path, marker, full), "profileProvenance": profile_provenance(path, marker, full)})
    blocks = governance_columns(F.col("movementProvenance"), marker)
    return files.select(
        "sourceFile", "marker", "pathType", "teamCount", "isFullLeague", "movementProvenance", "profileProvenance", *[c.alias(n) for n, c in blocks.items()])
