"""Registered queries of the file work, the reports and the rules: stored documents and spoiled rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sideline import config, schemas
from sideline.functions import lineage
from sideline.functions.numeric import rounded
from sideline.operators import coverage, features, forecast, profiles, quality, ranking, readiness, scoring, season
from sideline.plans import jobs
from sideline.sinks.artifacts import write_dataset
from sideline.sources import checksum, documents, governed, star_schema
from sideline.sources.governed import Consumption

NATIONS = tuple(f"NATION_{i}" for i in range(25))
# one team too many, one too few, and a window that ends a week early: every rule has cases
LEAGUE = coverage.Expectation(
    tuple(t for t in NATIONS if t != "NATION_3") + ("NATION_X",), tuple(range(1, 12)), 12, 2011
)
SEASON = 2011
_CANDIDATE = "named_struct('provenanceStatus', 'partial_real_data', 'governance', named_struct('governanceStatus', 'ungoverned', 'governanceSource', 'not_set'), 'deferredFields', array('pressureRateAllowed'))"
_GOVERNED = ("named_struct('provenanceStatus', 'governed_real_data', 'governance', named_struct('governanceStatus', 'governed', "
             "'governanceSource', 'explicit_marker', 'notes', 'checked'), 'deferredFields', array('pressureRateAllowed'), "
             "'validationReportPath', 'report.md', 'lineageManifestPath', 'manifest.json')")


# --- documents with many rows, one file each ---


def season_envelopes(rows: DataFrame, metadata: str) -> DataFrame:
    """One envelope per season; its rows (a season's weeks of all teams) in order of week and team."""
    names = {raw: n for raw, n in schemas.ENVELOPE_NAMES.items() if n in rows.columns}
    record = "named_struct(" + ", ".join(f"'{raw}', {n}" for raw, n in names.items()) + ")"
    grouped = rows.groupBy("season").agg(F.sort_array(F.collect_list(F.expr(record))).alias("rows"))
    return grouped.selectExpr(
        f"'{config.ARTIFACT_RAW}' AS artifact", "'now' AS generatedAt", "season", "array('plays') AS sourceArtifacts",
        f"{metadata} AS metadata", "rows",
    )


def _folder(spark: SparkSession, label: str) -> str:
    return lineage.owned(f"{lineage.shared_folder(spark)}/{label}-{uuid.uuid4().hex}")


def stored_documents(envelopes: DataFrame) -> str:
    """Write each envelope as a JSON file of its own; returns their folder."""
    path = _folder(envelopes.sparkSession, "documents")
    envelopes.write.option("ignoreNullFields", "false").option("maxRecordsPerFile", 1).json(path)
    return path


def _candidate_rows(spark, folder):
    rows = star_schema.candidate_weeks(spark, folder, season=SEASON)
    return rows.select(*schemas.KEYS, *schemas.METRICS)


def _used_candidate(spark, folder) -> Consumption:
    path = stored_documents(season_envelopes(_candidate_rows(spark, folder), _CANDIDATE))
    return governed.consume_candidate(documents.scan_documents(spark, path))


def _used_governed(spark, folder) -> Consumption:
    rows = star_schema.governed_weeks(spark, folder, season=SEASON)
    path = stored_documents(season_envelopes(rows, _GOVERNED))
    return governed.consume_governed(documents.scan_documents(spark, path))


def _scanned(spark, folder):
    """Several envelopes of many rows: written, scanned, checked and read."""
    rows = star_schema.team_weeks(spark, folder)
    path = stored_documents(season_envelopes(rows, "named_struct('provenanceStatus', 'sample')"))
    found = documents.typed_keys(documents.load_rows(documents.scan_documents(spark, path)))
    return found.select("rowIndex", *schemas.KEYS, *schemas.METRICS, *schemas.SPLITS)


def _canonical_file(spark, folder):
    """An array file per season, none of them called .json, read together."""
    names = [*schemas.KEYS, *schemas.METRICS, *schemas.SPLITS]
    record = "named_struct(" + ", ".join(f"'{n}', {n}" for n in names) + ")"
    texts = star_schema.team_weeks(spark, folder).groupBy("season").agg(F.sort_array(F.collect_list(F.expr(record))).alias("rows")).selectExpr(
        "to_json(rows, map('ignoreNullFields', 'false')) AS text", "season AS name")
    path = _folder(spark, "arrays")
    texts.write.partitionBy("name").text(path)
    docs = spark.read.text(path, wholetext=True).select(documents.plain_path(F.col("_metadata.file_path")).alias("sourceFile"), F.col("value").alias("text"))
    found = documents.typed_keys(documents.canonical_records(docs))
    return found.select("rowIndex", *names)


def _pinned(spark, folder):
    """Checksums of the stored files next to those of their texts, and the pin of one of them."""
    path = stored_documents(season_envelopes(star_schema.team_weeks(spark, folder), _CANDIDATE))
    digests = checksum.file_checksums(spark, f"{path}/*.json").withColumn("sourceFile", documents.plain_path(F.col("sourceFile")))
    texts = spark.read.text(path, wholetext=True, pathGlobFilter="*.json").select(
        documents.plain_path(F.col("_metadata.file_path")).alias("sourceFile"), F.sha2("value", 256).alias("right"))
    one = digests.orderBy("sourceFile").first()
    pinned = checksum.require_checksum(spark, one["sourceFile"], one["sha256"]) == one["sha256"]
    return digests.join(texts, "sourceFile").agg(
        F.count(F.lit(1)).alias("files"), F.every(F.col("sha256") == F.col("right")).alias("same"), F.lit(pinned).alias("pinned"))


def _manifest(spark, folder):
    made = checksum.manifest(_used_governed(spark, folder), "0" * 64)
    return made.drop("sourceArtifactPath")


# --- sinks ---


def _sink(spark, folder):
    """A ranking written as JSON lines and read back."""
    ranked = ranking.rank_states(
        scoring.build_states(star_schema.team_weeks(spark, folder)), {"team_power": "teamPowerScore"}, text=False)
    target = write_dataset(ranked, _folder(spark, "sink"), "team_power")
    return spark.read.schema(ranked.schema).json(target).select("rank", "season", "week", "team", "score")


def _family(spark, folder):
    """All rankings of a run in one partitioned table, read back and counted."""
    run = jobs.analyse(star_schema.team_weeks(spark, folder), generated_at="now")
    target = write_dataset(jobs.all_rankings(run), _folder(spark, "family"), "rankings", "parquet", by=("family", "metric"))
    return spark.read.parquet(target).groupBy("family", "metric").agg(
        F.count(F.lit(1)).alias("rows"), F.max("rank").alias("last"), F.countDistinct("team").alias("teams"))


def _season_order(spark, folder):
    """Publication order of the team-seasons as positions."""
    means = season.team_season_means(scoring.add_tags(scoring.score_rows(star_schema.team_weeks(spark, folder))))
    placed = ranking.number_rows(means.select("season", "team", "latestWeek", "games"), season.publication_order())
    return placed.select("rank", "season", "team", "latestWeek", "games")


def _bundle(spark, folder):
    """All season rankings of one set of team-seasons."""
    seasons = lineage.written(season.team_seasons(scoring.build_states(star_schema.team_weeks(spark, folder))), "seasons")
    parts = [
        season.rank_seasons(seasons).selectExpr("ranking AS list", "rank", "season", "team", "score"),
        season.rank_positions(seasons, "offense").selectExpr("concat('offense_', lower(position)) AS list", "rank", "season", "team", "score"),
        season.rank_positions(seasons, "matchup").selectExpr("concat('matchup_', lower(position)) AS list", "rank", "season", "team", "score"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- reports ---

_KINDS = "array_join(transform(map_entries({0}errorsByKind), e -> concat(e.key, ':', e.value)), ',') AS errorsByKind"


def _joined(name: str) -> str:
    return f"concat_ws('|', {name}) AS {name.rpartition('.')[2]}"


_COVERAGE = ["coverage.valid AS valid", "coverage.errorCount AS errorCount", _KINDS.format("coverage."), "rowCount"]


def _dry_run(spark, folder):
    report = readiness.dry_run(_used_candidate(spark, folder), LEAGUE)
    return report.selectExpr(
        *_COVERAGE, "provenanceStatus", "governanceStatus", "governanceSource", "promoted", "governed",
        _joined("deferredFields"), "pressurePosture")


_PROFILED = [*_COVERAGE, "kind", _joined("availableFields"), _joined("deferredInsufficientFields"), _joined("partialNullFields"),
             "concat_ws('|', transform(fieldReadiness, f -> concat(f.field, ':', f.finiteCount, ':', f.nullCount))) AS fields"]


def _rehearsal(spark, folder):
    report = readiness.rehearse(_used_candidate(spark, folder), LEAGUE)
    return report.selectExpr(*_PROFILED, "rehearsalOnly", "productionReady", "rehearsalStatus")


def _readiness(spark, folder):
    report = readiness.governed_readiness(_used_governed(spark, folder), LEAGUE)
    return report.selectExpr(
        *_PROFILED, "productionReady", "provenanceStatus", "governance.notes AS notes", "validationReportPath",
        "lineageManifestPath", "pressurePosture", "readinessStatus")


def _messages(spark, folder):
    """What the counts of the reports stand for."""
    return readiness.coverage_problems(_used_governed(spark, folder), LEAGUE)


_SEASONS = forecast.Seasons(SEASON, SEASON + 1)
_AS_OF = "2012-03-01T00:00:00.000Z"


def _forecast_input(spark, folder):
    made = forecast.forecast_input(_used_governed(spark, folder), _AS_OF, LEAGUE, _SEASONS)
    b = "downstreamBinding."
    return made.selectExpr(
        _joined("forecastInputColumns"), "forecastConsumable", "targetSeason", "teamCount", "rowCount", "rowGrain",
        "forecastCutoff.asOf AS asOf", "forecastCutoff.targetSeasonStart AS targetSeasonStart", "forecastCutoff.safeFor AS safeFor",
        "array_join(weekCoverage.window, ',') AS window", "weekCoverage.isFullLeague AS isFullLeague",
        _joined(f"{b}teamWeekGrainKeys"), _joined(f"{b}joinKeysRequired"), f"{b}bindsToForecastHere AS bindsToForecastHere",
        f"concat_ws('|', transform({b}fieldMapping, m -> concat(m.field, '>', m.forecastField))) AS fieldMapping",
        "size(fantasySplitPosture.fields) AS withheldFields", "fantasySplitPosture.presentInForecastInputColumns AS fantasyPresent",
        "pressureForecastPosture", "targetLeakageStatus")


def _evidence(spark, folder):
    used = _used_governed(spark, folder)
    artifact = lineage.written(forecast.forecast_input(used, _AS_OF, LEAGUE, _SEASONS), "artifact")
    made = forecast.coverage_evidence(used, artifact, "0" * 64, LEAGUE.teams, 300)
    return made.selectExpr(
        "source.sha256 AS sha256", "source.provenanceStatus AS provenanceStatus", "source.validationReportPath AS validationReportPath",
        "input.season AS season", "input.teamCount AS teamCount", "input.rowCount AS rowCount", "input.expectedRowCount AS expectedRowCount",
        _joined("input.presentTeams"), _joined("input.missingTeams"), "emitted.readinessStatus AS readinessStatus",
        "emitted.forecastInputColumnCount AS columns",
        "concat_ws('|', transform(nullSemantics.perColumn, c -> concat(c.column, ':', c.nonNullCount, ':', c.nullCount, ':', c.forecastInput))) AS perColumn",
        "nullSemantics.noSilentZeroFill AS noSilentZeroFill", "forecastGateProjection.expectedTeamCoverage AS expectedTeamCoverage",
        "forecastGateProjection.coversAllTeams AS coversAllTeams")


def _expectations(spark, folder):
    """Both standing expectations against the rows: problems by kind."""
    rows = coverage.counted(star_schema.team_weeks(spark, folder))
    out = None
    for name, wanted in (("full", coverage.FULL_SEASON_2024), ("excerpt", coverage.EXCERPT_2024)):
        found = coverage.bye_aware_problems(rows, wanted).groupBy("kind").agg(F.sum("occurrences").alias("n")).select(F.lit(name).alias("expectation"), "kind", "n")
        out = found if out is None else out.unionByName(found)
    return out


def _scaffold(spark, folder):
    """A placeholder league of the teams of every season through the whole chain."""
    pairs = star_schema.team_weeks(spark, folder).select("season", "team")
    rows = jobs.scaffold_rows(pairs, features.FeatureOptions(
        generated_at="now", cutoff_at="2012-01-01T00:00:00.000Z", feature_season=SEASON, target_season=SEASON + 1))
    return rows.selectExpr("teamId AS team", "season", "features.points_per_drive AS points", "features.offense_direction AS offense", "features.seconds_per_play AS seconds")


# --- rules: every row is spoiled in the way of its own number ---


def _code(count: int) -> str:
    return f"(season * 12 + week + 7 * int(substring(team, 8))) % {count} AS code"


def _spoils() -> list[dict[str, str]]:
    """Bad values by code, for the rules of canonical rows."""
    out = [{f: "NULL"} for f in schemas.REQUIRED]
    out += [{"season": "1998"}, {"week": "23"}, {"team": "' '"}, {"opponent": "''"}]
    out += [{f: "1.5D"} | ({"rushRate": "0.5D"} if f == "passRate" else {"passRate": "0.5D"} if f == "rushRate" else {}) for f in quality.RATE_FIELDS]
    out += [{f: "-1D"} for f in quality.COUNT_FIELDS]
    out += [{"passRate": "0.5D", "rushRate": "0.75D"}]
    return out + [{f: "-2D"} for f in schemas.SPLITS]


def _rules(spark, folder):
    """Canonical rules: each has rows that break it."""
    spoils = _spoils()
    rows = star_schema.team_weeks(spark, folder).selectExpr("*", _code(len(spoils) + 5), "concat_ws('-', season, week, team) AS row")
    names = [*schemas.KEYS, *schemas.METRICS, *schemas.SPLITS]
    changed = {n: " ".join(f"WHEN {i} THEN {s[n]}" for i, s in enumerate(spoils) if n in s) for n in names}
    spoiled = rows.selectExpr("row", *[f"CASE code {c} ELSE {n} END AS {n}" if c else n for n, c in changed.items()])
    return quality.violations(spoiled, quality.canonical_rules(), ["row"]).select("row", "message")


def _text_rules(kind: str, metadata: str):
    """Document rules by field: a text in place of the number, and a missing key."""

    def run(spark, folder):
        lane = {"envelope": star_schema.team_weeks, "candidate": star_schema.candidate_weeks, "governed": star_schema.governed_weeks}[kind]
        rows = lane(spark, folder)
        fields = ["season", "week", "teamCode", "opponentCode", *[m for m in schemas.METRICS if m in rows.columns],
                  *(schemas.SPLITS if kind == "envelope" else ())]
        if kind != "envelope":
            rows = rows.drop(*schemas.SPLITS)
        names = {raw: n for raw, n in schemas.ENVELOPE_NAMES.items() if n in rows.columns}
        record = "named_struct(" + ", ".join(f"'{raw}', {n}" for raw, n in names.items()) + ")"
        bad = " ".join(f"WHEN {i} THEN '\"{f}\":[^,}}]*'" for i, f in enumerate(fields))
        good = " ".join(f"WHEN {i} THEN '\"{f}\":{chr(34) * 2 if f in ('teamCode', 'opponentCode') else chr(34) + 'x' + chr(34)}'" for i, f in enumerate(fields))
        text = f"to_json({record}, map('ignoreNullFields', 'false'))"
        docs = rows.selectExpr("concat(season, '-', week, '-', team, '.json') AS sourceFile", _code(len(fields) + 3), f"{text} AS record").selectExpr(
            "sourceFile",
            f"concat('{{\"artifact\":\"{config.ARTIFACT_RAW}\",\"rows\":[', CASE WHEN code < {len(fields)} THEN regexp_replace(record, CASE code {bad} END, CASE code {good} END) "
            f"WHEN code = {len(fields)} THEN replace(record, '\"turnovers\"', '\"other\"') ELSE record END, '],\"metadata\":{metadata}}}') AS text")
        if kind == "envelope":
            return documents.raw_violations(documents.parsed_once(docs)).select("sourceFile", "message")
        rules = quality.candidate_rules() if kind == "candidate" else quality.governed_rules()
        return governed.row_violations(docs, rules).select("sourceFile", "message")

    return run


def _tiers(spark, folder):
    """Profiles of widened means, so that every tier occurs."""
    means = season.team_season_means(scoring.add_tags(scoring.score_rows(star_schema.team_weeks(spark, folder))))
    wide = means.selectExpr(
        "season", "team", "games", "latestWeek",
        *[f"double((season * 7 + int(substring(team, 8)) * {k}) % {n}) * {step}D + {low}D AS {name}" for name, k, n, step, low in WIDE],
        *[c for c in config.PROFILE_SIGNALS if c not in {w[0] for w in WIDE}])
    return profiles.build_profiles(wide).selectExpr(
        "season", "teamId AS team", "offenseTier", "passEnvironmentTier", "paceTier", "volatilityTier", _joined("warnings"))


#: column, multiplier of the nation, values, step and lowest value
WIDE = (("fantasyEnvironmentScore", 3, 11, 10, 0), ("neutralPassRate", 5, 9, 0.05, 0.35), ("secondsPerPlay", 2, 13, 1, 22), ("volatilityScore", 11, 10, 10, 0))


def _label_kinds(spark, folder):
    """Source labels of addresses, a quarter of which are neither samples nor fixtures."""
    from sideline.functions.text import normalized_path, path_type

    pages = star_schema.read_table(spark, folder, "pages")
    lead = F.element_at(F.array(*[F.lit(x) for x in ("data/sample/", "fixtures/", "elsewhere/", "./data/sampled/")]), (F.col("page_id") % 4 + 1).cast("int"))
    path = F.concat(lead, F.col("page_id").cast("string"))
    return pages.select("page_id", normalized_path(path).alias("path"), path_type(path).alias("type"))


def _dense_gaps(spark, folder):
    """Dense coverage of rows of which every fifth cell lies in another week: weeks are missing, repeated and unexpected."""
    moved = "if((week + int(substring(team, 8))) % 5 = 0, week + 12, week) AS week"
    rows = star_schema.team_weeks(spark, folder).selectExpr("season", "team", moved)
    return coverage.dense_problems(rows, coverage.Expectation(NATIONS, tuple(range(1, 13))))


def queries() -> dict:
    return {
        "scanned_documents": _scanned,
        "canonical_file": _canonical_file,
        "pinned_source": _pinned,
        "source_manifest": _manifest,
        "sink_round_trip": _sink,
        "published_family": _family,
        "season_order": _season_order,
        "report_bundle": _bundle,
        "dry_run_report": _dry_run,
        "rehearsal_report": _rehearsal,
        "readiness_report": _readiness,
        "report_messages": _messages,
        "forecast_input": _forecast_input,
        "coverage_evidence": _evidence,
        "standing_expectations": _expectations,
        "scaffold_features": _scaffold,
        "every_canonical_rule": _rules,
        "every_envelope_rule": _text_rules("envelope", "{}"),
        "every_candidate_rule": _text_rules("candidate", "{}"),
        "every_governed_rule": _text_rules("governed", "{}"),
        "every_tier": _tiers,
        "source_label_kinds": _label_kinds,
        "dense_gaps": _dense_gaps,
    }
