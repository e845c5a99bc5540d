"""Every registered query: (spark, folder of parquet tables) -> DataFrame."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sideline import config, schemas
from sideline.functions.lineage import written
from sideline.functions.numeric import rounded
from sideline.functions.session import prepare
from sideline.functions.text import normalized_path, path_type
from sideline.operators import context_tables, coverage, features, forecast, movement, profiles
from sideline.operators import provenance, quality, ranking, readiness, scoring, season, season_report
from sideline.plans import jobs, lanes, stored
from sideline.sources import documents, governed, star_schema

Query = Callable[[SparkSession, str], DataFrame]
_GRAIN = ("season", "week", "team")
NATIONS, LEAGUE = lanes.NATIONS, lanes.LEAGUE
PROFILE_PATH = "./export/data/sample/season.json"


def _joined(name: str, source: str | None = None) -> str:
    return f"concat_ws('|', {source or name}) AS {name}"


def _numbers(name: str) -> str:
    """An array of numbers as text."""
    return f"array_join({name}, ',') AS {name}"


def _rows(spark, folder) -> DataFrame:
    return star_schema.team_weeks(spark, folder)


def _states(spark, folder) -> DataFrame:
    return scoring.build_states(_rows(spark, folder))


def _tagged(spark, folder) -> DataFrame:
    return scoring.add_tags(scoring.score_rows(_rows(spark, folder)))


def _means(spark, folder) -> DataFrame:
    return season.team_season_means(_tagged(spark, folder))


def _seasons(spark, folder) -> DataFrame:
    return season.team_seasons(_states(spark, folder))


# --- rows ---


def _candidate(spark, folder):
    return star_schema.candidate_weeks(spark, folder).select(*schemas.KEYS, *schemas.METRICS)


def _scores(spark, folder):
    return scoring.score_rows(_rows(spark, folder)).selectExpr(*_GRAIN, *rounded(config.SCORE_FIELDS, 6))


def _components(part: str) -> Query:
    def run(spark, folder):
        _, weights = scoring.SCORE_PARTS[part]
        rows = scoring.add_components(_rows(spark, folder))
        return rows.selectExpr(*_GRAIN, *rounded(weights, 6, f"{part}."))

    return run


def _tags(spark, folder):
    return _tagged(spark, folder).selectExpr(*_GRAIN, _joined("tags"))


def _lists(spark, folder):
    return _states(spark, folder).selectExpr(*_GRAIN, _joined("strengths"), _joined("risks"))


def _summary(spark, folder):
    return _states(spark, folder).selectExpr(
        *_GRAIN, f"{scoring.ENVIRONMENT_TYPE} AS environmentType", "summary"
    )


def _state_records(spark, folder):
    return scoring.as_state_records(_states(spark, folder)).selectExpr(
        *_GRAIN, "opponent", *[f"input.{n} AS {n}" for n in (*schemas.METRICS, *schemas.SPLITS)],
        *rounded(config.SCORE_FIELDS, 6, "scores."),
        *[f"{sql} AS {part}_{name}" for part, (_, weights) in scoring.SCORE_PARTS.items()
          for name, sql in ((n, rounded([n], 6, f"components.{part}.")[0].rpartition(" AS ")[0]) for n in weights)],
        _joined("tags", "explanation.tags"), _joined("strengths", "explanation.strengths"),
        _joined("risks", "explanation.risks"), "explanation.summary AS summary",
    )


# --- rankings ---


def _rank(name: str, latest: bool) -> Query:
    """One weekly or latest-week ranking."""

    def run(spark, folder):
        chosen = {name: config.WEEKLY_RANKINGS[name]}
        ranked = ranking.rank_states(_states(spark, folder), chosen, latest_week=latest)
        return ranked.selectExpr("rank", "season", "week", "team", "score", _joined("tags"), "summary")

    return run


def _rank_all(latest: bool) -> Query:
    """All seven rankings from one sort."""

    def run(spark, folder):
        ranked = ranking.rank_states(_states(spark, folder), latest_week=latest, text=False)
        return ranked.select("ranking", "rank", "season", "week", "team", "score")

    return run


def _rank_volatility_asc(spark, folder):
    ranked = ranking.rank_states(
        _states(spark, folder), {"volatilityScore": "volatilityScore"}, descending=False, text=False)
    return ranked.select("rank", "season", "week", "team", "score")


def _latest_weeks(spark, folder):
    return ranking.latest_weeks(_rows(spark, folder))


# --- seasons ---


def _season_agg(spark, folder):
    return _seasons(spark, folder).selectExpr(
        "season", "team", "games", "latestWeek", _joined("tags"), "summary",
        *rounded(config.SEASON_MEANS, 6),
    )


def _season_means(spark, folder):
    return _means(spark, folder).selectExpr(
        "season", "team", "games", "latestWeek", _joined("tags"), *rounded(config.SEASON_MEANS, 6)
    )


def _season_rank(name: str) -> Query:
    def run(spark, folder):
        chosen = {name: config.SEASON_SCORE_RANKINGS[name]}
        return season.rank_seasons(_seasons(spark, folder), chosen).selectExpr(
            "rank", "season", "team", "latestWeek", "games", "score", _joined("tags"), "summary"
        )

    return run


def _positional(family: str, position: str) -> Query:
    def run(spark, folder):
        return season.rank_positions(_means(spark, folder), family, [position]).selectExpr(
            "position", "rank", "season", "team", "latestWeek", "games", "score", _joined("tags"),
            "summary",
        )

    return run


def _snapshot_list(build) -> Query:
    def run(spark, folder):
        return build(_seasons(spark, folder)).selectExpr(
            "rank", "season", "team", "latestWeek", "score", _joined("tags"), "summary"
        )

    return run


def _snapshot(spark, folder):
    return season.snapshot(_seasons(spark, folder)).select(
        "list", "rank", "season", "team", "latestWeek", "score"
    )


def _positional_snapshot(family: str) -> Query:
    def run(spark, folder):
        return season.positional_snapshot(_means(spark, folder), family).select(
            "position", "rank", "season", "team", "latestWeek", "games", "score"
        )

    return run


_BY_SEASON = (
    "array_join(transform(map_entries(latestWeekBySeason), e -> concat(e.key, ':', e.value)), ',')"
    " AS latestWeekBySeason"
)


def _scope(spark, folder):
    return season.scope(_rows(spark, folder)).selectExpr(
        "selectedSeason", "selectedWeek", _numbers("seasonsIncluded"), _BY_SEASON
    )


def _run_metadata(spark, folder):
    return jobs.run_metadata(_rows(spark, folder), 2011, 5).selectExpr(
        "sourceRowCount", "mappedRowCount", "filteredRowCount", "selectedSeason", "selectedWeek",
        _numbers("seasonsIncluded"), _BY_SEASON,
    )


def _slice(spark, folder):
    rows = star_schema.team_weeks(spark, folder, season=2011, last_week=5)
    return jobs.slice_rows(rows, 2011, 5).select(*schemas.KEYS, "pointsFor")


# --- movement, profiles, features ---


def _movement(cutoff: int | None = None) -> Query:
    def run(spark, folder):
        states = jobs.slice_rows(scoring.score_rows(_rows(spark, folder)), week=cutoff)
        flat = movement.movement_flat(states)
        names = [f"{side}_{m}" for side in ("early", "late") for m in config.WINDOW_DIGITS]
        names += [f"delta_{m}" for m in config.DELTA_METRICS]
        return flat.selectExpr(
            "season", "team", "games", f"array_join({movement.covered_weeks()}, ',') AS weeksCovered",
            "array_join(early.week, ',') AS earlyWeeks", "array_join(late.week, ',') AS lateWeeks",
            *names, "offenseDirection", "passEnvironmentDirection", "paceDirection",
            "pressureDirection", "volatilityDirection", "verdict", _joined("warnings"),
        )

    return run


def _movement_v1_frame(spark, folder):
    return movement.movement_v1(movement.movement_v0(scoring.score_rows(_rows(spark, folder))))


def _movement_v1(spark, folder):
    kept = [m for m in config.WINDOW_DIGITS if not m.startswith("fantasy")]
    v1 = movement.with_covered_weeks(_movement_v1_frame(spark, folder))
    return v1.selectExpr(
        "season", "teamId AS team", _numbers("weeksCovered"),
        "array_join(earlyWindow.weeks, ',') AS earlyWeeks", "array_join(lateWindow.weeks, ',') AS lateWeeks",
        *[f"movement.{d} AS {d}" for d in ("offenseDirection", "passEnvironmentDirection", "paceDirection",
                                           "pressureDirection", "volatilityDirection")], _joined("warnings"),
        *[f"{side}Window.averages.{m} AS {side}_{m}" for side in ("early", "late") for m in kept],
        *[f"deltas.{m} AS delta_{m}" for m in kept if m != "volatilityScore"],
        "movement.verdict AS verdict",
    )


def _movement_metadata(spark, folder):
    md = provenance.movement_metadata(_rows(spark, folder), None, "governed_real_data", NATIONS)
    md = provenance.movement_governance(md, "governed_real_data", "now")
    return md.selectExpr(
        "provenanceStatus", "governance.governanceStatus AS governanceStatus",
        "governance.governanceSource AS governanceSource", "coverage.teamCount AS teamCount",
        _joined("teams", "coverage.teams"), "array_join(coverage.seasons, ',') AS seasons",
        "array_join(coverage.weeks, ',') AS weeks", "coverage.latestWeek AS latestWeek",
        "coverage.isFullLeague AS isFullLeague",
    )


def _profiles(spark, folder):
    return profiles.build_profiles(_means(spark, folder)).selectExpr(
        "season", "teamId AS team", "marketTier", "offenseTier", "passEnvironmentTier", "paceTier",
        "volatilityTier", _joined("warnings"),
        *[f"signals[{i}].value AS {n}" for i, n in enumerate(config.PROFILE_SIGNALS)],
    )


def _profile_metadata(spark, folder):
    md = provenance.profile_metadata(
        _means(spark, folder), PROFILE_PATH, "governed_real_data", "now", LEAGUE.teams
    )
    c = "coverage."
    return md.selectExpr(
        "provenanceStatus", _joined("provenanceNotes"), "inputSources[0].path AS path",
        "inputSources[0].type AS type", f"{c}teamCount AS teamCount",
        f"{c}isFullLeague AS isFullLeague", _joined("presentTeams", f"{c}presentTeams"),
        _joined("missingTeams", f"{c}missingTeams"),
        _joined("unexpectedTeams", f"{c}unexpectedTeams"),
        f"array_join({c}seasons, ',') AS seasons", f"array_join({c}weeks, ',') AS weeks",
        f"{c}latestWeek AS latestWeek", f"{c}gamesPerTeamMin AS gamesPerTeamMin",
        f"{c}gamesPerTeamMax AS gamesPerTeamMax",
    )


def _options(season_: int = 2011) -> features.FeatureOptions:
    return features.FeatureOptions(
        generated_at="2012-01-01T00:00:00.000Z", cutoff_at="2012-01-01T00:00:00.000Z",
        feature_season=season_, target_season=season_ + 1, expected_teams=NATIONS,
    )


def _features(spark, folder):
    rows = features.feature_rows(_movement_v1_frame(spark, folder), _options())
    return rows.select("season", F.col("teamId").alias("team"), "features.*",
                       "featureCoverageStatus", "confidence")


def _feature_guards(spark, folder):
    return features.guard_problems(
        _movement_v1_frame(spark, folder), 2011, LEAGUE.teams
    ).select("rule", "message")


def _feature_table(spark, folder):
    """Feature table of one season, built with its guards."""
    rows = jobs.slice_rows(star_schema.team_weeks(spark, folder, season=2011), 2011)
    moved = movement.movement_v1(movement.movement_v0(scoring.score_rows(rows)))
    table = features.build_features(moved, _options())
    return table.header.selectExpr(
        "artifact", "featureSeason", "targetSeason", "governance.governanceStatus AS governanceStatus",
        "coverage.teamCount AS teamCount", "coverage.expectedTeamCount AS expectedTeamCount",
        "coverage.isFullLeague AS isFullLeague", "array_join(coverage.seasons, ',') AS seasons",
        "array_join(coverage.weeks, ',') AS weeks",
    )


def _feature_problems(spark, folder):
    """Validator over all seasons at once: wrong team count, and offense_tier spoiled by strength."""
    moved = written(_movement_v1_frame(spark, folder), "movement")
    one = features.build_features(jobs.slice_rows(moved, 2011), _options(), stored=True)
    spoiled = features.feature_rows(moved, _options()).withColumn(
        "features",
        F.col("features").withField(
            "offense_tier",
            F.when(F.col("features.points_per_drive") > 2, "great").otherwise("average"),
        ),
    )
    found = features.validate_features(features.FeatureTable(spoiled, one.header, one.catalogue), _options())
    return found.groupBy("part", "message").agg(F.count(F.lit(1)).alias("n"))


# --- quality and coverage ---


def _quality(spark, folder):
    rows = star_schema.candidate_weeks(spark, folder)
    return quality.violations(rows, quality.canonical_rules(), _GRAIN).select(*_GRAIN, "message")


def _coverage(build) -> Query:
    def run(spark, folder):
        return build(_rows(spark, folder), LEAGUE)

    return run


def _coverage_summary(build) -> Query:
    def run(spark, folder):
        rows = coverage.counted(_rows(spark, folder))
        return coverage.coverage_summary(rows, build(rows, LEAGUE), LEAGUE).selectExpr(
            "valid", "errorCount", "teamCount", "totalRowCount", "isFullLeague",
            "array_join(transform(map_entries(errorsByKind), e -> concat(e.key, ':', e.value)), ',')"
            " AS errorsByKind",
        )

    return run


def _null_profile(spark, folder):
    rows = star_schema.candidate_weeks(spark, folder)
    return readiness.null_profile(rows, schemas.METRICS, ["turnovers"]).drop("place")


def _null_profile_governed(spark, folder):
    rows = star_schema.governed_weeks(spark, folder)
    return readiness.null_profile(rows, schemas.GOVERNED_METRICS).drop("place")


def _column_evidence(spark, folder):
    rows = star_schema.governed_weeks(spark, folder)
    profile = readiness.null_profile(rows, schemas.GOVERNED_METRICS)
    accepted = [m for m in schemas.GOVERNED_METRICS if not forecast.leaking_columns([m])]
    return forecast.column_evidence(profile, accepted)


def _team_evidence(spark, folder):
    return forecast.team_evidence(star_schema.governed_weeks(spark, folder), LEAGUE.teams).selectExpr(
        "teamCount", "rowCount", _joined("presentTeams"), _joined("missingTeams"), "coversLeague"
    )


def _grid(spark, folder):
    """Expected grid next to the weeks that were played."""
    grid = coverage.expected_grid(spark, coverage.Expectation(NATIONS, tuple(range(1, 13))))
    played = _rows(spark, folder).groupBy("team", "week").agg(F.count(F.lit(1)).alias("games"))
    return grid.join(played, ["team", "week"], "left").selectExpr(
        "team", "week", "coalesce(games, 0L) AS games"
    )


# --- season report ---


def _report(spark, folder):
    report = season_report.season_report(star_schema.governed_weeks(spark, folder))
    return report.selectExpr(*[c for c in report.columns if c != "warnings"], _joined("warnings"))


def _report_problems(spark, folder):
    rows = written(star_schema.governed_weeks(spark, folder), "governed")
    report = season_report.season_report(rows)
    spoiled = report.withColumn("redZoneTdRate", F.expr("if(drivesTotal % 7 = 0, NULL, redZoneTdRate)"))
    return season_report.report_problems(
        spoiled, rows, {"provenanceStatus": "sample", "governanceStatus": "fixture",
                        "governanceSource": "explicit_marker"}, LEAGUE.teams, 84,
    )


# --- JSON documents made of the rows: one document per team-week ---


def _record(names: dict[str, str]) -> str:
    items = ", ".join(f"'{raw}', {name}" for raw, name in names.items())
    return f"named_struct({items})"


_KEEP_NULLS = "map('ignoreNullFields', 'false')"
_FILE = "concat(season, '-', week, '-', team, '.json') AS sourceFile"


def array_documents(rows: DataFrame) -> DataFrame:
    """Array files in snake_case."""
    text = f"to_json(array({_record(schemas.RAW_NAMES)}), {_KEEP_NULLS}) AS text"
    return rows.selectExpr(_FILE, text)


def envelope_documents(rows: DataFrame, metadata: str, keep_nulls: bool = True) -> DataFrame:
    """Envelopes in camelCase with a metadata struct expression."""
    names = {raw: n for raw, n in schemas.ENVELOPE_NAMES.items() if n in rows.columns}
    options = f", {_KEEP_NULLS}" if keep_nulls else ""
    body = (
        f"named_struct('artifact', '{config.ARTIFACT_RAW}', 'generatedAt', 'now', 'season', season, "
        f"'sourceArtifacts', array('plays'), 'metadata', {metadata}, 'rows', array({_record(names)}))"
    )
    return rows.selectExpr(_FILE, f"to_json({body}{options}) AS text")


def _read_arrays(spark, folder):
    parsed = documents.parse_documents(array_documents(star_schema.candidate_weeks(spark, folder)))
    rows = documents.typed_keys(documents.canonical_from_array(documents.array_records(parsed)))
    return rows.select(*schemas.KEYS, *schemas.METRICS, *schemas.SPLITS)


def _read_envelopes(spark, folder):
    md = "named_struct('provenanceStatus', if(week % 2 = 0, 'sample', NULL))"
    parsed = documents.parse_documents(envelope_documents(_rows(spark, folder), md))
    records = documents.envelope_records(parsed)
    rows = documents.typed_keys(documents.canonical_from_envelope(records))
    return rows.select(*schemas.KEYS, *schemas.METRICS, *schemas.SPLITS)


def _document_problems(spark, folder):
    """Envelopes without their null fields, a third of them cut off or renamed."""
    docs = envelope_documents(
        star_schema.candidate_weeks(spark, folder), "named_struct('provenanceStatus', 'sample')", False
    )
    broken = docs.selectExpr(
        "sourceFile",
        "CASE WHEN sourceFile LIKE '%-1-%' THEN left(text, length(text) - 1) "
        "WHEN sourceFile LIKE '%-2-%' THEN replace(text, 'team_week_raw_v0', 'other') "
        "WHEN sourceFile LIKE '%-3-%' THEN '[7]' ELSE text END AS text",
    )
    parsed = documents.parse_documents(written(broken, "documents"))
    return documents.raw_violations(parsed).select("sourceFile", "rowIndex", "message")


_CANDIDATE_MD = (
    "named_struct('provenanceStatus', if(week = 1, 'governed_real_data', 'partial_real_data'), "
    "'governance', named_struct('governanceStatus', if(week = 2, 'governed', 'ungoverned'), "
    "'governanceSource', if(week = 3, ' ', 'not_set')), 'deferredFields', array('pressureRateAllowed'))"
)
_GOVERNED_MD = (
    "named_struct('provenanceStatus', if(week = 1, 'sample', 'governed_real_data'), "
    "'governance', named_struct('governanceStatus', if(week = 2, 'ungoverned', 'governed'), "
    "'governanceSource', if(week = 3, 'path_inference', 'explicit_marker')), "
    "'deferredFields', if(week = 4, array('turnovers'), array('pressureRateAllowed')))"
)


def _candidate_documents(spark, folder):
    rows = star_schema.candidate_weeks(spark, folder).select(*schemas.KEYS, *schemas.METRICS)
    return governed.candidate_rows(envelope_documents(rows, _CANDIDATE_MD)).drop(*schemas.ORIGIN)


def _candidate_gate(spark, folder):
    rows = star_schema.candidate_weeks(spark, folder)
    return governed.gate_violations(
        envelope_documents(rows, _CANDIDATE_MD), governed.candidate_gate()
    ).select("sourceFile", "message")


def _candidate_row_problems(spark, folder):
    """Documents written without null fields: a null rate becomes a missing key."""
    rows = star_schema.candidate_weeks(spark, folder).select(*schemas.KEYS, *schemas.METRICS)
    docs = envelope_documents(rows, _CANDIDATE_MD, keep_nulls=False)
    return governed.row_violations(docs, quality.candidate_rules()).select("sourceFile", "message")


def _governed_documents(spark, folder):
    rows = star_schema.governed_weeks(spark, folder)
    return governed.governed_rows(envelope_documents(rows, _GOVERNED_MD)).drop(*schemas.ORIGIN)


def _governed_gate(spark, folder):
    docs = envelope_documents(star_schema.governed_weeks(spark, folder), _GOVERNED_MD)
    return governed.gate_violations(docs, governed.governed_gate()).select("sourceFile", "message")


def _governed_row_problems(spark, folder):
    """Production rows read as governed ones: fantasy and pressure values are refused."""
    docs = envelope_documents(star_schema.candidate_weeks(spark, folder), _GOVERNED_MD)
    return governed.row_violations(docs, quality.governed_rules()).select("sourceFile", "message")


# --- context tables made of the team-seasons ---


def offense_context(means: DataFrame) -> DataFrame:
    tiers = profiles.build_profiles(means)
    status = "CASE volatilityTier WHEN 'stable' THEN 'operator_seeded' ELSE 'guessed' END"
    return tiers.selectExpr(
        "double(season) AS season", "teamId AS team", "'caller' AS offensive_playcaller",
        "if(season = 2012, NULL, 'coach') AS head_coach",
        "CASE paceTier WHEN 'fast' THEN 'high' WHEN 'slow' THEN 'slow' ELSE 'neutral' END AS pace_label",
        "CASE passEnvironmentTier WHEN 'pass_heavy' THEN 'high' WHEN 'run_heavy' THEN 'low' "
        "ELSE 'neutral' END AS pass_rate_label",
        "'neutral' AS play_volume_label", "volatilityTier AS qb_stability_label",
        "offenseTier AS scoring_environment_label", "'neutral' AS rookie_landing_spot_modifier",
        "'light' AS modifier_strength", "'' AS notes", f"{status} AS source_status",
        "if(paceTier = 'neutral', array('even', ''), array(paceTier)) AS context_tags",
        "season - 2000 AS rowIndex",
    )


_GOOD = "filter(tags, t -> t IN ('stable_environment', 'red_zone_machine'))"
_OTHER = "filter(tags, t -> t NOT IN ('stable_environment', 'red_zone_machine'))"


def team_context(means: DataFrame) -> DataFrame:
    known = "if(latestWeek < 12, array('depth_chart_dependency'), array())"
    return means.selectExpr(
        "double(season) AS season", "team", "initcap(team) AS team_name", "'coach' AS head_coach",
        "if(games < 12, '', 'coordinator') AS offensive_coordinator", "'caller' AS play_caller",
        "'steady' AS qb_context", "'operator_seeded' AS source_status", "'none' AS notes",
        "concat(tags, slice(tags, 1, 1)) AS offensive_identity_tags",
        "array('base') AS personnel_usage_tags", "array('neutral') AS pace_pass_environment_tags",
        f"concat({_GOOD}, {known}) AS positive_team_context_tags",
        f"{_OTHER} AS risk_team_context_tags",
        f"concat(filter(tags, t -> t <> 'qb_friendly_matchup'), {known}) AS rookie_landing_context_tags",
        "season - 2000 AS rowIndex",
    )


def landing_context(means: DataFrame) -> DataFrame:
    return means.selectExpr(
        "double(season) AS season", "team", "'name' AS team_name", "'none' AS notes",
        "if(games < 12, 'draft', 'operator_seeded') AS source_status",
        "filter(tags, t -> t <> 'wr_slot_funnel_defense') AS context_tags",
        f"{_GOOD} AS positive_context_tags", f"{_OTHER} AS risk_context_tags",
        "season - 2000 AS rowIndex",
    )


def _context(build, kind: str) -> Query:
    def run(spark, folder):
        rules = context_tables.TableRules(kind, 2011, LEAGUE.teams)
        table = written(build(_means(spark, folder)), "context")
        return context_tables.table_problems(table, rules).select("team", "message")

    return run


# --- labels over other tables ---


def _paths(spark, folder):
    """Source-path labels of the page addresses."""
    pages = star_schema.read_table(spark, folder, "pages")
    path = F.concat(
        F.when(F.col("page_id") % 3 == 0, "C:\\data\\sample\\").when(F.col("page_id") % 3 == 1, "./fixtures/")
        .otherwise("/srv/fixtures/"), F.col("url"),
    )
    return pages.select("page_id", normalized_path(path).alias("path"), path_type(path).alias("type"))


def _cutoffs(spark, folder):
    """Cutoff status of every order date, written with, without and with a broken zone."""
    orders = star_schema.read_table(spark, folder, "orders")
    stamp = "date_format(o_orderdate, 'yyyy-MM-dd\\'T\\'HH:mm:ss')"
    as_of = (
        f"CASE o_orderpriority WHEN '1-URGENT' THEN concat({stamp}, 'Z') "
        f"WHEN '2-HIGH' THEN concat({stamp}, '.5+05:00') WHEN '3-MEDIUM' THEN {stamp} "
        f"WHEN '5-LOW' THEN concat('on ', {stamp}) ELSE ' ' END AS asOf"
    )
    return orders.selectExpr("o_orderkey", as_of, "'1998-09-01T00:00:00.000Z' AS start").selectExpr(
        "o_orderkey", "asOf", f"{forecast.cutoff_status('asOf', 'start')} AS status"
    )


def _prepared(query: Query) -> Query:
    return lambda spark, folder: query(prepare(spark), folder)


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        "bridge_team_week": _rows,
        "bridge_candidate": _candidate,
        "scores_all": _scores,
        "tags": _tags,
        "explanation_lists": _lists,
        "explanation_summary": _summary,
        "state_records": _state_records,
    }
    found.update({f"components_{part}": _components(part) for part in scoring.SCORE_PARTS})
    for name in config.WEEKLY_RANKINGS:
        found[f"rank_{name}"] = _rank(name, latest=False)
        found[f"latest_{name}"] = _rank(name, latest=True)
    found["rank_weekly_all"] = _rank_all(latest=False)
    found["rank_latest_all"] = _rank_all(latest=True)
    found["rank_volatility_ascending"] = _rank_volatility_asc
    found["latest_week_by_season"] = _latest_weeks
    found["season_agg"] = _season_agg
    found["season_means"] = _season_means
    for name in config.SEASON_SCORE_RANKINGS:
        found[f"season_rank_{name}"] = _season_rank(name)
    for p in config.POSITIONS:
        found[f"offense_{p.lower()}"] = _positional("offense", p)
        found[f"matchup_{p.lower()}"] = _positional("matchup", p)
    found.update(
        {
            "snapshot_stable": _snapshot_list(season.most_stable),
            "snapshot_volatile": _snapshot_list(season.most_volatile),
            "snapshot_least_volatile": _snapshot_list(season.least_volatile),
            "snapshot_lists": _snapshot,
            "snapshot_offense": _positional_snapshot("offense"),
            "snapshot_matchup": _positional_snapshot("matchup"),
            "snapshot_scope": _scope,
            "run_metadata": _run_metadata,
            "slice_rows": _slice,
            "movement_v0": _movement(),
            "movement_at_week_5": _movement(5),
            "movement_at_week_3": _movement(3),
            "movement_v1": _movement_v1,
            "movement_metadata": _movement_metadata,
            "profiles": _profiles,
            "profile_metadata": _profile_metadata,
            "features": _features,
            "feature_guards": _feature_guards,
            "feature_table": _feature_table,
            "feature_problems": _feature_problems,
            "quality_violations": _quality,
            "coverage_dense": _coverage(coverage.dense_problems),
            "coverage_dense_summary": _coverage_summary(coverage.dense_problems),
            "coverage_bye": _coverage(coverage.bye_aware_problems),
            "coverage_bye_summary": _coverage_summary(coverage.bye_aware_problems),
            "coverage_grid": _grid,
            "null_profile": _null_profile,
            "null_profile_governed": _null_profile_governed,
            "column_evidence": _column_evidence,
            "team_evidence": _team_evidence,
            "season_report_weighted": _report,
            "season_report_problems": _report_problems,
            "read_array_documents": _read_arrays,
            "read_envelope_documents": _read_envelopes,
            "document_problems": _document_problems,
            "candidate_documents": _candidate_documents,
            "candidate_gate": _candidate_gate,
            "candidate_row_problems": _candidate_row_problems,
            "governed_documents": _governed_documents,
            "governed_gate": _governed_gate,
            "governed_row_problems": _governed_row_problems,
            "context_offense_problems": _context(offense_context, "offense"),
            "context_team_problems": _context(team_context, "context"),
            "context_landing_problems": _context(landing_context, "landing"),
            "source_path_labels": _paths,
            "cutoff_status": _cutoffs,
        }
    )
    found |= lanes.queries() | stored.queries()
    return {name: _prepared(query) for name, query in found.items()}
