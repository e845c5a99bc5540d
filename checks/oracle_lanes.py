"""DuckDB SQL of the file work, the reports and the rules that spoiled rows break."""

from checks import oracle as o

ONE = ",\nchosen AS (SELECT * FROM {} WHERE season=2011)"
GOV_ONE = o.GOV.replace("FROM cand)", "FROM cand WHERE season=2011)")
BYE_ONE = o.BYE.replace("AS redZoneTdRate) FROM cand)", "AS redZoneTdRate) FROM cand WHERE season=2011)")
FIELDS = o.METRICS + o.SPLITS
RATES = ["passRate", "neutralPassRate", "rushRate", "successRate", "explosivePlayRate", "redZoneTdRate", "pressureRateAllowed"]
COUNTS = ["pointsFor", "pointsAgainst", "offensivePlays", "neutralPlays", "secondsPerPlay", "drives", "pointsPerDrive",
          "redZoneTrips", "sacksAllowed", "turnovers", *o.FANTASY]
CODE = "(season*12+week+7*CAST(substr(team, 8) AS INTEGER))"
ROW = "(season || '-' || week || '-' || team)"
KINDS = "(SELECT coalesce(string_agg(kind || ':' || n, ',' ORDER BY kind), '') FROM (SELECT kind, CAST(sum(occurrences) AS BIGINT) AS n FROM problems GROUP BY kind))"
COVERAGE = (f"false AS valid, (SELECT CAST(sum(occurrences) AS BIGINT) FROM problems) AS errorCount, {KINDS} AS errorsByKind, "
            "(SELECT count(*) FROM tw) AS rowCount")


def _listed(names) -> str:
    return "|".join(names)


def _profile(fields, table: str) -> str:
    """Lists of field names by status and the counts, as three SQL expressions."""
    held = "pressureRateAllowed"
    whole = [f"CASE WHEN (SELECT count({f})=count(*) FROM {table}) THEN '{f}' END" for f in fields if f != held]
    partial = [f"CASE WHEN (SELECT count({f})<count(*) FROM {table}) THEN '{f}' END" for f in fields if f != held]
    counts = [f"'{f}:' || (SELECT count({f}) || ':' || (count(*)-count({f})) FROM {table})" for f in fields]
    return (f"concat_ws('|', {', '.join(whole)}) AS availableFields, '{held}' AS deferredInsufficientFields, "
            f"concat_ws('|', {', '.join(partial)}) AS partialNullFields, concat_ws('|', {', '.join(counts)}) AS fields")


def _rules() -> list[tuple[dict, list[str]]]:
    """By code: the changed fields and the messages that follow."""
    out = [({f: None}, [f"Missing required field: {f}"]) for f in ["season", "week", "team", "opponent", *o.METRICS]]
    blank = "Team and opponent must be non-empty strings."
    out += [({}, ["Invalid season: 1998"]), ({}, ["Invalid week: 23"]), ({}, [blank]), ({}, [blank])]
    near = "passRate + rushRate must be near 1.0. Received 2"
    out += [({}, [f"Invalid rate field {f}: 1.5"] + [near] * (f in ("passRate", "rushRate"))) for f in RATES]
    out += [({}, [f"Invalid non-negative field {f}: -1"]) for f in COUNTS]
    out += [({}, ["passRate + rushRate must be near 1.0. Received 1.25"])]
    return out + [({}, [f"Invalid optional split field {f}: -2"]) for f in o.SPLITS]


def _texts(kind: str, fields) -> list[tuple[int, str]]:
    head = {"envelope": "team_week_raw_v0", "candidate": "team_week_raw_v0 candidate", "governed": "governed team_week_raw_v0"}[kind]
    at = f"Invalid {head} row at index 0: "
    out = []
    for i, f in enumerate(fields):
        if f in ("teamCode", "opponentCode"):
            said = f"{at}{f} must be a non-empty string."
        elif f in o.SPLITS:
            said = "Invalid optional split field value: x"
        elif kind == "envelope":
            said = f"{at}{f} must be a finite number."
        elif f in ("season", "week"):
            said = f"{at}{f} must be an integer."
        elif kind == "governed" and f == "pressureRateAllowed":
            said = f"{at}{f} must be null/deferred, never inferred or zero-filled."
        else:
            said = f"{at}{f} must be a finite number or null."
        out.append((i, said))
    last = {"envelope": f"{at}turnovers must be a finite number.", "candidate": f"{at}missing required field turnovers.",
            "governed": f"{at}turnovers must be a finite number or null."}[kind]
    return [*out, (len(fields), last)]


def _by_code(pairs, count: int, table: str, key: str, name: str) -> str:
    values = ", ".join("({}, '{}')".format(i, said.replace("'", "''")) for i, said in pairs)
    return f"SELECT {key} AS {name}, message FROM {table} JOIN (VALUES {values}) AS v(code, message) ON code={CODE}%{count}"


def build() -> dict[str, str]:
    q, sql = o.query, {}
    names = ", ".join(FIELDS)
    numbered = "CAST(row_number() OVER (PARTITION BY season ORDER BY week, team)-1 AS INTEGER) AS rowIndex"
    sql["scanned_documents"] = q(o.ROWS, f"SELECT {numbered}, {o.KEYS}, {names} FROM tw")
    sql["canonical_file"] = q(o.ROWS, f"SELECT {numbered}, {o.KEYS}, {names} FROM tw")
    sql["pinned_source"] = q(o.ROWS, "SELECT count(DISTINCT season) AS files, true AS same, true AS pinned FROM tw")
    sql["source_manifest"] = q(GOV_ONE, """SELECT count(*) AS rowCount, count(DISTINCT team) AS teamCount, repeat('0', 64) AS sha256,
    CAST(2011 AS INTEGER) AS season, 'now' AS generatedAt, 'governed_real_data' AS provenanceStatus, 'governed' AS governanceStatus,
    'explicit_marker' AS governanceSource, 'checked' AS governanceNotes FROM gov""")
    col = o.RANKED["team_power"]
    sql["sink_round_trip"] = q(o.STATES, f"SELECT row_number() OVER (ORDER BY {col} DESC, season DESC, week DESC, team) AS rank, season, week, team, {o.rnd(col, 2)} AS score FROM states")
    seasons = [f"('season_to_date', '{n}')" for n in o.SEASON_RANKED]
    seasons += [f"('season_to_date', '{p}_{s}')" for s in ("offense_environment", "matchups") for p in ("qb", "rb", "wr", "te")]
    weekly = [f"('{f}', '{n}')" for f in ("rankings", "latest_week") for n in o.RANKED]
    sql["published_family"] = q(o.ROWS + o.LATEST.replace("states", "tw"), f"""SELECT *, rows AS last FROM (SELECT family, metric, CASE family WHEN 'rankings' THEN (SELECT count(*) FROM tw)
      WHEN 'latest_week' THEN (SELECT count(*) FROM latest) ELSE (SELECT count(*) FROM (SELECT DISTINCT season, team FROM tw)) END AS rows,
      CASE family WHEN 'latest_week' THEN (SELECT count(DISTINCT team) FROM latest) ELSE (SELECT count(DISTINCT team) FROM tw) END AS teams
    FROM (VALUES {', '.join(weekly + seasons)}) AS v(family, metric))""")
    order = "season DESC, latestWeek DESC, team"
    sql["season_order"] = q(o.SEASONS, f"SELECT row_number() OVER (ORDER BY {order}) AS rank, season, team, latestWeek, games FROM seasons")
    lists = [(n, c) for n, (c, _) in o.SEASON_RANKED.items()] + [(f"offense_{p.lower()}", s) for p, s in o.OFFENSE.items()]
    lists += [(f"matchup_{p.lower()}", f"fantasyPointsAllowed{p}") for p in ("QB", "RB", "WR", "TE")]
    sql["report_bundle"] = q(o.SEASONS, " UNION ALL ".join(
        f"SELECT '{n}' AS list, row_number() OVER (ORDER BY v DESC, {order}) AS rank, season, team, {o.rnd('v', 2)} AS score FROM (SELECT *, {s} AS v FROM seasons)"
        for n, s in lists))
    _reports(sql)
    rules = _rules()
    fixed = [(i, m) for i, (_, said) in enumerate(rules) for m in said]
    sql["every_canonical_rule"] = q(o.ROWS, _by_code(fixed, len(rules) + 5, "tw", ROW, "row"))
    keys = ["season", "week", "teamCode", "opponentCode"]
    for kind, cte, table, fields in (("envelope", o.ROWS, "tw", FIELDS), ("candidate", o.CANDIDATE, "cand", o.METRICS), ("governed", o.GOV, "gov", o.GOVERNED)):
        found = [*keys, *[f for f in o.METRICS if f in fields], *(o.SPLITS if kind == "envelope" else [])]
        sql[f"every_{kind}_rule"] = q(cte, _by_code(_texts(kind, found), len(found) + 3, table, o.FILE, "sourceFile"))
    nation = "CAST(substr(team, 8) AS INTEGER)"
    wide = {"fe": (3, 11, 10, 0), "np": (5, 9, "0.05e0", "0.35e0"), "sp": (2, 13, 1, 22), "vo": (11, 10, 10, 0)}
    made = ", ".join(f"CAST((season*7+{nation}*{k})%{n} AS DOUBLE)*{step}+{low} AS {c}" for c, (k, n, step, low) in wide.items())
    sql["every_tier"] = q(o.ROWS, f"""SELECT season, team, CASE WHEN fe>=85 THEN 'elite' WHEN fe>=70 THEN 'strong' WHEN fe>=50 THEN 'average' ELSE 'weak' END AS offenseTier,
    CASE WHEN np>=0.57e0 THEN 'pass_heavy' WHEN np<=0.43e0 THEN 'run_heavy' ELSE 'balanced' END AS passEnvironmentTier,
    CASE WHEN sp<=27 THEN 'fast' WHEN sp>=29 THEN 'slow' ELSE 'neutral' END AS paceTier,
    CASE WHEN vo<=45 THEN 'stable' WHEN vo>=60 THEN 'volatile' ELSE 'unknown' END AS volatilityTier, concat_ws('|', '{o.MARKET}', CASE WHEN vo>45 AND vo<60 THEN 'volatilityTier unknown: volatility score unavailable or in neutral band (45-60).' END) AS warnings
    FROM (SELECT season, team, {made} FROM (SELECT DISTINCT season, team FROM tw))""")
    sql["source_label_kinds"] = """SELECT page_id, CASE page_id%4 WHEN 0 THEN 'data/sample/' WHEN 1 THEN 'fixtures/' WHEN 2 THEN 'elsewhere/' ELSE 'data/sampled/' END || page_id AS path,
    CASE page_id%4 WHEN 0 THEN 'sample' WHEN 1 THEN 'fixture' ELSE 'unknown' END AS type FROM pages"""
    everyone = ", ".join(f"'{t}'" for t in o.NATIONS)
    gaps = o.ROWS + f""",
moved AS (SELECT team, CASE WHEN (week+{nation})%5=0 THEN week+12 ELSE week END AS week FROM tw),
c AS (SELECT team, week, count(*) AS n FROM moved GROUP BY ALL), l AS (SELECT unnest([{everyone}]) AS team)"""
    sql["dense_gaps"] = q(gaps, """
    SELECT 'duplicate' AS kind, team, CAST(week AS INTEGER) AS week, CAST(n-1 AS BIGINT) AS occurrences, 'duplicate row for team "' || team || '" week ' || week AS message FROM c WHERE n>1
    UNION ALL SELECT 'missing_week', l.team, g.week, 1, 'team "' || l.team || '" is missing week ' || g.week
    FROM l, (SELECT CAST(unnest(range(1, 13)) AS INTEGER) AS week) g WHERE l.team IN (SELECT team FROM c) AND (l.team, g.week) NOT IN (SELECT (team, week) FROM c)
    UNION ALL SELECT 'missing_team', team, NULL, 1, 'missing team "' || team || '" (no rows)' FROM l WHERE team NOT IN (SELECT team FROM c)
    UNION ALL SELECT 'unexpected_week', team, CAST(week AS INTEGER), 1, 'team "' || team || '" has unexpected week ' || week || ' (outside expected weeks)' FROM c WHERE week NOT BETWEEN 1 AND 12""")
    return sql


def _reports(sql: dict[str, str]) -> None:
    q = o.query
    sql["dry_run_report"] = q(BYE_ONE, f"""SELECT {COVERAGE}, 'partial_real_data' AS provenanceStatus, 'ungoverned' AS governanceStatus, 'not_set' AS governanceSource,
    false AS promoted, false AS governed, 'pressureRateAllowed' AS deferredFields, 'insufficient_data' AS pressurePosture""")
    some = BYE_ONE + ONE.format("cand")
    sql["rehearsal_report"] = q(some, f"""SELECT {COVERAGE}, 'team_week_raw_v0_candidate_rehearsal' AS kind, {_profile(o.METRICS, 'chosen')}, true AS rehearsalOnly,
    false AS productionReady, 'withheld_invalid_coverage' AS rehearsalStatus""")
    governed = BYE_ONE + o.GOV[len(o.CANDIDATE):].replace("FROM cand)", "FROM cand WHERE season=2011)")
    sql["readiness_report"] = q(governed, f"""SELECT {COVERAGE}, 'team_week_raw_v0_governed_readiness' AS kind, {_profile(o.GOVERNED, 'gov')}, false AS productionReady,
    'governed_real_data' AS provenanceStatus, 'checked' AS notes, 'report.md' AS validationReportPath, 'manifest.json' AS lineageManifestPath,
    'unavailable_insufficient_data_deferred' AS pressurePosture, 'withheld_invalid_coverage' AS readinessStatus""")
    sql["report_messages"] = q(BYE_ONE, o.PROBLEM_COLUMNS)
    inputs = sorted(f for f in o.GOVERNED if f != "pressureRateAllowed")
    sql["forecast_input"] = q(governed, f"""SELECT '{_listed(inputs)}' AS forecastInputColumns, true AS forecastConsumable, CAST(2012 AS INTEGER) AS targetSeason,
    CAST(count(DISTINCT team) AS BIGINT) AS teamCount, count(*) AS rowCount, 'team_week' AS rowGrain, '2012-03-01T00:00:00.000Z' AS asOf,
    '2012-09-01T00:00:00.000Z' AS targetSeasonStart, '2011_input_to_2012_target' AS safeFor, '1,2,3,4,5,6,7,8,9,10,11' AS "window", false AS isFullLeague,
    'season|week|teamCode' AS teamWeekGrainKeys, 'player_input_season_team (team_2024)|input_season' AS joinKeysRequired, false AS bindsToForecastHere,
    'season>input_season|teamCode>player_input_season_team (team_2024)|week>(aggregated away)' AS fieldMapping, CAST(8 AS INTEGER) AS withheldFields,
    false AS fantasyPresent, 'unavailable_insufficient_data_deferred_excluded' AS pressureForecastPosture,
    'no_target_future_leakage_fields_emitted_as_input' AS targetLeakageStatus FROM gov""")
    cells = ", ".join(
        f"'{f}:' || count({f}) || ':' || (count(*)-count({f})) || ':{'false' if f == 'pressureRateAllowed' else 'true'}'" for f in o.GOVERNED)
    sql["coverage_evidence"] = q(governed, f"""SELECT repeat('0', 64) AS sha256, 'governed_real_data' AS provenanceStatus, 'report.md' AS validationReportPath,
    CAST(2011 AS INTEGER) AS season, CAST(count(DISTINCT team) AS INTEGER) AS teamCount, count(*) AS rowCount, CAST(300 AS INTEGER) AS expectedRowCount,
    string_agg(DISTINCT team, '|' ORDER BY team) AS presentTeams,
    (SELECT string_agg(t, '|' ORDER BY i) FROM (SELECT unnest([{o.LEAGUE_LIST}]) AS t, unnest(range(25)) AS i) WHERE t NOT IN (SELECT team FROM gov)) AS missingTeams,
    'withheld_invalid_coverage' AS readinessStatus, CAST({len(inputs)} AS INTEGER) AS columns, concat_ws('|', {cells}) AS perColumn, true AS noSilentZeroFill,
    '25/25' AS expectedTeamCoverage, false AS coversAllTeams FROM gov""")
    teams = {"full": 32, "excerpt": 4}
    parts = []
    for name, n in teams.items():
        games, weeks = (17, "week NOT BETWEEN 1 AND 18") if name == "full" else (1, "week NOT IN (1, 4, 9)")
        parts += [
            f"SELECT '{name}' AS expectation, 'duplicate' AS kind, sum(c-1) AS n FROM (SELECT count(*) AS c FROM tw GROUP BY team, week) HAVING sum(c-1)>0",
            f"SELECT '{name}', 'wrong_season', count(*) FROM tw WHERE season<>2024 HAVING count(*)>0",
            f"SELECT '{name}', 'missing_team', {n}",
            f"SELECT '{name}', 'unexpected_team', count(DISTINCT team) FROM tw",
            f"SELECT '{name}', 'out_of_window', count(*) FROM (SELECT DISTINCT team, week FROM tw WHERE {weeks}) HAVING count(*)>0",
            f"SELECT '{name}', 'row_count', 1 FROM tw HAVING count(*)<>{n * games}",
        ]
    sql["standing_expectations"] = q(o.ROWS, "SELECT expectation, kind, CAST(n AS BIGINT) AS n FROM (" + " UNION ALL ".join(parts) + ")")
    sql["scaffold_features"] = q(o.ROWS, "SELECT team, season, 2e0 AS points, 'stable' AS offense, 28e0 AS seconds FROM (SELECT DISTINCT team, season FROM tw)")
