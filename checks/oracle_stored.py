"""DuckDB SQL of the queries over spoiled documents: what each way of spoiling must bring up."""

from checks import oracle as o

NATION = "CAST(substr(team, 8) AS INTEGER)"
ENUMS = ["pace_label", "pass_rate_label", "play_volume_label", "qb_stability_label", "scoring_environment_label",
         "rookie_landing_spot_modifier", "modifier_strength", "source_status"]
TAGS = {
    "offense": ["context_tags"],
    "context": ["offensive_identity_tags", "personnel_usage_tags", "pace_pass_environment_tags", "positive_team_context_tags",
                "risk_team_context_tags", "rookie_landing_context_tags"],
    "landing": ["context_tags", "positive_context_tags", "risk_context_tags"],
}
WORDS = {"offense": ["offensive_playcaller", "head_coach", "notes"],
         "context": ["team_name", "head_coach", "offensive_coordinator", "play_caller", "qb_context", "notes"], "landing": ["team_name", "notes"]}
MATCH = "context_tags must match positive_context_tags + risk_context_tags."
COVER = "rookie_landing_context_tags must include all positive/risk tags."


def _said(kind: str) -> list[list[str]]:
    """Messages about a row, by code."""
    tags = TAGS[kind]
    whole = [] if kind == "context" else ["season must be an integer."]
    year, name = "season must equal 2011.", "team must be a non-empty string."
    out = [[*whole, year], [year], [name], [name], [], []]
    out.append([] if kind == "context" else ["unexpected fields: ['also', 'more']"])
    status = "source_status must be one of operator_seeded, operator_seeded_unknown."
    out += [[f"invalid {c} 'odd'."] for c in ENUMS] if kind == "offense" else [[status if kind == "context" else "invalid source_status 'odd'."]]
    text = lambda c: f"{c} must be a {'string' if kind == 'offense' or kind == 'landing' and c == 'notes' else 'non-empty string'}."
    out += [[text(c)] for c in WORDS[kind]]
    more = {"landing": [MATCH], "offense": []}
    out += [[f"{c} must be an array.", *more.get(kind, [COVER] if c.startswith("rookie") else [])] for c in tags]
    repeats = {"offense": None, "context": "must not contain duplicates.", "landing": "must not include duplicate tags."}[kind]
    out += [[f"{c} {repeats}"] if repeats else [] for c in tags]
    out.append([f"{tags[0]} must contain non-empty strings.", *more.get(kind, [])])
    out.append({"offense": [], "context": [COVER], "landing": [MATCH]}[kind])
    out += [["missing required fields: ['notes']", text("notes")], ["value must be an object."]]
    if kind == "context":
        out.append(["positive_team_context_tags includes known risk tag(s)."])
    return out


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _context(kind: str) -> str:
    said = _said(kind)
    gone = next(i for i, m in enumerate(said) if m == ["value must be an object."])
    values = ", ".join(f"({i}, {_quoted(m)})" for i, found in enumerate(said) for m in found)
    missing, lines = ("Missing required team", "team rows") if kind == "context" else ("Missing team", "teams")
    cte = o.ROWS + o.LEAGUE_CTE + f""",
p AS (SELECT season, team, (season*7+{NATION}*3)%{len(said) + 6} AS code, CAST(row_number() OVER (PARTITION BY season ORDER BY team)-1 AS INTEGER) AS i FROM (SELECT DISTINCT season, team FROM tw)),
e AS (SELECT *, CASE WHEN code IN (2, {gone}) THEN NULL WHEN code=3 THEN '' WHEN code=4 THEN 'XX' WHEN code=5 THEN 'NATION_0' ELSE team END AS t FROM p)"""
    return o.query(cte, f"""
SELECT CAST(season AS VARCHAR) AS sourceFile, i AS rowIndex, 'Row ' || i || ': ' || m AS message FROM e JOIN (VALUES {values}) v(c, m) ON c=code
UNION ALL SELECT CAST(season AS VARCHAR), i, 'Row ' || i || ': unknown team code ''' || t || '''.' FROM e WHERE t NOT IN (SELECT team FROM league)
UNION ALL SELECT CAST(season AS VARCHAR), i, 'Row ' || i || ': duplicate team code ''' || t || '''.' FROM (SELECT *, row_number() OVER (PARTITION BY season, t ORDER BY i) AS k FROM e WHERE t IS NOT NULL) WHERE k>1
UNION ALL SELECT CAST(s.season AS VARCHAR), NULL, '{missing}: ' || l.team FROM (SELECT DISTINCT season FROM e) s, league l WHERE (s.season, l.team) NOT IN (SELECT (season, t) FROM e WHERE t IS NOT NULL)
UNION ALL SELECT CAST(season AS VARCHAR), NULL, 'Expected 25 {lines}, found ' || count(*) || '.' FROM e GROUP BY season HAVING count(*)<>25""")


NUMBERS = ["points_per_drive", "epa_per_play", "success_rate", "explosive_play_rate", "pressure_rate_allowed", "seconds_per_play",
           "neutral_pass_rate", "volatility_score"]
MOVES = {
    "offense_direction": "improving, declining", "pass_environment_direction": "more_pass_heavy, less_pass_heavy", "pace_direction": "faster, slower",
    "pressure_direction": "improving, worsening", "volatility_direction": "rising, falling",
}
CHOICES = {n: f"{ways}, stable, insufficient_data, unknown" for n, ways in MOVES.items()} | {
    "offense_tier": "elite, strong, average, weak, unknown", "pass_environment_tier": "pass_heavy, balanced, run_heavy, unknown",
    "pace_tier": "fast, neutral, slow, unknown", "volatility_tier": "stable, volatile, unknown",
}


def _found() -> list[list[tuple[str, str]]]:
    """(part, message) of a feature document, by code."""
    d, c, t = ((lambda *m, p=p: [(p, x) for x in m]) for p in ("document", "catalogue", "teams"))
    contract = "team_environment_forecast_features_v1"
    out = [d(f'{f} must be "{v}"') for f, v in (("artifact", contract), ("contractVersion", contract), ("owningRepo", "team-environment"),
                                              ("intendedConsumer", "Point-prediction-model"), ("outputKind", "model-legible-team-context"))]
    out += [[("names", f"forbidden fantasy-point field present: {k}")] for k in ("fantasyPoints", "Fantasy_point total")]
    out += [d(f"{f} must be a non-empty ISO string") for f in ("generatedAt", "cutoffAt")] + [d(f"{f} must be a number") for f in ("featureSeason", "targetSeason")]
    out += [d("governance must be an object"), d("governance.governanceStatus must be one of governed, fixture, ungoverned, unknown"),
            d("governance.governanceSource must be one of explicit_marker, path_inference, unknown"), d("governance.generatedAt must be a non-empty ISO string")]
    out += [d("coverage must be an object"), *[d(f"coverage.{f} must be a number") for f in ("teamCount", "expectedTeamCount")],
            d("coverage.isFullLeague must be a boolean"), *[d(f"coverage.{f} must be an array") for f in ("seasons", "weeks")]]
    out += [d("coverage.teamCount (2) must equal the number of team rows (1)", "coverage.isFullLeague (true) must be false when teamCount=2 and expectedTeamCount=1"),
            d("coverage.isFullLeague (false) must be true when teamCount=1 and expectedTeamCount=1")]
    names, extra, lost = [*NUMBERS, *CHOICES], 'teams[0].features has undeclared feature "{}"', 'teams[0].features is missing declared feature "{}"'
    out += [d("featureDefinitions must be a non-empty array") + t(*[extra.format(n) for n in names]), d("teams must be an array")]
    first, second = NUMBERS[:2]
    gone = c(f'featureDefinitions is missing canonical feature "{first}"') + t(extra.format(first))
    at = "featureDefinitions[0]"
    out += [c(f"{at} must be an object") + gone, c(f"{at}.name must be a non-empty string") + gone,
            c('featureDefinitions declares unknown feature "invented"') + t(lost.format("invented")) + gone, c(f'featureDefinitions declares "{second}" more than once') + gone,
            c(f'{at}.type for "{first}" must be "number"'), c(f"{at}.description must be a non-empty string"), c(f"{at}.allowedInModel must be a boolean"),
            c(f"{at}.allowedInPosthocExplanation must be a boolean"), c(f"{at}.type must be one of number, direction, tier", 'featureDefinitions declares unknown feature "new"') + t(lost.format("new"))]
    out += [t("teams[0] must be an object")] + [t(f"teams[0].{f} must be a non-empty string") for f in ("teamId", "teamAbbr", "cutoffAt")]
    out += [t("teams[0].season must be a number"), t("teams[0].featureCoverageStatus must be one of complete, partial, unavailable"),
            t("teams[0].confidence must be a number in [0, 1]"), t("teams[0].warnings must be an array"), t("teams[0].sourceDatasetRefs must be an array"),
            t("teams[0].features must be an object"), t(lost.format(second)), t(extra.format("more"))]
    out += [t(f"teams[0].features.{n} must be a finite number or null") for n in NUMBERS] + [t(f"teams[0].features.{n} must be one of {ways}") for n, ways in CHOICES.items()]
    return [*out, d("invalid JSON"), d("artifact must be an object")]


def _published() -> str:
    """Rows of every data set of a run."""
    seasons = "(SELECT count(*) FROM (SELECT DISTINCT season, team FROM tw))"
    top = f"least(10, {seasons})"
    weekly, season = len(o.RANKED), len(o.SEASON_RANKED) + 8
    rows = {
        "weekly_states": "(SELECT count(*) FROM tw)", "pipeline_metadata": "1", "team_seasons": seasons, "current_snapshot": f"{3 + len(o.SEASON_RANKED)}*{top}",
        "current_offense_environments": f"4*{top}", "current_matchup_environments": f"4*{top}", "snapshot_scope": "1",
        "team_environment_profiles_v0": seasons, "team_environment_profiles_v0_metadata": "1", "team_environment_movement_v0": seasons,
        "team_environment_movement_v1": seasons, "team_environment_movement_metadata": "1",
        "rankings": f"{weekly}*(SELECT count(*) FROM tw)+{weekly}*(SELECT count(*) FROM latest)+{season}*{seasons}",
    }
    parts = " UNION ALL ".join(f"SELECT '{name}' AS dataset, CAST({n} AS BIGINT) AS rows, CAST(0 AS BIGINT) AS wrong" for name, n in rows.items())
    return o.query(o.ROWS + o.LATEST.replace("states", "tw"), parts)


def _reports() -> str:
    absent = ("E_PROVENANCE_MISSING", "provenance or governance markers absent")
    checksum, times = ("E_GOVERNED_INPUT_CHECKSUM_MISMATCH", "checksum absent or different"), ("E_TEMPORAL_METADATA_MISSING", "dataThrough, sourceSnapshotAt, generatedAt")
    conflated = "E_TEMPORAL_METADATA_CONFLATED"
    said = {
        1: [absent], 2: [absent], 3: [("E_PROVENANCE_NOT_GOVERNED", "sample, governed, explicit_marker")], 4: [checksum], 5: [times],
        6: [(conflated, "sourceSnapshotAt is not the latest snapshot")], 7: [(conflated, "two time fields are wired to one source")],
        8: [("E_UPSTREAM_SOURCE_CHECKSUM_MISSING", f"upstream source {n}") for n in ("plays", "games")], 9: [("E_METHODOLOGY_VERSION_UNKNOWN", "x")],
        10: [("E_WITHHELD_FIELD_PRESENT", "passRate"), ("E_APPROXIMATED_DENOMINATOR_UNAUTHORIZED", "passRate")], 11: [("E_WITHHELD_FIELD_PRESENT", "pointsAgainstTotal")],
        12: [("E_UNDOCUMENTED_FIELD_PRESENT", "mood")], 15: [absent, checksum, times],
    }
    values = ", ".join(f"({i}, '{code}', '{detail}')" for i, found in said.items() for code, detail in found)
    return o.query(o.REPORT, f"""SELECT season || '-' || c AS sourceFile, code, CAST(NULL AS VARCHAR) AS team, detail FROM (SELECT DISTINCT season FROM report), (VALUES {values}) v(c, code, detail)
UNION ALL SELECT season || '-11', 'E_WITHHELD_FIELD_ZERO_FILLED', team, 'pointsAgainstTotal' FROM report
UNION ALL SELECT season || '-13', 'E_UNWEIGHTED_AGGREGATION_USED', team, 'epaPerPlay' FROM report WHERE epaPerPlay IS NOT NULL AND epaPerPlay<>7.5
UNION ALL SELECT season || '-14', 'E_UNWEIGHTED_AGGREGATION_USED', team, 'redZoneTdRate' FROM report WHERE redZoneTdRate IS NOT NULL
UNION ALL SELECT season || '-14', 'E_REDZONE_NULL_INVARIANT_VIOLATED', team, 'redZoneTripsTotal ' || redZoneTripsTotal FROM report WHERE redZoneTripsTotal<>0""")


def build() -> dict[str, str]:
    sql = {f"context_files_{name}": _context(kind) for name, kind in (("offense", "offense"), ("team", "context"), ("landing", "landing"))}
    sql["published_run"] = _published()
    sql["report_files"] = _reports()
    sql["manifest_findings"] = o.query(o.ROWS + f""",
p AS (SELECT season || '-' || team AS name, (season+{NATION})%6 AS code FROM (SELECT DISTINCT season, team FROM tw))""", """
SELECT name, false AS invented, CASE code WHEN 0 THEN 'changed' WHEN 1 THEN 'extra' ELSE 'listed twice' END AS problem, code<>1 AS listed, true AS there FROM p WHERE code IN (0, 1, 3)
UNION ALL SELECT name, true, 'missing', true, false FROM p WHERE code=2""")
    marks = "['fixture_scaffold', 'sample', 'partial_real_data', 'governed_real_data', 'unknown_provenance', 'promoted', NULL]"
    sql["document_provenance"] = o.query(o.ROWS, f"""SELECT sourceFile, marker, pathType, teamCount, isFullLeague, movementProvenance, profileProvenance,
  CASE movementProvenance WHEN 'governed_real_data' THEN 'governed' WHEN 'partial_real_data' THEN 'ungoverned' WHEN 'unknown_provenance' THEN 'unknown' ELSE 'fixture' END AS governanceStatus,
  CASE WHEN marker<>'promoted' THEN 'explicit_marker' WHEN movementProvenance='unknown_provenance' THEN 'unknown' ELSE 'path_inference' END AS governanceSource,
  CASE WHEN marker<>'promoted' THEN '' WHEN movementProvenance='unknown_provenance' THEN 'No explicit producer' ELSE 'Governance status in' END AS promotionNotes
FROM (SELECT *, CASE WHEN marker='governed_real_data' THEN CASE WHEN isFullLeague THEN marker ELSE 'partial_real_data' END WHEN marker<>'promoted' THEN marker
    WHEN pathType<>'unknown' THEN 'fixture_scaffold' ELSE 'unknown_provenance' END AS movementProvenance,
  CASE WHEN marker='governed_real_data' AND isFullLeague THEN marker WHEN pathType<>'unknown' THEN 'fixture_scaffold' ELSE 'unknown_provenance' END AS profileProvenance
FROM (SELECT (['data/sample/', 'fixtures/', 'elsewhere/', './data/sample/'])[1+(season+week)%4] || season || '-' || week || '.json' AS sourceFile, ({marks})[1+(season*12+week)%7] AS marker,
  CASE (season+week)%4 WHEN 1 THEN 'fixture' WHEN 2 THEN 'unknown' ELSE 'sample' END AS pathType, count(DISTINCT team) AS teamCount, count(DISTINCT team)=25 AS isFullLeague FROM tw GROUP BY season, week))""")
    found = _found()
    values = ", ".join(f"({i}, '{part}', {_quoted(m)})" for i, some in enumerate(found) for part, m in some)
    sql["feature_files"] = o.query(o.ROWS, f"""SELECT season || '-' || team AS sourceFile, part, message FROM (SELECT DISTINCT season, team FROM tw)
JOIN (VALUES {values}) v(code, part, message) ON code=(season*25+{NATION})%{len(found) + 5}""")
    return sql
