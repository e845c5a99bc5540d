"""DuckDB SQL that recomputes every registered query from the parquet tables.

The SQL is written on its own, from the rules and not from the Spark columns. Doubles are spelled
with an exponent: DuckDB reads 0.2 as a decimal.
"""

METRICS = """pointsFor pointsAgainst offensivePlays neutralPlays secondsPerPlay passRate
neutralPassRate rushRate epaPerPlay passEpaPerPlay rushEpaPerPlay successRate explosivePlayRate
drives pointsPerDrive redZoneTrips redZoneTdRate sacksAllowed pressureRateAllowed turnovers
fantasyPointsForQB fantasyPointsForRB fantasyPointsForWR fantasyPointsForTE
fantasyPointsAllowedQB fantasyPointsAllowedRB fantasyPointsAllowedWR fantasyPointsAllowedTE""".split()
SPLITS = """qbPassAllowed qbRushAllowed rbRushAllowed rbRecAllowed wrSlotAllowed wrWideAllowed
teInlineAllowed teSplitAllowed""".split()
FANTASY = [m for m in METRICS if m.startswith("fantasy")]
GOVERNED = [m for m in METRICS if m not in FANTASY and m != "pressureRateAllowed"] + ["pressureRateAllowed"]


def rnd(c: str, digits: int) -> str:
    """Half away from zero on the exact binary value; ``c`` is a column."""
    a, m = f"abs({c})", f"1e{digits}"
    hi = f"({a}*134217729e0-({a}*134217729e0-{a}))"
    up = f"(({hi}*{m}-floor({a}*{m}))-0.5e0)+({a}-{hi})*{m}>=0"
    return f"((floor({a}*{m})+CASE WHEN {up} THEN 1e0 ELSE 0e0 END)/{m})*sign({c})+0e0"


def text(c: str, digits: int) -> str:
    return f"CASE WHEN {c}<0 THEN '-' ELSE '' END || printf('%.{digits}f', {rnd(f'abs({c})', digits)})"


WEEKLY = """
weekly AS (
  SELECT n_name AS team, n_nationkey AS k, CAST(year(l_shipdate)+10 AS INTEGER) AS season,
    CAST(month(l_shipdate) AS INTEGER) AS week, count(*) AS n,
    sum(l_quantity) AS quantity, CAST(sum(p_size) AS DOUBLE) AS size,
    CAST(sum(CAST(round(l_discount*100) AS BIGINT)) AS DOUBLE) AS discount,
    CAST(sum(CAST(round(l_tax*100) AS BIGINT)) AS DOUBLE) AS tax,
    count(*) FILTER (l_returnflag='R') AS r, count(*) FILTER (l_returnflag='A') AS a,
    count(*) FILTER (l_returnflag='N') AS x, count(*) FILTER (l_linestatus='F') AS f,
    count(*) FILTER (o_orderpriority IN ('1-URGENT','2-HIGH')) AS u,
    count(*) FILTER (l_quantity>=45) AS z,
    count(*) FILTER (l_quantity>=45 AND l_returnflag='R') AS zr
  FROM lineitem JOIN part ON l_partkey=p_partkey JOIN orders ON l_orderkey=o_orderkey
    JOIN supplier ON l_suppkey=s_suppkey JOIN nation ON s_nationkey=n_nationkey
  GROUP BY ALL),
shares AS (
  SELECT team, k, season, week, n, z, zr, quantity/n AS q, size/n AS s, discount/(n*100) AS d,
    tax/(n*100) AS t, r/CAST(n AS DOUBLE) AS r, a/CAST(n AS DOUBLE) AS a, x/CAST(n AS DOUBLE) AS x,
    f/CAST(n AS DOUBLE) AS f, u/CAST(n AS DOUBLE) AS u
  FROM weekly),
unrounded AS (
  SELECT season, week, team,
    'NATION_' || CASE WHEN (k+week)%25=k THEN (k+week+1)%25 ELSE (k+week)%25 END AS opponent,
    (1e0+2.5e0*u)*(8+n%5) AS pointsFor, 10e0+20e0*a AS pointsAgainst,
    45e0+35e0*q/50e0 AS offensivePlays, 0.7e0*(45e0+35e0*q/50e0) AS neutralPlays,
    22e0+12e0*s/50e0 AS secondsPerPlay, 0.35e0+0.3e0*f AS passRate,
    0.35e0+0.35e0*least(1e0, 1.5e0*r) AS neutralPassRate, 1e0-(0.35e0+0.3e0*f) AS rushRate,
    -0.3e0+7e0*d AS epaPerPlay, (-0.3e0+7e0*d)+t-0.04e0 AS passEpaPerPlay,
    (-0.3e0+7e0*d)-t+0.04e0 AS rushEpaPerPlay, 0.3e0+0.3e0*f AS successRate,
    0.04e0+0.16e0*a AS explosivePlayRate, CAST(8+n%5 AS DOUBLE) AS drives,
    1e0+2.5e0*u AS pointsPerDrive, CAST(z AS DOUBLE) AS redZoneTrips,
    CASE WHEN z>0 THEN CAST(zr AS DOUBLE)/z END AS redZoneTdRate,
    CAST(n%7 AS DOUBLE) AS sacksAllowed, 0.12e0+0.33e0*x AS pressureRateAllowed,
    CAST(z%5 AS DOUBLE) AS turnovers,
    8e0+22e0*u AS fantasyPointsForQB, 8e0+27e0*f AS fantasyPointsForRB,
    12e0+33e0*r AS fantasyPointsForWR, 2e0+18e0*a AS fantasyPointsForTE,
    8e0+22e0*(1e0-u) AS fantasyPointsAllowedQB, 8e0+30e0*(1e0-f) AS fantasyPointsAllowedRB,
    12e0+38e0*(1e0-r) AS fantasyPointsAllowedWR, 3e0+21e0*(1e0-a) AS fantasyPointsAllowedTE,
    15e0*u AS qbPassAllowed, 5e0*f AS qbRushAllowed, 12e0*a AS rbRushAllowed,
    CAST(NULL AS DOUBLE) AS rbRecAllowed,
    CASE WHEN n%3<>0 THEN 22e0*r END AS wrSlotAllowed, CASE WHEN n%3<>0 THEN 22e0*a END AS wrWideAllowed,
    8e0*f AS teInlineAllowed, CASE WHEN n%4<>0 THEN 8e0*(1e0-f) END AS teSplitAllowed
  FROM shares)"""

CANDIDATE = WEEKLY + ",\ncand AS (SELECT season, week, team, opponent, " + ", ".join(METRICS + SPLITS) + " FROM unrounded)"

ROWS = CANDIDATE + """,
tw AS (SELECT * REPLACE (coalesce(redZoneTdRate, 0.5e0) AS redZoneTdRate) FROM cand)"""


def norm(c: str, low: str, high: str, inverse: bool = False) -> str:
    ratio = f"least(100e0, greatest(0e0, ({c}-({low}))/(({high})-({low}))*100e0))"
    return f"(100e0-{ratio})" if inverse else ratio


SPLIT_SUM = "+".join(f"coalesce({s},0e0)" for s in SPLITS)
SPLIT_N = "+".join(f"CASE WHEN {s} IS NULL THEN 0 ELSE 1 END" for s in SPLITS)

# score -> [(component, SQL, weight)]
COMPONENTS = {
    "teamPower": [
        ("epaPerPlay", norm("epaPerPlay", "-0.3e0", "0.4e0"), "0.2e0"),
        ("successRate", norm("successRate", "0.3e0", "0.6e0"), "0.18e0"),
        ("pointsPerDrive", norm("pointsPerDrive", "1e0", "3.5e0"), "0.18e0"),
        ("explosivePlayRate", norm("explosivePlayRate", "0.04e0", "0.2e0"), "0.1e0"),
        ("redZoneTdRate", norm("redZoneTdRate", "0.3e0", "0.8e0"), "0.1e0"),
        ("turnoverDiscipline", norm("turnovers", "0e0", "4e0", True), "0.1e0"),
        ("pressureAvoidance", norm("pressureRateAllowed", "0.12e0", "0.45e0", True), "0.07e0"),
        ("sackAvoidance", norm("sacksAllowed", "0e0", "6e0", True), "0.07e0"),
    ],
    "fantasyEnvironment": [
        ("offensivePlays", norm("offensivePlays", "45e0", "80e0"), "0.17e0"),
        ("pace", norm("secondsPerPlay", "22e0", "34e0", True), "0.12e0"),
        ("neutralPassRate", norm("neutralPassRate", "0.35e0", "0.7e0"), "0.1e0"),
        ("redZoneTrips", norm("redZoneTrips", "1e0", "7e0"), "0.12e0"),
        ("redZoneTdRate", norm("redZoneTdRate", "0.3e0", "0.8e0"), "0.1e0"),
        ("explosivePlayRate", norm("explosivePlayRate", "0.04e0", "0.2e0"), "0.1e0"),
        ("fantasyPointsForQB", norm("fantasyPointsForQB", "8e0", "30e0"), "0.08e0"),
        ("fantasyPointsForRB", norm("fantasyPointsForRB", "8e0", "35e0"), "0.08e0"),
        ("fantasyPointsForWR", norm("fantasyPointsForWR", "12e0", "45e0"), "0.08e0"),
        ("fantasyPointsForTE", norm("fantasyPointsForTE", "2e0", "20e0"), "0.05e0"),
    ],
    "matchupEnvironment": [
        ("fantasyPointsAllowedQB", norm("fantasyPointsAllowedQB", "8e0", "30e0"), "0.22e0"),
        ("fantasyPointsAllowedRB", norm("fantasyPointsAllowedRB", "8e0", "38e0"), "0.22e0"),
        ("fantasyPointsAllowedWR", norm("fantasyPointsAllowedWR", "12e0", "50e0"), "0.24e0"),
        ("fantasyPointsAllowedTE", norm("fantasyPointsAllowedTE", "3e0", "24e0"), "0.16e0"),
        ("splitAllowanceBoost", norm(f"(({SPLIT_SUM})/({SPLIT_N}))", "0e0", "22e0"), "0.16e0"),
    ],
    "stability": [
        ("successRate", norm("successRate", "0.3e0", "0.6e0"), "0.2e0"),
        ("pointsPerDrive", norm("pointsPerDrive", "1e0", "3.5e0"), "0.16e0"),
        ("epaPerPlay", norm("epaPerPlay", "-0.3e0", "0.4e0"), "0.16e0"),
        ("turnoverDiscipline", norm("turnovers", "0e0", "4e0", True), "0.16e0"),
        ("sackAvoidance", norm("sacksAllowed", "0e0", "6e0", True), "0.12e0"),
        ("pressureAvoidance", norm("pressureRateAllowed", "0.12e0", "0.45e0", True), "0.1e0"),
        ("redZoneSustainability",
         "least(100e0, greatest(0e0, 100e0-abs(redZoneTdRate-0.62e0)*200e0))", "0.1e0"),
    ],
}
SCORES = ["teamPowerScore", "fantasyEnvironmentScore", "matchupEnvironmentScore", "stabilityScore",
          "volatilityScore"]


def _score(part: str) -> str:
    terms = "+".join(f"{part}_{name}*{w}" for name, _, w in COMPONENTS[part])
    total = "+".join(["0e0"] + [w for _, _, w in COMPONENTS[part]])
    return f"least(100e0, greatest(0e0, (0e0+{terms})/({total}))) AS {part}Score"


SCORED = ROWS + ",\ncomps AS (SELECT *, " + ",\n  ".join(
    f"{sql} AS {part}_{name}" for part, items in COMPONENTS.items() for name, sql, _ in items
) + " FROM tw),\nscored0 AS (SELECT *, " + ", ".join(_score(p) for p in COMPONENTS) + f""" FROM comps),
scored AS (SELECT *, least(100e0, greatest(0e0, (100e0-stabilityScore)*0.7e0
    +{norm('explosivePlayRate', '0.04e0', '0.2e0')}*0.2e0
    +{norm('redZoneTdRate', '0.3e0', '0.8e0')}*0.1e0)) AS volatilityScore FROM scored0)"""

TAG_SQL = [
    ("elite_real_life_team", "teamPowerScore>=80"),
    ("elite_fantasy_environment", "fantasyEnvironmentScore>=80"),
    ("pass_funnel_offense", "neutralPassRate>=0.6e0 AND rushRate<=0.42e0"),
    ("run_heavy_low_ceiling", "rushRate>=0.52e0 AND fantasyEnvironmentScore<60"),
    ("red_zone_machine", "redZoneTrips>=5 AND redZoneTdRate>=0.65e0"),
    ("explosive_but_volatile", "explosivePlayRate>=0.14e0 AND volatilityScore>=65"),
    ("stable_environment", "stabilityScore>=72 AND volatilityScore<=38"),
    ("fraudulent_td_environment", "redZoneTdRate>=0.72e0 AND pointsPerDrive<2"),
    ("qb_friendly_matchup", "fantasyPointsAllowedQB>=22"),
    ("wr_slot_funnel_defense",
     "coalesce(wrSlotAllowed,0)>=16 AND coalesce(wrSlotAllowed,0)>coalesce(wrWideAllowed,0)+2"),
    ("te_dead_zone_defense",
     "fantasyPointsAllowedTE<=7 AND coalesce(teInlineAllowed,0)<=4 AND coalesce(teSplitAllowed,0)<=4"),
]
TAG_TEXT = {
    "elite_real_life_team": "Profiled as an elite real-life team with strong down-to-down quality.",
    "elite_fantasy_environment": "Creates one of the strongest fantasy ecosystems in the league.",
    "pass_funnel_offense": "Leans pass-heavy in neutral situations, supporting QB/WR volume.",
    "run_heavy_low_ceiling": "Rush tendency suppresses broad fantasy ceiling despite some floor.",
    "red_zone_machine": "Generates frequent and efficient red-zone opportunities.",
    "explosive_but_volatile": "High-play volatility with spike-week capability and fragility.",
    "stable_environment": "Environment is repeatable with low week-to-week chaos.",
    "fraudulent_td_environment": "Touchdown efficiency appears unsustainably high versus drive quality.",
    "qb_friendly_matchup": "Defense allows elevated QB scoring outcomes to opponents.",
    "wr_slot_funnel_defense": "Defense is notably vulnerable to slot receiver production.",
    "te_dead_zone_defense": "Defense suppresses tight-end production across usage alignments.",
}

TAGGED = SCORED + ",\ntagged AS (SELECT *, concat_ws('|', " + ", ".join(
    f"CASE WHEN {cond} THEN '{tag}' END" for tag, cond in TAG_SQL
) + ") AS tagText FROM scored)"

STATES = TAGGED + f""",
percents AS (SELECT *, successRate*100e0 AS pSuccess, redZoneTdRate*100e0 AS pRed FROM tagged),
states AS (SELECT *,
  CASE WHEN teamPowerScore>=75 AND fantasyEnvironmentScore>=75 THEN 'an elite real-life and fantasy environment'
    WHEN teamPowerScore>=70 THEN 'a strong real-life team environment'
    WHEN fantasyEnvironmentScore>=70 THEN 'a fantasy-friendly offense-first environment'
    WHEN volatilityScore>=65 THEN 'a volatile, high-variance environment'
    ELSE 'a balanced but middling environment' END AS environmentType,
  coalesce(nullif(concat_ws('|',
    CASE WHEN teamPowerScore>=70 THEN 'Strong team power driven by efficient and successful offense.' END,
    CASE WHEN fantasyEnvironmentScore>=70 THEN 'High fantasy-friendly environment with pace, volume, and scoring access.' END,
    CASE WHEN matchupEnvironmentScore>=65 THEN 'Defense allows productive fantasy matchups across key positions.' END,
    CASE WHEN stabilityScore>=70 THEN 'Scoring profile is repeatable with solid process indicators.' END), ''),
    'Balanced profile with no singular dominant strength this week.') AS strengthText,
  coalesce(nullif(concat_ws('|',
    CASE WHEN teamPowerScore<45 THEN 'Underlying team quality is weak and can collapse under pressure.' END,
    CASE WHEN fantasyEnvironmentScore<45 THEN 'Limited play volume or red-zone access reduces fantasy viability.' END,
    CASE WHEN volatilityScore>=65 THEN 'High volatility suggests unstable weekly outcomes.' END,
    CASE WHEN turnovers>=3 THEN 'Turnover risk can quickly break expected game environment.' END), ''),
    'No immediate structural red flags beyond normal weekly variance.') AS riskText,
  team || ' in Week ' || week || ' profiles as ' || environmentType || '. Core drivers were EPA/play '
    || {text('epaPerPlay', 2)} || ', success rate ' || {text('pSuccess', 1)} || '%, and '
    || CAST(redZoneTrips AS BIGINT) || ' red-zone trips at ' || {text('pRed', 1)} || '% TD conversion. '
    || CASE split_part(tagText, '|', 1) """ + " ".join(
    f"WHEN '{tag}' THEN '{msg}'" for tag, msg in TAG_TEXT.items()
) + """ ELSE 'No dominant tag signal was triggered this week.' END AS summary
  FROM percents)"""


def query(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select}"


RANKED = {
    "team_power": "teamPowerScore", "fantasy_environment": "fantasyEnvironmentScore",
    "matchup_environment": "matchupEnvironmentScore", "qb_matchups": "fantasyPointsAllowedQB",
    "rb_matchups": "fantasyPointsAllowedRB", "wr_matchups": "fantasyPointsAllowedWR",
    "te_matchups": "fantasyPointsAllowedTE",
}
LATEST = """,
latest AS (SELECT * FROM states WHERE (season, week) IN (SELECT season, max(week) FROM states GROUP BY season))"""
KEYS = "season, week, team, opponent"



MEANS = SCORES + """offensivePlays secondsPerPlay neutralPassRate rushRate redZoneTrips redZoneTdRate
explosivePlayRate fantasyPointsForQB fantasyPointsForRB fantasyPointsForWR fantasyPointsForTE
fantasyPointsAllowedQB fantasyPointsAllowedRB fantasyPointsAllowedWR fantasyPointsAllowedTE""".split()

SEASONS = STATES + """,
season_tags AS (
  SELECT season, team, string_agg(tag, '|' ORDER BY tag) AS tags FROM (
    SELECT DISTINCT season, team, unnest(string_split(tagText, '|')) AS tag FROM states) WHERE tag<>''
  GROUP BY ALL),
season_words AS (
  SELECT season, team, summary FROM (
    SELECT season, team, summary, row_number() OVER (PARTITION BY season, team ORDER BY count(*) DESC, summary) AS rn
    FROM states GROUP BY season, team, summary) WHERE rn=1),
season_sums AS (
  SELECT season, team, count(*) AS games, max(week) AS latestWeek, """ + ", ".join(
    f"sum({m} ORDER BY week)/count(*) AS {m}" for m in MEANS) + """ FROM states GROUP BY season, team),
seasons AS (
  SELECT s.*, coalesce(t.tags, '') AS tags, w.summary FROM season_sums s
  LEFT JOIN season_tags t USING (season, team) JOIN season_words w USING (season, team))"""

OFFENSE = {
    "QB": "fantasyPointsForQB*0.45e0+neutralPassRate*25e0+offensivePlays*0.25e0+(greatest(0e0,40e0-secondsPerPlay)*2.5e0)*0.3e0+teamPowerScore*0.15e0",
    "RB": "fantasyPointsForRB*0.45e0+redZoneTrips*2.2e0+redZoneTdRate*20e0+rushRate*20e0+fantasyEnvironmentScore*0.15e0",
    "WR": "fantasyPointsForWR*0.5e0+neutralPassRate*25e0+offensivePlays*0.2e0+(greatest(0e0,40e0-secondsPerPlay)*2.5e0)*0.2e0+explosivePlayRate*80e0",
    "TE": "fantasyPointsForTE*0.6e0+redZoneTdRate*20e0+neutralPassRate*10e0+stabilityScore*0.15e0",
}
SEASON_RANKED = {
    "team_power": ("teamPowerScore", "Season average team power"),
    "fantasy_environment": ("fantasyEnvironmentScore", "Season average fantasy environment"),
    "matchup_environment": ("matchupEnvironmentScore", "Season average matchup environment"),
}

WINDOW = {"pointsPerDrive": 3, "epaPerPlay": 4, "successRate": 4, "explosivePlayRate": 4,
          "pressureRateAllowed": 4, "secondsPerPlay": 3, "neutralPassRate": 4,
          "fantasyPointsForQB": 2, "fantasyPointsForRB": 2, "fantasyPointsForWR": 2,
          "fantasyPointsForTE": 2, "volatilityScore": 2}
DELTAS = [m for m in WINDOW if m != "volatilityScore"]


def movement(where: str = "true") -> str:
    """CTE ``moves`` over the scored rows of a slice."""
    def mean(m, place, order):
        v = [f"max({m}) FILTER (WHERE {place}={i})" for i in order]
        return (f"CASE any_value(k) WHEN 3 THEN (0e0+{v[0]}+{v[1]}+{v[2]})/3 "
                f"WHEN 2 THEN (0e0+{v[-2] if place == 'rd' else v[0]}+{v[-1] if place == 'rd' else v[1]})/2 END")

    raw = ", ".join(f"{mean(m, 'rn', (1, 2, 3))} AS early_{m}, {mean(m, 'rd', (3, 2, 1))} AS late_{m}" for m in WINDOW)
    rounded = ", ".join(f"{rnd(f'{s}_{m}', d)} AS {s}_{m}" for s in ("early", "late") for m, d in WINDOW.items())
    gaps = ", ".join(f"late_{m}-early_{m} AS gap_{m}" for m in WINDOW)
    deltas = ", ".join(f"{rnd(f'gap_{m}', 4)} AS delta_{m}" for m in DELTAS)
    votes = [("pointsPerDrive", "0.25e0"), ("epaPerPlay", "0.03e0"), ("successRate", "0.025e0"), ("explosivePlayRate", "0.015e0")]
    up = "+".join(f"CAST(delta_{m}>={s} AS INTEGER)" for m, s in votes)
    down = "+".join(f"CAST(delta_{m}<=-{s} AS INTEGER)" for m, s in votes)

    def direction(gap, step, hi, lo):
        return f"CASE WHEN {gap} IS NULL THEN 'insufficient_data' WHEN {gap}>={step} THEN '{hi}' WHEN {gap}<=-{step} THEN '{lo}' ELSE 'stable' END"

    return SCORED + f""",
placed AS (SELECT *, row_number() OVER (PARTITION BY season, team ORDER BY week) AS rn,
  row_number() OVER (PARTITION BY season, team ORDER BY week DESC) AS rd,
  count(*) OVER (PARTITION BY season, team) AS g FROM scored WHERE {where}),
sized AS (SELECT *, CASE WHEN g>=6 THEN 3 WHEN g>=4 THEN 2 ELSE 0 END AS k FROM placed),
m0 AS (SELECT season, team, count(*) AS games, any_value(k) AS k, string_agg(week, ',' ORDER BY week) AS weeksCovered,
  coalesce(string_agg(week, ',' ORDER BY week) FILTER (WHERE rn<=k), '') AS earlyWeeks,
  coalesce(string_agg(week, ',' ORDER BY week) FILTER (WHERE rd<=k), '') AS lateWeeks, {raw}
  FROM sized GROUP BY season, team),
m1 AS (SELECT season, team, games, k, weeksCovered, earlyWeeks, lateWeeks, {rounded} FROM m0),
m2 AS (SELECT *, {gaps} FROM m1),
m3 AS (SELECT *, {deltas} FROM m2),
m4 AS (SELECT *, CASE WHEN k=0 THEN 'insufficient_data'
    WHEN {down}>=2 OR ({down}>=1 AND {up}=0) THEN 'declining'
    WHEN {up}>=2 OR ({up}>=1 AND {down}=0) THEN 'improving' ELSE 'stable' END AS offenseDirection,
  {direction('delta_neutralPassRate', '0.03e0', 'more_pass_heavy', 'less_pass_heavy')} AS passEnvironmentDirection,
  {direction('delta_secondsPerPlay', '0.5e0', 'slower', 'faster')} AS paceDirection,
  {direction('delta_pressureRateAllowed', '0.03e0', 'worsening', 'improving')} AS pressureDirection,
  {direction('gap_volatilityScore', '5e0', 'rising', 'falling')} AS volatilityDirection FROM m3),
moves AS (SELECT *, CASE WHEN offenseDirection='insufficient_data' THEN 'insufficient_data'
    WHEN offenseDirection='declining' AND pressureDirection='worsening' THEN 'offensive_environment_declining_pressure_worsening'
    WHEN offenseDirection='declining' THEN 'offensive_environment_declining'
    WHEN offenseDirection='improving' AND pressureDirection<>'worsening' THEN 'offensive_environment_improving'
    WHEN volatilityDirection='rising' THEN 'environment_volatility_rising' ELSE 'environment_stable' END AS verdict,
  CASE WHEN k=0 THEN 'insufficient_data: fewer than 4 weeks available for deterministic temporal windows.' ELSE '' END AS warnings
  FROM m4)"""


NATIONS = [f"NATION_{i}" for i in range(25)]
LEAGUE = [t for t in NATIONS if t != "NATION_3"] + ["NATION_X"]
LEAGUE_LIST = ", ".join(f"'{t}'" for t in LEAGUE)
LEAGUE_CTE = ",\nleague AS (SELECT unnest([" + LEAGUE_LIST + "]) AS team)"
MARKET = "marketTier unknown: no governed market-prior input artifact exists."
TIERS = SEASONS + """,
tiers AS (SELECT *,
  CASE WHEN fantasyEnvironmentScore>=85 THEN 'elite' WHEN fantasyEnvironmentScore>=70 THEN 'strong'
    WHEN fantasyEnvironmentScore>=50 THEN 'average' ELSE 'weak' END AS offenseTier,
  CASE WHEN neutralPassRate>=0.57e0 THEN 'pass_heavy' WHEN neutralPassRate<=0.43e0 THEN 'run_heavy' ELSE 'balanced' END AS passEnvironmentTier,
  CASE WHEN secondsPerPlay<=27 THEN 'fast' WHEN secondsPerPlay>=29 THEN 'slow' ELSE 'neutral' END AS paceTier,
  CASE WHEN volatilityScore<=45 THEN 'stable' WHEN volatilityScore>=60 THEN 'volatile' ELSE 'unknown' END AS volatilityTier
  FROM seasons)"""
BY_SEASON = "string_agg(season || ':' || w, ',' ORDER BY season)"

DENSE = ROWS + LEAGUE_CTE + """,
cells AS (SELECT team, week, count(*) AS n FROM tw GROUP BY ALL),
teams AS (SELECT DISTINCT team FROM cells),
problems AS (
  SELECT 'duplicate' AS kind, team, week, n-1 AS occurrences, 'duplicate row for team "' || team || '" week ' || week AS message FROM cells WHERE n>1
  UNION ALL SELECT 'missing_team', team, NULL, 1, 'missing team "' || team || '" (no rows)' FROM league WHERE team NOT IN (SELECT team FROM teams)
  UNION ALL SELECT 'missing_week', l.team, g.week, 1, 'team "' || l.team || '" is missing week ' || g.week
    FROM league l JOIN teams USING (team), (SELECT CAST(unnest(range(1, 12)) AS INTEGER) AS week) g
    WHERE (l.team, g.week) NOT IN (SELECT (team, week) FROM cells)
  UNION ALL SELECT 'unexpected_team', team, NULL, 1, 'unexpected team "' || team || '" not in expected set' FROM teams WHERE team NOT IN (SELECT team FROM league)
  UNION ALL SELECT 'unexpected_week', team, week, 1, 'team "' || team || '" has unexpected week ' || week || ' (outside expected weeks)' FROM cells WHERE week NOT BETWEEN 1 AND 11)"""
BYE = ROWS + LEAGUE_CTE + """,
cells AS (SELECT team, week, count(*) AS n FROM tw GROUP BY ALL),
teams AS (SELECT team, count(*) AS n FROM tw GROUP BY ALL),
problems AS (
  SELECT 'duplicate' AS kind, team, week, n-1 AS occurrences, 'duplicate row for team "' || team || '" week ' || week AS message FROM cells WHERE n>1
  UNION ALL SELECT 'wrong_season', team, week, count(*), 'team "' || team || '" week ' || week || ' has season ' || season || ', expected season 2011'
    FROM tw WHERE season<>2011 GROUP BY team, week, season
  UNION ALL SELECT 'missing_team', team, NULL, 1, 'missing team "' || team || '" (no rows)' FROM league WHERE team NOT IN (SELECT team FROM teams)
  UNION ALL SELECT 'game_count', team, NULL, 1, 'team "' || team || '" has ' || n || ' game row(s), expected exactly 12 (bye-aware: an absent week is treated as a bye, not a coverage gap, but the total game-row count must still match exactly)'
    FROM teams WHERE n<>12 AND team IN (SELECT team FROM league)
  UNION ALL SELECT 'unexpected_team', team, NULL, 1, 'unexpected team "' || team || '" not in expected set' FROM teams WHERE team NOT IN (SELECT team FROM league)
  UNION ALL SELECT 'out_of_window', team, week, 1, 'team "' || team || '" has out-of-window week ' || week || ' (expected window weeks: 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11)' FROM cells WHERE week NOT BETWEEN 1 AND 11
  UNION ALL SELECT 'row_count', NULL, NULL, 1, 'total row count (' || count(*) || ') must equal 300 (expectedTeams.length * expectedGamesPerTeam)' FROM tw HAVING count(*)<>300)"""
PROBLEM_COLUMNS = "SELECT kind, team, CAST(week AS INTEGER) AS week, CAST(occurrences AS BIGINT) AS occurrences, message FROM problems"
COVERAGE_SUMMARY = """SELECT e.errors=0 AS valid, e.errors AS errorCount, t.teams AS teamCount, t.n AS totalRowCount,
  e.errors=0 AND t.teams=25 AS isFullLeague, e.kinds AS errorsByKind
FROM (SELECT CAST(coalesce(sum(o), 0) AS BIGINT) AS errors, coalesce(string_agg(kind || ':' || o, ',' ORDER BY kind), '') AS kinds
      FROM (SELECT kind, CAST(sum(occurrences) AS BIGINT) AS o FROM problems GROUP BY kind)) e,
     (SELECT count(DISTINCT team) AS teams, count(*) AS n FROM tw) t"""


def profile(cte: str, table: str, fields, deferred) -> str:
    parts = []
    for f in fields:
        status = "'deferred_insufficient_data'" if f in deferred else (
            f"CASE WHEN count(*)>0 AND count({f})=count(*) THEN 'available' ELSE 'partial_nulls' END")
        parts.append(f"SELECT '{f}' AS field, count({f}) AS finiteCount, count(*)-count({f}) AS nullCount, {status} AS status FROM {table}")
    return query(cte, " UNION ALL ".join(parts))


GOV = CANDIDATE + """,
gov AS (SELECT season, week, team, opponent, """ + ", ".join(m for m in GOVERNED if m != "pressureRateAllowed") + """,
  CAST(NULL AS DOUBLE) AS pressureRateAllowed FROM cand)"""

COUNTS = "pointsFor offensivePlays neutralPlays drives redZoneTrips sacksAllowed turnovers".split()
RATES = {"neutralPassRate": ("neutralPlays", 4), "pointsPerDrive": ("drives", 2), "redZoneTdRate": ("redZoneTrips", 4),
         "secondsPerPlay": ("offensivePlays", 2), "epaPerPlay": ("offensivePlays", 4)}
REPORT = GOV + ",\nsums AS (SELECT season, team, count(*) AS gamesPlayed, " + ", ".join(
    [f"sum({c} ORDER BY week) AS {c}Sum, sum({c} ORDER BY week)/count(*) AS {c}Mean" for c in COUNTS]
    + [f"sum({r}*{w} ORDER BY week)/nullif(sum({w} ORDER BY week), 0) AS {r}Raw" for r, (w, _) in RATES.items()]
) + " FROM gov GROUP BY season, team),\nreport AS (SELECT season, team, gamesPlayed, " + ", ".join(
    [f"CAST({rnd(f'{c}Sum', 0)} AS BIGINT) AS {c}Total, {rnd(f'{c}Mean', 1)} AS {c}PerGame" for c in COUNTS]
    + [f"{rnd(f'{r}Raw', d)} AS {r}" for r, (_, d) in RATES.items()]
) + """, CASE WHEN redZoneTripsSum=0 THEN 'W_ZERO_REDZONE_OPPORTUNITIES' ELSE '' END AS warnings FROM sums)"""

FILE = "(season || '-' || week || '-' || team || '.json')"


def build() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["bridge_team_week"] = query(ROWS, f"SELECT {KEYS}, {', '.join(METRICS + SPLITS)} FROM tw")
    sql["bridge_candidate"] = query(CANDIDATE, f"SELECT {KEYS}, {', '.join(METRICS)} FROM cand")
    sql["scores_all"] = query(SCORED, "SELECT season, week, team, "
                              + ", ".join(f"{rnd(s, 6)} AS {s}" for s in SCORES) + " FROM scored")
    for part, items in COMPONENTS.items():
        cols = ", ".join(f"{rnd(f'{part}_{n}', 6)} AS {n}" for n, _, _ in items)
        sql["components_" + part] = query(SCORED, f"SELECT season, week, team, {cols} FROM comps")
    sql["tags"] = query(TAGGED, "SELECT season, week, team, tagText AS tags FROM tagged")
    sql["explanation_lists"] = query(
        STATES, "SELECT season, week, team, strengthText AS strengths, riskText AS risks FROM states")
    sql["explanation_summary"] = query(STATES, "SELECT season, week, team, environmentType, summary FROM states")
    for name, col in RANKED.items():
        sql[f"rank_{name}"] = query(STATES, f"""SELECT row_number() OVER (ORDER BY {col} DESC, season DESC,
    week DESC, team) AS rank, season, week, team, {rnd(col, 2)} AS score, tagText AS tags, summary FROM states""")
        sql[f"latest_{name}"] = query(STATES + LATEST, f"""SELECT row_number() OVER (ORDER BY {col} DESC,
    season DESC, team) AS rank, season, week, team, {rnd(col, 2)} AS score, tagText AS tags, summary FROM latest""")
    sql["rank_weekly_all"] = query(STATES, " UNION ALL ".join(
        f"SELECT '{name}' AS ranking, row_number() OVER (ORDER BY {col} DESC, season DESC, week DESC, team)"
        f" AS rank, season, week, team, {rnd(col, 2)} AS score FROM states" for name, col in RANKED.items()))
    sql["rank_latest_all"] = query(STATES + LATEST, " UNION ALL ".join(
        f"SELECT '{name}' AS ranking, row_number() OVER (ORDER BY {col} DESC, season DESC, team)"
        f" AS rank, season, week, team, {rnd(col, 2)} AS score FROM latest" for name, col in RANKED.items()))
    sql["rank_volatility_ascending"] = query(SCORED, f"""SELECT row_number() OVER (ORDER BY volatilityScore,
    season DESC, week DESC, team) AS rank, season, week, team, {rnd('volatilityScore', 2)} AS score FROM scored""")
    parts = [f"{part}_{n}" for part, items in COMPONENTS.items() for n, _, _ in items]
    sql["state_records"] = query(STATES, f"""SELECT {KEYS}, {', '.join(METRICS + SPLITS)},
    {', '.join(f'{rnd(s, 6)} AS {s}' for s in SCORES + parts)}, tagText AS tags, strengthText AS strengths, riskText AS risks, summary FROM states""")
    sql["latest_week_by_season"] = query(ROWS, "SELECT season, max(week) AS latestWeek FROM tw GROUP BY season")
    sql["slice_rows"] = query(ROWS, f"SELECT {KEYS}, pointsFor FROM tw WHERE season=2011 AND week<=5")
    _seasons(sql)
    _movement(sql)
    _coverage(sql)
    _documents(sql)
    _contexts(sql)
    _labels(sql)
    from checks import oracle_lanes, oracle_stored

    return sql | oracle_lanes.build() | oracle_stored.build()


def _seasons(sql: dict[str, str]) -> None:
    means = ", ".join(f"{rnd(m, 6)} AS {m}" for m in MEANS)
    sql["season_agg"] = query(SEASONS, f"SELECT season, team, games, latestWeek, tags, summary, {means} FROM seasons")
    sql["season_means"] = query(SEASONS, f"SELECT season, team, games, latestWeek, tags, {means} FROM seasons")
    order = "season DESC, latestWeek DESC, team"
    for name, (col, label) in SEASON_RANKED.items():
        sql[f"season_rank_{name}"] = query(SEASONS, f"""SELECT row_number() OVER (ORDER BY {col} DESC, {order}) AS rank,
    season, team, latestWeek, games, {rnd(col, 2)} AS score, tags, '{label}: ' || summary AS summary FROM seasons""")
    families = {
        "offense": (lambda p: OFFENSE[p], "{} offense environment from production + pace/usage context."),
        "matchup": (lambda p: f"fantasyPointsAllowed{p}", "{} matchup environment based on fantasy points allowed."),
    }
    heads = {}
    for family, (score, words) in families.items():
        for p in ("QB", "RB", "WR", "TE"):
            ctes = SEASONS + f",\nvalued AS (SELECT *, {score(p)} AS v FROM seasons)"
            ranked = f"row_number() OVER (ORDER BY v DESC, {order}) AS rank"
            sql[f"{family}_{p.lower()}"] = query(ctes, f"""SELECT '{p}' AS position, {ranked}, season, team, latestWeek,
    games, {rnd('v', 2)} AS score, tags, '{words.format(p)}' AS summary FROM valued""")
            heads.setdefault(family, []).append(
                f"SELECT * FROM (SELECT '{p}' AS position, row_number() OVER (ORDER BY v DESC, {order}) AS rank, season, team,"
                f" latestWeek, games, {rnd('v', 2)} AS score FROM (SELECT *, {score(p)} AS v FROM seasons)) WHERE rank<=10")
        sql[f"snapshot_{family}"] = query(SEASONS, " UNION ALL ".join(heads[family]))
    lists = {
        "most_stable": ("stabilityScore", "DESC", "season DESC, team", "Season average stability"),
        "most_volatile": ("volatilityScore", "DESC", "season DESC, team", "Season average volatility"),
        "least_volatile": ("volatilityScore", "ASC", "season DESC, team", "Season average volatility"),
    }
    short = {"most_stable": "stable", "most_volatile": "volatile", "least_volatile": "least_volatile"}
    for name, (col, way, rest, label) in lists.items():
        sql[f"snapshot_{short[name]}"] = query(SEASONS, f"""SELECT row_number() OVER (ORDER BY {col} {way}, {rest}) AS rank,
    season, team, latestWeek, {rnd(col, 2)} AS score, tags, '{label}: ' || summary AS summary
    FROM seasons ORDER BY {col} {way}, {rest} LIMIT 10""")
    for name, (col, label) in SEASON_RANKED.items():
        lists[f"top_{name}"] = (col, "DESC", order, label)
    sql["snapshot_lists"] = query(SEASONS, " UNION ALL ".join(
        f"SELECT * FROM (SELECT '{name}' AS list, row_number() OVER (ORDER BY {col} {way}, {rest}) AS rank, season, team,"
        f" latestWeek, {rnd(col, 2)} AS score FROM seasons) WHERE rank<=10" for name, (col, way, rest, _) in lists.items()))
    sql["snapshot_scope"] = query(ROWS, f"""SELECT CAST(NULL AS INTEGER) AS selectedSeason, CAST(NULL AS INTEGER) AS selectedWeek,
    string_agg(season, ',' ORDER BY season DESC) AS seasonsIncluded, {BY_SEASON} AS latestWeekBySeason
    FROM (SELECT season, max(week) AS w FROM tw GROUP BY season)""")
    sql["run_metadata"] = query(ROWS, f"""SELECT a.n AS sourceRowCount, a.n AS mappedRowCount, b.n AS filteredRowCount,
    CAST(2011 AS INTEGER) AS selectedSeason, CAST(5 AS INTEGER) AS selectedWeek, b.seasonsIncluded, b.latestWeekBySeason
    FROM (SELECT count(*) AS n FROM tw) a, (SELECT CAST(sum(n) AS BIGINT) AS n, string_agg(season, ',' ORDER BY season DESC) AS seasonsIncluded,
      {BY_SEASON} AS latestWeekBySeason FROM (SELECT season, count(*) AS n, max(week) AS w FROM tw WHERE season=2011 AND week<=5 GROUP BY season)) b""")


def _movement(sql: dict[str, str]) -> None:
    names = [f"{s}_{m}" for s in ("early", "late") for m in WINDOW] + [f"delta_{m}" for m in DELTAS]
    columns = (f"season, team, games, weeksCovered, earlyWeeks, lateWeeks, {', '.join(names)}, offenseDirection, "
               "passEnvironmentDirection, paceDirection, pressureDirection, volatilityDirection, verdict, warnings")
    sql["movement_v0"] = query(movement(), f"SELECT {columns} FROM moves")
    sql["movement_at_week_5"] = query(movement("week<=5"), f"SELECT {columns} FROM moves")
    sql["movement_at_week_3"] = query(movement("week<=3"), f"SELECT {columns} FROM moves")
    kept = [n for n in names if "fantasy" not in n]
    sql["movement_v1"] = query(movement(), f"SELECT season, team, weeksCovered, earlyWeeks, lateWeeks, offenseDirection, passEnvironmentDirection, "
                               f"paceDirection, pressureDirection, volatilityDirection, warnings, {', '.join(kept)}, verdict FROM moves")
    sql["movement_metadata"] = query(ROWS, """SELECT CASE WHEN count(DISTINCT team)=25 THEN 'governed_real_data' ELSE 'partial_real_data' END AS provenanceStatus,
    CASE WHEN count(DISTINCT team)=25 THEN 'governed' ELSE 'ungoverned' END AS governanceStatus, 'explicit_marker' AS governanceSource,
    CAST(count(DISTINCT team) AS INTEGER) AS teamCount, string_agg(DISTINCT team, '|' ORDER BY team) AS teams,
    string_agg(DISTINCT season, ',' ORDER BY season) AS seasons, string_agg(DISTINCT week, ',' ORDER BY week) AS weeks,
    max(week) AS latestWeek, count(DISTINCT team)=25 AS isFullLeague FROM tw""")
    sql["profiles"] = query(TIERS, f"""SELECT season, team, 'unknown' AS marketTier, offenseTier, passEnvironmentTier, paceTier, volatilityTier,
    '{MARKET}' || CASE WHEN volatilityTier='unknown' THEN '|volatilityTier unknown: volatility score unavailable or in neutral band (45-60).' ELSE '' END AS warnings,
    {rnd('fantasyEnvironmentScore', 2)} AS fantasyEnvironmentScore, {rnd('neutralPassRate', 4)} AS neutralPassRate,
    {rnd('secondsPerPlay', 3)} AS secondsPerPlay, {rnd('volatilityScore', 2)} AS volatilityScore FROM tiers""")
    sql["profile_metadata"] = query(SEASONS + LEAGUE_CTE, """SELECT 'fixture_scaffold' AS provenanceStatus,
    'Input path indicates sample/fixture scaffold data; artifact is not governed production truth.|Coverage is incomplete (<32 NFL teams); artifact cannot be governed_real_data.' AS provenanceNotes,
    'data/sample/season.json' AS path, 'sample' AS type, CAST(count(DISTINCT team) AS INTEGER) AS teamCount, false AS isFullLeague,
    string_agg(DISTINCT team, '|' ORDER BY team) AS presentTeams,
    (SELECT string_agg(t, '|' ORDER BY i) FROM (SELECT unnest([""" + LEAGUE_LIST + """]) AS t, unnest(range(25)) AS i) WHERE t NOT IN (SELECT team FROM seasons)) AS missingTeams,
    coalesce((SELECT string_agg(DISTINCT team, '|' ORDER BY team) FROM seasons WHERE team NOT IN (SELECT team FROM league)), '') AS unexpectedTeams,
    string_agg(DISTINCT season, ',' ORDER BY season) AS seasons, string_agg(DISTINCT latestWeek, ',' ORDER BY latestWeek) AS weeks,
    max(latestWeek) AS latestWeek, min(games) AS gamesPerTeamMin, max(games) AS gamesPerTeamMax FROM seasons""")
    sql["features"] = query(movement(), """SELECT season, team, late_pointsPerDrive AS points_per_drive, late_epaPerPlay AS epa_per_play,
    late_successRate AS success_rate, late_explosivePlayRate AS explosive_play_rate, late_pressureRateAllowed AS pressure_rate_allowed,
    late_secondsPerPlay AS seconds_per_play, late_neutralPassRate AS neutral_pass_rate, late_volatilityScore AS volatility_score,
    offenseDirection AS offense_direction, passEnvironmentDirection AS pass_environment_direction, paceDirection AS pace_direction,
    pressureDirection AS pressure_direction, volatilityDirection AS volatility_direction, 'unknown' AS offense_tier,
    'unknown' AS pass_environment_tier, 'unknown' AS pace_tier, 'unknown' AS volatility_tier,
    'partial' AS featureCoverageStatus, 0e0 AS confidence FROM moves""")
    sql["feature_guards"] = query(ROWS + LEAGUE_CTE, """SELECT 0 AS rule, 'movement contains season(s) ' || string_agg(DISTINCT season, ', ' ORDER BY season) || ' not matching feature season 2011' AS message
    FROM tw WHERE season<>2011 HAVING count(*)>0
    UNION ALL SELECT 1, 'duplicate team "' || team || '" in movement input' FROM tw GROUP BY team HAVING count(DISTINCT season)>1
    UNION ALL SELECT DISTINCT 2, 'unexpected team "' || team || '" not in the expected team set for season 2011' FROM tw WHERE team NOT IN (SELECT team FROM league)""")
    sql["feature_table"] = query(ROWS, """SELECT 'team_environment_forecast_features_v1' AS artifact, CAST(2011 AS INTEGER) AS featureSeason,
    CAST(2012 AS INTEGER) AS targetSeason, 'fixture' AS governanceStatus, CAST(count(DISTINCT team) AS INTEGER) AS teamCount,
    CAST(25 AS INTEGER) AS expectedTeamCount, count(DISTINCT team)=25 AS isFullLeague, '2011' AS seasons,
    string_agg(DISTINCT week, ',' ORDER BY week) AS weeks FROM tw WHERE season=2011""")
    sql["feature_problems"] = query(movement(), """SELECT 'header' AS part, 'coverage.teamCount (' || (SELECT count(*) FROM moves WHERE season=2011)
      || ') must equal the number of team rows (' || (SELECT count(*) FROM moves) || ')' AS message, 1 AS n
    WHERE (SELECT count(*) FROM moves WHERE season=2011)<>(SELECT count(*) FROM moves)
    UNION ALL SELECT 'rows', 'teams[' || team || '].features.offense_tier must be one of elite, strong, average, weak, unknown', count(*)
    FROM moves WHERE late_pointsPerDrive>2 GROUP BY team""")


def _coverage(sql: dict[str, str]) -> None:
    sql["quality_violations"] = query(CANDIDATE, """SELECT season, week, team, 'Missing required field: redZoneTdRate' AS message FROM cand WHERE redZoneTdRate IS NULL
    UNION ALL SELECT season, week, team, 'passRate + rushRate must be near 1.0. Received ' || (passRate+rushRate) FROM cand WHERE abs(passRate+rushRate-1)>0.08e0""")
    sql["coverage_dense"] = query(DENSE, PROBLEM_COLUMNS)
    sql["coverage_dense_summary"] = query(DENSE, COVERAGE_SUMMARY)
    sql["coverage_bye"] = query(BYE, PROBLEM_COLUMNS)
    sql["coverage_bye_summary"] = query(BYE, COVERAGE_SUMMARY)
    sql["coverage_grid"] = query(ROWS, """SELECT t.team, CAST(w.week AS INTEGER) AS week, coalesce(c.games, 0) AS games
    FROM (SELECT 'NATION_' || unnest(range(25)) AS team) t, (SELECT unnest(range(1, 13)) AS week) w
    LEFT JOIN (SELECT team, week, count(*) AS games FROM tw GROUP BY ALL) c ON c.team=t.team AND c.week=w.week""")
    sql["null_profile"] = profile(CANDIDATE, "cand", METRICS, ("pressureRateAllowed", "turnovers"))
    sql["null_profile_governed"] = profile(GOV, "gov", GOVERNED, ("pressureRateAllowed",))
    sql["column_evidence"] = query(GOV, " UNION ALL ".join(
        f"SELECT '{f}' AS column, " + ("'deferred_insufficient_data'" if f == "pressureRateAllowed" else
        f"CASE WHEN count({f})=count(*) THEN 'available' ELSE 'partial_nulls' END") +
        f" AS status, count({f}) AS nonNullCount, count(*)-count({f}) AS nullCount, {'false' if f == 'pressureRateAllowed' else 'true'} AS forecastInput FROM gov"
        for f in GOVERNED))
    sql["team_evidence"] = query(GOV + LEAGUE_CTE, """SELECT CAST(count(DISTINCT team) AS INTEGER) AS teamCount, count(*) AS rowCount,
    string_agg(DISTINCT team, '|' ORDER BY team) AS presentTeams,
    (SELECT string_agg(t, '|' ORDER BY i) FROM (SELECT unnest([""" + LEAGUE_LIST + """]) AS t, unnest(range(25)) AS i) WHERE t NOT IN (SELECT team FROM gov)) AS missingTeams,
    false AS coversLeague FROM gov""")
    columns = (["season", "team", "gamesPlayed"] + [f"{c}Total" for c in COUNTS] + [f"{c}PerGame" for c in COUNTS]
               + list(RATES) + ["warnings"])
    sql["season_report_weighted"] = query(REPORT, f"SELECT {', '.join(columns)} FROM report")
    sql["season_report_problems"] = query(REPORT + LEAGUE_CTE + """,
per_team AS (SELECT team, count(*) AS n FROM gov GROUP BY team),
spoiled AS (SELECT * REPLACE (CASE WHEN drivesTotal%7=0 THEN NULL ELSE redZoneTdRate END AS redZoneTdRate), redZoneTdRate AS rightRate FROM report)""",
    """SELECT 'E_PROVENANCE_NOT_GOVERNED' AS code, CAST(NULL AS VARCHAR) AS team, 'sample, fixture, explicit_marker' AS detail
    UNION ALL SELECT 'E_GOVERNED_INPUT_CHECKSUM_MISMATCH', NULL, 'checksum absent or different'
    UNION ALL SELECT 'E_TEMPORAL_METADATA_MISSING', NULL, 'dataThrough, sourceSnapshotAt, generatedAt'
    UNION ALL SELECT 'E_COVERAGE_TEAM_MISSING', team, 'no rows' FROM league WHERE team NOT IN (SELECT team FROM per_team)
    UNION ALL SELECT 'E_COVERAGE_TEAM_UNEXPECTED', team, 'not in the league' FROM per_team WHERE team NOT IN (SELECT team FROM league)
    UNION ALL SELECT 'E_COVERAGE_ROW_COUNT_MISMATCH', team, n || ' rows, expected 84' FROM per_team WHERE n<>84
    UNION ALL SELECT 'E_COVERAGE_ROW_COUNT_MISMATCH', NULL, count(*) || ' rows in total, expected 2100' FROM gov HAVING count(*)<>2100
    UNION ALL SELECT 'E_REDZONE_NULL_INVARIANT_VIOLATED', team, 'redZoneTripsTotal ' || redZoneTripsTotal FROM spoiled WHERE (redZoneTdRate IS NULL)<>(redZoneTripsTotal=0)
    UNION ALL SELECT 'E_UNWEIGHTED_AGGREGATION_USED', team, 'redZoneTdRate' FROM spoiled WHERE redZoneTdRate IS DISTINCT FROM rightRate""")


def _documents(sql: dict[str, str]) -> None:
    rows = f"SELECT {KEYS}, {', '.join(METRICS + SPLITS)} FROM "
    sql["read_array_documents"] = query(CANDIDATE, rows + "cand")
    sql["read_envelope_documents"] = query(ROWS, rows + "tw")
    sql["document_problems"] = query(CANDIDATE, f"""SELECT {FILE} AS sourceFile, -1 AS rowIndex,
      CASE week WHEN 1 THEN 'Invalid JSON in ' || {FILE} ELSE 'Invalid artifact literal: expected team_week_raw_v0, received other' END AS message
    FROM cand WHERE week IN (1, 2)
    UNION ALL SELECT {FILE}, 0, 'Invalid raw row in ' || {FILE} || ' at index 0: expected object.' FROM cand WHERE week=3
    UNION ALL SELECT {FILE}, 0, 'Invalid team_week_raw_v0 row at index 0: redZoneTdRate must be a finite number.' FROM cand
      WHERE redZoneTdRate IS NULL AND week NOT IN (1, 3)""")
    sql["candidate_documents"] = query(CANDIDATE, f"SELECT {KEYS}, {', '.join(METRICS)} FROM cand")
    sql["governed_documents"] = query(GOV, f"SELECT {KEYS}, {', '.join(GOVERNED)} FROM gov")
    refuse = "Refusing to consume team_week_raw_v0 candidate artifact: "
    sql["candidate_gate"] = query(CANDIDATE, f"""SELECT {FILE} AS sourceFile, CASE week
      WHEN 1 THEN '{refuse}provenanceStatus "governed_real_data" is not an accepted candidate-input status. Accepted: fixture_scaffold, sample, partial_real_data, unknown_provenance.'
      WHEN 2 THEN '{refuse}governanceStatus "governed" is not an accepted candidate-input status.'
      ELSE 'Invalid team_week_raw_v0 candidate artifact: metadata.governance.governanceSource must be a non-empty string.' END AS message
    FROM cand WHERE week<=3""")
    sql["candidate_row_problems"] = query(CANDIDATE, f"""SELECT {FILE} AS sourceFile,
      'Invalid team_week_raw_v0 candidate row at index 0: missing required field redZoneTdRate.' AS message FROM cand WHERE redZoneTdRate IS NULL""")
    refuse = "Refusing governed team_week_raw_v0 source: "
    sql["governed_gate"] = query(CANDIDATE, f"""SELECT {FILE} AS sourceFile, CASE week
      WHEN 1 THEN '{refuse}provenanceStatus must be governed_real_data, received sample.'
      WHEN 2 THEN '{refuse}metadata.governance.governanceStatus must be governed.'
      WHEN 3 THEN '{refuse}metadata.governance.governanceSource must be explicit_marker.'
      ELSE 'Invalid governed team_week_raw_v0 artifact: metadata.deferredFields must include pressureRateAllowed.' END AS message
    FROM cand WHERE week<=4""")
    at = "Invalid governed team_week_raw_v0 row at index 0: "
    refused = [f"('{f}', '{at}fantasy split field {f} must be null when present and is stripped from the output.')"
               for f in METRICS if f.startswith("fantasy")]
    refused.append(f"('pressureRateAllowed', '{at}pressureRateAllowed must be null/deferred, never inferred or zero-filled.')")
    sql["governed_row_problems"] = query(CANDIDATE, f"""SELECT {FILE} AS sourceFile, message
      FROM cand, (VALUES {', '.join(refused)}) AS v(field, message)""")


def _table_level(rows: str, missing: str, lines: str) -> str:
    return f"""
    UNION ALL SELECT team, 'duplicate team code ''' || team || ''' (' || count(*) || ' rows).' FROM {rows} GROUP BY team HAVING count(*)>1
    UNION ALL SELECT team, '{missing}: ' || team FROM league WHERE team NOT IN (SELECT team FROM {rows})
    UNION ALL SELECT NULL, 'Expected 25 {lines}, found ' || count(*) || '.' FROM {rows} HAVING count(*)<>25"""


def _rules(rows: str, rules, missing: str = "Missing team", lines: str = "teams") -> str:
    """Row rules (condition, message tail as SQL) plus the rules common to the context tables."""
    at = "'Row ' || (season-2000) || ': '"
    common = [("season<>2011", "'season must equal 2011.'"),
              ("team NOT IN (SELECT team FROM league)", "'unknown team code ''' || team || '''.'")]
    return " UNION ALL ".join(
        f"SELECT team, {at} || {message} AS message FROM {rows} WHERE {cond}" for cond, message in common + rules
    ) + _table_level(rows, missing, lines)


def _contexts(sql: dict[str, str]) -> None:
    sql["context_offense_problems"] = query(TIERS + LEAGUE_CTE, _rules("tiers", [
        ("paceTier='slow'", "'invalid pace_label ''slow''.'"),
        ("passEnvironmentTier='run_heavy'", "'invalid pass_rate_label ''low''.'"),
        ("volatilityTier<>'unknown'", "'invalid qb_stability_label ''' || volatilityTier || '''.'"),
        ("offenseTier NOT IN ('strong', 'weak')", "'invalid scoring_environment_label ''' || offenseTier || '''.'"),
        ("volatilityTier<>'stable'", "'invalid source_status ''guessed''.'"),
        ("season=2012", "'head_coach must be a string.'"),
        ("paceTier='neutral'", "'context_tags must contain non-empty strings.'"),
    ]))
    lists = SEASONS + LEAGUE_CTE + """,
ctx AS (SELECT *, list_filter(string_split(tags, '|'), lambda t: t<>'') AS l FROM seasons),
parts AS (SELECT *, list_filter(l, lambda t: t IN ('stable_environment', 'red_zone_machine')) AS good,
  list_filter(l, lambda t: t NOT IN ('stable_environment', 'red_zone_machine')) AS other FROM ctx)"""
    sql["context_team_problems"] = query(lists, _rules("parts", [
        ("games<12", "'offensive_coordinator must be a non-empty string.'"),
        ("len(l)>0", "'offensive_identity_tags must not contain duplicates.'"),
        ("latestWeek<12", "'positive_team_context_tags includes known risk tag(s).'"),
        ("list_contains(l, 'qb_friendly_matchup')", "'rookie_landing_context_tags must include all positive/risk tags.'"),
    ], "Missing required team", "team rows"))
    sql["context_landing_problems"] = query(lists, _rules("parts", [
        ("list_contains(l, 'wr_slot_funnel_defense')", "'context_tags must match positive_context_tags + risk_context_tags.'"),
        ("games<12", "'invalid source_status ''draft''.'"),
    ]))


def _labels(sql: dict[str, str]) -> None:
    sql["source_path_labels"] = """WITH p AS (SELECT page_id, CASE page_id%3 WHEN 0 THEN 'C:/data/sample/' WHEN 1 THEN 'fixtures/' ELSE '/srv/fixtures/' END || replace(url, '\\', '/') AS p FROM pages),
cut AS (SELECT page_id, CASE WHEN contains(p, '/data/sample/') THEN substr(p, strpos(p, '/data/sample/')+1)
  WHEN contains(p, '/fixtures/') THEN substr(p, strpos(p, '/fixtures/')+1) ELSE p END AS path FROM p)
SELECT page_id, path, CASE WHEN path LIKE 'data/sample/%' THEN 'sample' WHEN path LIKE 'fixtures/%' OR contains(path, '/fixtures/') THEN 'fixture' ELSE 'unknown' END AS type FROM cut"""
    sql["cutoff_status"] = """WITH o AS (SELECT *, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS s FROM orders)
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN s || 'Z' WHEN '2-HIGH' THEN s || '.5+05:00' WHEN '3-MEDIUM' THEN s WHEN '5-LOW' THEN 'on ' || s ELSE ' ' END AS asOf,
  CASE o_orderpriority WHEN '1-URGENT' THEN CASE WHEN o_orderdate>=TIMESTAMP '1998-09-01' THEN 'too_late' ELSE 'ok' END
    WHEN '2-HIGH' THEN CASE WHEN o_orderdate+INTERVAL 500 MILLISECOND-INTERVAL 5 HOUR>=TIMESTAMP '1998-09-01' THEN 'too_late' ELSE 'ok' END
    WHEN '3-MEDIUM' THEN 'ambiguous' WHEN '5-LOW' THEN 'malformed' ELSE 'missing' END AS status FROM o"""
