"""Fixed values of the data contracts.

Everything in this module is a constant that results depend on: weights, bounds,
thresholds, vocabularies and message texts. Changing one changes published numbers.
"""

# --- scoring: (component, input field, bounds key, inverse, weight), in fold order ---

BOUNDS = {
    "epaPerPlay": (-0.3, 0.4),
    "successRate": (0.3, 0.6),
    "pointsPerDrive": (1.0, 3.5),
    "explosivePlayRate": (0.04, 0.2),
    "redZoneTdRate": (0.3, 0.8),
    "turnovers": (0.0, 4.0),
    "pressureRateAllowed": (0.12, 0.45),
    "sacksAllowed": (0.0, 6.0),
    "offensivePlays": (45.0, 80.0),
    "secondsPerPlay": (22.0, 34.0),
    "neutralPassRate": (0.35, 0.7),
    "redZoneTrips": (1.0, 7.0),
    "fantasyPointsForQB": (8.0, 30.0),
    "fantasyPointsForRB": (8.0, 35.0),
    "fantasyPointsForWR": (12.0, 45.0),
    "fantasyPointsForTE": (2.0, 20.0),
    "fantasyPointsAllowedQB": (8.0, 30.0),
    "fantasyPointsAllowedRB": (8.0, 38.0),
    "fantasyPointsAllowedWR": (12.0, 50.0),
    "fantasyPointsAllowedTE": (3.0, 24.0),
    "splitAllowance": (0.0, 22.0),
}

# component name -> (input field, inverse)
COMPONENT_INPUTS = {
    "turnoverDiscipline": ("turnovers", True),
    "pressureAvoidance": ("pressureRateAllowed", True),
    "sackAvoidance": ("sacksAllowed", True),
    "pace": ("secondsPerPlay", True),
}

TEAM_POWER_WEIGHTS = {
    "epaPerPlay": 0.2,
    "successRate": 0.18,
    "pointsPerDrive": 0.18,
    "explosivePlayRate": 0.1,
    "redZoneTdRate": 0.1,
    "turnoverDiscipline": 0.1,
    "pressureAvoidance": 0.07,
    "sackAvoidance": 0.07,
}
FANTASY_WEIGHTS = {
    "offensivePlays": 0.17,
    "pace": 0.12,
    "neutralPassRate": 0.1,
    "redZoneTrips": 0.12,
    "redZoneTdRate": 0.1,
    "explosivePlayRate": 0.1,
    "fantasyPointsForQB": 0.08,
    "fantasyPointsForRB": 0.08,
    "fantasyPointsForWR": 0.08,
    "fantasyPointsForTE": 0.05,
}
MATCHUP_WEIGHTS = {
    "fantasyPointsAllowedQB": 0.22,
    "fantasyPointsAllowedRB": 0.22,
    "fantasyPointsAllowedWR": 0.24,
    "fantasyPointsAllowedTE": 0.16,
    "splitAllowanceBoost": 0.16,
}
STABILITY_WEIGHTS = {
    "successRate": 0.2,
    "pointsPerDrive": 0.16,
    "epaPerPlay": 0.16,
    "turnoverDiscipline": 0.16,
    "sackAvoidance": 0.12,
    "pressureAvoidance": 0.1,
    "redZoneSustainability": 0.1,
}
RED_ZONE_SUSTAINABLE_RATE = 0.62
RED_ZONE_SUSTAINABLE_SLOPE = 200.0
VOLATILITY_WEIGHTS = {"instability": 0.7, "explosivePlayRate": 0.2, "redZoneTdRate": 0.1}

# --- tags, in rule order; the first one that fires picks the closing sentence ---

TAG_MESSAGES = {
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
TAGS = tuple(TAG_MESSAGES)
NO_TAG_MESSAGE = "No dominant tag signal was triggered this week."

STRENGTH_POWER = "Strong team power driven by efficient and successful offense."
STRENGTH_FANTASY = "High fantasy-friendly environment with pace, volume, and scoring access."
STRENGTH_MATCHUP = "Defense allows productive fantasy matchups across key positions."
STRENGTH_STABLE = "Scoring profile is repeatable with solid process indicators."
STRENGTH_DEFAULT = "Balanced profile with no singular dominant strength this week."
RISK_POWER = "Underlying team quality is weak and can collapse under pressure."
RISK_FANTASY = "Limited play volume or red-zone access reduces fantasy viability."
RISK_VOLATILE = "High volatility suggests unstable weekly outcomes."
RISK_TURNOVERS = "Turnover risk can quickly break expected game environment."
RISK_DEFAULT = "No immediate structural red flags beyond normal weekly variance."

ENVIRONMENT_ELITE = "an elite real-life and fantasy environment"
ENVIRONMENT_POWER = "a strong real-life team environment"
ENVIRONMENT_FANTASY = "a fantasy-friendly offense-first environment"
ENVIRONMENT_VOLATILE = "a volatile, high-variance environment"
ENVIRONMENT_BALANCED = "a balanced but middling environment"

# --- rankings ---

SCORE_FIELDS = (
    "teamPowerScore",
    "fantasyEnvironmentScore",
    "matchupEnvironmentScore",
    "stabilityScore",
    "volatilityScore",
)
POSITIONS = ("QB", "RB", "WR", "TE")
# ranking name -> ranked column; the weekly and the latest-week families share it
WEEKLY_RANKINGS = {
    "team_power": "teamPowerScore",
    "fantasy_environment": "fantasyEnvironmentScore",
    "matchup_environment": "matchupEnvironmentScore",
    "qb_matchups": "fantasyPointsAllowedQB",
    "rb_matchups": "fantasyPointsAllowedRB",
    "wr_matchups": "fantasyPointsAllowedWR",
    "te_matchups": "fantasyPointsAllowedTE",
}
# ranking name -> (averaged score, label in front of the season narrative)
SEASON_SCORE_RANKINGS = {
    "team_power": ("teamPowerScore", "Season average team power"),
    "fantasy_environment": ("fantasyEnvironmentScore", "Season average fantasy environment"),
    "matchup_environment": ("matchupEnvironmentScore", "Season average matchup environment"),
}
STABILITY_LABEL = "Season average stability"
VOLATILITY_LABEL = "Season average volatility"
SNAPSHOT_SIZE = 10

SEASON_MEANS = SCORE_FIELDS + (
    "offensivePlays",
    "secondsPerPlay",
    "neutralPassRate",
    "rushRate",
    "redZoneTrips",
    "redZoneTdRate",
    "explosivePlayRate",
    "fantasyPointsForQB",
    "fantasyPointsForRB",
    "fantasyPointsForWR",
    "fantasyPointsForTE",
    "fantasyPointsAllowedQB",
    "fantasyPointsAllowedRB",
    "fantasyPointsAllowedWR",
    "fantasyPointsAllowedTE",
)

# position -> [(averaged field, factor)] in sum order; paceBoost is derived from secondsPerPlay
OFFENSE_FORMULAS = {
    "QB": [("fantasyPointsForQB", 0.45), ("neutralPassRate", 25.0), ("offensivePlays", 0.25),
           ("paceBoost", 0.3), ("teamPowerScore", 0.15)],
    "RB": [("fantasyPointsForRB", 0.45), ("redZoneTrips", 2.2), ("redZoneTdRate", 20.0),
           ("rushRate", 20.0), ("fantasyEnvironmentScore", 0.15)],
    "WR": [("fantasyPointsForWR", 0.5), ("neutralPassRate", 25.0), ("offensivePlays", 0.2),
           ("paceBoost", 0.2), ("explosivePlayRate", 80.0)],
    "TE": [("fantasyPointsForTE", 0.6), ("redZoneTdRate", 20.0), ("neutralPassRate", 10.0),
           ("stabilityScore", 0.15)],
}
PACE_BOOST_CEILING = 40.0
PACE_BOOST_FACTOR = 2.5

# --- movement: window average -> digits ---

WINDOW_DIGITS = {
    "pointsPerDrive": 3,
    "epaPerPlay": 4,
    "successRate": 4,
    "explosivePlayRate": 4,
    "pressureRateAllowed": 4,
    "secondsPerPlay": 3,
    "neutralPassRate": 4,
    "fantasyPointsForQB": 2,
    "fantasyPointsForRB": 2,
    "fantasyPointsForWR": 2,
    "fantasyPointsForTE": 2,
    "volatilityScore": 2,
}
DELTA_METRICS = tuple(m for m in WINDOW_DIGITS if m != "volatilityScore")
DELTA_DIGITS = 4
OFFENSE_VOTES = {
    "pointsPerDrive": 0.25,
    "epaPerPlay": 0.03,
    "successRate": 0.025,
    "explosivePlayRate": 0.015,
}
PASS_STEP = 0.03
PACE_STEP = 0.5
PRESSURE_STEP = 0.03
VOLATILITY_STEP = 5.0
NO_DATA = "insufficient_data"
SHORT_SEASON_WARNING = (
    "insufficient_data: fewer than 4 weeks available for deterministic temporal windows."
)

# --- profiles ---

OFFENSE_TIERS = ((85.0, "elite"), (70.0, "strong"), (50.0, "average"))
PASS_HEAVY_MIN, RUN_HEAVY_MAX = 0.57, 0.43
FAST_MAX, SLOW_MIN = 27.0, 29.0
STABLE_MAX, VOLATILE_MIN = 45.0, 60.0
# signal -> (digits, source artifact)
PROFILE_SIGNALS = {
    "fantasyEnvironmentScore": (2, "season_to_date.fantasy_environment.json"),
    "neutralPassRate": (4, "season_to_date.team_power.json"),
    "secondsPerPlay": (3, "season_to_date.team_power.json"),
    "volatilityScore": (2, "season_to_date.team_power.json"),
}
MARKET_WARNING = "marketTier unknown: no governed market-prior input artifact exists."
# tier column -> warning when it is unknown
TIER_WARNINGS = {
    "offenseTier": "offenseTier unknown: fantasy environment score missing from source artifact.",
    "passEnvironmentTier": "passEnvironmentTier unknown: neutral pass rate missing from source artifact.",
    "paceTier": "paceTier unknown: seconds per play missing from source artifact.",
    "volatilityTier": "volatilityTier unknown: volatility score unavailable or in neutral band (45-60).",
}

# --- league ---

LEAGUE_TEAMS = tuple(
    "ARI ATL BAL BUF CAR CHI CIN CLE DAL DEN DET GB HOU IND JAX KC "
    "LAC LAR LV MIA MIN NE NO NYG NYJ PHI PIT SEA SF TB TEN WAS".split()
)
# the profile contract lists missing teams in this order
PROFILE_TEAM_ORDER = tuple(
    "ARI ATL BAL BUF CAR CHI CIN CLE DAL DEN DET GB HOU IND JAX KC "
    "LV LAC LAR MIA MIN NE NO NYG NYJ PHI PIT SEA SF TB TEN WAS".split()
)
REGULAR_SEASON_WEEKS = tuple(range(1, 19))
REGULAR_SEASON_GAMES = 17

# --- provenance and governance vocabularies ---

ARTIFACT_RAW = "team_week_raw_v0"
ARTIFACT_MOVEMENT_V0 = "team_environment_movement_v0"
ARTIFACT_MOVEMENT_V1 = "team_environment_movement_v1"
ARTIFACT_PROFILES = "team_environment_profiles_v0"
CONTRACT_PROFILE = "team_environment_profile_v0"
CONTRACT_FEATURES = "team_environment_forecast_features_v1"

PROVENANCE = ("fixture_scaffold", "sample", "partial_real_data", "governed_real_data",
              "unknown_provenance")
CANDIDATE_PROVENANCE = ("fixture_scaffold", "sample", "partial_real_data", "unknown_provenance")
GOVERNANCE_BY_PROVENANCE = {
    "governed_real_data": "governed",
    "fixture_scaffold": "fixture",
    "sample": "fixture",
    "partial_real_data": "ungoverned",
    "unknown_provenance": "unknown",
}
GOVERNANCE_STATUSES = ("governed", "fixture", "ungoverned", "unknown")
GOVERNANCE_SOURCES = ("explicit_marker", "path_inference", "unknown")
NOTE_PATH_INFERENCE = (
    "Governance status inferred from input path; no explicit producer marker was supplied. "
    "Path location (e.g. /promoted/) is a weak hint and is not, on its own, governance proof."
)
NOTE_NO_SIGNAL = (
    "No explicit producer marker was supplied and the input path yielded no usable provenance "
    "signal; governance could not be established."
)
NOTE_SCAFFOLD_PATH = (
    "Input path indicates sample/fixture scaffold data; artifact is not governed production truth."
)
NOTE_UNKNOWN_PATH = (
    "Input source path was not available or did not match sample/fixture/governed patterns."
)
NOTE_INCOMPLETE = (
    "Coverage is incomplete (<32 NFL teams); artifact cannot be governed_real_data."
)

PRESSURE_FIELD = "pressureRateAllowed"
AVAILABLE, PARTIAL_NULLS, DEFERRED = "available", "partial_nulls", "deferred_insufficient_data"
LEAKAGE_MARKERS = ("fantasy", "pressure", "target", "label", "2025", "next", "future")
FORBIDDEN_KEY = "fantasypoint"

# --- model features: name -> (type, allowed values, allowed in model, description) ---

_DIRECTION_TAIL = ("stable", "insufficient_data", "unknown")
FEATURES = {
    "points_per_drive": ("number", None, True, "Pre-cutoff team points scored per offensive drive."),
    "epa_per_play": ("number", None, True, "Pre-cutoff team offensive EPA per play."),
    "success_rate": ("number", None, True, "Pre-cutoff team offensive success rate."),
    "explosive_play_rate": ("number", None, True, "Pre-cutoff team explosive-play rate."),
    "pressure_rate_allowed": ("number", None, True,
                              "Pre-cutoff rate of pressures allowed by the team offense."),
    "seconds_per_play": ("number", None, True, "Pre-cutoff team pace, in seconds per offensive play."),
    "neutral_pass_rate": ("number", None, True, "Pre-cutoff team neutral-script pass rate."),
    "volatility_score": ("number", None, True,
                         "Pre-cutoff stability/volatility score (team metric, not a fantasy output)."),
    "offense_direction": ("direction", ("improving", "declining") + _DIRECTION_TAIL, True,
                          "Directional change in the team's offensive environment across the pre-cutoff window."),
    "pass_environment_direction": ("direction", ("more_pass_heavy", "less_pass_heavy") + _DIRECTION_TAIL, True,
                                   "Directional change in the team's pass-script lean across the pre-cutoff window."),
    "pace_direction": ("direction", ("faster", "slower") + _DIRECTION_TAIL, True,
                       "Directional change in the team's pace across the pre-cutoff window."),
    "pressure_direction": ("direction", ("improving", "worsening") + _DIRECTION_TAIL, True,
                           "Directional change in pressure allowed by the team offense across the pre-cutoff window."),
    "volatility_direction": ("direction", ("rising", "falling") + _DIRECTION_TAIL, True,
                             "Directional change in the team's volatility across the pre-cutoff window."),
    "offense_tier": ("tier", ("elite", "strong", "average", "weak", "unknown"), False,
                     "Candidate categorical offensive-environment tier (from team_environment_profiles_v0)."),
    "pass_environment_tier": ("tier", ("pass_heavy", "balanced", "run_heavy", "unknown"), False,
                              "Candidate categorical pass-environment tier (from team_environment_profiles_v0)."),
    "pace_tier": ("tier", ("fast", "neutral", "slow", "unknown"), False,
                  "Candidate categorical pace tier (from team_environment_profiles_v0)."),
    "volatility_tier": ("tier", ("stable", "volatile", "unknown"), False,
                        "Candidate categorical volatility tier (from team_environment_profiles_v0)."),
}
FEATURE_COVERAGE = ("complete", "partial", "unavailable")

# --- season report ---

REPORT_COUNTS = ("pointsFor", "offensivePlays", "neutralPlays", "drives", "redZoneTrips",
                 "sacksAllowed", "turnovers")
# rate -> (weight field, digits, warning when the weights sum to zero)
REPORT_RATES = {
    "neutralPassRate": ("neutralPlays", 4, "W_ZERO_DENOMINATOR_NEUTRAL_PLAYS"),
    "pointsPerDrive": ("drives", 2, "W_ZERO_DENOMINATOR_DRIVES"),
    "redZoneTdRate": ("redZoneTrips", 4, "W_ZERO_REDZONE_OPPORTUNITIES"),
    "secondsPerPlay": ("offensivePlays", 2, "W_ZERO_DENOMINATOR_OFFENSIVE_PLAYS"),
    "epaPerPlay": ("offensivePlays", 4, "W_ZERO_DENOMINATOR_OFFENSIVE_PLAYS"),
}
REPORT_WITHHELD = ("pointsAgainst", "pressureRateAllowed", "passRate", "rushRate", "successRate",
                   "explosivePlayRate", "passEpaPerPlay", "rushEpaPerPlay")
# Withheld rates whose denominators may not be approximated, and approved methods.
REPORT_BLOCKED = ("passRate", "rushRate", "successRate", "explosivePlayRate", "passEpaPerPlay", "rushEpaPerPlay")
REPORT_METHODOLOGIES = ("public_offensive_environment_2024_v1",)
# The artifacts that profiles are made from.
PROFILE_SOURCES = ("season_to_date.fantasy_environment.json", "season_to_date.team_power.json", "weekly_states.json")
