"""Column lists and Spark schemas of the team-week contracts."""

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from sideline import config

METRICS = (
    "pointsFor",
    "pointsAgainst",
    "offensivePlays",
    "neutralPlays",
    "secondsPerPlay",
    "passRate",
    "neutralPassRate",
    "rushRate",
    "epaPerPlay",
    "passEpaPerPlay",
    "rushEpaPerPlay",
    "successRate",
    "explosivePlayRate",
    "drives",
    "pointsPerDrive",
    "redZoneTrips",
    "redZoneTdRate",
    "sacksAllowed",
    "pressureRateAllowed",
    "turnovers",
) + tuple(f"fantasyPointsFor{p}" for p in config.POSITIONS) + tuple(
    f"fantasyPointsAllowed{p}" for p in config.POSITIONS
)
SPLITS = (
    "qbPassAllowed",
    "qbRushAllowed",
    "rbRushAllowed",
    "rbRecAllowed",
    "wrSlotAllowed",
    "wrWideAllowed",
    "teInlineAllowed",
    "teSplitAllowed",
)
FANTASY_FIELDS = tuple(m for m in METRICS if m.startswith("fantasyPoints"))
GOVERNED_METRICS = tuple(
    m for m in METRICS if m not in FANTASY_FIELDS and m != config.PRESSURE_FIELD
) + (config.PRESSURE_FIELD,)

KEYS = ("season", "week", "team", "opponent")
REQUIRED = KEYS + METRICS
# where a row came from: ties between equal keys are broken by input order
ORIGIN = ("sourceFile", "rowIndex")


def snake(name: str) -> str:
    """fantasyPointsForQB -> fantasy_points_for_qb, the spelling of raw array files."""
    out = []
    for i, ch in enumerate(name):
        if ch.isupper() and not name[i - 1].isupper():
            out.append("_")
        out.append(ch.lower())
    return "".join(out)


# raw column -> canonical column
RAW_NAMES = {"season": "season", "week": "week", "team_code": "team", "opponent_code": "opponent"}
RAW_NAMES.update({snake(m): m for m in METRICS + SPLITS})
# envelope column -> canonical column
ENVELOPE_NAMES = {"season": "season", "week": "week", "teamCode": "team", "opponentCode": "opponent"}
ENVELOPE_NAMES.update({m: m for m in METRICS + SPLITS})
RAW_REQUIRED = tuple(raw for raw, name in RAW_NAMES.items() if name not in SPLITS)


def _row_type(names) -> StructType:
    # season and week are read as doubles so that a fractional one can be reported
    return StructType(
        [
            StructField(raw, StringType() if name in ("team", "opponent") else DoubleType())
            for raw, name in names.items()
        ]
    )


RAW_ROW = _row_type(RAW_NAMES)
ENVELOPE_ROW = _row_type(ENVELOPE_NAMES)
CANONICAL_ROW = _row_type({name: name for name in RAW_NAMES.values()})

TEAM_WEEK = StructType(
    [
        StructField("season", IntegerType()),
        StructField("week", IntegerType()),
        StructField("team", StringType()),
        StructField("opponent", StringType()),
    ]
    + [StructField(m, DoubleType()) for m in METRICS + SPLITS]
)

_TEXT_COLUMNS = {
    "offense": ("team", "offensive_playcaller", "head_coach", "pace_label", "pass_rate_label",
                "play_volume_label", "qb_stability_label", "scoring_environment_label",
                "rookie_landing_spot_modifier", "modifier_strength", "notes", "source_status"),
    "context": ("team", "team_name", "head_coach", "offensive_coordinator", "play_caller",
                "qb_context", "source_status", "notes"),
    "landing": ("team", "team_name", "notes", "source_status"),
}
_TAG_COLUMNS = {
    "offense": ("context_tags",),
    "context": ("offensive_identity_tags", "personnel_usage_tags", "pace_pass_environment_tags",
                "positive_team_context_tags", "risk_team_context_tags",
                "rookie_landing_context_tags"),
    "landing": ("context_tags", "positive_context_tags", "risk_context_tags"),
}


def context_schema(kind: str) -> StructType:
    """Schema of one of the three seeded context tables."""
    return StructType(
        [StructField("season", DoubleType())]
        + [StructField(c, StringType()) for c in _TEXT_COLUMNS[kind]]
        + [StructField(c, ArrayType(StringType())) for c in _TAG_COLUMNS[kind]]
    )
