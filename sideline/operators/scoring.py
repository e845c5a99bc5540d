"""Per-row scores, tags and explanations. Narrow projections only: no shuffle, no UDF."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sideline import config, schemas
from sideline.functions.numeric import clamp, fixed_text, is_finite, lit, normalize, number_text
from sideline.functions.numeric import weighted_average


class SchemaError(ValueError):
    """A frame that must not be scored was handed to the scoring functions."""


def normalized(field: str, inverse: bool = False) -> str:
    """Scale one input field to 0-100 by its configured bounds."""
    return normalize(field, *config.BOUNDS[field], inverse)


def split_average() -> str:
    """Mean of the finite splits, 0 when there are none."""
    total = " + ".join(f"if({is_finite(s)}, {s}, 0D)" for s in schemas.SPLITS)
    count = " + ".join(f"int({is_finite(s)})" for s in schemas.SPLITS)
    return f"coalesce(({total}) / nullif({count}, 0), 0D)"


def _component(name: str) -> str:
    if name == "splitAllowanceBoost":
        return normalize("_splitAverage", *config.BOUNDS["splitAllowance"])
    if name == "redZoneSustainability":
        gap = f"abs(redZoneTdRate - {lit(config.RED_ZONE_SUSTAINABLE_RATE)})"
        return clamp(f"(100D - {gap} * {lit(config.RED_ZONE_SUSTAINABLE_SLOPE)})")
    field, inverse = config.COMPONENT_INPUTS.get(name, (name, False))
    return normalized(field, inverse)


# components column -> (score column, weights)
SCORE_PARTS = {
    "teamPower": ("teamPowerScore", config.TEAM_POWER_WEIGHTS),
    "fantasyEnvironment": ("fantasyEnvironmentScore", config.FANTASY_WEIGHTS),
    "matchupEnvironment": ("matchupEnvironmentScore", config.MATCHUP_WEIGHTS),
    "stability": ("stabilityScore", config.STABILITY_WEIGHTS),
}


def add_components(rows: DataFrame) -> DataFrame:
    """Add one struct of 0-100 components per score."""
    structs = [
        "named_struct(" + ", ".join(f"'{n}', {_component(n)}" for n in weights) + f") AS {part}"
        for part, (_, weights) in SCORE_PARTS.items()
    ]
    with_average = rows.selectExpr("*", f"{split_average()} AS _splitAverage")
    return with_average.selectExpr("*", *structs).drop("_splitAverage")


def add_scores(rows: DataFrame) -> DataFrame:
    """Add the five scores to a frame that has the component structs."""
    scores = [
        weighted_average({n: f"{part}.{n}" for n in weights}, weights) + f" AS {score}"
        for part, (score, weights) in SCORE_PARTS.items()
    ]
    w = config.VOLATILITY_WEIGHTS
    volatility = (
        f"(100D - stabilityScore) * {lit(w['instability'])}"
        f" + ({normalized('explosivePlayRate')}) * {lit(w['explosivePlayRate'])}"
        f" + ({normalized('redZoneTdRate')}) * {lit(w['redZoneTdRate'])}"
    )
    return rows.selectExpr("*", *scores).selectExpr(
        "*", f"least(100D, greatest(0D, {volatility})) AS volatilityScore"
    )


# tag -> condition, in the order in which tags are listed; fixed thresholds
TAG_RULES = {
    "elite_real_life_team": "teamPowerScore >= 80",
    "elite_fantasy_environment": "fantasyEnvironmentScore >= 80",
    "pass_funnel_offense": "neutralPassRate >= 0.6D AND rushRate <= 0.42D",
    "run_heavy_low_ceiling": "rushRate >= 0.52D AND fantasyEnvironmentScore < 60",
    "red_zone_machine": "redZoneTrips >= 5 AND redZoneTdRate >= 0.65D",
    "explosive_but_volatile": "explosivePlayRate >= 0.14D AND volatilityScore >= 65",
    "stable_environment": "stabilityScore >= 72 AND volatilityScore <= 38",
    "fraudulent_td_environment": "redZoneTdRate >= 0.72D AND pointsPerDrive < 2",
    "qb_friendly_matchup": "fantasyPointsAllowedQB >= 22",
    "wr_slot_funnel_defense": "coalesce(wrSlotAllowed, 0D) >= 16"
    " AND coalesce(wrSlotAllowed, 0D) > coalesce(wrWideAllowed, 0D) + 2",
    "te_dead_zone_defense": "fantasyPointsAllowedTE <= 7"
    " AND coalesce(teInlineAllowed, 0D) <= 4 AND coalesce(teSplitAllowed, 0D) <= 4",
}

# text -> condition, in list order; fixed thresholds
STRENGTH_RULES = {
    config.STRENGTH_POWER: "teamPowerScore >= 70",
    config.STRENGTH_FANTASY: "fantasyEnvironmentScore >= 70",
    config.STRENGTH_MATCHUP: "matchupEnvironmentScore >= 65",
    config.STRENGTH_STABLE: "stabilityScore >= 70",
}
RISK_RULES = {
    config.RISK_POWER: "teamPowerScore < 45",
    config.RISK_FANTASY: "fantasyEnvironmentScore < 45",
    config.RISK_VOLATILE: "volatilityScore >= 65",
    config.RISK_TURNOVERS: "turnovers >= 3",
}

ENVIRONMENT_TYPE = f"""CASE
  WHEN teamPowerScore >= 75 AND fantasyEnvironmentScore >= 75 THEN '{config.ENVIRONMENT_ELITE}'
  WHEN teamPowerScore >= 70 THEN '{config.ENVIRONMENT_POWER}'
  WHEN fantasyEnvironmentScore >= 70 THEN '{config.ENVIRONMENT_FANTASY}'
  WHEN volatilityScore >= 65 THEN '{config.ENVIRONMENT_VOLATILE}'
  ELSE '{config.ENVIRONMENT_BALANCED}' END"""


def _present(rules: dict[str, str]) -> str:
    """Array of the texts whose condition holds, in order."""
    return "array_compact(array(" + ", ".join(
        f"CASE WHEN {cond} THEN '{text}' END" for text, cond in rules.items()
    ) + "))"


def _or_default(rules: dict[str, str], default: str) -> str:
    """The list of present texts, or the default line when none is."""
    nothing = " AND ".join(f"NOT coalesce({cond}, false)" for cond in rules.values())
    return f"CASE WHEN {nothing} THEN array('{default}') ELSE {_present(rules)} END"


def tag_sentence() -> str:
    """Sentence of the first tag."""
    cases = " ".join(f"WHEN '{tag}' THEN '{text}'" for tag, text in config.TAG_MESSAGES.items())
    return f"CASE try_element_at(tags, 1) {cases} ELSE '{config.NO_TAG_MESSAGE}' END"


def add_tags(scored: DataFrame) -> DataFrame:
    """Add the ordered ``tags`` array."""
    return scored.selectExpr("*", f"{_present(TAG_RULES)} AS tags")


def add_explanation(tagged: DataFrame) -> DataFrame:
    """Add ``strengths``, ``risks`` and ``summary``."""
    percents = tagged.selectExpr(
        "*", "successRate * 100D AS _success", "redZoneTdRate * 100D AS _redZone"
    )
    summary = f"""concat(team, ' in Week ', {number_text('week')}, ' profiles as ', {ENVIRONMENT_TYPE},
      '. Core drivers were EPA/play ', {fixed_text('epaPerPlay', 2)},
      ', success rate ', {fixed_text('_success', 1)}, '%, and ', {number_text('redZoneTrips')},
      ' red-zone trips at ', {fixed_text('_redZone', 1)}, '% TD conversion. ', {tag_sentence()})"""
    return percents.selectExpr(
        "*",
        f"{_or_default(STRENGTH_RULES, config.STRENGTH_DEFAULT)} AS strengths",
        f"{_or_default(RISK_RULES, config.RISK_DEFAULT)} AS risks",
        f"{summary} AS summary",
    ).drop("_success", "_redZone")


def score_rows(rows: DataFrame) -> DataFrame:
    """Components and scores of canonical rows.

    Null metrics would silently score as 0, so only frames that carry every canonical column are
    accepted; the null-preserving candidate and governed frames are refused.
    """
    missing = [n for n in schemas.REQUIRED + schemas.SPLITS if n not in rows.columns]
    if missing:
        raise SchemaError(f"not a canonical team-week frame, missing {missing}")
    return add_scores(add_components(rows))


def build_states(rows: DataFrame) -> DataFrame:
    """Full team-week state: input columns, components, scores, tags and explanation."""
    return add_explanation(add_tags(score_rows(rows)))


def as_state_records(states: DataFrame) -> DataFrame:
    """Nest the flat state columns into the published record shape."""
    return states.select(
        *schemas.KEYS,
        F.struct(*schemas.REQUIRED, *schemas.SPLITS).alias("input"),
        F.struct(*config.SCORE_FIELDS).alias("scores"),
        F.struct(*SCORE_PARTS).alias("components"),
        "tags",
        F.struct("summary", "strengths", "risks", "tags").alias("explanation"),
    )
