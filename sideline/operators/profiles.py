"""Season tiers with their signals and warnings."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sideline import config
from sideline.functions.numeric import exact_round, is_finite, lit

_MISSING = "WHEN NOT {} THEN 'unknown'"


def offense_tier(x: str) -> str:
    steps = " ".join(f"WHEN {x} >= {lit(low)} THEN '{tier}'" for low, tier in config.OFFENSE_TIERS)
    return f"CASE {_MISSING.format(is_finite(x))} {steps} ELSE 'weak' END"


def pass_tier(x: str) -> str:
    return (
        f"CASE {_MISSING.format(is_finite(x))} WHEN {x} >= {lit(config.PASS_HEAVY_MIN)} THEN 'pass_heavy' "
        f"WHEN {x} <= {lit(config.RUN_HEAVY_MAX)} THEN 'run_heavy' ELSE 'balanced' END"
    )


def pace_tier(x: str) -> str:
    return (
        f"CASE {_MISSING.format(is_finite(x))} WHEN {x} <= {lit(config.FAST_MAX)} THEN 'fast' "
        f"WHEN {x} >= {lit(config.SLOW_MIN)} THEN 'slow' ELSE 'neutral' END"
    )


def volatility_tier(x: str) -> str:
    """Between the two thresholds the tier is unknown, not neutral."""
    return (
        f"CASE {_MISSING.format(is_finite(x))} WHEN {x} <= {lit(config.STABLE_MAX)} THEN 'stable' "
        f"WHEN {x} >= {lit(config.VOLATILE_MIN)} THEN 'volatile' ELSE 'unknown' END"
    )


def _signal(name: str) -> str:
    digits, source = config.PROFILE_SIGNALS[name]
    value = f"if({is_finite(name)}, {exact_round(name, digits)}, NULL)"
    return f"named_struct('name', '{name}', 'value', {value}, 'source', '{source}')"


def build_profiles(
    seasons: DataFrame, generated_at: str | None = None, snapshot_at: str | None = None
) -> DataFrame:
    """One profile per team-season of ``team_season_means`` (or ``team_seasons``)."""
    tiers = seasons.selectExpr(
        "*",
        f"{offense_tier('fantasyEnvironmentScore')} AS offenseTier",
        f"{pass_tier('neutralPassRate')} AS passEnvironmentTier",
        f"{pace_tier('secondsPerPlay')} AS paceTier",
        f"{volatility_tier('volatilityScore')} AS volatilityTier",
    )
    warnings = ", ".join(
        f"CASE WHEN {tier} = 'unknown' THEN '{text}' END" for tier, text in config.TIER_WARNINGS.items()
    )
    shaped = tiers.selectExpr(
        f"'{config.CONTRACT_PROFILE}' AS contractVersion", "team AS teamId", "team AS teamAbbr",
        "season", "'unknown' AS marketTier", *config.TIER_WARNINGS,
        "array(" + ", ".join(_signal(n) for n in config.PROFILE_SIGNALS) + ") AS signals",
        f"array_compact(array('{config.MARKET_WARNING}', {warnings})) AS warnings",
    )
    return shaped.withColumns(
        {
            "generatedAt": F.lit(generated_at).cast("string"),
            "sourceSnapshotAt": F.lit(snapshot_at).cast("string"),
        }
    )


def ordered_profiles(profiles: DataFrame) -> DataFrame:
    """Publication order: season desc, team."""
    return profiles.orderBy(F.desc("season"), F.collate("teamId", "UNICODE"))
