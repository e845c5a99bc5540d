"""The model feature table: projection, guards, catalogue and validator."""

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, NumericType, StringType, StructType

from sideline import config
from sideline.functions.lineage import written
from sideline.functions.numeric import is_finite
from sideline.operators import quality
from sideline.operators.quality import QualityError, Rule

# feature -> field of a movement record; tiers are not derived here and stay unknown
_SOURCES = {
    "points_per_drive": "lateWindow.averages.pointsPerDrive",
    "epa_per_play": "lateWindow.averages.epaPerPlay",
    "success_rate": "lateWindow.averages.successRate",
    "explosive_play_rate": "lateWindow.averages.explosivePlayRate",
    "pressure_rate_allowed": "lateWindow.averages.pressureRateAllowed",
    "seconds_per_play": "lateWindow.averages.secondsPerPlay",
    "neutral_pass_rate": "lateWindow.averages.neutralPassRate",
    "volatility_score": "lateWindow.averages.volatilityScore",
    "offense_direction": "movement.offenseDirection",
    "pass_environment_direction": "movement.passEnvironmentDirection",
    "pace_direction": "movement.paceDirection",
    "pressure_direction": "movement.pressureDirection",
    "volatility_direction": "movement.volatilityDirection",
}


class FeatureOptions(NamedTuple):
    """Envelope of a feature table. ``owner`` and ``consumer`` name the two ends of the contract."""

    generated_at: str
    cutoff_at: str
    feature_season: int
    target_season: int
    expected_teams: Sequence[str] | None = None
    expected_team_count: int = 32
    source_refs: Sequence[str] = ()
    coverage_status: str = "partial"
    confidence: float = 0.0
    row_warnings: Sequence[str] = ()
    governance_status: str = "fixture"
    governance_source: str = "explicit_marker"
    promotion_notes: Sequence[str] | None = None
    owner: str = "team-environment"
    consumer: str = "Point-prediction-model"
    output_kind: str = "model-legible-team-context"


class FeatureTable(NamedTuple):
    rows: DataFrame
    header: DataFrame
    catalogue: DataFrame


def feature_values() -> str:
    """Struct of the 17 features of one movement record."""
    items = [f"'{n}', {_SOURCES[n]}" if n in _SOURCES else f"'{n}', 'unknown'" for n in config.FEATURES]
    return f"named_struct({', '.join(items)})"


def catalogue(spark: SparkSession) -> DataFrame:
    """Feature definitions; tiers may explain a forecast but not enter the model."""
    rows = [(n, kind, text, in_model, True) for n, (kind, _, in_model, text) in config.FEATURES.items()]
    return spark.createDataFrame(
        rows, "name string, type string, description string, allowedInModel boolean, "
        "allowedInPosthocExplanation boolean"
    )


def guard_problems(
    movement: DataFrame, season: int, expected: Sequence[str] | None = None
) -> DataFrame:
    """Rows that cannot be published under one feature season: (rule, message)."""
    # one read: the three rules share the counts per team and season
    per = written(movement.groupBy("teamId", "season").agg(F.count(F.lit(1)).alias("n")), "guards")
    off = (
        per.where(f"season <> {season}").select("season").distinct()
        .agg(F.array_join(F.sort_array(F.collect_list("season")), ", ").alias("seasons"))
        .where("seasons <> ''")
        .selectExpr("0 AS rule", "concat('movement contains season(s) ', seasons, "
                    f"' not matching feature season {season}') AS message")
    )
    per_team = per.groupBy("teamId").agg(F.sum("n").alias("n"))
    double = per_team.where("n > 1").selectExpr(
        "1 AS rule", "concat('duplicate team \"', teamId, '\" in movement input') AS message"
    )
    if expected is None:
        return off.unionByName(double)
    league = movement.sparkSession.createDataFrame([(t,) for t in expected], "teamId string")
    other = per_team.join(league, "teamId", "left_anti").selectExpr(
        "2 AS rule",
        f"concat('unexpected team \"', teamId, '\" not in the expected team set for season {season}') AS message",
    )
    return off.unionByName(double).unionByName(other)


def feature_rows(movement: DataFrame, options: FeatureOptions) -> DataFrame:
    """One row per team, without the guards."""
    o = options
    texts = lambda items: F.array(*[F.lit(x) for x in items]).cast("array<string>")
    return movement.select(
        "teamId", "teamAbbr", "season",
        F.lit(o.cutoff_at).alias("cutoffAt"),
        F.expr(feature_values()).alias("features"),
        F.lit(o.coverage_status).alias("featureCoverageStatus"),
        F.lit(float(o.confidence)).alias("confidence"),
        texts(o.row_warnings).alias("warnings"),
        texts(o.source_refs).alias("sourceDatasetRefs"),
    )


def build_features(movement: DataFrame, options: FeatureOptions, stored: bool = False) -> FeatureTable:
    """Feature table of one season. Refuses other seasons, repeated teams and unknown teams.

    The guards, the header and the rows read ``movement``: it is written once, unless it is a
    ``stored`` table already.
    """
    o = options
    movement = movement if stored else written(movement, "movement")
    quality.require_clean(
        guard_problems(movement, o.feature_season, o.expected_teams), ["rule", "message"]
    )
    rows = feature_rows(movement, o).orderBy(
        F.collate("teamId", "UNICODE"), F.collate("teamAbbr", "UNICODE")
    )
    expected = len(o.expected_teams) if o.expected_teams is not None else o.expected_team_count
    weeks = movement.selectExpr("season", "explode_outer(weekGames.week) AS week").distinct().agg(
        F.sort_array(F.collect_set("season")).alias("seasons"),
        F.sort_array(F.collect_set("week")).alias("weeks"),
    )
    count = movement.count()
    header = weeks.select(
        F.lit(config.CONTRACT_FEATURES).alias("artifact"),
        F.lit(config.CONTRACT_FEATURES).alias("contractVersion"),
        F.lit(o.generated_at).alias("generatedAt"),
        F.lit(o.cutoff_at).alias("cutoffAt"),
        F.lit(o.feature_season).alias("featureSeason"),
        F.lit(o.target_season).alias("targetSeason"),
        F.lit(o.owner).alias("owningRepo"),
        F.lit(o.consumer).alias("intendedConsumer"),
        F.lit(o.output_kind).alias("outputKind"),
        F.struct(
            F.lit(o.governance_status).alias("governanceStatus"),
            F.lit(o.governance_source).alias("governanceSource"),
            F.lit(o.generated_at).alias("generatedAt"),
            (F.array(*[F.lit(n) for n in o.promotion_notes]) if o.promotion_notes
             else F.lit(None).cast("array<string>")).alias("promotionNotes"),
        ).alias("governance"),
        F.struct(
            F.lit(count).alias("teamCount"),
            F.lit(expected).alias("expectedTeamCount"),
            F.lit(count == expected).alias("isFullLeague"),
            "seasons", "weeks",
        ).alias("coverage"),
    )
    return FeatureTable(rows, header, catalogue(movement.sparkSession))


def field_names(kind: DataType) -> list[str]:
    """Every field name anywhere inside a type."""
    if isinstance(kind, StructType):
        return [n for f in kind.fields for n in [f.name, *field_names(f.dataType)]]
    if isinstance(kind, ArrayType):
        return field_names(kind.elementType)
    if isinstance(kind, MapType):
        return field_names(kind.keyType) + field_names(kind.valueType)
    return []


def forbidden_fields(kind: DataType) -> list[str]:
    """Names that spell fantasy points in any case, with any punctuation."""
    letters = lambda name: "".join(ch for ch in name.lower() if "a" <= ch <= "z")
    return [n for n in field_names(kind) if config.FORBIDDEN_KEY in letters(n)]


def _one_of(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _row_rules(rows: DataFrame, declared: set[str]) -> list[Rule]:
    have = set(rows.columns)
    at = "concat('teams[', coalesce(teamId, '?'), ']{}')"
    text = lambda message: at.format(message.replace("'", "\\'"))
    rules = []
    for f in ("teamId", "teamAbbr", "cutoffAt"):
        bad = f"coalesce({f}, '') = ''" if f in have else "true"
        rules.append(Rule(bad, text(f".{f} must be a non-empty string")))
    rules.append(Rule("season IS NULL", text(".season must be a number")))
    rules.append(Rule(f"coalesce(featureCoverageStatus, '') NOT IN {_one_of(config.FEATURE_COVERAGE)}",
                      text(f".featureCoverageStatus must be one of {', '.join(config.FEATURE_COVERAGE)}")))
    rules.append(Rule("NOT coalesce(confidence BETWEEN 0 AND 1, false)",
                      text(".confidence must be a number in [0, 1]")))
    for f in ("warnings", "sourceDatasetRefs"):
        rules.append(Rule(f"{f} IS NULL", text(f".{f} must be an array")))
    shape = rows.schema["features"].dataType if "features" in have else None
    if not isinstance(shape, StructType):
        return rules + [Rule("true", text(".features must be an object"))]
    rules.append(Rule("features IS NULL", text(".features must be an object")))
    rules += [Rule("true", text(f'.features is missing declared feature "{n}"'))
              for n in declared if n not in shape.names]
    for field in shape.fields:
        n = field.name
        if n not in declared:
            rules.append(Rule("true", text(f'.features has undeclared feature "{n}"')))
        if n not in config.FEATURES:
            continue
        kind, allowed, _, _ = config.FEATURES[n]
        value = f"features.`{n}`"
        if kind == "number":
            bad = (f"{value} IS NOT NULL AND NOT {is_finite(value)}"
                   if isinstance(field.dataType, NumericType) else f"{value} IS NOT NULL")
            rules.append(Rule(bad, text(f".features.{n} must be a finite number or null")))
        else:
            bad = (f"features IS NOT NULL AND NOT coalesce({value} IN {_one_of(allowed)}, false)"
                   if isinstance(field.dataType, StringType) else "true")
            rules.append(Rule(bad, text(f".features.{n} must be one of {', '.join(allowed)}")))
    return rules


def _header_rules(row_count: int, options: FeatureOptions) -> list[Rule]:
    t = quality.text
    fixed = {
        "artifact": config.CONTRACT_FEATURES, "contractVersion": config.CONTRACT_FEATURES,
        "owningRepo": options.owner, "intendedConsumer": options.consumer,
        "outputKind": options.output_kind,
    }
    rules = [Rule(f"NOT {f} <=> '{v}'", t(f'{f} must be "{v}"')) for f, v in fixed.items()]
    rules += [Rule(f"coalesce({f}, '') = ''", t(f"{f} must be a non-empty ISO string"))
              for f in ("generatedAt", "cutoffAt")]
    rules += [Rule(f"{f} IS NULL", t(f"{f} must be a number")) for f in ("featureSeason", "targetSeason")]
    rules += [
        Rule(f"coalesce(governance.governanceStatus, '') NOT IN {_one_of(config.GOVERNANCE_STATUSES)}",
             t(f"governance.governanceStatus must be one of {', '.join(config.GOVERNANCE_STATUSES)}")),
        Rule(f"coalesce(governance.governanceSource, '') NOT IN {_one_of(config.GOVERNANCE_SOURCES)}",
             t(f"governance.governanceSource must be one of {', '.join(config.GOVERNANCE_SOURCES)}")),
        Rule("coalesce(governance.generatedAt, '') = ''",
             t("governance.generatedAt must be a non-empty ISO string")),
    ]
    rules += [Rule(f"coverage.{f} IS NULL", t(f"coverage.{f} must be a number"))
              for f in ("teamCount", "expectedTeamCount")]
    rules.append(Rule("coverage.isFullLeague IS NULL", t("coverage.isFullLeague must be a boolean")))
    rules += [Rule(f"coverage.{f} IS NULL", t(f"coverage.{f} must be an array")) for f in ("seasons", "weeks")]
    rules += [
        Rule(f"coverage.teamCount <> {row_count}",
             f"concat('coverage.teamCount (', coverage.teamCount, ') must equal the number of team rows ({row_count})')"),
        Rule("coverage.isFullLeague <> (coverage.teamCount = coverage.expectedTeamCount)",
             "concat('coverage.isFullLeague (', coverage.isFullLeague, ') must be ', "
             "coverage.teamCount = coverage.expectedTeamCount, ' when teamCount=', coverage.teamCount, "
             "' and expectedTeamCount=', coverage.expectedTeamCount)"),
    ]
    return rules


def _catalogue_problems(defs: DataFrame) -> DataFrame:
    """Definitions against the canonical set, both ways."""
    spark = defs.sparkSession
    canon = spark.createDataFrame(
        [(n, kind) for n, (kind, _, _, _) in config.FEATURES.items()], "name string, wanted string"
    )
    named = defs.where("coalesce(name, '') <> ''")
    rules = [
        Rule("coalesce(name, '') = ''", quality.text("featureDefinitions: name must be a non-empty string")),
        Rule("wanted IS NOT NULL AND NOT type <=> wanted",
             "concat('featureDefinitions type for \"', name, '\" must be \"', wanted, '\"')"),
        Rule("wanted IS NULL AND coalesce(type, '') NOT IN ('number', 'direction', 'tier')",
             "concat('featureDefinitions type of \"', name, '\" must be one of number, direction, tier')"),
        Rule("coalesce(name, '') <> '' AND wanted IS NULL",
             "concat('featureDefinitions declares unknown feature \"', name, '\"')"),
        Rule("coalesce(description, '') = ''",
             "concat('featureDefinitions description of \"', name, '\" must be a non-empty string')"),
    ] + [
        Rule(f"{f} IS NULL", f"concat('featureDefinitions {f} of \"', name, '\" must be a boolean')")
        for f in ("allowedInModel", "allowedInPosthocExplanation")
    ]
    each = quality.violations(defs.join(canon, "name", "left"), rules, []).select("message")
    twice = named.groupBy("name").count().where("count > 1").selectExpr(
        "concat('featureDefinitions declares \"', name, '\" more than once') AS message"
    )
    absent = canon.join(named, "name", "left_anti").selectExpr(
        "concat('featureDefinitions is missing canonical feature \"', name, '\"') AS message"
    )
    return each.unionByName(twice).unionByName(absent)


def validate_features(table: FeatureTable, options: FeatureOptions) -> DataFrame:
    """Everything wrong with a feature table, as (part, message) rows; empty when it is valid."""
    spark = table.rows.sparkSession
    bad_names = [
        (f"forbidden fantasy-point field present: {n}",)
        for part in table for n in forbidden_fields(part.schema)
    ]
    names = spark.createDataFrame(bad_names, "message string")
    # the catalogue is a short list of names
    declared = {r["name"] for r in table.catalogue.where("name IS NOT NULL").select("name").collect()}
    header = quality.violations(
        table.header, _header_rules(table.rows.count(), options), []
    ).select("message")
    rows = quality.violations(table.rows, _row_rules(table.rows, declared), []).select("message")
    parts = {"names": names, "header": header, "catalogue": _catalogue_problems(table.catalogue),
             "rows": rows}
    out = None
    for part, found in parts.items():
        found = found.select(F.lit(part).alias("part"), "message")
        out = found if out is None else out.unionByName(found)
    return out


def require_valid(table: FeatureTable, options: FeatureOptions) -> None:
    first = validate_features(table, options).limit(1).collect()
    if first:
        raise QualityError(first[0]["message"])
