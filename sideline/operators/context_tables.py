"""Rules of the three seeded context tables: offense labels, team context and landing tags."""

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sideline import config, schemas
from sideline.operators import quality
from sideline.operators.quality import Rule

# fixed vocabularies
LEVELS = ("high", "above_average", "neutral", "below_average", "unknown")
STRENGTHS = ("strong", "moderate", "uncertain", "weak", "unknown")
OFFENSE_ENUMS = {
    "pace_label": LEVELS,
    "pass_rate_label": LEVELS,
    "play_volume_label": LEVELS,
    "qb_stability_label": STRENGTHS,
    "scoring_environment_label": STRENGTHS,
    "rookie_landing_spot_modifier": ("positive", "neutral", "negative", "uncertain"),
    "modifier_strength": ("strong", "moderate", "light", "unknown"),
    "source_status": ("operator_seeded", "public_data_pending", "validated_public_data"),
}
SEED_STATUSES = ("operator_seeded", "operator_seeded_unknown")
CONTEXT_TEAMS = (
    "SF", "CLE", "TEN", "PHI", "LAR", "SEA", "PIT", "WAS", "JAX", "KC", "BUF", "NYG", "MIA", "CHI",
    "HOU", "NO", "NYJ", "ATL", "CAR", "TB", "BAL", "NE", "ARI",
)
KNOWN_RISK_TAGS = (
    "low_pass_volume_risk", "role_specific_usage_dependency",
    "day2_49ers_skill_pick_hit_rate_caution", "browns_offensive_volatility",
    "target_competition_between_rookies", "qb_environment_uncertainty",
    "young_qb_development_dependency", "offense_environment_uncertainty", "depth_chart_volume_cap",
    "target_concentration_ahead", "veteran_depth_chart_block", "delayed_start_path",
    "shared_backfield_context", "workload_projection_risk", "qb_room_uncertainty",
    "steelers_wr_room_watch", "role_projection_uncertainty", "round5_insulation_risk",
    "depth_chart_path_uncertain", "delayed_te_translation_watch", "late_round_role_uncertainty",
    "depth_chart_dependency", "role_competition_risk", "low_draft_capital_insulation",
    "profile_translation_risk", "target_competition_cluster", "role_assignment_uncertainty",
    "target_hierarchy_uncertainty", "offensive_line_dependency", "play_caller_transfer_uncertainty",
    "qb_context_uncertainty", "scheme_transition_variance",
)


class TableRules(NamedTuple):
    """Expected season, teams and closed column set (``exact`` also refuses extra columns)."""

    kind: str
    season: int = 2026
    teams: Sequence[str] = config.LEAGUE_TEAMS
    exact: bool = True

    @property
    def texts(self) -> tuple[str, str]:
        """How the table's messages call a missing team and the number of rows."""
        return ("Missing required team", "team rows") if self.kind == "context" else ("Missing team", "teams")


OFFENSE = TableRules("offense")
CONTEXT = TableRules("context", teams=CONTEXT_TEAMS, exact=False)
LANDING = TableRules("landing", teams=CONTEXT_TEAMS)


def _list(values: Sequence[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _row(message: str) -> str:
    return f"concat('Row ', rowIndex, ': {message}')"


def _filled(column: str) -> Rule:
    return Rule(f"coalesce({column}, '') = ''", _row(f"{column} must be a non-empty string."))


def _tag_array(column: str, unique: bool = True, repeats: str = "must not contain duplicates.") -> list[Rule]:
    """An array of non-empty strings, without repeats."""
    rules = [
        Rule(f"{column} IS NULL", _row(f"{column} must be an array.")),
        Rule(f"NOT forall({column}, t -> coalesce(t, '') <> '')",
             _row(f"{column} must contain non-empty strings.")),
    ]
    if unique:
        rules.append(Rule(f"size(array_distinct({column})) <> size({column})",
                          _row(f"{column} {repeats}")))
    return rules


def _common(table: TableRules) -> list[Rule]:
    whole = [Rule("season IS NULL OR season <> floor(season)", _row("season must be an integer."))]
    return [
        *([] if table.kind == "context" else whole),
        Rule(f"NOT season <=> {table.season}", _row(f"season must equal {table.season}.")),
        Rule("coalesce(team, '') = ''", _row("team must be a non-empty string.")),
        Rule(f"team NOT IN ({_list(table.teams)})",
             f"concat('Row ', rowIndex, ': unknown team code \\'', team, '\\'.')"),
    ]


def _offense_rules() -> list[Rule]:
    rules = [
        Rule(f"coalesce({c}, '') NOT IN ({_list(allowed)})",
             f"concat('Row ', rowIndex, ': invalid {c} \\'', coalesce({c}, 'null'), '\\'.')")
        for c, allowed in OFFENSE_ENUMS.items()
    ]
    rules += [Rule(f"{c} IS NULL", _row(f"{c} must be a string."))
              for c in ("offensive_playcaller", "head_coach", "notes")]
    return rules + _tag_array("context_tags", unique=False)


def _context_rules() -> list[Rule]:
    rules = [_filled(c) for c in ("team_name", "head_coach", "offensive_coordinator", "play_caller",
                                  "qb_context", "notes")]
    for c in ("positive_team_context_tags", "risk_team_context_tags", "offensive_identity_tags",
              "personnel_usage_tags", "pace_pass_environment_tags", "rookie_landing_context_tags"):
        rules += _tag_array(c)
    tags = "coalesce({}, array())".format
    both = f"array_union({tags('positive_team_context_tags')}, {tags('risk_team_context_tags')})"
    rules += [
        Rule(f"arrays_overlap({tags('positive_team_context_tags')}, array({_list(KNOWN_RISK_TAGS)}))",
             _row("positive_team_context_tags includes known risk tag(s).")),
        Rule(f"size(array_except({both}, {tags('rookie_landing_context_tags')})) > 0",
             _row("rookie_landing_context_tags must include all positive/risk tags.")),
        Rule(f"coalesce(source_status, '') NOT IN ({_list(SEED_STATUSES)})",
             _row(f"source_status must be one of {', '.join(SEED_STATUSES)}.")),
    ]
    return rules


def _landing_rules() -> list[Rule]:
    rules = [_filled("team_name")]
    for c in ("context_tags", "positive_context_tags", "risk_context_tags"):
        rules += _tag_array(c, repeats="must not include duplicate tags.")
    tags = "coalesce({}, array())".format
    both = f"array_union({tags('positive_context_tags')}, {tags('risk_context_tags')})"
    rules += [
        Rule(f"size(array_except({both}, {tags('context_tags')})) > 0"
             f" OR size(array_except({tags('context_tags')}, {both})) > 0",
             _row("context_tags must match positive_context_tags + risk_context_tags.")),
        Rule("notes IS NULL", _row("notes must be a string.")),
        Rule(f"coalesce(source_status, '') NOT IN ({_list(SEED_STATUSES)})",
             f"concat('Row ', rowIndex, ': invalid source_status \\'', coalesce(source_status, 'null'), '\\'.')"),
    ]
    return rules


_RULES = {"offense": _offense_rules, "context": _context_rules, "landing": _landing_rules}


def column_problems(df: DataFrame, table: TableRules) -> list[str]:
    """Missing and (for closed tables) unexpected columns; a frame has the same ones in all rows."""
    wanted = schemas.context_schema(table.kind).names
    have = [c for c in df.columns if c != "rowIndex"]
    missing, extra = sorted(set(wanted) - set(have)), sorted(set(have) - set(wanted))
    found = [f"missing required fields: {missing}"] if missing else []
    return found + ([f"unexpected fields: {extra}"] if extra and table.exact else [])


def table_problems(df: DataFrame, table: TableRules) -> DataFrame:
    """Everything wrong with a context table, as (rule, team, message) rows.

    ``df`` needs a ``rowIndex`` column. Table-level findings (columns, repeats, missing teams, row
    count) have rule -1.
    """
    spark = df.sparkSession
    found = [(-1, None, c) for c in column_problems(df, table)]
    columns = spark.createDataFrame(found, "rule int, team string, message string")
    # a missing column is a null in every row: all other rules still apply
    wanted = schemas.context_schema(table.kind)
    df = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in wanted if f.name not in df.columns})
    rules = _common(table) + _RULES[table.kind]()
    by_row = quality.violations(df, rules, ["team"]).select("rule", "team", "message")

    missing, lines = table.texts
    league = spark.createDataFrame([(t,) for t in table.teams], "team string")
    per_team = df.where("team IS NOT NULL").groupBy("team").agg(F.count(F.lit(1)).alias("n"))
    twice = per_team.where("n > 1").selectExpr(
        "-1 AS rule", "team", "concat('duplicate team code \\'', team, '\\' (', n, ' rows).') AS message"
    )
    absent = league.join(per_team, "team", "left_anti").selectExpr(
        "-1 AS rule", "team", f"concat('{missing}: ', team) AS message"
    )
    size = df.agg(F.count(F.lit(1)).alias("n")).where(f"n <> {len(table.teams)}").selectExpr(
        "-1 AS rule", "string(NULL) AS team",
        f"concat('Expected {len(table.teams)} {lines}, found ', n, '.') AS message",
    )
    return columns.unionByName(by_row).unionByName(twice).unionByName(absent).unionByName(size)
