"""Files of the three seeded context tables: every rule, those on types included."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sideline import schemas
from sideline.functions import variants as v
from sideline.functions.lineage import written
from sideline.operators import context_tables as t
from sideline.operators import quality
from sideline.operators.quality import Rule
from sideline.sources.variant_documents import exploded


def _at(column: str) -> str:
    return f"fields['{column}']"


def _text_rule(column: str, filled: bool) -> Rule:
    text = v.string(_at(column))
    said = "a non-empty string" if filled else "a string"
    return Rule(f"coalesce({text}, '') = ''" if filled else f"{text} IS NULL", t._row(f"{column} must be {said}."))


def _enum_rule(column: str, allowed) -> Rule:
    return Rule(f"NOT coalesce({v.string(_at(column))} IN ({t._list(allowed)}), false)",
                f"concat('Row ', rowIndex, ': invalid {column} \\'', {v.shown(_at(column))}, '\\'.')")


def _tags(column: str) -> str:
    """The texts of a tag array; empty for what is no array."""
    return f"coalesce(transform({v.items(_at(column))}, i -> {v.shown('i')}), array())"


def _tag_rules(column: str, unique: bool = True, repeats: str = "must not contain duplicates.") -> list[Rule]:
    held = v.items(_at(column))
    rules = [
        Rule(f"NOT {v.is_a(_at(column), 'array')}", t._row(f"{column} must be an array.")),
        Rule(f"exists({held}, i -> coalesce({v.string('i')}, '') = '')", t._row(f"{column} must contain non-empty strings.")),
    ]
    if unique:
        rules.append(Rule(f"size(array_distinct({_tags(column)})) <> size({held})", t._row(f"{column} {repeats}")))
    return rules


def _union(*columns: str) -> str:
    both = _tags(columns[0])
    for column in columns[1:]:
        both = f"array_union({both}, {_tags(column)})"
    return both


def _own_rules(kind: str) -> list[Rule]:
    statuses = f"coalesce({v.string(_at('source_status'))} IN ({t._list(t.SEED_STATUSES)}), false)"
    if kind == "offense":
        rules = [_enum_rule(c, allowed) for c, allowed in t.OFFENSE_ENUMS.items()]
        rules += [_text_rule(c, False) for c in ("offensive_playcaller", "head_coach", "notes")]
        return rules + _tag_rules("context_tags", unique=False)
    if kind == "context":
        rules = [_text_rule(c, True) for c in ("team_name", "head_coach", "offensive_coordinator", "play_caller", "qb_context", "notes")]
        for c in schemas._TAG_COLUMNS["context"]:
            rules += _tag_rules(c)
        both = _union("positive_team_context_tags", "risk_team_context_tags")
        return rules + [
            Rule(f"arrays_overlap({_tags('positive_team_context_tags')}, array({t._list(t.KNOWN_RISK_TAGS)}))",
                 t._row("positive_team_context_tags includes known risk tag(s).")),
            Rule(f"size(array_except({both}, {_tags('rookie_landing_context_tags')})) > 0",
                 t._row("rookie_landing_context_tags must include all positive/risk tags.")),
            Rule(f"NOT {statuses}", t._row(f"source_status must be one of {', '.join(t.SEED_STATUSES)}.")),
        ]
    rules = [_text_rule("team_name", True)]
    for c in schemas._TAG_COLUMNS["landing"]:
        rules += _tag_rules(c, repeats="must not include duplicate tags.")
    both, tags = _union("positive_context_tags", "risk_context_tags"), _tags("context_tags")
    return rules + [
        Rule(f"size(array_except({both}, {tags})) > 0 OR size(array_except({tags}, {both})) > 0",
             t._row("context_tags must match positive_context_tags + risk_context_tags.")),
        _text_rule("notes", False),
        _enum_rule("source_status", t.SEED_STATUSES),
    ]


def row_rules(table: t.TableRules) -> list[Rule]:
    """Rules of one row of a file; all but the first need an object. A boolean counts as an integer here."""
    wanted = sorted(schemas.context_schema(table.kind).names)
    names = f"array({t._list(wanted)})"
    listed = lambda x: f"concat('[\\'', array_join(array_sort({x}), '\\', \\''), '\\']')"
    missing, extra = f"array_except({names}, map_keys(fields))", f"array_except(map_keys(fields), {names})"
    rules = [Rule(f"size({missing}) > 0", f"concat('Row ', rowIndex, ': missing required fields: ', {listed(missing)})")]
    if table.exact:
        rules.append(Rule(f"size({extra}) > 0", f"concat('Row ', rowIndex, ': unexpected fields: ', {listed(extra)})"))
    if table.kind != "context":
        rules.append(Rule(f"NOT {v.is_a(_at('season'), 'integer', 'boolean')}", t._row("season must be an integer.")))
    rules += [
        Rule(f"NOT {v.number(_at('season'))} <=> {table.season}D", t._row(f"season must equal {table.season}.")),
        _text_rule("team", True),
        Rule(f"{v.string(_at('team'))} NOT IN ({t._list(table.teams)})",
             f"concat('Row ', rowIndex, ': unknown team code \\'', {v.shown(_at('team'))}, '\\'.')"),
    ]
    objects = [Rule(f"fields IS NOT NULL AND ({r.bad})", r.message) for r in [*rules, *_own_rules(table.kind)]]
    return [Rule("fields IS NULL", t._row("value must be an object.")), *objects]


def document_problems(values: DataFrame, table: t.TableRules) -> DataFrame:
    """Everything wrong with files of a context table: (sourceFile, rowIndex, message).

    ``values`` has a variant per file (see ``variant_documents``). A file that is no array has that
    finding only; findings on a whole file have no row. Rows and files of any number are checked in
    one pass, and the counts per file and team in another.
    """
    malformed = values.where("value IS NULL").selectExpr("sourceFile", "int(NULL) AS rowIndex", "'Invalid JSON.' AS message")
    arrays = v.is_a("value", "array")
    other = values.where(f"value IS NOT NULL AND NOT {arrays}").selectExpr(
        "sourceFile", "int(NULL) AS rowIndex", "'Top-level JSON value must be an array.' AS message")
    rows = exploded(values.where(arrays), "value", "row")
    by_row = quality.violations(rows, row_rules(table), ["sourceFile", "rowIndex"]).select("sourceFile", "rowIndex", "message")

    teams = written(rows.selectExpr("sourceFile", "rowIndex", f"{v.string(_at('team'))} AS team"), "file-teams")
    seen = Window.partitionBy("sourceFile", "team").orderBy("rowIndex")
    twice = teams.where("team IS NOT NULL").withColumn("place", F.row_number().over(seen)).where("place > 1").selectExpr(
        "sourceFile", "rowIndex", "concat('Row ', rowIndex, ': duplicate team code \\'', team, '\\'.') AS message")
    missing, lines = table.texts
    league = f"array({t._list(table.teams)})"
    of_file = teams.groupBy("sourceFile").agg(
        F.count(F.lit(1)).alias("n"), F.collect_set(F.expr(f"if(team IN ({t._list(table.teams)}), team, NULL)")).alias("present"))
    # a file without rows lacks every team
    of_file = values.where(arrays).select("sourceFile").join(of_file, "sourceFile", "left").selectExpr(
        "sourceFile", "coalesce(n, 0L) AS n", "coalesce(present, array()) AS present")
    absent = of_file.selectExpr("sourceFile", "int(NULL) AS rowIndex", f"explode(array_except({league}, present)) AS team").selectExpr(
        "sourceFile", "rowIndex", f"concat('{missing}: ', team) AS message")
    size = of_file.where(f"n <> {len(table.teams)}").selectExpr(
        "sourceFile", "int(NULL) AS rowIndex", f"concat('Expected {len(table.teams)} {lines}, found ', n, '.') AS message")
    out = malformed
    for part in (other, by_row, twice, absent, size):
        out = out.unionByName(part)
    return out
