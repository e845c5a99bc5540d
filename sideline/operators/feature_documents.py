"""Stored feature documents: the whole contract, checked on the values as they were written."""

from pyspark.sql import DataFrame

from sideline import config
from sideline.functions import variants as v
from sideline.functions.lineage import written
from sideline.functions.numeric import MAX_DOUBLE
from sideline.operators import quality
from sideline.operators.features import FeatureOptions
from sideline.operators.quality import QualityError, Rule
from sideline.sources.variant_documents import exploded


def _list(values) -> str:
    return ", ".join(f"'{x}'" for x in values)


def _within(value: str, allowed) -> str:
    return f"coalesce({v.string(value)} IN ({_list(allowed)}), false)"


def _choice(value: str, path: str, allowed) -> Rule:
    return Rule(f"NOT {_within(value, allowed)}", f"concat({path}, ' must be one of {', '.join(allowed)}')")


def _filled(value: str, path: str, said: str = "a non-empty string") -> Rule:
    return Rule(f"coalesce({v.string(value)}, '') = ''", f"concat({path}, ' must be {said}')")


def _typed(value: str, path: str, said: str, *kinds: str) -> Rule:
    return Rule(f"NOT {v.is_a(value, *kinds)}", f"concat({path}, ' must be {said}')")


def document_rules(options: FeatureOptions) -> list[Rule]:
    """Rules of the envelope, its governance and its coverage; rows have ``doc``, ``gov`` and ``cov`` as maps."""
    q = quality.text
    fixed = {
        "artifact": config.CONTRACT_FEATURES, "contractVersion": config.CONTRACT_FEATURES,
        "owningRepo": options.owner, "intendedConsumer": options.consumer, "outputKind": options.output_kind,
    }
    object_ = v.is_a("value", "object")
    rules = [Rule(f"NOT {v.string(f"doc['{f}']")} <=> '{said}'", q(f'{f} must be "{said}"')) for f, said in fixed.items()]
    rules += [_filled(f"doc['{f}']", q(f), "a non-empty ISO string") for f in ("generatedAt", "cutoffAt")]
    rules += [_typed(f"doc['{f}']", q(f), "a number", "integer", "number") for f in ("featureSeason", "targetSeason")]
    rules.append(Rule("gov IS NULL", q("governance must be an object")))
    inside = [
        _choice("gov['governanceStatus']", q("governance.governanceStatus"), config.GOVERNANCE_STATUSES),
        _choice("gov['governanceSource']", q("governance.governanceSource"), config.GOVERNANCE_SOURCES),
        _filled("gov['generatedAt']", q("governance.generatedAt"), "a non-empty ISO string"),
    ]
    rules += [Rule(f"gov IS NOT NULL AND {r.bad}", r.message) for r in inside]
    rules.append(Rule("cov IS NULL", q("coverage must be an object")))
    inside = [_typed(f"cov['{f}']", q(f"coverage.{f}"), "a number", "integer", "number") for f in ("teamCount", "expectedTeamCount")]
    inside.append(_typed("cov['isFullLeague']", q("coverage.isFullLeague"), "a boolean", "boolean"))
    inside += [_typed(f"cov['{f}']", q(f"coverage.{f}"), "an array", "array") for f in ("seasons", "weeks")]
    count, expected = v.number("cov['teamCount']"), v.number("cov['expectedTeamCount']")
    full = f"if({v.is_a("cov['isFullLeague']", 'boolean')}, variant_get(cov['isFullLeague'], '$', 'boolean'), NULL)"
    inside += [
        Rule(f"coalesce({count} <> size(teams), false)",
             f"concat('coverage.teamCount (', {v.shown("cov['teamCount']")}, ') must equal the number of team rows (', size(teams), ')')"),
        Rule(f"coalesce({full} <> ({count} = {expected}), false)",
             f"concat('coverage.isFullLeague (', {full}, ') must be ', {count} = {expected}, ' when teamCount=', "
             f"{v.shown("cov['teamCount']")}, ' and expectedTeamCount=', {v.shown("cov['expectedTeamCount']")})"),
    ]
    rules += [Rule(f"cov IS NOT NULL AND {r.bad}", r.message) for r in inside]
    rules.append(Rule("coalesce(size(defs), 0) <= 0", q("featureDefinitions must be a non-empty array")))
    rules.append(Rule("teams IS NULL", q("teams must be an array")))
    return [
        Rule("value IS NULL", q("invalid JSON")), Rule(f"value IS NOT NULL AND NOT {object_}", q("artifact must be an object")),
        *[Rule(f"{object_} AND ({r.bad})", r.message) for r in rules],
    ]


def definition_rules() -> list[Rule]:
    """Rules of one item of featureDefinitions."""
    at = "concat('featureDefinitions[', rowIndex, ']{}')"
    name, kind = v.string("fields['name']"), v.string("fields['type']")
    wanted = "CASE " + name + " " + " ".join(f"WHEN '{n}' THEN '{rule[0]}'" for n, rule in config.FEATURES.items()) + " END"
    rules = [
        Rule(f"coalesce({kind} <> {wanted}, {wanted} IS NOT NULL)",
             f"concat('featureDefinitions[', rowIndex, '].type for \"', {name}, '\" must be \"', {wanted}, '\"')"),
        Rule(f"{wanted} IS NULL AND NOT coalesce({kind} IN ('number', 'direction', 'tier'), false)",
             f"concat({at.format('.type')}, ' must be one of number, direction, tier')"),
        _filled("fields['description']", at.format(".description")),
        *[_typed(f"fields['{f}']", at.format(f".{f}"), "a boolean", "boolean") for f in ("allowedInModel", "allowedInPosthocExplanation")],
    ]
    named = f"coalesce({name}, '') <> ''"
    return [
        Rule("fields IS NULL", f"concat({at.format('')}, ' must be an object')"),
        Rule(f"fields IS NOT NULL AND NOT ({named})", f"concat({at.format('.name')}, ' must be a non-empty string')"),
        *[Rule(f"fields IS NOT NULL AND {named} AND ({r.bad})", r.message) for r in rules],
    ]


def team_rules() -> list[Rule]:
    """Rules of one item of teams and of the values of its canonical features."""
    at = "concat('teams[', rowIndex, ']{}')"
    confidence = v.number("fields['confidence']")
    rules = [_filled(f"fields['{f}']", at.format(f".{f}")) for f in ("teamId", "teamAbbr", "cutoffAt")]
    rules.append(_typed("fields['season']", at.format(".season"), "a number", "integer", "number"))
    rules.append(_choice("fields['featureCoverageStatus']", at.format(".featureCoverageStatus"), config.FEATURE_COVERAGE))
    rules.append(Rule(f"NOT coalesce({confidence} BETWEEN 0 AND 1, false)", f"concat({at.format('.confidence')}, ' must be a number in [0, 1]')"))
    rules += [_typed(f"fields['{f}']", at.format(f".{f}"), "an array", "array") for f in ("warnings", "sourceDatasetRefs")]
    rules.append(Rule("features IS NULL", f"concat({at.format('.features')}, ' must be an object')"))
    for name, (kind, allowed, _, _) in config.FEATURES.items():
        value, path = f"features['{name}']", at.format(f".features.{name}")
        if kind == "number":
            finite = f"coalesce(abs({v.number(value)}) <= {MAX_DOUBLE}, false)"
            rule = Rule(f"NOT ({v.is_a(value, 'null')} OR {finite})", f"concat({path}, ' must be a finite number or null')")
        else:
            rule = _choice(value, path, allowed)
        rules.append(Rule(f"coalesce(map_contains_key(features, '{name}'), false) AND {rule.bad}", rule.message))
    objects = [Rule(f"fields IS NOT NULL AND ({r.bad})", r.message) for r in rules]
    return [Rule("fields IS NULL", f"concat({at.format('')}, ' must be an object')"), *objects]


def document_problems(values: DataFrame, options: FeatureOptions) -> DataFrame:
    """Everything wrong with stored feature documents: (sourceFile, part, message).

    ``values`` has a variant per file (see ``variant_documents``). Names that spell fantasy points in any
    case and with any punctuation are refused as keys at any depth, also inside parts that the
    contract does not know. Documents, definitions and teams are rows of their own, so any number of
    files and teams is checked in parallel; nothing goes to the driver.
    """
    parts = values.selectExpr("sourceFile", "value", f"{v.fields('value')} AS doc")
    parts = written(parts.selectExpr(
        "sourceFile", "value", "doc", f"{v.fields("doc['governance']")} AS gov", f"{v.fields("doc['coverage']")} AS cov",
        f"{v.items("doc['featureDefinitions']")} AS defs", f"{v.items("doc['teams']")} AS teams"), "feature-documents")
    names = v.key_tokens("to_json(value)")
    letters = "regexp_replace(lower(key), '[^a-z]', '')"
    forbidden = parts.where("doc IS NOT NULL").selectExpr("sourceFile", f"explode({names}) AS key").where(
        f"contains({letters}, '{config.FORBIDDEN_KEY}')").selectExpr("sourceFile", "'names' AS part", "concat('forbidden fantasy-point field present: ', key) AS message")
    whole = quality.violations(parts, document_rules(options), ["sourceFile"]).selectExpr("sourceFile", "'document' AS part", "message")

    name_of = lambda d: v.string(f"{v.fields(d)}['name']")
    named = f"filter(transform(coalesce(defs, array()), d -> {name_of('d')}), n -> n <> '')"
    declared = parts.where("doc IS NOT NULL").selectExpr("sourceFile", "defs", "teams", f"{named} AS names")
    canonical = f"array({_list(config.FEATURES)})"
    sets = {
        "repeated": "explode(transform(filter(sequence(0, size(names)), i -> i >= 1 AND i < size(names) AND array_contains(slice(names, 1, i), names[i])), i -> names[i]))",
        "missing": f"explode(if(coalesce(size(defs), 0) > 0, array_except({canonical}, names), array()))",
        "unknown": f"explode(array_except(array_distinct(names), {canonical}))",
    }
    said = {"repeated": "'featureDefinitions declares \"', n, '\" more than once'", "missing": "'featureDefinitions is missing canonical feature \"', n, '\"'",
            "unknown": "'featureDefinitions declares unknown feature \"', n, '\"'"}
    catalogue = quality.violations(exploded(parts, "doc['featureDefinitions']", "definition"), definition_rules(), ["sourceFile"]).select("sourceFile", "message")
    for rule, rows in sets.items():
        catalogue = catalogue.unionByName(declared.selectExpr("sourceFile", f"{rows} AS n").selectExpr("sourceFile", f"concat({said[rule]}) AS message"))

    teams = declared.selectExpr("sourceFile", "array_distinct(names) AS names", "posexplode(teams) AS (rowIndex, team)").selectExpr(
        "*", f"{v.fields('team')} AS fields").selectExpr("*", f"{v.fields("fields['features']")} AS features")
    each = quality.violations(teams, team_rules(), ["sourceFile"]).select("sourceFile", "message")
    for diff, text in (("array_except(names, map_keys(features))", "'].features is missing declared feature \"'"),
                       ("array_except(map_keys(features), names)", "'].features has undeclared feature \"'")):
        some = teams.where("features IS NOT NULL").selectExpr("sourceFile", "rowIndex", f"explode({diff}) AS n")
        each = each.unionByName(some.selectExpr("sourceFile", f"concat('teams[', rowIndex, {text}, n, '\"') AS message"))
    return forbidden.unionByName(whole).unionByName(
        catalogue.selectExpr("sourceFile", "'catalogue' AS part", "message")).unionByName(each.selectExpr("sourceFile", "'teams' AS part", "message"))


def require_valid(values: DataFrame, options: FeatureOptions) -> None:
    """Raise with the first problem of the first file, by name."""
    first = document_problems(values, options).orderBy("sourceFile", "part", "message").limit(1).collect()
    if first:
        raise QualityError(f"{first[0]['sourceFile']}: {first[0]['message']}")
