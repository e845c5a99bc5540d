"""Stored season reports: declared metadata, fields and values of every document."""

from pyspark.sql import DataFrame

from sideline import config, schemas
from sideline.functions import variants as v
from sideline.functions.lineage import written
from sideline.operators import season_report
from sideline.sources.variant_documents import exploded

#: fixed values: the declared times of a report
_TIMES = ("dataThrough", "sourceSnapshotAt", "generatedAt")


def _md(name: str) -> str:
    return f"coalesce({v.string(f"md['{name}']")}, '')"


def declared_rules() -> list[tuple[str, str, str]]:
    """(code, condition, detail) of the rules on a document's metadata."""
    status, governance, source = map(_md, ("provenanceStatus", "governanceStatus", "governanceSource"))
    times = [_md(t) for t in _TIMES]
    absent = " OR ".join(f"{x} = ''" for x in (status, governance, source))
    untimed = " OR ".join(f"{t} = ''" for t in times)
    latest = f"array_max(transform({v.items("md['upstreamSnapshots']")}, s -> {v.string('s')}))"
    origins = f"filter(transform(map_values({v.fields("md['timeOrigins']")}), o -> {v.string('o')}), o -> o <> '')"
    version = "md['methodologyVersion']"
    known = ", ".join(f"'{m}'" for m in config.REPORT_METHODOLOGIES)
    return [
        ("E_PROVENANCE_MISSING", absent, "'provenance or governance markers absent'"),
        ("E_PROVENANCE_NOT_GOVERNED", f"NOT ({absent}) AND NOT ({status} = 'governed_real_data' AND {governance} = 'governed' AND {source} = 'explicit_marker')",
         f"concat_ws(', ', {status}, {governance}, {source})"),
        ("E_GOVERNED_INPUT_CHECKSUM_MISMATCH", f"{_md('checksum')} = '' OR {_md('checksum')} <> {_md('expectedChecksum')}", "'checksum absent or different'"),
        ("E_TEMPORAL_METADATA_MISSING", untimed, f"'{', '.join(_TIMES)}'"),
        ("E_TEMPORAL_METADATA_CONFLATED", f"NOT ({untimed}) AND coalesce({times[1]} <> {latest}, false)", "'sourceSnapshotAt is not the latest snapshot'"),
        ("E_TEMPORAL_METADATA_CONFLATED", f"coalesce(size(array_distinct({origins})) < size({origins}), false)", "'two time fields are wired to one source'"),
        ("E_METHODOLOGY_VERSION_UNKNOWN", f"{version} IS NOT NULL AND NOT coalesce({v.string(version)} IN ({known}), false)", v.shown(version)),
    ]


def _base(key: str) -> str:
    return f"regexp_replace({key}, '(PerGame|Total)$', '')"


def _names(values) -> str:
    return ", ".join(f"'{x}'" for x in values)


def document_problems(values: DataFrame, rows: DataFrame) -> DataFrame:
    """(sourceFile, code, team, detail) of stored reports.

    ``values`` has a variant per file: an object with ``metadata`` and ``rows``. ``rows`` are the
    team-weeks that the reports are made from; they are read once, for the weighted report that every
    line has to equal. Declared metadata are typed columns of one rule table, fields are the keys that any row of a document has, and lines meet
    the weighted report by season and team, all documents at once.
    """
    docs = written(values.selectExpr("sourceFile", f"{v.fields('value')} AS doc").selectExpr(
        "sourceFile", "doc", f"{v.fields("doc['metadata']")} AS md"), "reports")
    items = ", ".join(
        f"CASE WHEN coalesce({bad}, true) THEN named_struct('code', '{code}', 'detail', {detail}) END" for code, bad, detail in declared_rules())
    found = docs.selectExpr("sourceFile", "coalesce(md, map()) AS md").selectExpr("sourceFile", f"inline(array_compact(array({items})))").selectExpr(
        "sourceFile", "code", "string(NULL) AS team", "detail")
    digests = docs.selectExpr("sourceFile", f"explode({v.fields("md['upstreamChecksums']")}) AS (name, digest)").where(
        f"NOT coalesce({v.string('digest')} RLIKE '^[0-9a-f]{{64}}$', false)")
    out = found.unionByName(digests.selectExpr(
        "sourceFile", "'E_UPSTREAM_SOURCE_CHECKSUM_MISSING' AS code", "string(NULL) AS team", "concat('upstream source ', name) AS detail"))

    lines = written(exploded(docs, "doc['rows']", "line").selectExpr(
        "sourceFile", f"{v.string("fields['team']")} AS team", f"int({v.number("fields['season']")}) AS season", "fields",
        f"{v.number("fields['redZoneTripsTotal']")} AS trips", *[f"{v.number(f"fields['{r}']")} AS {r}" for r in config.REPORT_RATES]), "report-lines")
    held = lines.selectExpr("sourceFile", "team", "explode(fields) AS (field, x)")
    withheld = _names((*config.REPORT_WITHHELD, *schemas.FANTASY_FIELDS))
    kept = f"(field IN ({withheld}) OR {_base('field')} IN ({withheld}))"
    keys = held.select("sourceFile", "field").distinct().selectExpr("sourceFile", "field", f"{kept} AS kept")
    named = {
        "E_WITHHELD_FIELD_PRESENT": "kept",
        "E_APPROXIMATED_DENOMINATOR_UNAUTHORIZED": f"kept AND {_base('field')} IN ({_names(config.REPORT_BLOCKED)})",
        "E_UNDOCUMENTED_FIELD_PRESENT": f"NOT kept AND field NOT IN ({_names(season_report.report_columns())})",
    }
    for code, bad in named.items():
        out = out.unionByName(keys.where(bad).selectExpr("sourceFile", f"'{code}' AS code", "string(NULL) AS team", "field AS detail"))
    zeros = held.where(f"{kept} AND {v.number('x')} = 0").selectExpr("sourceFile", "'E_WITHHELD_FIELD_ZERO_FILLED' AS code", "team", "field AS detail")
    red = lines.where("(redZoneTdRate IS NULL) <> coalesce(trips = 0, false)").selectExpr(
        "sourceFile", "'E_REDZONE_NULL_INVARIANT_VIOLATED' AS code", "team", "concat('redZoneTripsTotal ', bigint(trips)) AS detail")

    right = season_report.season_report(rows).selectExpr("season", "team", *[f"{r} AS right_{r}" for r in config.REPORT_RATES])
    wanted = lines.select("sourceFile", "season").distinct().join(right, "season").selectExpr("*", "true AS computed")
    off = ", ".join(f"CASE WHEN NOT {r} <=> right_{r} THEN '{r}' END" for r in config.REPORT_RATES)
    unweighted = lines.selectExpr("sourceFile", "season", "team", *config.REPORT_RATES, "true AS reported").join(wanted, ["sourceFile", "season", "team"], "full").selectExpr(
        "sourceFile", "'E_UNWEIGHTED_AGGREGATION_USED' AS code", "team",
        "explode(CASE WHEN computed IS NULL THEN array(concat('season ', season, ': reported without rows')) "
        "WHEN reported IS NULL THEN array(concat('season ', season, ': rows without a report line')) "
        f"ELSE array_compact(array({off})) END) AS detail")
    for part in (zeros, red, unweighted):
        out = out.unionByName(part)
    return out
