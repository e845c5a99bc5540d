"""Registered queries over documents of any shape: files that are written, spoiled in many ways, scanned and checked."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sideline import config, schemas
from sideline.functions import lineage
from sideline.operators import context_documents, context_tables, feature_documents, provenance, report_documents, season_report
from sideline.operators.features import FeatureOptions
from sideline.plans import jobs
from sideline.plans.lanes import LEAGUE, NATIONS, SEASON
from sideline.sinks import publication
from sideline.sources import checksum, documents, star_schema, variant_documents

NATION = "int(substring(team, 8))"


def _folder(spark: SparkSession, label: str) -> str:
    return lineage.owned(f"{lineage.shared_folder(spark)}/{label}-{uuid.uuid4().hex}")


def stored_texts(docs: DataFrame) -> DataFrame:
    """Write (name, text) as a file per name; returns the files' texts as (sourceFile, text)."""
    spark = docs.sparkSession
    path = _folder(spark, "texts")
    docs.write.partitionBy("name").text(path)
    read = spark.read.schema("value string, name string").text(path, wholetext=True)
    return read.selectExpr("name AS sourceFile", "value AS text")


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _chosen(texts: list[str]) -> str:
    """SQL of the text by ``code``; null beyond the last."""
    return f"try_element_at(array({', '.join(map(_literal, texts))}), code + 1)"


# --- the three seeded tables ---


def context_row(kind: str) -> dict:
    """A row without a fault; @ stands for the team."""
    row = {"season": SEASON, "team": "@"} | {c: "x" for c in schemas._TEXT_COLUMNS[kind] if c != "team"}
    row |= {c: ["calm", "risky"] for c in schemas._TAG_COLUMNS[kind]} | {"source_status": "operator_seeded"}
    row |= {c: ["calm"] for c in row if c.startswith("positive")} | {c: ["risky"] for c in row if c.startswith("risk")}
    return row | ({c: allowed[0] for c, allowed in context_tables.OFFENSE_ENUMS.items()} if kind == "offense" else {})


def context_spoils(kind: str) -> list[dict | None]:
    """Changes of a row by code: every rule has some; a value None takes the field out, a change None the whole object."""
    out: list[dict | None] = [{"season": str(SEASON)}, {"season": SEASON - 1}, {"team": 7}, {"team": ""}, {"team": "XX"}, {"team": "NATION_0"}]
    out.append({"more": 1, "also": 2})
    out += [{c: "odd"} for c in (context_tables.OFFENSE_ENUMS if kind == "offense" else ["source_status"])]
    out += [{c: 3} for c in schemas._TEXT_COLUMNS[kind] if c not in ("team", "source_status") and c not in context_tables.OFFENSE_ENUMS]
    out += [{c: "calm"} for c in schemas._TAG_COLUMNS[kind]]
    out += [{c: 2 * context_row(kind)[c]} for c in schemas._TAG_COLUMNS[kind]]
    out += [{schemas._TAG_COLUMNS[kind][0]: ["calm", "risky", 4]}, {schemas._TAG_COLUMNS[kind][-1]: []}, {"notes": None}, None]
    if kind == "context":
        out.append({"positive_team_context_tags": ["role_competition_risk"], "rookie_landing_context_tags": ["role_competition_risk", "risky"]})
    return out


def context_files(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """A file per season; its rows are spoiled in the way of season and nation, some stay whole."""
    spoils, row = context_spoils(kind), context_row(kind)
    texts = ["[]" if s is None else json.dumps({k: x for k, x in (row | s).items() if x is not None}) for s in spoils]
    pairs = star_schema.team_weeks(spark, folder).select("season", "team").distinct()
    coded = pairs.selectExpr("*", f"(season * 7 + {NATION} * 3) % {len(spoils) + 6} AS code")
    rows = coded.selectExpr("season", "team", f"replace(coalesce({_chosen(texts)}, {_literal(json.dumps(row))}), '@', team) AS text")
    files = rows.groupBy("season").agg(F.sort_array(F.collect_list(F.struct("team", "text"))).alias("rows"))
    return stored_texts(files.selectExpr("concat('[', array_join(transform(rows, r -> r.text), ','), ']') AS text", "string(season) AS name"))


def _context(kind: str):
    def run(spark, folder):
        values = variant_documents.read_values(context_files(spark, folder, kind))
        rules = context_tables.TableRules(kind, SEASON, LEAGUE.teams, exact=kind != "context")
        return context_documents.document_problems(values, rules).select("sourceFile", "rowIndex", "message")

    return run


# --- feature documents ---

OPTIONS = FeatureOptions("now", "2012-01-01T00:00:00.000Z", SEASON, SEASON + 1)
_TEXT, _NUMBER = '"{}":"[^"]*"', '"{}":-?[0-9][0-9.E-]*'


def feature_spoils() -> list[tuple[str, str]]:
    """Pattern and replacement in a document's text, by code."""
    number = [n for n, rule in config.FEATURES.items() if rule[0] == "number"]
    choice = [n for n, rule in config.FEATURES.items() if rule[0] != "number"]
    out = [(_TEXT.format(f), f'"{f}":"odd"') for f in ("artifact", "contractVersion", "owningRepo", "intendedConsumer", "outputKind")]
    out += [('^[{]"artifact":', '{"fantasyPoints":1,"artifact":'), ('"weeks":[^]]*]', '"weeks":[{"deep":[{"Fantasy_point total":1}]}]')]
    out += [('"generatedAt":"now"', '"generatedAt":5'), ('^(.*?)"cutoffAt":"[^"]*"', '$1"cutoffAt":""')]
    out += [(_NUMBER.format(f), f'"{f}":"2011"') for f in ("featureSeason", "targetSeason")]
    out += [('"governance":[{][^}]*[}]', '"governance":[]'), (_TEXT.format("governanceStatus"), '"governanceStatus":"odd"'),
            (_TEXT.format("governanceSource"), '"governanceSource":5'), ('"generatedAt":"checked"', '"generatedAt":""')]
    out += [('"coverage":[{][^}]*[}]', '"coverage":"full"')]
    out += [(_NUMBER.format(f), f'"{f}":null') for f in ("teamCount", "expectedTeamCount")]
    out += [('"isFullLeague":[a-z]*', '"isFullLeague":"yes"'), ('"seasons":[^]]*]', '"seasons":"2011"'), ('"weeks":[^]]*]', '"weeks":{}')]
    out += [('"teamCount":1', '"teamCount":2'), ('"isFullLeague":true', '"isFullLeague":false')]
    out += [('"featureDefinitions":[^]]*]', '"featureDefinitions":[]'), ('"teams":.*$', '"teams":{}}')]
    first = f'[{{]"name":"{number[0]}"'
    out += [(first + "[^}]*[}]", "5"), (first, '{"name":""'), (first, '{"name":"invented"'), (first, f'{{"name":"{number[1]}"'),
            (first + ',"type":"number"', f'{{"name":"{number[0]}","type":"tier"'),
            (first + '(.*?)"description":"[^"]*"', f'{{"name":"{number[0]}"$1"description":""'),
            (first + '(.*?)"allowedInModel":true', f'{{"name":"{number[0]}"$1"allowedInModel":1'),
            (first + '(.*?)"allowedInPosthocExplanation":true', f'{{"name":"{number[0]}"$1"allowedInPosthocExplanation":"no"')]
    out.append(('"featureDefinitions":\\[', '"featureDefinitions":[{"name":"new","type":"odd","description":"d","allowedInModel":true,"allowedInPosthocExplanation":true},'))
    out.append(('"teams":.*$', '"teams":[7]}'))
    out += [(_TEXT.format(f), f'"{f}":""') for f in ("teamId", "teamAbbr")] + [('("teams":.*?)"cutoffAt":"[^"]*"', '$1"cutoffAt":5')]
    out += [(_NUMBER.format("season"), '"season":"2011"'), (_TEXT.format("featureCoverageStatus"), '"featureCoverageStatus":"odd"'),
            (_NUMBER.format("confidence"), '"confidence":1.5'), ('"warnings":\\[]', '"warnings":"none"'), ('"sourceDatasetRefs":\\[]', '"sourceDatasetRefs":null')]
    out += [('"features":[{][^}]*[}]', '"features":[]'), (f',"{number[1]}":[^,]*', ""), ('"features":[{]', '"features":{"more":1,')]
    out += [(f'"{n}":(null|-?[0-9][0-9.E-]*)', f'"{n}":"n/a"') for n in number]
    out += [(_TEXT.format(n), f'"{n}":"odd"') for n in choice]
    return [*out, ("[}]$", ""), ("^.*$", "[]")]


def feature_files(spark: SparkSession, folder: str) -> DataFrame:
    """A document per team and season with means of its rows, spoiled in the way of its own number."""
    means = star_schema.team_weeks(spark, folder).groupBy("season", "team").agg(
        *[F.round(F.avg(c), 6).alias(c) for c in ("pointsPerDrive", "epaPerPlay", "successRate", "explosivePlayRate", "secondsPerPlay", "neutralPassRate")])
    held = {"points_per_drive": "pointsPerDrive", "epa_per_play": "epaPerPlay", "success_rate": "successRate", "explosive_play_rate": "explosivePlayRate",
            "seconds_per_play": "secondsPerPlay", "neutral_pass_rate": "neutralPassRate"}
    values = ", ".join(f"'{n}', {held.get(n, 'double(NULL)') if rule[0] == 'number' else repr(rule[1][0])}" for n, rule in config.FEATURES.items())
    defs = ", ".join(
        f"named_struct('name', '{n}', 'type', '{rule[0]}', 'description', 'of a team', 'allowedInModel', true, 'allowedInPosthocExplanation', true)"
        for n, rule in config.FEATURES.items())
    o = OPTIONS
    doc = f"""named_struct('artifact', '{config.CONTRACT_FEATURES}', 'contractVersion', '{config.CONTRACT_FEATURES}', 'generatedAt', '{o.generated_at}',
      'cutoffAt', '{o.cutoff_at}', 'featureSeason', season, 'targetSeason', season + 1, 'owningRepo', '{o.owner}', 'intendedConsumer', '{o.consumer}',
      'outputKind', '{o.output_kind}', 'governance', named_struct('governanceStatus', 'fixture', 'governanceSource', 'explicit_marker', 'generatedAt', 'checked'),
      'coverage', named_struct('teamCount', 1, 'expectedTeamCount', 1, 'isFullLeague', true, 'seasons', array(season), 'weeks', array(1)),
      'featureDefinitions', array({defs}), 'teams', array(named_struct('teamId', team, 'teamAbbr', team, 'season', season, 'cutoffAt', '{o.cutoff_at}',
      'features', named_struct({values}), 'featureCoverageStatus', 'partial', 'confidence', 0.5D, 'warnings', array(), 'sourceDatasetRefs', array())))"""
    spoils = feature_spoils()
    coded = means.selectExpr("*", f"(season * 25 + {NATION}) % {len(spoils) + 5} AS code").selectExpr(
        "concat(season, '-', team) AS name", "code", f"to_json({doc}, map('ignoreNullFields', 'false')) AS text")
    changed = f"regexp_replace(text, {_chosen([a for a, _ in spoils])}, {_chosen([b for _, b in spoils])})"
    return stored_texts(coded.selectExpr(f"if(code < {len(spoils)}, {changed}, text) AS text", "name"))


def _features(spark, folder):
    values = variant_documents.read_values(feature_files(spark, folder))
    return feature_documents.document_problems(values, OPTIONS).select("sourceFile", "part", "message")


# --- manifests and publication ---


def _manifest(spark, folder):
    """A file per team and season against a manifest that is wrong in four ways."""
    weeks = star_schema.team_weeks(spark, folder).groupBy("season", "team").agg(F.sort_array(F.collect_list(F.struct("week", "pointsFor"))).alias("weeks"))
    path = _folder(spark, "pinned")
    weeks.selectExpr("concat(season, '-', team) AS name", "to_json(weeks) AS text").write.partitionBy("name").text(path)
    found = lineage.written(checksum.folder_manifest(spark, path), "digests")
    name = "regexp_extract(file, 'name=([^/]*)', 1)"
    coded = found.selectExpr("file", "sha256", f"pmod(int(substring({name}, 13)) + int(substring({name}, 1, 4)), 6) AS code")
    listed = coded.where("code <> 1").selectExpr("file", "if(code = 0, repeat('0', 64), sha256) AS sha256")
    gone = coded.where("code = 2").selectExpr("concat(file, '.gone') AS file", "sha256")
    twice = coded.where("code = 3").selectExpr("file", "repeat('1', 64) AS sha256")
    equal = coded.where("code = 4").select("file", "sha256")
    problems = checksum.manifest_problems(found, listed.unionByName(gone).unionByName(twice).unionByName(equal))
    return problems.selectExpr(f"{name} AS name", "endswith(file, '.gone') AS invented", "problem", "expected IS NOT NULL AS listed", "found IS NOT NULL AS there")


def _published(spark, folder):
    """A run, published; then one that fails half-way. Every data set of the first is read back."""
    run = jobs.analyse(star_schema.team_weeks(spark, folder), generated_at="now")
    out = _folder(spark, "published")
    jobs.publish_run(run, out)
    names = [*jobs.datasets(run), "rankings"]
    broken = spark.range(1).select(F.raise_error(F.lit("half-way")).cast("int").alias("x"))
    try:
        publication.publish(spark, {"weekly_states": publication.Dataset(run.metadata), "last": publication.Dataset(broken)}, out)
    except Exception as error:  # noqa: BLE001
        if "half-way" not in str(error):
            raise
    counts = None
    for name in names:
        rows = publication.read_dataset(spark, out, name).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("dataset"), "rows")
        counts = rows if counts is None else counts.unionByName(rows)
    wrong = publication.published_problems(spark, out).agg(F.count(F.lit(1)).alias("wrong"))
    return counts.join(publication.contents(spark, out).where("bytes > 0").select("dataset"), "dataset").crossJoin(wrong)


# --- season reports ---


def report_spoils() -> list[tuple[str, str]]:
    """Pattern and replacement in a report's text, by code."""
    row = '"drivesTotal":'
    return [
        ("^$", ""), ('"provenanceStatus":"[^"]*"', '"provenanceStatus":""'), (',"governanceSource":"[^"]*"', ""),
        ('"provenanceStatus":"[^"]*"', '"provenanceStatus":"sample"'), ('"expectedChecksum":"[^"]*"', '"expectedChecksum":"other"'),
        ('"generatedAt":"[^"]*"', '"generatedAt":null'), ('"sourceSnapshotAt":"[^"]*"', '"sourceSnapshotAt":"2012-01-15"'),
        ('"timeOrigins":[{][^}]*[}]', '"timeOrigins":{"dataThrough":"a","generatedAt":"a"}'),
        ('"upstreamChecksums":[{][^}]*[}]', '"upstreamChecksums":{"plays":"b","games":null}'),
        ('"methodologyVersion":"[^"]*"', '"methodologyVersion":"x"'), (row, f'"passRate":0.4,{row}'), (row, f'"pointsAgainstTotal":0,{row}'),
        (row, f'"mood":1,{row}'), ('"epaPerPlay":-?[0-9.E-]*', '"epaPerPlay":7.5'), ('"redZoneTdRate":[0-9.E-]+', '"redZoneTdRate":null'),
        ('"metadata":[{].*?[}],"rows"', '"metadata":[],"rows"'),
    ]


def _reports(spark, folder):
    """A report per season and way of spoiling it, against the rows it is made from."""
    rows = lineage.written(star_schema.governed_weeks(spark, folder), "governed")
    report = season_report.season_report(rows)
    names = [*season_report.report_columns()]
    line = "named_struct(" + ", ".join(f"'{n}', {n}" for n in names) + ")"
    seasons = report.groupBy("season").agg(F.sort_array(F.collect_list(F.expr(f"struct(team, to_json({line}, map('ignoreNullFields', 'false')) AS text)"))).alias("lines"))
    digest = "a" * 64
    metadata = json.dumps({
        "provenanceStatus": "governed_real_data", "governanceStatus": "governed", "governanceSource": "explicit_marker", "checksum": digest, "expectedChecksum": digest,
        "dataThrough": "2012-01-01", "sourceSnapshotAt": "2012-02-01", "generatedAt": "2012-03-01", "upstreamSnapshots": ["2012-01-15", "2012-02-01"],
        "upstreamChecksums": {"plays": digest}, "methodologyVersion": config.REPORT_METHODOLOGIES[0], "timeOrigins": {"dataThrough": "a", "generatedAt": "b"},
    }, separators=(",", ":"))
    spoils = report_spoils()
    docs = seasons.selectExpr("season", f"concat('{{\"metadata\":', {_literal(metadata)}, ',\"rows\":[', array_join(transform(lines, l -> l.text), ','), ']}}') AS text",
                              f"explode(sequence(0, {len(spoils) - 1})) AS code")
    changed = f"regexp_replace(text, {_chosen([a for a, _ in spoils])}, {_chosen([b for _, b in spoils])})"
    texts = stored_texts(docs.selectExpr(f"{changed} AS text", "concat(season, '-', code) AS name"))
    return report_documents.document_problems(variant_documents.read_values(texts), rows)


# --- provenance of every document ---

MARKERS = (*config.PROVENANCE, "promoted", None)
PLACES = ("data/sample/", "fixtures/", "elsewhere/", "./data/sample/")


def _provenance(spark, folder):
    """A document per week, under changing paths and with changing markers: both ladders per file."""
    weeks = star_schema.team_weeks(spark, folder).groupBy("season", "week").agg(F.sort_array(F.collect_list(F.struct(F.col("team").alias("teamCode")))).alias("rows"))
    marker = "element_at(array(" + ", ".join(f"'{m}'" if m else "NULL" for m in MARKERS) + f"), 1 + (season * 12 + week) % {len(MARKERS)})"
    place = "element_at(array(" + ", ".join(f"'{p}'" for p in PLACES) + f"), 1 + (season + week) % {len(PLACES)})"
    docs = weeks.selectExpr(
        f"concat({place}, season, '-', week, '.json') AS sourceFile",
        f"to_json(named_struct('artifact', '{config.ARTIFACT_RAW}', 'metadata', named_struct('provenanceStatus', {marker}), 'rows', rows)) AS text")
    parsed = documents.parsed_once(docs)
    declared = parsed.selectExpr("sourceFile", "get_json_object(metadata, '$.provenanceStatus') AS marker")
    rows = documents.envelope_records(parsed).selectExpr("sourceFile", "teamCode AS team")
    found = provenance.document_provenance(declared, rows, NATIONS)
    return found.withColumn("promotionNotes", F.substring(F.coalesce(F.element_at("promotionNotes", 1), F.lit("")), 1, 20))


def queries() -> dict:
    return {
        "report_files": _reports,
        "document_provenance": _provenance,
        "manifest_findings": _manifest,
        "published_run": _published,
        "context_files_offense": _context("offense"),
        "context_files_team": _context("context"),
        "context_files_landing": _context("landing"),
        "feature_files": _features,
    }
