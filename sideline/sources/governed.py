"""Null-preserving readers of candidate and governed envelopes.

Acceptance depends only on what the document declares about itself; the path is a label. Rows of
these lanes keep their nulls and are never scored.
"""

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sideline import config, schemas
from sideline.functions.lineage import written
from sideline.operators import quality
from sideline.operators.quality import QualityError, Rule
from sideline.sources import documents

_METADATA = (
    "provenanceStatus string, governance string, deferredFields string, fieldReadiness string, "
    "validationReportPath string, lineageManifestPath string"
)


class Consumption(NamedTuple):
    """What a reader accepted: the declared context of the document and its rows."""

    upstream: dict
    rows: DataFrame


def declared_context(docs: DataFrame) -> DataFrame:
    """One row per document with its declared metadata, unchecked."""
    parsed = docs if "malformed" in docs.columns else documents.parse_documents(docs)
    with_md = parsed.selectExpr(
        "*", f"from_json(metadata, '{_METADATA}') AS md", "coalesce(startswith(ltrim(metadata), '{'), false) AS hasMetadata",
    ).selectExpr(
        "*", "coalesce(startswith(ltrim(md.governance), '{'), false) AS hasGovernance",
        "from_json(md.governance, 'governanceStatus string, governanceSource string, notes string') AS gov",
        "coalesce(startswith(ltrim(md.deferredFields), '['), false) AS deferredIsArray",
        "from_json(md.deferredFields, 'array<string>') AS deferred",
        "coalesce(startswith(ltrim(sourceArtifacts), '['), false) AS sourcesIsArray",
        "from_json(sourceArtifacts, 'array<string>') AS sources",
    )
    return with_md.selectExpr(
        "sourceFile", "malformed", "isArray", "isEnvelope", "artifact", "rows", "generatedAt",
        "if(try_cast(season AS double) = floor(try_cast(season AS double)), int(try_cast(season AS double)), NULL) AS season",
        "hasMetadata", "hasGovernance",
        "md.provenanceStatus", "gov.governanceStatus", "gov.governanceSource", "gov.notes AS governanceNotes",
        "deferredIsArray", "coalesce(filter(deferred, d -> d IS NOT NULL), array()) AS deferredFields",
        "exists(deferred, d -> coalesce(trim(d), '') = '') AS deferredBlank",
        "sourcesIsArray AND NOT exists(sources, s -> coalesce(trim(s), '') = '') AS sourcesValid",
        "sources AS sourceArtifacts", "md.fieldReadiness", "md.validationReportPath", "md.lineageManifestPath",
    )


def _blank(column: str) -> str:
    return f"coalesce(trim({column}), '') = ''"


def candidate_gate() -> list[Rule]:
    """Declared status a candidate document needs."""
    kind = f"Invalid {config.ARTIFACT_RAW} candidate artifact: "
    refuse = f"Refusing to consume {config.ARTIFACT_RAW} candidate artifact: "
    accepted = ", ".join(f"'{p}'" for p in config.CANDIDATE_PROVENANCE)
    return [
        Rule("malformed OR NOT isEnvelope", quality.text(kind + "expected object envelope.")),
        Rule(f"NOT artifact <=> '{config.ARTIFACT_RAW}'",
             f"concat('Invalid artifact literal: expected {config.ARTIFACT_RAW}, received ', coalesce(artifact, 'undefined'))"),
        Rule("NOT coalesce(startswith(rows, '['), false)", quality.text(kind + "rows must be an array.")),
        Rule("NOT hasMetadata", quality.text(kind + "metadata block is required.")),
        Rule(f"hasMetadata AND {_blank('provenanceStatus')}",
             quality.text(kind + "metadata.provenanceStatus must be a non-empty string.")),
        Rule(f"NOT {_blank('provenanceStatus')} AND provenanceStatus NOT IN ({accepted})",
             f"concat('{refuse}provenanceStatus \"', provenanceStatus, '\" is not an accepted candidate-input "
             f"status. Accepted: {', '.join(config.CANDIDATE_PROVENANCE)}.')"),
        Rule("hasMetadata AND NOT hasGovernance", quality.text(
            kind + "metadata.governance block is required and must declare governanceStatus/governanceSource explicitly.")),
        Rule(f"hasGovernance AND {_blank('governanceStatus')}",
             quality.text(kind + "metadata.governance.governanceStatus must be a non-empty string.")),
        Rule(f"NOT {_blank('governanceStatus')} AND governanceStatus <> 'ungoverned'",
             f"concat('{refuse}governanceStatus \"', governanceStatus, '\" is not an accepted candidate-input status.')"),
        Rule(f"hasGovernance AND {_blank('governanceSource')}",
             quality.text(kind + "metadata.governance.governanceSource must be a non-empty string.")),
    ]


def governed_gate() -> list[Rule]:
    """Declared status a governed document needs: explicit markers and withheld pressure."""
    kind = f"Invalid governed {config.ARTIFACT_RAW} artifact: "
    refuse = f"Refusing governed {config.ARTIFACT_RAW} source: "
    return [
        Rule("malformed OR NOT isEnvelope", quality.text(kind + "expected object envelope.")),
        Rule(f"NOT artifact <=> '{config.ARTIFACT_RAW}'",
             f"concat('{kind}expected artifact {config.ARTIFACT_RAW}, received ', coalesce(artifact, 'undefined'), '.')"),
        Rule("NOT coalesce(startswith(rows, '['), false)", quality.text(kind + "rows must be an array.")),
        Rule("NOT hasMetadata", quality.text(kind + "metadata block is required.")),
        Rule(f"hasMetadata AND {_blank('provenanceStatus')}",
             quality.text(kind + "metadata.provenanceStatus must be a non-empty string.")),
        Rule(f"NOT {_blank('provenanceStatus')} AND provenanceStatus <> 'governed_real_data'",
             f"concat('{refuse}provenanceStatus must be governed_real_data, received ', provenanceStatus, '.')"),
        Rule("hasMetadata AND NOT hasGovernance", quality.text(kind + "metadata.governance block is required.")),
        Rule("hasGovernance AND NOT governanceStatus <=> 'governed'",
             quality.text(refuse + "metadata.governance.governanceStatus must be governed.")),
        Rule("hasGovernance AND NOT governanceSource <=> 'explicit_marker'",
             quality.text(refuse + "metadata.governance.governanceSource must be explicit_marker.")),
        Rule("hasMetadata AND (NOT deferredIsArray OR deferredBlank)",
             quality.text(kind + "metadata.deferredFields must be an array of non-empty strings.")),
        Rule(f"deferredIsArray AND NOT array_contains(deferredFields, '{config.PRESSURE_FIELD}')",
             quality.text(kind + f"metadata.deferredFields must include {config.PRESSURE_FIELD}.")),
        Rule("NOT coalesce(sourcesValid, false)",
             quality.text(kind + "sourceArtifacts must be an array of non-empty strings.")),
    ]


def gate_violations(docs: DataFrame, gate: list[Rule]) -> DataFrame:
    """Broken gate rules per document."""
    return quality.violations(declared_context(docs), gate, ["sourceFile"])


def _records(docs: DataFrame, spread: bool = False) -> DataFrame:
    parsed = docs if "malformed" in docs.columns else documents.parse_documents(docs)
    return documents.envelope_records(parsed, spread)


def _candidate(records: DataFrame) -> DataFrame:
    return documents.typed_keys(
        records.selectExpr(
            *schemas.ORIGIN, "season", "week", "teamCode AS team", "opponentCode AS opponent",
            *schemas.METRICS,
        )
    )


def _governed(records: DataFrame) -> DataFrame:
    kept = [m for m in schemas.GOVERNED_METRICS if m != config.PRESSURE_FIELD]
    return _candidate(records).selectExpr(
        *schemas.ORIGIN, *schemas.KEYS, *kept, f"double(NULL) AS {config.PRESSURE_FIELD}"
    )


def candidate_rows(docs: DataFrame) -> DataFrame:
    """Whitelisted candidate rows: four keys and 28 nullable metrics."""
    return _candidate(_records(docs))


def governed_rows(docs: DataFrame) -> DataFrame:
    """Governed rows: fantasy columns stripped and pressure withheld, whatever the text says."""
    return _governed(_records(docs))


def row_violations(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    return quality.violations(_records(docs), rules, list(schemas.ORIGIN))


def _consume(docs: DataFrame, gate: list[Rule], rules: list[Rule], shape) -> Consumption:
    docs = documents.parsed_once(docs)
    if docs.limit(2).count() != 1:
        raise QualityError("one document is needed: its declared context belongs to all rows")
    quality.require_clean(gate_violations(docs, gate), ["sourceFile"])
    # coverage, null profile and export read the rows again: parse them once
    records = written(_records(docs, spread=True), "records")
    located = list(schemas.ORIGIN)
    quality.require_clean(quality.violations(records, rules, located), located)
    context = declared_context(docs).orderBy(F.collate("sourceFile", "UNICODE")).limit(1).first()
    kept = ("generatedAt", "season", "provenanceStatus", "governanceStatus", "governanceSource",
            "governanceNotes", "deferredFields", "sourceArtifacts", "fieldReadiness",
            "validationReportPath", "lineageManifestPath")
    upstream = {"sourceArtifactPath": context["sourceFile"], **{k: context[k] for k in kept}}
    return Consumption(upstream, shape(records))


def consume_candidate(docs: DataFrame) -> Consumption:
    """Accept a candidate document or raise with the first reason not to."""
    return _consume(docs, candidate_gate(), quality.candidate_rules(), _candidate)


def consume_governed(docs: DataFrame) -> Consumption:
    """Accept a governed document or raise with the first reason not to."""
    return _consume(docs, governed_gate(), quality.governed_rules(), _governed)
