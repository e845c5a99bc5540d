"""Null profiles and the readiness reports of the null-preserving lanes."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sideline import config, schemas
from sideline.functions.numeric import is_finite
from sideline.operators import coverage
from sideline.sources.governed import Consumption


def null_profile(
    rows: DataFrame, fields: Sequence[str] = schemas.METRICS, deferred: Sequence[str] = ()
) -> DataFrame:
    """Per field: finite and null counts, and whether it is available, partial or deferred."""
    counts = rows.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.expr(f"count_if({is_finite(f)}) AS {f}") for f in fields],
    )
    pairs = ", ".join(f"{i}, '{f}', {f}" for i, f in enumerate(fields))
    held = ", ".join(f"'{f}'" for f in (config.PRESSURE_FIELD, *deferred))
    return counts.selectExpr(
        "_rows", f"stack({len(fields)}, {pairs}) AS (place, field, finiteCount)"
    ).selectExpr(
        "place", "field", "finiteCount", "_rows - finiteCount AS nullCount",
        f"CASE WHEN field IN ({held}) THEN '{config.DEFERRED}' "
        f"WHEN _rows > 0 AND _rows = finiteCount THEN '{config.AVAILABLE}' "
        f"ELSE '{config.PARTIAL_NULLS}' END AS status",
    )


def profile_report(profile: DataFrame) -> DataFrame:
    """One row: the profile as an array and the field names of each status, in field order."""
    ordered = F.sort_array(
        F.collect_list(F.struct("place", "field", "finiteCount", "nullCount", "status"))
    )
    by_status = "transform(filter(readiness, r -> r.status = '{}'), r -> r.field) AS {}"
    return profile.agg(ordered.alias("readiness")).selectExpr(
        "transform(readiness, r -> named_struct('field', r.field, 'finiteCount', r.finiteCount, "
        "'nullCount', r.nullCount, 'status', r.status)) AS fieldReadiness",
        by_status.format(config.AVAILABLE, "availableFields"),
        by_status.format(config.DEFERRED, "deferredInsufficientFields"),
        by_status.format(config.PARTIAL_NULLS, "partialNullFields"),
    )


def _literals(values: dict) -> dict:
    out = {}
    for name, v in values.items():
        if isinstance(v, (list, tuple)):
            out[name] = F.array(*[F.lit(x) for x in v]).cast("array<string>")
        elif v is None:
            out[name] = F.lit(None).cast("string")
        else:
            out[name] = F.lit(v)
    return out


def coverage_problems(used: Consumption, expectation: coverage.Expectation = coverage.FULL_SEASON_2024) -> DataFrame:
    """The coverage problems of a report, one row each: what its ``coverage`` block counts by kind."""
    return coverage.bye_aware_problems(used.rows, expectation)


def _coverage_report(used: Consumption, expectation: coverage.Expectation) -> DataFrame:
    """One row with the coverage summary; ``coverage_problems`` lists the problems themselves."""
    cells = coverage.counted(used.rows)
    return coverage.coverage_summary(cells, coverage.bye_aware_problems(cells, expectation), expectation)


def dry_run(used: Consumption, expectation: coverage.Expectation = coverage.FULL_SEASON_2024) -> DataFrame:
    """Coverage of a candidate with its declared status echoed; nothing is ever promoted here."""
    up = used.upstream
    report = _coverage_report(used, expectation)
    summary = F.struct(*report.columns).alias("coverage")
    return report.select(summary, F.col("totalRowCount").alias("rowCount")).withColumns(
        _literals(
            {
                "sourceArtifactPath": up["sourceArtifactPath"],
                "provenanceStatus": up["provenanceStatus"],
                "governanceStatus": up["governanceStatus"],
                "governanceSource": up["governanceSource"],
                "promoted": False,
                "governed": False,
                "deferredFields": up["deferredFields"],
                "pressurePosture": "insufficient_data",
            }
        )
    )


def _with_profile(report: DataFrame, used: Consumption, fields: Sequence[str]) -> DataFrame:
    """Attach the null profile, a single row of as many entries as there are fields."""
    profile = profile_report(null_profile(used.rows, fields, used.upstream["deferredFields"])).first()
    entries = [
        F.struct(F.lit(e["field"]).alias("field"), F.lit(e["finiteCount"]).alias("finiteCount"),
                 F.lit(e["nullCount"]).alias("nullCount"), F.lit(e["status"]).alias("status"))
        for e in profile["fieldReadiness"]
    ]
    lists = {k: profile[k] for k in ("availableFields", "deferredInsufficientFields", "partialNullFields")}
    return report.withColumns({"fieldReadiness": F.array(*entries), **_literals(lists)})


def rehearse(used: Consumption, expectation: coverage.Expectation = coverage.FULL_SEASON_2024) -> DataFrame:
    """Dry run plus null profile; withheld when coverage fails."""
    report = _with_profile(dry_run(used, expectation), used, schemas.METRICS)
    return report.withColumns(
        {
            "kind": F.lit(f"{config.ARTIFACT_RAW}_candidate_rehearsal"),
            "rehearsalOnly": F.lit(True),
            "productionReady": F.lit(False),
            "rehearsalStatus": F.when(F.col("coverage.valid"), "rehearsed").otherwise(
                "withheld_invalid_coverage"
            ),
        }
    )


def governed_readiness(
    used: Consumption, expectation: coverage.Expectation = coverage.FULL_SEASON_2024
) -> DataFrame:
    """Readiness of a governed source: echoed markers, coverage and null profile."""
    up = used.upstream
    report = _coverage_report(used, expectation)
    report = report.select(
        F.struct(*report.columns).alias("coverage"), F.col("totalRowCount").alias("rowCount")
    )
    report = _with_profile(report, used, schemas.GOVERNED_METRICS)
    return report.withColumns(
        {
            **_literals(
                {
                    "kind": f"{config.ARTIFACT_RAW}_governed_readiness",
                    "artifact": config.ARTIFACT_RAW,
                    "productionReady": False,
                    "sourceArtifactPath": up["sourceArtifactPath"],
                    "sourceArtifacts": up["sourceArtifacts"],
                    "validationReportPath": up["validationReportPath"],
                    "lineageManifestPath": up["lineageManifestPath"],
                    "provenanceStatus": up["provenanceStatus"],
                    "upstreamFieldReadiness": up["fieldReadiness"],
                    "pressurePosture": "unavailable_insufficient_data_deferred",
                    "deferredFields": up["deferredFields"],
                }
            ),
            "governance": F.struct(
                F.lit(up["governanceStatus"]).alias("governanceStatus"),
                F.lit(up["governanceSource"]).alias("governanceSource"),
                F.lit(up["governanceNotes"]).cast("string").alias("notes"),
            ),
            "readinessStatus": F.when(F.col("coverage.valid"), "ready_minimal_boundary").otherwise(
                "withheld_invalid_coverage"
            ),
        }
    )
