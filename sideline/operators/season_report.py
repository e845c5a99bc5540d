"""Public season report: totals, per-game values and opportunity-weighted rates."""

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sideline import config, schemas
from sideline.functions.lineage import written
from sideline.functions.numeric import exact_round
from sideline.operators.season import season_sums, week_cells


def season_report(rows: DataFrame) -> DataFrame:
    """One row per team-season from null-preserving rows.

    Sums stay at full precision and are rounded once. A week without a rate adds nothing to the
    weighted sum; a rate whose weights sum to zero is null with a warning, never 0.
    """
    values = {f"{c}Sum": c for c in config.REPORT_COUNTS}
    values |= {f"{r}Weighted": f"{r} * {w}" for r, (w, _, _) in config.REPORT_RATES.items()}
    grouped = season_sums(week_cells(rows, values), list(values)).withColumnRenamed(
        "games", "gamesPlayed"
    )
    raw = grouped.selectExpr(
        "season", "team", "gamesPlayed",
        *[f"{c}Sum" for c in config.REPORT_COUNTS],
        *[f"{c}Sum / gamesPlayed AS {c}Mean" for c in config.REPORT_COUNTS],
        *[f"{rate}Weighted / nullif({weight}Sum, 0D) AS {rate}Raw"
          for rate, (weight, _, _) in config.REPORT_RATES.items()],
    )
    codes = {}
    for weight, _, code in config.REPORT_RATES.values():
        codes[code] = weight
    warnings = ", ".join(
        f"CASE WHEN coalesce({weight}Sum, 0D) = 0D THEN '{code}' END" for code, weight in codes.items()
    )
    return raw.selectExpr(
        "season", "team", "gamesPlayed",
        *[f"bigint({exact_round(f'{c}Sum', 0)}) AS {c}Total" for c in config.REPORT_COUNTS],
        *[f"{exact_round(f'{c}Mean', 1)} AS {c}PerGame" for c in config.REPORT_COUNTS],
        *[f"{exact_round(f'{rate}Raw', digits)} AS {rate}"
          for rate, (_, digits, _) in config.REPORT_RATES.items()],
        f"array_compact(array({warnings})) AS warnings",
    )


def report_columns() -> list[str]:
    """All columns a report may have."""
    counts = [f"{c}{suffix}" for suffix in ("Total", "PerGame") for c in config.REPORT_COUNTS]
    return ["season", "team", "gamesPlayed", *counts, *config.REPORT_RATES, "warnings"]


def report_problems(
    report: DataFrame,
    rows: DataFrame,
    metadata: dict,
    expected_teams: Sequence[str],
    games_per_team: int,
) -> DataFrame:
    """Rejections of a report as (code, team, detail) rows.

    ``metadata`` has the declared provenanceStatus, governanceStatus, governanceSource, checksum,
    expectedChecksum, dataThrough, sourceSnapshotAt, upstreamSnapshots and generatedAt, and, where
    they are declared, upstreamChecksums (name to sha256), methodologyVersion and timeOrigins (time
    field to the source it is read from).
    """
    spark = report.sparkSession
    found = _declared_problems(metadata) + _column_problems(report.columns)
    declared = spark.createDataFrame(found, "code string, team string, detail string")

    # the rows are read once: their weighted report also has the games of every team
    right = written(season_report(rows), "report")
    expected = spark.createDataFrame([(t,) for t in expected_teams], "team string").selectExpr("team", "1 AS planned", "0L AS n")
    both = right.selectExpr("team", "0 AS planned", "gamesPlayed AS n").unionByName(expected)
    per_team = both.groupBy("team").agg(F.max("planned").alias("planned"), F.sum("n").alias("n"))
    found = (
        ("n = 0", "E_COVERAGE_TEAM_MISSING", "'no rows'"),
        ("planned = 0", "E_COVERAGE_TEAM_UNEXPECTED", "'not in the league'"),
        (f"n > 0 AND n <> {games_per_team}", "E_COVERAGE_ROW_COUNT_MISMATCH", f"concat(n, ' rows, expected {games_per_team}')"),
    )
    items = ", ".join(f"CASE WHEN {cond} THEN named_struct('code', '{code}', 'detail', {detail}) END" for cond, code, detail in found)
    covered = per_team.selectExpr("team", f"inline_outer(array_compact(array({items})))").where("code IS NOT NULL").select("code", "team", "detail")
    wanted = len(expected_teams) * games_per_team
    total = per_team.agg(F.sum("n").alias("n")).where(f"n <> {wanted}").selectExpr(
        "'E_COVERAGE_ROW_COUNT_MISMATCH' AS code", "string(NULL) AS team",
        f"concat(n, ' rows in total, expected {wanted}') AS detail",
    )
    red_zone = report.where("(redZoneTdRate IS NULL) <> (redZoneTripsTotal = 0)").selectExpr(
        "'E_REDZONE_NULL_INVARIANT_VIOLATED' AS code", "team",
        "concat('redZoneTripsTotal ', redZoneTripsTotal) AS detail",
    )
    out = declared
    for part in (covered, total, red_zone, _zero_filled(report), _unweighted(report, right)):
        out = out.unionByName(part)
    return out


def _withheld(column: str) -> bool:
    names = {*config.REPORT_WITHHELD, *schemas.FANTASY_FIELDS}
    return column in names or column.removesuffix("Total").removesuffix("PerGame") in names


def _zero_filled(report: DataFrame) -> DataFrame:
    """Withheld columns that hold a zero instead of being absent."""
    zeros = ", ".join(f"CASE WHEN `{c}` = 0 THEN '{c}' END" for c in report.columns if _withheld(c)) or "CAST(NULL AS STRING)"
    return report.selectExpr("team", f"explode_outer(array_compact(array({zeros}))) AS detail").where(
        "detail IS NOT NULL").selectExpr("'E_WITHHELD_FIELD_ZERO_FILLED' AS code", "team", "detail")


def _unweighted(report: DataFrame, right: DataFrame) -> DataFrame:
    """Rates that do not equal the weighted formula over the rows, and lines on one side only."""
    right = right.select(
        "season", "team", F.lit(True).alias("computed"), *[F.col(r).alias(f"right_{r}") for r in config.REPORT_RATES]
    )
    report = report.withColumn("reported", F.lit(True))
    off = ", ".join(
        f"CASE WHEN NOT {r} <=> right_{r} THEN '{r}' END" for r in config.REPORT_RATES
    )
    return (
        report.join(right, ["season", "team"], "full")
        .selectExpr("team", "explode_outer(CASE "
                    "WHEN computed IS NULL THEN array(concat('season ', season, ': reported without rows')) "
                    "WHEN reported IS NULL THEN array(concat('season ', season, ': rows without a report line')) "
                    f"ELSE array_compact(array({off})) END) AS detail")
        .where("detail IS NOT NULL")
        .selectExpr("'E_UNWEIGHTED_AGGREGATION_USED' AS code", "team", "detail")
    )


def _declared_problems(md: dict) -> list[tuple]:
    found = []
    status = md.get("provenanceStatus")
    markers = (md.get("governanceStatus"), md.get("governanceSource"))
    if not status or not all(markers):
        found.append(("E_PROVENANCE_MISSING", None, "provenance or governance markers absent"))
    elif status != "governed_real_data" or markers != ("governed", "explicit_marker"):
        found.append(("E_PROVENANCE_NOT_GOVERNED", None, f"{status}, {markers[0]}, {markers[1]}"))
    if not md.get("checksum") or md["checksum"] != md.get("expectedChecksum"):
        found.append(("E_GOVERNED_INPUT_CHECKSUM_MISMATCH", None, "checksum absent or different"))
    times = [md.get(k) for k in ("dataThrough", "sourceSnapshotAt", "generatedAt")]
    snapshots = md.get("upstreamSnapshots") or []
    if not all(times):
        found.append(("E_TEMPORAL_METADATA_MISSING", None, "dataThrough, sourceSnapshotAt, generatedAt"))
    elif snapshots and md["sourceSnapshotAt"] != max(snapshots):
        found.append(("E_TEMPORAL_METADATA_CONFLATED", None, "sourceSnapshotAt is not the latest snapshot"))
    # the declared origin of each time: a structural check, equal instants of two origins are fine
    origins = [v for v in (md.get("timeOrigins") or {}).values() if v]
    if len(set(origins)) < len(origins):
        found.append(("E_TEMPORAL_METADATA_CONFLATED", None, "two time fields are wired to one source"))
    found += [
        ("E_UPSTREAM_SOURCE_CHECKSUM_MISSING", None, f"upstream source {name}")
        for name, digest in (md.get("upstreamChecksums") or {}).items() if not re.fullmatch(r"[0-9a-f]{64}", digest or "")
    ]
    if "methodologyVersion" in md and md["methodologyVersion"] not in config.REPORT_METHODOLOGIES:
        found.append(("E_METHODOLOGY_VERSION_UNKNOWN", None, str(md["methodologyVersion"])))
    return found


def _column_problems(columns: Sequence[str]) -> list[tuple]:
    found, known = [], set(report_columns())
    for c in columns:
        base = c.removesuffix("Total").removesuffix("PerGame")
        if _withheld(c):
            found.append(("E_WITHHELD_FIELD_PRESENT", None, c))
            if base in config.REPORT_BLOCKED:
                found.append(("E_APPROXIMATED_DENOMINATOR_UNAUTHORIZED", None, c))
        elif c not in known:
            found.append(("E_UNDOCUMENTED_FIELD_PRESENT", None, c))
    return found
