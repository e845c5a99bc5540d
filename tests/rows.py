"""Hand-made team-week rows and documents."""

import json

from pyspark.sql import DataFrame

from sideline import schemas

BASE = {
    "pointsFor": 24.0, "pointsAgainst": 20.0, "offensivePlays": 64.0, "neutralPlays": 40.0,
    "secondsPerPlay": 27.5, "passRate": 0.58, "neutralPassRate": 0.57, "rushRate": 0.42,
    "epaPerPlay": 0.08, "passEpaPerPlay": 0.12, "rushEpaPerPlay": 0.01, "successRate": 0.47,
    "explosivePlayRate": 0.12, "drives": 11.0, "pointsPerDrive": 2.2, "redZoneTrips": 4.0,
    "redZoneTdRate": 0.6, "sacksAllowed": 2.0, "pressureRateAllowed": 0.25, "turnovers": 1.0,
    "fantasyPointsForQB": 19.0, "fantasyPointsForRB": 22.0, "fantasyPointsForWR": 31.0,
    "fantasyPointsForTE": 9.0, "fantasyPointsAllowedQB": 18.0, "fantasyPointsAllowedRB": 21.0,
    "fantasyPointsAllowedWR": 30.0, "fantasyPointsAllowedTE": 10.0,
    "qbPassAllowed": 14.0, "qbRushAllowed": 4.0, "rbRushAllowed": 12.0, "rbRecAllowed": 7.0,
    "wrSlotAllowed": 13.0, "wrWideAllowed": 12.0, "teInlineAllowed": 5.0, "teSplitAllowed": 6.0,
}


def row(team="DET", week=1, season=2025, opponent="GB", **changes) -> dict:
    return {"season": season, "week": week, "team": team, "opponent": opponent, **BASE, **changes}


def frame(spark, rows) -> DataFrame:
    names = schemas.TEAM_WEEK.names
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schemas.TEAM_WEEK)


def placed(spark, rows) -> DataFrame:
    """Rows that know their input position."""
    names = schemas.TEAM_WEEK.names
    data = [("a.json", i, *[r[n] for n in names]) for i, r in enumerate(rows)]
    return spark.createDataFrame(
        data, "sourceFile string, rowIndex int, " + ", ".join(
            f"{f.name} {f.dataType.simpleString()}" for f in schemas.TEAM_WEEK.fields)
    )


def raw_record(r: dict) -> dict:
    return {raw: r[n] for raw, n in schemas.RAW_NAMES.items() if r.get(n) is not None or n not in schemas.SPLITS}


def envelope_record(r: dict, splits=True) -> dict:
    return {raw: r[n] for raw, n in schemas.ENVELOPE_NAMES.items() if splits or n not in schemas.SPLITS}


def envelope(rows, **metadata) -> dict:
    return {"artifact": "team_week_raw_v0", "metadata": metadata, "rows": [envelope_record(r) for r in rows]}


def governed(rows, **changes) -> dict:
    """An accepted governed document of the rows."""
    records = []
    for r in rows:
        rec = envelope_record(r, splits=False)
        rec.update({f: None for f in schemas.FANTASY_FIELDS}, pressureRateAllowed=None, gameId="x")
        records.append(rec)
    doc = {
        "artifact": "team_week_raw_v0", "generatedAt": "2025-02-20T00:00:00Z", "season": 2024,
        "sourceArtifacts": ["plays"],
        "metadata": {
            "provenanceStatus": "governed_real_data",
            "governance": {"governanceStatus": "governed", "governanceSource": "explicit_marker", "notes": "n"},
            "deferredFields": ["pressureRateAllowed"],
            "validationReportPath": "v.json",
        },
        "rows": records,
    }
    doc.update(changes)
    return doc


def candidate(rows, **changes) -> dict:
    """An accepted candidate document of the rows."""
    doc = governed(rows)
    doc["metadata"].update(
        provenanceStatus="partial_real_data",
        governance={"governanceStatus": "ungoverned", "governanceSource": "not_set"},
        deferredFields=["pressureRateAllowed", *schemas.FANTASY_FIELDS],
    )
    doc.update(changes)
    return doc


def write(path, value) -> str:
    path.write_text(value if isinstance(value, str) else json.dumps(value, indent=1))
    return str(path)


def docs(spark, *values) -> DataFrame:
    texts = [(f"{i}.json", v if isinstance(v, str) else json.dumps(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(texts, "sourceFile string, text string")
