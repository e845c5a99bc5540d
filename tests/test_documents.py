import json

import pytest

from sideline import schemas
from sideline.operators import quality
from sideline.operators.quality import QualityError
from sideline.operators.ranking import origin_order
from sideline.plans import jobs
from sideline.sources import checksum, documents
from tests.rows import docs, envelope, frame, raw_record, row, write


def _messages(spark, *values):
    found = documents.raw_violations(documents.parse_documents(docs(spark, *values)))
    return [r["message"] for r in found.orderBy("sourceFile", "rowIndex", "rule").collect()]


def test_folder_of_both_shapes(spark, tmp_path):
    write(tmp_path / "b.json", [raw_record(row(team="B", week=1)), raw_record(row(team="B", week=2, wrSlotAllowed=None))])
    write(tmp_path / "a.JSON", envelope([row(team="A", teSplitAllowed=None)], provenanceStatus="sample"))
    write(tmp_path / "c.json", envelope([row(team="C")], provenanceStatus="partial_real_data"))
    write(tmp_path / "d.json", envelope([row(team="D")]))
    write(tmp_path / "note.txt", "not json")
    (tmp_path / "deep").mkdir()
    write(tmp_path / "deep" / "e.json", [raw_record(row(team="E"))])
    scanned = documents.scan_documents(spark, str(tmp_path))
    assert scanned.count() == 4
    rows = documents.typed_keys(documents.load_rows(scanned))
    got = {(r["team"], r["week"]): r for r in rows.collect()}
    assert set(got) == {("A", 1), ("B", 1), ("B", 2), ("C", 1), ("D", 1)}
    assert got[("A", 1)]["teSplitAllowed"] is None and got[("B", 2)]["wrSlotAllowed"] is None
    want = row(team="B", week=1)
    assert {n: got[("B", 1)][n] for n in want} == want
    assert got[("B", 2)]["rowIndex"] == 1
    assert documents.declared_provenance(scanned) == "partial_real_data"


def test_single_file_and_empty_folder(spark, tmp_path):
    path = write(tmp_path / "one.json", [raw_record(row())])
    assert documents.load_rows(documents.scan_documents(spark, path)).count() == 1
    (tmp_path / "empty").mkdir()
    with pytest.raises(QualityError, match="No .json files found"):
        documents.scan_documents(spark, str(tmp_path / "empty"))


def test_a_file_of_any_name_and_plain_paths(spark, tmp_path):
    path = write(tmp_path / "b 100%+ü.txt", [raw_record(row())])
    rows = documents.load_rows(documents.scan_documents(spark, path))
    assert rows.first()["sourceFile"] == path


def test_files_are_ordered_by_locale(spark, tmp_path):
    write(tmp_path / "B.json", [raw_record(row(week=1, pointsFor=1.0))])
    write(tmp_path / "a.json", [raw_record(row(week=1, pointsFor=2.0))])
    rows = documents.typed_keys(documents.load_rows(documents.scan_documents(spark, str(tmp_path))))
    first = rows.orderBy(*origin_order(rows)).first()
    assert first["pointsFor"] == 2.0 and first["sourceFile"].endswith("a.json")
    assert rows.orderBy(*origin_order(rows, backwards=True)).first()["pointsFor"] == 1.0


def test_broken_documents(spark):
    good = json.dumps([raw_record(row())])
    got = _messages(spark, "{oops", good + " tail", "7", {"artifact": "other", "rows": []},
                    {"artifact": "team_week_raw_v0", "rows": {}}, {"rows": []}, good)
    assert got == [
        "Invalid JSON in 0.json", "Invalid JSON in 1.json",
        "Invalid team_week_raw_v0 artifact: expected object envelope.",
        "Invalid artifact literal: expected team_week_raw_v0, received other",
        "Invalid team_week_raw_v0 artifact: rows must be an array.",
        "Invalid artifact literal: expected team_week_raw_v0, received undefined",
    ]


def test_array_rows_need_keys_but_not_values(spark):
    missing = raw_record(row())
    del missing["drives"]
    null = raw_record(row()) | {"drives": None}
    assert _messages(spark, [null, missing, 5]) == [
        "Invalid raw row in 0.json at index 1: missing required key drives.",
        "Invalid raw row in 0.json at index 2: expected object.",
    ]
    rows = documents.load_rows(docs(spark, [null]))
    with pytest.raises(QualityError, match="Missing required field: drives"):
        jobs.require_canonical(rows)


def test_envelope_rows_need_finite_numbers(spark):
    bad = [row(drives=None), row(team=" "), row(pointsFor="x"), row(qbPassAllowed="x")]
    got = _messages(spark, envelope(bad))
    at = "Invalid team_week_raw_v0 row at index "
    assert got == [
        f"{at}0: drives must be a finite number.", f"{at}1: teamCode must be a non-empty string.",
        f"{at}2: pointsFor must be a finite number.", "Invalid optional split field value: x"]


def test_unknown_columns_are_ignored(spark):
    extra = raw_record(row()) | {"mood": "good", "qb_pass_allowed": "n/a"}
    rows = documents.load_rows(docs(spark, [extra]))
    assert "mood" not in rows.columns and rows.first()["qbPassAllowed"] is None


def test_first_error_is_raised_in_file_and_row_order(spark):
    bad = raw_record(row())
    del bad["week"]
    with pytest.raises(QualityError, match="in 0.json at index 1: missing required key week"):
        documents.load_rows(docs(spark, [raw_record(row()), bad], "{"))


@pytest.mark.parametrize("change, message", [
    (dict(neutralPassRate=1.3), "Invalid rate field neutralPassRate: 1.3"),
    (dict(redZoneTdRate=float("nan")), "Invalid rate field redZoneTdRate: NaN"),
    (dict(season=1998), "Invalid season: 1998"),
    (dict(week=23), "Invalid week: 23"),
    (dict(week=0), "Invalid week: 0"),
    (dict(team="  "), "Team and opponent must be non-empty strings."),
    (dict(drives=-1.0), "Invalid non-negative field drives: -1"),
    (dict(turnovers=float("inf")), "Invalid non-negative field turnovers: Infinity"),
    (dict(passRate=0.3, rushRate=0.5), "passRate + rushRate must be near 1.0. Received 0.8"),
    (dict(teSplitAllowed=-0.5), "Invalid optional split field teSplitAllowed: -0.5"),
    (dict(epaPerPlay=None), "Missing required field: epaPerPlay"),
    (dict(epaPerPlay=float("nan")), None),
    (dict(passRate=0.5, rushRate=0.43), None),
])
def test_canonical_rules(spark, change, message):
    found = quality.violations(frame(spark, [row(**change)]), quality.canonical_rules(), ["team"]).collect()
    assert [r["message"] for r in found] == ([message] if message else [])


def test_fractional_week_is_reported(spark):
    rows = documents.load_rows(docs(spark, [raw_record(row()) | {"week": 1.5}]))
    with pytest.raises(QualityError, match="Invalid week: 1.5"):
        jobs.require_canonical(rows)


def test_canonical_file_and_table_input(spark, tmp_path):
    path = write(tmp_path / "c.json", [row(), row(week=2)])
    rows = documents.read_canonical(spark, path)
    jobs.require_canonical(rows)
    assert rows.count() == 2
    with pytest.raises(QualityError, match="Expected an array"):
        documents.read_canonical(spark, write(tmp_path / "d.json", {"rows": []}))
    for fmt in ("parquet", "json"):
        target = str(tmp_path / fmt)
        frame(spark, [row()]).write.format(fmt).save(target)
        back = documents.read_table_rows(spark, target, fmt)
        assert set(schemas.TEAM_WEEK.names) <= set(back.columns) and back.count() == 1


def test_checksum(spark, tmp_path):
    import hashlib

    path = write(tmp_path / "s.json", "[1]")
    good = hashlib.sha256(b"[1]").hexdigest()
    assert checksum.require_checksum(spark, path, good) == good
    with pytest.raises(QualityError, match="pinned is 00"):
        checksum.require_checksum(spark, path, "00")
