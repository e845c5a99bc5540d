"""Files of the seeded tables: every rule of the three tables has a row that breaks it."""

import json

import pytest

from sideline import schemas
from sideline.operators import context_documents
from sideline.operators import context_tables as ct
from sideline.sources import variant_documents
from tests.rows import docs, write

TABLES = {"offense": ct.OFFENSE, "context": ct.CONTEXT, "landing": ct.LANDING}


def _valid(kind):
    out = []
    for team in TABLES[kind].teams:
        row = {c: "x" for c in schemas._TEXT_COLUMNS[kind]} | {c: ["calm", "risky"] for c in schemas._TAG_COLUMNS[kind]}
        row |= {"season": 2026, "team": team, "source_status": "operator_seeded"}
        row |= {c: ["calm"] for c in row if c.startswith("positive")} | {c: ["risky"] for c in row if c.startswith("risk")}
        if kind == "offense":
            row |= {c: allowed[0] for c, allowed in ct.OFFENSE_ENUMS.items()}
        out.append(row)
    return out


def _cases(kind):
    """(change of the first row, messages about it); a change to None takes the field out."""
    gone = lambda c: f"Row 0: missing required fields: ['{c}']"
    integer = [] if kind == "context" else ["Row 0: season must be an integer."]
    cases = [
        ({"season": "2026"}, [*integer, "Row 0: season must equal 2026."]),
        ({"season": 2026.5}, [*integer, "Row 0: season must equal 2026."]),
        ({"season": 2026.0}, integer), ({"season": True}, ["Row 0: season must equal 2026."]),
        ({"season": [2026]}, [*integer, "Row 0: season must equal 2026."]),
        ({"team": 7}, ["Row 0: team must be a non-empty string."]),
        ({"team": ""}, ["Row 0: team must be a non-empty string.", "Row 0: unknown team code ''."]),
        ({"team": "XX"}, ["Row 0: unknown team code 'XX'."]),
    ]
    last = TABLES[kind].teams[-1]
    cases.append(({"team": last}, [f"Row {len(TABLES[kind].teams) - 1}: duplicate team code '{last}'."]))
    if kind != "context":
        cases.append(({"more": 1, "also": 2}, ["Row 0: unexpected fields: ['also', 'more']"]))
    else:
        cases.append(({"more": 1}, []))
    enums = {"offense": list(ct.OFFENSE_ENUMS), "landing": ["source_status"], "context": []}[kind]
    for c in enums:
        cases += [({c: "odd"}, [f"Row 0: invalid {c} 'odd'."]), ({c: 5}, [f"Row 0: invalid {c} '5'."]), ({c: None}, [gone(c), f"Row 0: invalid {c} 'null'."])]
    if kind == "context":
        cases.append(({"source_status": ["operator_seeded"]}, ["Row 0: source_status must be one of operator_seeded, operator_seeded_unknown."]))
    filled = {"offense": [], "landing": ["team_name"], "context": ["team_name", "head_coach", "offensive_coordinator", "play_caller", "qb_context", "notes"]}[kind]
    for c in filled:
        cases += [({c: v}, [f"Row 0: {c} must be a non-empty string."]) for v in ("", 3, {"a": 1})]
        cases.append(({c: None}, [gone(c), f"Row 0: {c} must be a non-empty string."]))
    for c in {"offense": ["offensive_playcaller", "head_coach", "notes"], "landing": ["notes"], "context": []}[kind]:
        cases += [({c: 3}, [f"Row 0: {c} must be a string."]), ({c: ""}, []), ({c: None}, [gone(c), f"Row 0: {c} must be a string."])]
    match = {"landing": "Row 0: context_tags must match positive_context_tags + risk_context_tags."}.get(kind)
    twice = {"landing": "must not include duplicate tags.", "context": "must not contain duplicates."}.get(kind)
    for c in schemas._TAG_COLUMNS[kind]:
        more = [match] * bool(match)
        rookie = ["Row 0: rookie_landing_context_tags must include all positive/risk tags."] * (c == "rookie_landing_context_tags")
        cases.append(({c: "calm"}, [f"Row 0: {c} must be an array.", *more, *rookie]))
        if kind == "offense":
            cases.append(({c: ["calm", "calm"]}, []))
        else:
            cases.append(({c: ["calm", "risky"] * 2}, [f"Row 0: {c} {twice}"]) if not c.startswith(("positive", "risk")) else ({c: [("calm" if c[0] == "p" else "risky")] * 2}, [f"Row 0: {c} {twice}"]))
        if c in ("context_tags", "offensive_identity_tags", "personnel_usage_tags", "pace_pass_environment_tags"):
            cases += [({c: ["calm", "risky", bad]}, [f"Row 0: {c} must contain non-empty strings.", *more]) for bad in ("", 4)]
    if kind == "context":
        cases.append(({"positive_team_context_tags": ["role_competition_risk"], "rookie_landing_context_tags": ["role_competition_risk", "risky"]},
                      ["Row 0: positive_team_context_tags includes known risk tag(s)."]))
    if kind == "landing":
        cases.append(({"context_tags": ["calm"]}, [match]))
    return cases


@pytest.mark.parametrize("kind", TABLES)
def test_every_rule_of_rows(spark, kind):
    cases, files = _cases(kind), []
    for change, _ in cases:
        rows = _valid(kind)
        rows[0] = {k: x for k, x in (rows[0] | change).items() if x is not None}
        files.append(json.dumps(rows))
    values = variant_documents.read_values(docs(spark, *files))
    names = [r.sourceFile for r in docs(spark, *files).select("sourceFile").collect()]
    found = {n: [] for n in names}
    for r in context_documents.document_problems(values, TABLES[kind]).collect():
        found[r.sourceFile].append(r)
    missing = TABLES[kind].texts[0]
    first = TABLES[kind].teams[0]
    fired = set()
    for name, (change, want) in zip(names, cases, strict=True):
        lost = [f"{missing}: {first}"] if "team" in change else []
        assert sorted(r.message for r in found[name]) == sorted([*want, *lost]), change
        fired |= {r.message.split("season must equal")[0] for r in found[name]}
    rules = context_documents.row_rules(TABLES[kind])
    assert len(fired) >= len(rules) - 1  # the rule on values that are no objects is tested below


@pytest.mark.parametrize("kind", TABLES)
def test_whole_files(spark, tmp_path, kind):
    rows = _valid(kind)
    write(tmp_path / "good.json", rows)
    write(tmp_path / "object.json", {"rows": rows})
    write(tmp_path / "empty.json", [])
    write(tmp_path / "odd.json", [*rows, 5, None, ["x"]])
    (tmp_path / "broken.json").write_text(json.dumps(rows) + " x")
    (tmp_path / "twice.json").write_text('[{"season": 1, "season": 2}]')
    values = variant_documents.scan_values(spark, str(tmp_path))
    found = {}
    for r in context_documents.document_problems(values, TABLES[kind]).collect():
        found.setdefault(r.sourceFile.rsplit("/", 1)[1], []).append((r.rowIndex, r.message))
    n, (missing, lines) = len(TABLES[kind].teams), TABLES[kind].texts
    assert "good.json" not in found
    assert found["object.json"] == [(None, "Top-level JSON value must be an array.")]
    assert found["broken.json"] == found["twice.json"] == [(None, "Invalid JSON.")]
    assert sorted(found["empty.json"]) == sorted([(None, f"Expected {n} {lines}, found 0."), *((None, f"{missing}: {t}") for t in TABLES[kind].teams)])
    assert sorted(found["odd.json"], key=str) == sorted(
        [(None, f"Expected {n} {lines}, found {n + 3}."), *((n + i, f"Row {n + i}: value must be an object.") for i in range(3))], key=str)


def test_a_variant_keeps_what_columns_lose(spark):
    values = variant_documents.read_values(docs(spark, '[{"season": "2026"}]', '[{"season": 2026}]'))
    found = context_documents.document_problems(values, ct.OFFENSE).where("message LIKE '%must equal%'")
    assert found.count() == 1
