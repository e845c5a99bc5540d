"""Stored feature documents: every rule of the contract has a document that breaks it."""

import copy
import json

import pytest

from sideline import config
from sideline.operators import feature_documents
from sideline.operators.features import FeatureOptions
from sideline.operators.quality import QualityError
from sideline.sources import variant_documents
from tests.rows import docs

OPTIONS = FeatureOptions("g", "c", 2024, 2025)
NUMBERS = [n for n, (kind, *_) in config.FEATURES.items() if kind == "number"]
CHOICES = {n: allowed for n, (kind, allowed, *_) in config.FEATURES.items() if kind != "number"}


def _valid():
    values = {n: 0.5 for n in NUMBERS} | {n: allowed[0] for n, allowed in CHOICES.items()}
    team = {"teamId": "A", "teamAbbr": "A", "season": 2024, "cutoffAt": "c", "features": values,
            "featureCoverageStatus": "partial", "confidence": 0.5, "warnings": [], "sourceDatasetRefs": []}
    return {
        "artifact": config.CONTRACT_FEATURES, "contractVersion": config.CONTRACT_FEATURES, "generatedAt": "g", "cutoffAt": "c",
        "featureSeason": 2024, "targetSeason": 2025, "owningRepo": OPTIONS.owner, "intendedConsumer": OPTIONS.consumer,
        "outputKind": OPTIONS.output_kind,
        "governance": {"governanceStatus": "fixture", "governanceSource": "explicit_marker", "generatedAt": "g"},
        "coverage": {"teamCount": 2, "expectedTeamCount": 2, "isFullLeague": True, "seasons": [2024], "weeks": [1]},
        "featureDefinitions": [{"name": n, "type": kind, "description": "d", "allowedInModel": True, "allowedInPosthocExplanation": True}
                               for n, (kind, *_) in config.FEATURES.items()],
        "teams": [team, copy.deepcopy(team) | {"teamId": "B"}],
    }


GONE = object()


def _set(path, value):
    def change(doc):
        *parents, last = path
        for p in parents:
            doc = doc[p]
        if value is GONE:
            del doc[last]
        else:
            doc[last] = value
    return change


def _cases():
    out = [(lambda d: None, [])]
    for f, said in (("artifact", config.CONTRACT_FEATURES), ("contractVersion", config.CONTRACT_FEATURES), ("owningRepo", OPTIONS.owner),
                    ("intendedConsumer", OPTIONS.consumer), ("outputKind", OPTIONS.output_kind)):
        out += [(_set([f], v), [f'{f} must be "{said}"']) for v in ("other", 5, GONE)]
    for f in ("generatedAt", "cutoffAt"):
        out += [(_set([f], v), [f"{f} must be a non-empty ISO string"]) for v in ("", 5, None, GONE)]
    for f in ("featureSeason", "targetSeason"):
        out += [(_set([f], v), [f"{f} must be a number"]) for v in ("2024", True, None, GONE)]
        out.append((_set([f], 2024.5), []))
    for part in ("governance", "coverage"):
        out += [(_set([part], v), [f"{part} must be an object"]) for v in ([], "x", None, GONE)]
    gov = {"governanceStatus": config.GOVERNANCE_STATUSES, "governanceSource": config.GOVERNANCE_SOURCES}
    for f, allowed in gov.items():
        out += [(_set(["governance", f], v), [f"governance.{f} must be one of {', '.join(allowed)}"]) for v in ("odd", 5, GONE)]
    out += [(_set(["governance", "generatedAt"], v), ["governance.generatedAt must be a non-empty ISO string"]) for v in ("", 5, GONE)]
    for f in ("teamCount", "expectedTeamCount"):
        out += [(_set(["coverage", f], v), [f"coverage.{f} must be a number"]) for v in ("2", None, GONE)]
    out += [(_set(["coverage", "isFullLeague"], v), ["coverage.isFullLeague must be a boolean"]) for v in ("true", 1, None)]
    for f in ("seasons", "weeks"):
        out += [(_set(["coverage", f], v), [f"coverage.{f} must be an array"]) for v in ("1", {}, None, GONE)]
    out.append((_set(["coverage", "teamCount"], 3), [
        "coverage.teamCount (3) must equal the number of team rows (2)", "coverage.isFullLeague (true) must be false when teamCount=3 and expectedTeamCount=2"]))
    out.append((_set(["coverage", "isFullLeague"], False), ["coverage.isFullLeague (false) must be true when teamCount=2 and expectedTeamCount=2"]))
    undeclared = [f'teams[{i}].features has undeclared feature "{n}"' for i in (0, 1) for n in config.FEATURES]
    out += [(_set(["featureDefinitions"], v), ["featureDefinitions must be a non-empty array", *undeclared]) for v in ([], {}, GONE)]
    first = NUMBERS[0]
    lost = [f'featureDefinitions is missing canonical feature "{first}"', *(f'teams[{i}].features has undeclared feature "{first}"' for i in (0, 1))]
    at = ["featureDefinitions", 0]
    out += [(_set(at, v), ["featureDefinitions[0] must be an object", *lost]) for v in (5, [], None)]
    out += [(_set([*at, "name"], v), ["featureDefinitions[0].name must be a non-empty string", *lost]) for v in ("", 5, GONE)]
    out.append((_set([*at, "name"], "invented"), [
        *lost, 'featureDefinitions declares unknown feature "invented"', *(f'teams[{i}].features is missing declared feature "invented"' for i in (0, 1))]))
    out.append((lambda d: d["featureDefinitions"].append(dict(d["featureDefinitions"][0])), [f'featureDefinitions declares "{first}" more than once']))
    out += [(_set([*at, "type"], v), [f'featureDefinitions[0].type for "{first}" must be "number"']) for v in ("tier", 5, GONE)]
    out.append((lambda d: d["featureDefinitions"].append({"name": "new", "type": "odd", "description": "d", "allowedInModel": True, "allowedInPosthocExplanation": True}), [
        f"featureDefinitions[{len(config.FEATURES)}].type must be one of number, direction, tier", 'featureDefinitions declares unknown feature "new"',
        *(f'teams[{i}].features is missing declared feature "new"' for i in (0, 1))]))
    out += [(_set([*at, "description"], v), ["featureDefinitions[0].description must be a non-empty string"]) for v in ("", 5, GONE)]
    for f in ("allowedInModel", "allowedInPosthocExplanation"):
        out += [(_set([*at, f], v), [f"featureDefinitions[0].{f} must be a boolean"]) for v in ("true", 1, GONE)]
    out += [(_set(["teams"], v), ["teams must be an array"]) for v in ({}, "x", GONE)]
    out += [(_set(["teams", 1], v), ["teams[1] must be an object"]) for v in (5, [], None)]
    team = ["teams", 1]
    for f in ("teamId", "teamAbbr", "cutoffAt"):
        out += [(_set([*team, f], v), [f"teams[1].{f} must be a non-empty string"]) for v in ("", 5, GONE)]
    out += [(_set([*team, "season"], v), ["teams[1].season must be a number"]) for v in ("2024", None, GONE)]
    out += [(_set([*team, "featureCoverageStatus"], v), ["teams[1].featureCoverageStatus must be one of complete, partial, unavailable"]) for v in ("odd", 5, GONE)]
    out += [(_set([*team, "confidence"], v), ["teams[1].confidence must be a number in [0, 1]"]) for v in (1.5, -1, "0.5", GONE)]
    for f in ("warnings", "sourceDatasetRefs"):
        out += [(_set([*team, f], v), [f"teams[1].{f} must be an array"]) for v in ("x", {}, None, GONE)]
    out += [(_set([*team, "features"], v), ["teams[1].features must be an object"]) for v in ([], "x", None, GONE)]
    for n in NUMBERS:
        out += [(_set([*team, "features", n], v), [f"teams[1].features.{n} must be a finite number or null"]) for v in ("n/a", True, [1])]
        out.append((_set([*team, "features", n], None), []))
    for n, allowed in CHOICES.items():
        out += [(_set([*team, "features", n], v), [f"teams[1].features.{n} must be one of {', '.join(allowed)}"]) for v in ("odd", 1, None)]
    out.append((_set([*team, "features", first], GONE), [f'teams[1].features is missing declared feature "{first}"']))
    out.append((_set([*team, "features", "more"], 1), ['teams[1].features has undeclared feature "more"']))
    spelled = "forbidden fantasy-point field present: "
    out.append((_set(["fantasyPoints"], 1), [spelled + "fantasyPoints"]))
    out.append((_set(["governance", "deep"], [{"x": [{"my Fantasy-POINT_total": {"fantasy_points": 1}}]}]), [spelled + "my Fantasy-POINT_total", spelled + "fantasy_points"]))
    out.append((_set([*team, "warnings"], ['"fantasyPoints": 5', 'a "quoted" fantasyPoints', "fantasypoint:"]), []))
    out.append((_set(["odd \"fantasy\\points\": é"], 1), [spelled + "odd \"fantasy\\points\": é"]))
    return out


def test_every_rule(spark):
    files = []
    cases = _cases()
    for change, _ in cases:
        doc = _valid()
        change(doc)
        files.append(json.dumps(doc))
    files += ["[]", "5", "{", '{"artifact": 1}']
    frame = docs(spark, *files)
    found = {r.sourceFile: [] for r in frame.collect()}
    names = list(found)
    for r in feature_documents.document_problems(variant_documents.read_values(frame), OPTIONS).collect():
        found[r.sourceFile].append(r.message)
    for name, (_, want) in zip(names, cases, strict=False):
        assert sorted(found[name]) == sorted(want)
    assert found[names[-4]] == found[names[-3]] == ["artifact must be an object"] and found[names[-2]] == ["invalid JSON"]
    assert len(found[names[-1]]) == 13
    assert sum(len(want) > 0 for _, want in cases) > 150


def test_require_valid(spark):
    good, bad = json.dumps(_valid()), json.dumps(_valid() | {"cutoffAt": 5})
    feature_documents.require_valid(variant_documents.read_values(docs(spark, good)), OPTIONS)
    with pytest.raises(QualityError, match="cutoffAt must be a non-empty ISO string"):
        feature_documents.require_valid(variant_documents.read_values(docs(spark, good, bad)), OPTIONS)
