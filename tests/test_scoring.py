import random

import pytest

from sideline import config, schemas
from sideline.operators import scoring
from tests.brute import scores
from tests.rows import BASE, frame, row


def test_scores_match_plain_formulas(spark):
    rng = random.Random(7)
    rows = []
    for i in range(60):
        r = row(team=f"T{i}", week=1 + i % 18)
        for f in ("successRate", "redZoneTdRate", "explosivePlayRate", "neutralPassRate", "pressureRateAllowed"):
            r[f] = rng.random()
        r["epaPerPlay"] = rng.uniform(-0.6, 0.6)
        for s in schemas.SPLITS:
            r[s] = rng.choice([None, rng.uniform(0, 30)])
        rows.append(r)
    got = {r["team"]: r for r in scoring.score_rows(frame(spark, rows)).collect()}
    for r in rows:
        want = scores(r)
        for name in config.SCORE_FIELDS:
            assert got[r["team"]][name] == pytest.approx(want[name], abs=1e-12)
            assert 0 <= got[r["team"]][name] <= 100


def test_missing_splits_score_as_zero(spark):
    r = row(**{s: None for s in schemas.SPLITS})
    got = scoring.score_rows(frame(spark, [r])).first()
    assert got["matchupEnvironment"]["splitAllowanceBoost"] == 0.0


TAG_CASES = {
    "elite_real_life_team": dict(epaPerPlay=0.4, successRate=0.6, pointsPerDrive=3.5, explosivePlayRate=0.2,
                                 redZoneTdRate=0.62, turnovers=0.0, pressureRateAllowed=0.12, sacksAllowed=0.0),
    "elite_fantasy_environment": dict(offensivePlays=80.0, secondsPerPlay=22.0, neutralPassRate=0.59, redZoneTrips=7.0,
                                      redZoneTdRate=0.64, explosivePlayRate=0.2, fantasyPointsForQB=30.0,
                                      fantasyPointsForRB=35.0, fantasyPointsForWR=45.0, fantasyPointsForTE=20.0),
    "pass_funnel_offense": dict(neutralPassRate=0.6, rushRate=0.42),
    "run_heavy_low_ceiling": dict(rushRate=0.52),
    "red_zone_machine": dict(redZoneTrips=5.0, redZoneTdRate=0.65),
    "explosive_but_volatile": dict(explosivePlayRate=0.2, epaPerPlay=-0.3, successRate=0.3, pointsPerDrive=1.0,
                                   turnovers=4.0, sacksAllowed=6.0),
    "stable_environment": dict(epaPerPlay=0.4, successRate=0.6, pointsPerDrive=3.5, turnovers=0.0, sacksAllowed=0.0,
                               pressureRateAllowed=0.12, redZoneTdRate=0.62, explosivePlayRate=0.04),
    "fraudulent_td_environment": dict(redZoneTdRate=0.72, pointsPerDrive=1.99),
    "qb_friendly_matchup": dict(fantasyPointsAllowedQB=22.0),
    "wr_slot_funnel_defense": dict(wrSlotAllowed=16.0, wrWideAllowed=13.9),
    "te_dead_zone_defense": dict(fantasyPointsAllowedTE=7.0, teInlineAllowed=None, teSplitAllowed=4.0),
}


def test_every_tag_fires_and_order_is_kept(spark):
    assert set(TAG_CASES) == set(config.TAGS)
    rows = [row(team=tag, **changes) for tag, changes in TAG_CASES.items()]
    got = {r["team"]: r["tags"] for r in scoring.build_states(frame(spark, rows)).collect()}
    for tag in TAG_CASES:
        assert tag in got[tag], (tag, got[tag])
        assert got[tag] == [t for t in config.TAGS if t in got[tag]]


def test_thresholds_just_missed(spark):
    rows = [
        row(team="a", neutralPassRate=0.6, rushRate=0.43), row(team="b", rushRate=0.51),
        row(team="c", redZoneTrips=5.0, redZoneTdRate=0.64), row(team="d", wrSlotAllowed=16.0, wrWideAllowed=14.0),
        row(team="e", fantasyPointsAllowedTE=7.0, teInlineAllowed=4.1, teSplitAllowed=1.0),
    ]
    got = {r["team"]: r["tags"] for r in scoring.build_states(frame(spark, rows)).collect()}
    assert all(tags == [] for tags in got.values()), got


def test_explanation(spark):
    rows = [
        row(team="MID", epaPerPlay=-0.001, redZoneTrips=3.5),
        row(team="BAD", epaPerPlay=-0.3, successRate=0.3, pointsPerDrive=1.0, turnovers=4.0, sacksAllowed=6.0,
            explosivePlayRate=0.2, offensivePlays=45.0, neutralPassRate=0.35),
        row(team="TOP", **TAG_CASES["elite_real_life_team"], **{k: v for k, v in TAG_CASES["elite_fantasy_environment"].items()
                                                               if k not in TAG_CASES["elite_real_life_team"]}),
    ]
    got = {r["team"]: r for r in scoring.build_states(frame(spark, rows)).collect()}
    mid, bad, top = got["MID"], got["BAD"], got["TOP"]
    assert mid["strengths"] == [config.STRENGTH_DEFAULT] and mid["risks"] == [config.RISK_DEFAULT]
    assert mid["summary"] == (
        "MID in Week 1 profiles as a balanced but middling environment. Core drivers were EPA/play -0.00, "
        "success rate 47.0%, and 3.5 red-zone trips at 60.0% TD conversion. "
        "No dominant tag signal was triggered this week."
    )
    assert bad["risks"] == [config.RISK_POWER, config.RISK_FANTASY, config.RISK_VOLATILE, config.RISK_TURNOVERS]
    assert config.ENVIRONMENT_VOLATILE in bad["summary"]
    assert config.TAG_MESSAGES["explosive_but_volatile"] in bad["summary"]
    assert config.ENVIRONMENT_ELITE in top["summary"] and "and 7 red-zone trips" in top["summary"]
    assert top["strengths"][:2] == [config.STRENGTH_POWER, config.STRENGTH_FANTASY]


def test_null_preserving_frames_are_refused(spark):
    rows = frame(spark, [row()]).drop("fantasyPointsForQB")
    with pytest.raises(scoring.SchemaError):
        scoring.build_states(rows)


def test_state_records_are_nested(spark):
    rec = scoring.as_state_records(scoring.build_states(frame(spark, [row()]))).first()
    assert rec["input"]["pointsFor"] == BASE["pointsFor"]
    assert rec["explanation"]["tags"] == rec["tags"]
    assert set(rec["components"].asDict()) == {"teamPower", "fantasyEnvironment", "matchupEnvironment", "stability"}
