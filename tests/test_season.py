import random
from collections import Counter

import pytest

from sideline import config
from sideline.operators import scoring, season
from tests.brute import half_up, scores
from tests.rows import frame, placed, row


def _rows(seed=5):
    rng = random.Random(seed)
    return [row(team=t, season=s, week=w, epaPerPlay=round(rng.uniform(-0.3, 0.4), 6),
                fantasyPointsForQB=round(rng.uniform(5, 30), 6), redZoneTdRate=round(rng.random(), 6),
                fantasyPointsAllowedQB=float(rng.randint(15, 25)))
            for s in (2024, 2025) for t in ("BUF", "DET", "KC", "SF") for w in range(1, 9)]


def test_means_tags_and_narrative(spark):
    rows = _rows()
    states = scoring.build_states(frame(spark, rows))
    weekly = states.select("season", "team", "week", "tags", "summary").collect()
    got = {(r["season"], r["team"]): r for r in season.team_seasons(states).collect()}
    assert len(got) == 8
    for key, g in got.items():
        mine = [r for r in rows if (r["season"], r["team"]) == key]
        assert (g["games"], g["latestWeek"]) == (8, 8)
        for m in config.SEASON_MEANS:
            total = 0.0
            for r in mine:
                total += (scores(r) | r)[m]
            assert g[m] == pytest.approx(total / 8, abs=1e-12)
        words = [w for w in weekly if (w["season"], w["team"]) == key]
        assert g["tags"] == sorted({t for w in words for t in w["tags"]})
        counts = Counter(w["summary"] for w in words)
        assert g["summary"] == min(counts, key=lambda s: (-counts[s], s))


def test_repeated_rows_are_kept_and_decide_the_narrative(spark):
    rows = [row(week=1), row(week=2, pointsFor=1.0), row(week=2, pointsFor=2.0)]
    g = season.team_seasons(scoring.build_states(placed(spark, rows))).first()
    assert g["games"] == 3 and " in Week 2 " in g["summary"]


def test_season_rankings_and_positions(spark):
    seasons = season.team_seasons(scoring.build_states(frame(spark, _rows())))
    base = {(r["season"], r["team"]): r for r in seasons.collect()}
    ranked = season.rank_seasons(seasons).collect()
    assert Counter(r["ranking"] for r in ranked) == {n: 8 for n in config.SEASON_SCORE_RANKINGS}
    for name, (col, label) in config.SEASON_SCORE_RANKINGS.items():
        want = sorted(base.values(), key=lambda r: (-r[col], -r["season"], r["team"]))
        got = sorted((r for r in ranked if r["ranking"] == name), key=lambda r: r["rank"])
        assert [(r["season"], r["team"]) for r in got] == [(r["season"], r["team"]) for r in want]
        assert got[0]["summary"] == f"{label}: {want[0]['summary']}"
        assert got[0]["score"] == half_up(want[0][col], 2)

    qb = season.rank_positions(seasons, "offense", ["QB"]).collect()
    for r in qb:
        b = base[(r["season"], r["team"])]
        v = (b["fantasyPointsForQB"] * 0.45 + b["neutralPassRate"] * 25 + b["offensivePlays"] * 0.25
             + max(0, 40 - b["secondsPerPlay"]) * 2.5 * 0.3 + b["teamPowerScore"] * 0.15)
        assert r["score"] == pytest.approx(half_up(v, 2), abs=0.0100001)
        assert r["summary"] == "QB offense environment from production + pace/usage context."


def test_top_lists(spark):
    seasons = season.team_seasons(scoring.build_states(frame(spark, _rows())))
    base = seasons.collect()
    least = [r for r in season.least_volatile(seasons, 3).orderBy("rank").collect()]
    want = sorted(base, key=lambda r: (r["volatilityScore"], -r["season"], r["team"]))[:3]
    assert [(r["rank"], r["season"], r["team"]) for r in least] == [
        (i, r["season"], r["team"]) for i, r in enumerate(want, 1)]
    assert least[0]["summary"].startswith("Season average volatility: ")
    lists = Counter(r["list"] for r in season.snapshot(seasons, 5).collect())
    assert lists == {k: 5 for k in ("top_team_power", "top_fantasy_environment", "top_matchup_environment",
                                    "most_stable", "most_volatile", "least_volatile")}
    assert season.positional_snapshot(seasons, "matchup", 2).count() == 8


def test_scope(spark):
    got = season.scope(frame(spark, _rows()), 2024, None).first()
    assert got["seasonsIncluded"] == [2025, 2024] and got["latestWeekBySeason"] == {2024: 8, 2025: 8}
    assert got["selectedSeason"] == 2024 and got["selectedWeek"] is None


def test_a_hot_team_season_stays_whole(spark):
    """One team-season with most of the rows: sums over its weeks, whatever their number."""
    rows = [row(week=1 + i % 18, pointsFor=float(i)) for i in range(900)] + [row(team="KC")]
    states = scoring.build_states(placed(spark, rows))
    got = {r["team"]: r for r in season.team_season_means(states).collect()}
    assert got["DET"]["games"] == 900 and got["KC"]["games"] == 1
    assert got["DET"]["offensivePlays"] == pytest.approx(64.0)
