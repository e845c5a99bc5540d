import random

from pyspark.sql import functions as F

from sideline.operators import ranking, scoring
from tests.rows import frame, placed, row


def _league(seed=3, n=300):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        # few distinct values: most ranks are decided by the tie-breaks
        out.append(row(team=f"T{i % 40:02d}", season=2023 + i % 3, week=1 + (i // 120),
                       fantasyPointsAllowedQB=float(rng.choice([10, 20])), epaPerPlay=rng.choice([0.0, 0.1])))
    return out


def test_rank_matches_a_full_sort(spark):
    rows = _league()
    ranked = ranking.rank_by(scoring.build_states(frame(spark, rows)), "fantasyPointsAllowedQB").collect()
    want = sorted(rows, key=lambda r: (-r["fantasyPointsAllowedQB"], -r["season"], -r["week"], r["team"]))
    got = {r["rank"]: (r["score"], r["season"], r["week"], r["team"]) for r in ranked}
    assert sorted(got) == list(range(1, len(rows) + 1))
    for i, r in enumerate(want, 1):
        assert got[i] == (r["fantasyPointsAllowedQB"], r["season"], r["week"], r["team"])


def test_ascending_order(spark):
    states = scoring.build_states(frame(spark, _league(n=60)))
    up = {r["rank"]: r["score"] for r in ranking.rank_by(states, "volatilityScore", descending=False).collect()}
    assert [up[i] for i in sorted(up)] == sorted(up.values())


def test_equal_rows_keep_input_order(spark):
    rows = [row(pointsFor=float(i)) for i in range(50)]
    states = scoring.build_states(placed(spark, rows))
    order = [F.desc("teamPowerScore"), F.asc("team"), *ranking.origin_order(states)]
    got = {r["rank"]: r["rowIndex"] for r in ranking.number_rows(states, order).collect()}
    assert got == {i + 1: i for i in range(50)}


def test_rank_is_taken_on_the_unrounded_score(spark):
    rows = [row(team="A", fantasyPointsAllowedTE=10.001), row(team="B", fantasyPointsAllowedTE=10.004)]
    got = ranking.rank_by(scoring.build_states(frame(spark, rows)), "fantasyPointsAllowedTE").collect()
    assert {r["team"]: (r["rank"], r["score"]) for r in got} == {"B": (1, 10.0), "A": (2, 10.0)}


def test_several_rankings_at_once_and_latest_week(spark):
    rows = [row(team=t, season=s, week=w, fantasyPointsAllowedQB=float(w + i))
            for i, t in enumerate("ABC") for s, last in ((2024, 3), (2025, 2)) for w in range(1, last + 1)]
    states = scoring.build_states(frame(spark, rows))
    got = ranking.rank_states(states, latest_week=True).collect()
    assert len(got) == 7 * 6
    assert {(r["season"], r["week"]) for r in got} == {(2024, 3), (2025, 2)}
    qb = sorted((r for r in got if r["ranking"] == "qb_matchups"), key=lambda r: r["rank"])
    assert [(r["season"], r["team"], r["score"]) for r in qb] == [
        (2024, "C", 5.0), (2025, "C", 4.0), (2024, "B", 4.0), (2025, "B", 3.0), (2024, "A", 3.0), (2025, "A", 2.0)]


def test_dictionary_order_of_teams(spark):
    rows = [row(team=t) for t in ("b", "B", "a1", "A", "a")]
    got = ranking.rank_by(scoring.build_states(frame(spark, rows)), "stabilityScore").orderBy("rank").collect()
    assert [r["team"] for r in got] == ["a", "A", "a1", "b", "B"]


def test_hot_value_spreads_over_slices(spark):
    """A third of all rows share one score: ranks stay whole and the rows are split over slices."""
    n = 60_000
    df = spark.range(n).selectExpr("id", "if(id % 3 = 0, 7D, double(id)) AS value")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = ranking.number_rows(df, [F.desc("value"), F.asc("id")])
        got = ranked.agg(F.min("rank"), F.max("rank"), F.countDistinct("rank")).first()
        assert tuple(got) == (1, n, n)
        off = ranked.where("value = 7").agg(F.min("rank"), F.max("rank")).first()
        assert off[1] - off[0] + 1 == ranked.where("value = 7").count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
