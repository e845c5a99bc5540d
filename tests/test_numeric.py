import random

import pytest
from pyspark.sql import functions as F

from sideline.functions import numeric as n
from sideline.functions.text import normalized_path, path_type
from tests.brute import half_up


@pytest.mark.parametrize("digits", [0, 1, 2, 3, 4, 6])
def test_exact_round_matches_exact_decimals(spark, digits):
    rng = random.Random(digits)
    ties = [k / 10**digits + 0.5 / 10**digits for k in range(-300, 300)]
    eighths = [k / 8 for k in range(-200, 200)]
    xs = ties + eighths + [rng.uniform(-1e5, 1e5) for _ in range(2000)] + [1.005, 1.115, -1.005, 0.0]
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = df.selectExpr("x", f"{n.exact_round('x', digits)} AS y").collect()
    bad = [(r.x, r.y, half_up(r.x, digits)) for r in got if r.y != half_up(r.x, digits)]
    assert not bad, bad[:3]


def test_rounding_keeps_null_and_has_no_negative_zero(spark):
    df = spark.createDataFrame([(None,), (-0.001,)], "x double")
    got = [r.y for r in df.selectExpr(f"{n.exact_round('x', 2)} AS y").collect()]
    assert got[0] is None and str(got[1]) == "0.0"


def test_texts(spark):
    df = spark.createDataFrame([(-0.001,), (0.125,), (1.005,), (-1.5,), (12.0,)], "x double")
    got = [tuple(r) for r in df.selectExpr(n.fixed_text("x", 2), n.number_text("x")).collect()]
    assert got == [("-0.00", "-0.001"), ("0.13", "0.125"), ("1.00", "1.005"), ("-1.50", "-1.5"), ("12.00", "12")]


def test_non_finite_values(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (None,), (5.0,)], "x double")
    got = [tuple(r) for r in df.selectExpr(
        n.is_finite("x"), n.clamp("x", 1, 4), n.safe_number("x", 7), n.normalize("x", 0, 10),
        n.normalize("x", 0, 10, True), n.normalize("x", 3, 3), n.is_integer("x"),
    ).collect()]
    lost = (False, 1.0, 7.0, 0.0, 0.0, 0.0, False)
    assert got == [lost, lost, lost, (True, 4.0, 5.0, 50.0, 50.0, 0.0, True)]


def test_weighted_average(spark):
    parts = {"a": "x", "b": "10D"}
    df = spark.createDataFrame([(50.0,)], "x double")
    got = df.selectExpr(
        n.weighted_average(parts, {"a": 0.5, "b": 0.5, "gone": 1.0}), n.weighted_average(parts, {"a": 0.0}),
        n.weighted_average({"a": "500D"}, {"a": 1.0}),
    ).first()
    assert tuple(got) == (15.0, 0.0, 100.0)


def test_source_paths(spark):
    paths = {
        "/home/x/data/sample/a.json": ("data/sample/a.json", "sample"),
        "C:\\w\\data\\fixtures\\a.json": ("fixtures/a.json", "fixture"),
        "./data/fixtures/a.json": ("fixtures/a.json", "fixture"),
        "fixtures/a.json": ("fixtures/a.json", "fixture"),
        "/promoted/a.json": ("/promoted/a.json", "unknown"),
        "": (None, "unknown"),
    }
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = df.select("p", normalized_path(F.col("p")), path_type(F.col("p"))).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == paths
