"""No query reads the facts more than once, whatever it writes on the way."""

import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from sideline.operators import quality
from sideline.plans import jobs, registry
from sideline.sources import documents, star_schema

FOLDER = "/root/testdata/sf0.001"
NAMES = [
    "movement_v0", "movement_at_week_5", "movement_at_week_3", "movement_v1", "features", "feature_guards", "feature_table",
    "feature_problems", "coverage_dense", "coverage_bye", "coverage_dense_summary", "coverage_bye_summary", "run_metadata",
    "rank_weekly_all", "rank_latest_all", "latest_team_power", "rank_team_power", "season_report_problems", "report_bundle",
    "standing_expectations", "season_order",
]


def _facts(df) -> int:
    return len(re.findall(r"FileScan parquet \[l_orderkey", df._jdf.queryExecution().executedPlan().toString()))


@pytest.mark.parametrize("name", NAMES)
def test_one_scan(spark, monkeypatch, name):
    seen, real = [], DataFrameWriter.parquet

    def parquet(self, *args, **options):
        seen.append(_facts(self._df))
        return real(self, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    df = registry.queries()[name](spark, FOLDER)
    assert sum(seen) + _facts(df) == 1


def test_a_published_run_reads_the_facts_once(spark, monkeypatch, tmp_path):
    """Whatever data sets count the rows, of a whole run and of a sliced one."""
    seen, real = [], DataFrameWriter.save

    def save(self, *args, **options):
        seen.append(_facts(self._df))
        return real(self, *args, **options)

    def parquet(self, *args, **options):
        seen.append(_facts(self._df))
        return written(self, *args, **options)

    written = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "save", save)
    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    for season, last in ((None, None), (2011, 5), (None, 7)):
        seen.clear()
        rows = star_schema.team_weeks(spark, FOLDER)
        run = jobs.analyse(rows, season, last)
        jobs.publish_run(run, f"{tmp_path}/out")
        assert sum(seen) == 1
        assert run.metadata.collect() == jobs.run_metadata(documents.typed_keys(rows), season, last).collect()


def test_the_check_of_a_run_costs_no_scan(spark, monkeypatch):
    """Canonical rules are counted in the pass that writes the states, over all rows of all seasons."""
    seen, real = [], DataFrameWriter.parquet

    def parquet(self, *args, **options):
        seen.append(_facts(self._df))
        return real(self, *args, **options)

    def none(*_):
        raise AssertionError("rows of a clean run are looked at again")

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    monkeypatch.setattr(quality, "violations", none)
    run = jobs.analyse(star_schema.team_weeks(spark, FOLDER), season_=2011)
    assert sum(seen) == 1 and run.states.select("season").distinct().count() == 1


def test_a_bad_row_outside_the_slice_fails_the_run(spark):
    rows = star_schema.team_weeks(spark, FOLDER)
    spoiled = rows.withColumn("turnovers", F.expr("if(season = 2008, -1D, turnovers)"))
    with pytest.raises(quality.QualityError, match="Invalid non-negative field turnovers: -1"):
        jobs.analyse(spoiled, season_=2011)
    with pytest.raises(quality.QualityError, match="No rows remain"):
        jobs.analyse(rows, season_=1990)


def test_a_ranking_without_text_writes_none(spark, monkeypatch):
    seen, real = [], DataFrameWriter.parquet

    def parquet(self, *args, **options):
        seen.append(self._df.columns)
        return real(self, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    registry.queries()["rank_weekly_all"](spark, FOLDER)
    assert seen and not any({"tags", "summary"} & set(columns) for columns in seen)


def test_a_season_reaches_the_scan(spark):
    df = registry.queries()["slice_rows"](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan
