"""Manifests of folders, and publication of whole runs or nothing."""

import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sideline.operators.quality import QualityError
from sideline.plans import jobs
from sideline.sinks import publication
from sideline.sinks.publication import Dataset
from sideline.sources import checksum
from tests.rows import raw_record, row, write


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "deep er").mkdir()
    for name in ("a.json", "b 100%.json", "deep er/c.json", "same.json"):
        write(tmp_path / name, name[:1])
    return tmp_path


def test_manifest_of_a_folder(spark, folder):
    got = {r.file: (r.sha256, r.length) for r in checksum.folder_manifest(spark, str(folder)).collect()}
    files = [p for p in folder.rglob("*") if p.is_file()]
    assert got == {str(p.relative_to(folder)): (hashlib.sha256(p.read_bytes()).hexdigest(), p.stat().st_size) for p in files}


def test_every_difference_is_found(spark, folder):
    pinned = spark.createDataFrame(checksum.folder_manifest(spark, str(folder)).collect(), "file string, sha256 string, length long")
    assert checksum.manifest_problems(checksum.folder_manifest(spark, str(folder)), pinned.unionByName(pinned)).count() == 0
    twice = spark.createDataFrame([("same.json", "0" * 64, 1), ("gone.json", "1" * 64, 1)], pinned.schema)
    pinned = pinned.where("file <> 'deep er/c.json'").unionByName(twice)
    write(folder / "a.json", "changed")
    found = {r.file: r.problem for r in checksum.manifest_problems(checksum.folder_manifest(spark, str(folder)), pinned).collect()}
    assert found == {"a.json": "changed", "deep er/c.json": "extra", "gone.json": "missing", "same.json": "listed twice"}
    with pytest.raises(QualityError, match="1 changed .first a.json.; 1 extra .first deep er/c.json.; 1 listed twice .first same.json.; 1 missing .first gone.json."):
        checksum.require_manifest(spark, str(folder), pinned)


def test_empty_manifest(spark, folder):
    none = spark.createDataFrame([], "file string, sha256 string")
    assert {r.problem for r in checksum.manifest_problems(checksum.folder_manifest(spark, str(folder)), none).collect()} == {"extra"}


def test_a_pinned_export_refuses_before_it_writes(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for team in ("BUF", "DET"):
        write(tmp_path / "in" / f"{team}.json", [raw_record(row(team=team, week=w)) for w in (1, 2)])
    pinned = spark.createDataFrame(checksum.folder_manifest(spark, str(tmp_path / "in")).collect(), "file string, sha256 string, length long")
    out = str(tmp_path / "out")
    run = jobs.publish_pinned(spark, str(tmp_path / "in"), pinned, out, generated_at="now")
    assert publication.current_run(spark, out) == run
    assert publication.read_dataset(spark, out, "weekly_states").count() == 4
    write(tmp_path / "in" / "KC.json", [raw_record(row(team="KC"))])
    before = sorted(map(str, Path(out).rglob("*")))
    with pytest.raises(QualityError, match="1 extra .first KC.json."):
        jobs.publish_pinned(spark, str(tmp_path / "in"), pinned, out)
    assert sorted(map(str, Path(out).rglob("*"))) == before


def test_a_failed_run_leaves_the_last_one(spark, tmp_path):
    out = str(tmp_path / "out")
    with pytest.raises(QualityError, match="nothing has been published"):
        publication.run_folder(spark, out)
    assert publication.current_run(spark, out) is None
    numbers = spark.range(10)
    first = publication.publish(spark, {"n": Dataset(numbers), "m": Dataset(numbers.withColumn("half", F.col("id") % 2), ("half",))}, out)
    with pytest.raises(Exception, match="half-way"):
        publication.publish(spark, {"n": Dataset(spark.range(99)), "x": Dataset(numbers.select(F.raise_error(F.lit("half-way")).cast("int").alias("x")))}, out)
    assert publication.current_run(spark, out) == first
    assert publication.read_dataset(spark, out, "n").count() == 10
    assert [p.name for p in Path(out, "runs").iterdir()] == [first]
    assert publication.published_problems(spark, out).count() == 0
    assert {r.dataset: r.files > 0 and r.bytes > 0 for r in publication.contents(spark, out).collect()} == {"n": True, "m": True}
    # the next runs take its place; two are kept
    runs = [publication.publish(spark, {"n": Dataset(spark.range(k))}, out) for k in (3, 4)]
    assert publication.current_run(spark, out) == runs[-1] and publication.read_dataset(spark, out, "n").count() == 4
    assert {p.name for p in Path(out, "runs").iterdir()} == set(runs)
    # a file that changes afterwards is found
    part = next(Path(out, "runs", runs[-1], "data", "n").glob("part-*"))
    part.write_bytes(part.read_bytes() + b"x")
    part.with_name("." + part.name + ".crc").unlink(missing_ok=True)
    assert [r.problem for r in publication.published_problems(spark, out).collect()] == ["changed"]


def test_a_whole_run_is_read_back(spark, tmp_path):
    write(tmp_path / "a.json", [raw_record(row(team=t, week=w)) for t in ("BUF", "DET") for w in range(1, 7)])
    run = jobs.run_documents(spark, str(tmp_path / "a.json"), generated_at="now")
    out = str(tmp_path / "out")
    jobs.publish_run(run, out)
    names = [*jobs.datasets(run), "rankings"]
    assert {r.dataset for r in publication.contents(spark, out).collect()} == set(names)
    for name, df in jobs.datasets(run).items():
        back = publication.read_dataset(spark, out, name)
        assert back.count() == df.count() and back.columns == df.columns
    assert publication.read_dataset(spark, out, "rankings").select("family", "metric").distinct().count() == 25
