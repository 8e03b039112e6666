"""Tables of versioned slices: commits show whole or not at all."""

import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from idlewatch.sinks import versions
from idlewatch.sinks.facts import SLICES, read_facts, replace_slices, update_stored_units
from tests.test_facts import FEB, JAN, PRODUCTS, facts, stored

ROWS = "a string, b int, v double"


def rows_of(spark, *rows):
    return spark.createDataFrame(list(rows), ROWS)


def slices_of(spark, *rows):
    return spark.createDataFrame(list(rows), "a string, b int")


def content(spark, path, where=None):
    schema = rows_of(spark).schema
    return sorted(tuple(r) for r in versions.read_slices(spark, path, schema, ["a", "b"], where).collect())


@pytest.fixture()
def path(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = rows_of(spark, ("x", 1, 1.0), ("x", 2, 2.0), ("007", 1, 3.0))
    versions.commit(rows, path, ["a", "b"], rows.select("a", "b"))
    return path


OLD = [("007", 1, 3.0), ("x", 1, 1.0), ("x", 2, 2.0)]


def test_replace_empty_and_add(spark, path):
    new = rows_of(spark, ("x", 1, 9.0), ("x", 1, 8.0), ("z", 5, 7.0))
    versions.commit(new, path, ["a", "b"], slices_of(spark, ("x", 1), ("007", 1), ("z", 5), ("never", 0)))
    assert content(spark, path) == [("x", 1, 8.0), ("x", 1, 9.0), ("x", 2, 2.0), ("z", 5, 7.0)]
    assert content(spark, path, "a = 'x' AND b = 1") == [("x", 1, 8.0), ("x", 1, 9.0)]
    named = {(r.a, r.b): r.folder for r in versions.manifest(spark, path, slices_of(spark).schema).collect()}
    assert named[("007", 1)] is None and ("never", 0) not in named and len(named) == 4
    # The emptied slice can be filled again.
    versions.commit(rows_of(spark, ("007", 1, 4.0)), path, ["a", "b"], slices_of(spark, ("007", 1)))
    assert ("007", 1, 4.0) in content(spark, path)


def test_names_with_special_characters(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(a, 1, 1.0) for a in ("EC2(RIs)", "a/b=c", "50%", "x+y z", "[q]{r}*?", "é:ü", "\\")]
    df = rows_of(spark, *rows)
    versions.commit(df, path, ["a", "b"], df.select("a", "b"))
    assert content(spark, path) == sorted(rows)
    assert {r.a for r in versions.manifest(spark, path, slices_of(spark).schema).collect()} == {r[0] for r in rows}


def test_a_failed_write_leaves_the_table(spark, path):
    bad = rows_of(spark, ("x", 1, 5.0)).withColumn("v", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        versions.commit(bad, path, ["a", "b"], slices_of(spark, ("x", 1)))
    assert content(spark, path) == OLD and versions.snapshots(spark, path) == [1]


def test_a_run_that_stops_between_data_and_manifest(spark, path, monkeypatch):
    def stop(*_):
        raise KeyboardInterrupt

    new = rows_of(spark, ("x", 1, 5.0))
    with monkeypatch.context() as m:
        m.setattr(versions, "publish", stop)
        with pytest.raises(KeyboardInterrupt):
            versions.commit(new, path, ["a", "b"], slices_of(spark, ("x", 1), ("x", 2)))
    assert content(spark, path) == OLD
    # A manifest that was begun but never completed does not count either.
    os.makedirs(f"{path}/manifest/2")
    assert content(spark, path) == OLD and versions.snapshots(spark, path) == [1]
    os.rmdir(f"{path}/manifest/2")
    versions.commit(new, path, ["a", "b"], slices_of(spark, ("x", 1), ("x", 2)))
    assert content(spark, path) == [("007", 1, 3.0), ("x", 1, 5.0)]


def test_a_commit_beside_another_is_refused(spark, path, monkeypatch):
    plain = versions.written_slices

    def meanwhile(*args):
        monkeypatch.setattr(versions, "written_slices", plain)
        versions.commit(rows_of(spark, ("x", 2, 6.0)), path, ["a", "b"], slices_of(spark, ("x", 2)))
        return plain(*args)

    monkeypatch.setattr(versions, "written_slices", meanwhile)
    with pytest.raises(versions.ConcurrentCommit):
        versions.commit(rows_of(spark, ("x", 1, 5.0)), path, ["a", "b"], slices_of(spark, ("x", 1)))
    assert content(spark, path) == [("007", 1, 3.0), ("x", 1, 1.0), ("x", 2, 6.0)]


def test_unreferenced_folders_are_removed(spark, path):
    for v in (4.0, 5.0, 6.0):
        versions.commit(rows_of(spark, ("x", 1, v)), path, ["a", "b"], slices_of(spark, ("x", 1)))
    before = content(spark, path)
    schema = StructType(slices_of(spark).schema.fields)
    gone = versions.remove_unreferenced(spark, path, schema, keep=1)
    assert {g for g in gone if g.startswith("manifest")} == {"manifest/1", "manifest/2", "manifest/3"}
    assert len([g for g in gone if g.startswith("data")]) == 2 and content(spark, path) == before
    assert versions.remove_unreferenced(spark, path, schema, keep=1) == []
    versions.commit(rows_of(spark), path, ["a", "b"], slices_of(spark, ("x", 1)))
    assert content(spark, path) == [("007", 1, 3.0), ("x", 2, 2.0)]


def test_table_without_any_commit(spark, tmp_path):
    assert content(spark, str(tmp_path / "none")) == []
    assert read_facts(spark, str(tmp_path / "none")).count() == 0


def jobs_of(spark, run):
    tracker, group = spark.sparkContext.statusTracker(), "count-jobs"
    spark.sparkContext.setJobGroup(group, group)
    run()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(tracker.getJobIdsForGroup(group))


def test_emptying_many_slices_takes_no_job_each(spark, tmp_path):
    def emptied(n):
        path, payer_ids = str(tmp_path / f"f{n}"), [str(i) for i in range(n)]
        replace_slices(facts(spark, *[("RDS", p, JAN, 1.0) for p in payer_ids]), path, 2024, 1, payer_ids, PRODUCTS)
        jobs = jobs_of(spark, lambda: replace_slices(facts(spark).limit(0), path, 2024, 1, payer_ids, PRODUCTS))
        assert stored(spark, path) == []
        return jobs

    assert emptied(12) <= emptied(2)


def test_unit_update_never_overwrites_what_it_reads(spark, tmp_path):
    path = str(tmp_path / "facts")
    replace_slices(facts(spark, ("Redshift", "1", JAN, 8.0)), path, 2024, 1, ["1"], ["Redshift"])
    replace_slices(facts(spark, ("Redshift", "1", FEB, 6.0)), path, 2024, 2, ["1"], ["Redshift"])
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/data/**/*.parquet", recursive=True)}
    folders = set(versions.folders(spark, path, SLICES))
    update_stored_units(spark, path, 2024, 1)
    assert {f: os.stat(f).st_mtime_ns for f in before} == before
    after = set(versions.folders(spark, path, SLICES))
    # The January slice has a new folder, the February slice the one it had.
    assert {f for f in after & folders} == {f for f in folders if "startmonth=2" in f} and len(after) == 2
