"""The incremental run: outcomes per payer, what failures leave behind, what is found again."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks import shapes
from checks.billing import accounts, billing, payers
from idlewatch.plans import refresh
from idlewatch.plans.refresh import Places, processed_files, refresh_reopened, refresh_run, reopened_months, summary_of
from idlewatch.sinks.facts import read_facts
from idlewatch.sinks.staging import export_files, stage_exports, withdraw_files
from idlewatch.sources.billing import billing_period_path, month_table
from idlewatch.sources.discovery import file_diff, file_listing

ONE, TWO = shapes.PAYER_IDS[6], shapes.PAYER_IDS[7]


@pytest.fixture(scope="module")
def lines(spark, sf_dir):
    """Lines of the two payers with the most facts, under fixed names."""
    from checks.queries import facts

    most = facts(spark, sf_dir).groupBy("bill_payeraccountid").count().orderBy(F.desc("count")).limit(2).collect()
    mine = billing(spark, sf_dir).where(F.col("bill_payer_account_id").isin([r[0] for r in most]))
    renamed = F.when(F.col("bill_payer_account_id") == most[0][0], ONE).otherwise(TWO)
    return mine.withColumn("bill_payer_account_id", renamed).cache()


class Exports:
    """Two payers with an export each, and one without configuration."""

    def __init__(self, spark, sf_dir, lines, root):
        self.spark, self.lines, self.root = spark, lines, root
        self.places = Places(f"{root}/staged", f"{root}/facts", f"{root}/ledger", payers(spark, sf_dir), accounts(spark, sf_dir))
        rows = [(ONE, "primary", "one"), (TWO, "fallback", "two"), ("9", "missing", None)]
        self.resolved = spark.createDataFrame(rows, "payer_id string, source string, bucket string")

    def folder(self, payer_id, month=1):
        return billing_period_path(f"{self.root}/{'one' if payer_id == ONE else 'two'}", 2024, month)

    def write(self, payer_id, condition="true", month=1):
        mine = self.lines.where(F.col("bill_payer_account_id") == payer_id).where(condition)
        mine.coalesce(1).write.mode("append").parquet(self.folder(payer_id, month))

    def files(self, payer_id, month=1):
        folder = self.folder(payer_id, month)
        return sorted(f"{folder}/{f}" for f in os.listdir(folder) if f.endswith(".parquet"))

    def run(self):
        outcomes = refresh_run(self.spark, self.resolved, f"concat('{self.root}/', bucket)", self.places, 2024, 1)
        return {r.payer_id: (r.status, r.success, r.failed) for r in outcomes.collect()}, summary_of(outcomes).first()

    def facts(self):
        counted = read_facts(self.spark, self.places.fact_path).groupBy("bill_payeraccountid").count()
        return {r[0]: r[1] for r in counted.collect()}

    def processed(self):
        return processed_files(self.spark, self.places.ledger_path, 2024, 1).count()


@pytest.fixture()
def job(spark, sf_dir, lines, tmp_path):
    return Exports(spark, sf_dir, lines, str(tmp_path))


def test_runs_in_sequence(job, monkeypatch):
    job.write(ONE)
    state, summary = job.run()
    assert state == {ONE: ("HAS_NEW_FILES", 1, 0), TWO: ("UP_TO_DATE", 0, 0), "9": ("FAILED", 0, 0)}
    assert (summary.status, summary.success, summary.failed, summary.failed_payers) == ("FAILED", 1, 0, 1)
    first = job.facts()
    assert set(first) == {ONE} and job.processed() == 1
    # Nothing new: nothing is staged or computed, so a broken job would not show.
    with monkeypatch.context() as m:
        m.setattr(refresh, "run_month", None)
        m.setattr(refresh, "stage_each", None)
        assert job.run()[0][ONE] == ("UP_TO_DATE", 0, 0)
    # The facts fail after staging: the ledger stays, the next run finds the file again.
    job.write(TWO)
    with monkeypatch.context() as m:
        m.setattr(refresh, "run_month", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            job.run()
    assert job.facts() == first and job.processed() == 1
    assert job.run()[0][TWO] == ("HAS_NEW_FILES", 1, 0)
    assert set(job.facts()) == {ONE, TWO} and job.processed() == 2


def test_a_broken_file_costs_its_own_payer_and_holds_up_the_facts(job):
    job.write(ONE)
    os.makedirs(job.folder(TWO))
    with open(f"{job.folder(TWO)}/x.parquet", "wb") as file:
        file.write(b"PAR1 no parquet")
    state, summary = job.run()
    assert state[ONE] == ("HAS_NEW_FILES", 1, 0) and state[TWO] == ("HAS_NEW_FILES", 0, 1)
    assert (summary.status, summary.success, summary.failed) == ("FAILED", 1, 1)
    assert job.facts() == {} and job.processed() == 0
    assert month_table(job.spark, job.places.staged_root, 2024, 1, [ONE]).count() > 0
    os.remove(f"{job.folder(TWO)}/x.parquet")
    job.write(TWO)
    assert job.run()[0][TWO] == ("HAS_NEW_FILES", 1, 0) and set(job.facts()) == {ONE, TWO}


def test_removed_files_restage_and_lost_folders_keep_the_staged_lines(job):
    late = "line_item_usage_start_date >= TIMESTAMP_NTZ '2024-01-10 00:00:00'"
    job.write(ONE, f"NOT ({late})")
    job.write(ONE, late)
    job.run()
    whole = month_table(job.spark, job.places.staged_root, 2024, 1, [ONE]).count()
    before = job.facts()
    files = job.files(ONE)
    os.remove(files[0])
    assert job.run()[0][ONE] == ("HAS_NEW_FILES", 1, 0)
    left = month_table(job.spark, job.places.staged_root, 2024, 1, [ONE]).count()
    assert 0 < left < whole and job.processed() == 1
    second = job.facts()
    os.remove(files[1])
    state, summary = job.run()
    assert state[ONE] == ("HAS_NEW_FILES", 0, 1) and (summary.status, summary.failed) == ("FAILED", 1)
    assert month_table(job.spark, job.places.staged_root, 2024, 1, [ONE]).count() == left
    assert job.facts() == second and before != {} and job.processed() == 1


def test_late_files_reopen_their_month_for_their_payer(job):
    job.write(ONE)
    job.write(TWO)
    job.run()
    exports = [(ONE, f"{job.root}/one"), (TWO, f"{job.root}/two"), ("8", f"{job.root}/nowhere")]
    assert reopened_months(job.spark, exports, job.places.ledger_path).collect() == []
    # A month never processed, and a file outside any billing period.
    job.write(ONE, month=2)
    job.lines.limit(1).write.parquet(f"{job.root}/one/data/elsewhere")
    job.write(TWO, "line_item_line_item_type = 'RIFee'")
    got = [tuple(r) for r in reopened_months(job.spark, exports, job.places.ledger_path).collect()]
    assert got == [(2024, 1, TWO, 1)]
    (run,) = refresh_reopened(job.spark, job.resolved, f"concat('{job.root}/', bucket)", job.places)
    assert run[:2] == (2024, 1) and [r.payer_id for r in run[2].collect()] == [TWO]
    assert reopened_months(job.spark, exports, job.places.ledger_path).collect() == []


def test_a_payer_whose_file_has_no_lines(job):
    job.write(ONE, "false")
    assert job.run()[0][ONE] == ("HAS_NEW_FILES", 1, 0) and job.facts() == {} and job.processed() == 1
    job.write(ONE)
    job.run()
    assert set(job.facts()) == {ONE}
    os.remove(next(f for f in job.files(ONE) if os.path.getsize(f) == max(map(os.path.getsize, job.files(ONE)))))
    assert job.run()[0][ONE] == ("HAS_NEW_FILES", 1, 0) and job.facts() == {}


def test_file_diff(spark, tmp_path):
    t = datetime(2024, 1, 1)
    schema = "payer_id string, key string, size bigint, last_modified timestamp, checksum string"
    old = [("p", "same", 1, t, "a"), ("p", "gone", 1, t, "a"), ("p", "grown", 1, t, "a"), ("p", "touched", 1, t, "a"),
           ("p", "rewritten", 1, t, "a"), ("p", "folder/", 0, t, "a"), ("q", "same", 1, t, "a")]
    new = [("p", "same", 1, t, "a"), ("p", "new", 1, t, "a"), ("p", "grown", 2, t, "a"), ("p", "touched", 1, datetime(2023, 1, 1), "a"),
           ("p", "rewritten", 1, t, "b"), ("q", "same", 1, t, None)]
    before, after = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    got = {(r.payer_id, r.key, r.change) for r in file_diff(before, after).collect()}
    assert got == {("p", "gone", "removed"), ("p", "new", "added"), ("p", "grown", "changed"), ("p", "touched", "changed"),
                   ("p", "rewritten", "changed"), ("q", "same", "changed")}
    plain = file_diff(before.drop("checksum"), after).collect()
    assert {r.key for r in plain} == {"gone", "new", "grown", "touched"}
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "x").write_bytes(b"abc")
    (row,) = file_listing(spark, str(tmp_path / "f"), checksum=True).collect()
    assert row.checksum == "900150983cd24fb0d6963f7d28e17f72" and row.size == 3
    assert file_listing(spark, str(tmp_path / "f"), pattern="*.parquet").count() == 0


def test_an_empty_folder_keeps_the_staged_lines(spark, job):
    job.write(ONE)
    job.write(TWO)
    exports = [(ONE, f"{job.root}/one"), (TWO, f"{job.root}/two")]
    assert stage_exports(spark, exports, f"{job.root}/s", 2024, 1) == [ONE, TWO]
    before = month_table(spark, f"{job.root}/s", 2024, 1, [ONE]).count()
    os.remove(job.files(ONE)[0])
    assert stage_exports(spark, exports, f"{job.root}/s", 2024, 1) == [TWO]
    assert month_table(spark, f"{job.root}/s", 2024, 1, [ONE]).count() == before > 0
    assert {r.payer_id for r in export_files(spark, exports, 2024, 1).collect()} == {TWO}
    with pytest.raises(FileNotFoundError):
        stage_exports(spark, exports[:1], f"{job.root}/s", 2024, 1)


def test_lines_of_one_file_can_be_withdrawn(spark, job):
    job.write(ONE, "line_item_line_item_type = 'RIFee'")
    job.write(ONE, "line_item_line_item_type <> 'RIFee'")
    job.write(TWO)
    stage_exports(spark, [(ONE, f"{job.root}/one"), (TWO, f"{job.root}/two")], f"{job.root}/s", 2024, 1)
    staged = month_table(spark, f"{job.root}/s", 2024, 1)
    names = {r.source_file: r.types for r in staged.where(F.col("bill_payer_account_id") == ONE).groupBy("source_file").agg(
        F.collect_set("line_item_line_item_type").alias("types")).collect()}
    assert set(names) == {os.path.basename(f) for f in job.files(ONE)}
    fees = next(n for n, types in names.items() if types == ["RIFee"])
    two = staged.where(F.col("bill_payer_account_id") == TWO).count()
    gone = spark.createDataFrame([(ONE, fees), (ONE, "never.parquet")], "payer_id string, source_file string")
    assert withdraw_files(spark, f"{job.root}/s", 2024, 1, gone) == [ONE]
    left = month_table(spark, f"{job.root}/s", 2024, 1)
    assert {r[0] for r in left.where(F.col("bill_payer_account_id") == ONE).select("source_file").distinct().collect()} == set(names) - {fees}
    assert left.where(F.col("bill_payer_account_id") == TWO).count() == two
    assert withdraw_files(spark, f"{job.root}/s", 2024, 1, gone.limit(0)) == []
