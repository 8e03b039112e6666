"""The stream followed to the facts: replayed batches, rejected files."""

import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from checks import shapes
from checks.billing import accounts, billing, payers
from idlewatch.plans.refresh import Places
from idlewatch.sinks.facts import read_facts
from idlewatch.sources.billing import billing_period_path
from idlewatch.streaming import intake
from idlewatch.streaming.intake import BatchLedger, export_stream, follow_to_facts


class Killed(Exception):
    """Ends the work of a batch where it stands."""


@pytest.fixture()
def stream(spark, sf_dir, tmp_path):
    root = str(tmp_path)
    places = Places(f"{root}/staged", f"{root}/facts", f"{root}/ledger", payers(spark, sf_dir), accounts(spark, sf_dir))
    lines = billing(spark, sf_dir)

    def follow(exports=None):
        source = export_stream(spark, f"{root}/export", lines.schema)
        exports = exports or (lambda ids: [(p, f"{root}/export") for p in ids])
        follow_to_facts(source, f"{root}/checkpoint", f"{root}/batches", exports, places).awaitTermination()

    return root, places, lines, follow


def test_a_kill_between_stage_and_facts(spark, stream, monkeypatch):
    root, places, lines, follow = stream
    lines.write.parquet(billing_period_path(f"{root}/export", 2024, 1))
    calls = {"stage": 0, "facts": 0}
    stage, run = intake.stage_exports, intake.run_month

    def staged(*args):
        calls["stage"] += 1
        return stage(*args)

    def killed(*_):
        raise Killed

    def computed(*args):
        calls["facts"] += 1
        return run(*args)

    monkeypatch.setattr(intake, "stage_exports", staged)
    monkeypatch.setattr(intake, "run_month", killed)
    with pytest.raises(StreamingQueryException):
        follow()
    assert calls == {"stage": 1, "facts": 0} and read_facts(spark, places.fact_path).count() == 0
    ledger = BatchLedger(spark, f"{root}/batches")
    assert [key[2] for key in ledger.steps(0)] == ["staged"]
    # The batch comes again: it is not staged again, only its facts are computed.
    monkeypatch.setattr(intake, "run_month", computed)
    follow()
    assert calls == {"stage": 1, "facts": 1} and read_facts(spark, places.fact_path).count() > 0
    assert sorted(key[2] for key in ledger.steps(0)) == ["facts", "staged"]
    # A later batch begins with no step behind it, whatever the last one left.
    lines.limit(3).write.mode("append").parquet(billing_period_path(f"{root}/export", 2024, 1))
    follow()
    assert calls == {"stage": 2, "facts": 2} and ledger.steps(0) == {} and len(ledger.steps(1)) == 2


def test_a_kill_after_the_facts_of_one_month(spark, stream, monkeypatch):
    root, places, lines, follow = stream
    for month in (1, 2):
        lines.where(F.col("bill_payer_account_id").isin(shapes.PAYER_IDS[:12])).write.parquet(billing_period_path(f"{root}/export", 2024, month))
    run, months, dead = intake.run_month, [], [True]

    def computed(*args):
        if args[6] == 2 and dead.pop():
            raise Killed
        months.append(args[6])
        return run(*args)

    monkeypatch.setattr(intake, "run_month", computed)
    with pytest.raises(StreamingQueryException):
        follow()
    dead.append(False)
    follow()
    assert months == [1, 2]


def test_rejected_files(spark, stream):
    root, places, lines, follow = stream
    some = lines.where("bill_payer_account_id IS NOT NULL").limit(5)
    some.coalesce(1).write.parquet(f"{root}/export/data/elsewhere")
    inside = billing_period_path(f"{root}/export", 2024, 1)
    lines.limit(1).withColumn("bill_payer_account_id", F.lit(None).cast("string")).coalesce(1).write.parquet(inside)
    lost = lines.where("bill_payer_account_id IS NOT NULL").limit(1)
    lost.coalesce(1).write.mode("append").parquet(inside)
    follow(lambda ids: [(p, f"{root}/nowhere") for p in ids])
    rows = BatchLedger(spark, f"{root}/batches").rejected().collect()
    assert {(r.batch_id, r.reason) for r in rows} == {(0, "no billing period"), (0, "lines without payer"), (0, "not staged")}
    assert [r.payer_id for r in rows if r.reason == "not staged"] == [lost.first().bill_payer_account_id]
    paths = {r.file_path for r in rows if r.reason == "no billing period"}
    assert len(paths) == 1 and "elsewhere" in paths.pop()
    assert not os.path.exists(places.staged_root) and read_facts(spark, places.fact_path).count() == 0
