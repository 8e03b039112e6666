"""The monthly job and the stream that triggers it."""

import pytest

from checks import shapes
from checks.billing import accounts, billing, payers
from checks.run import differences
from pyspark.sql import functions as F

from idlewatch.operators.lines import billing_lines
from idlewatch.operators.wastage import with_units
from idlewatch.plans.job import require_unique, run_month
from idlewatch.plans.monthly import wastage_plan
from idlewatch.session import shared_folder
from idlewatch.sinks.facts import FACT_SCHEMA, read_facts
from idlewatch.sinks.staging import stage_exports, stage_lines
from idlewatch.sources.billing import billing_period_path
from idlewatch.streaming.intake import export_stream, follow_exports


def expected(spark, sf_dir, payer_ids):
    lines = billing_lines(billing(spark, sf_dir), payer_ids)
    facts = with_units(wastage_plan(lines, payers(spark, sf_dir), accounts(spark, sf_dir), 2024, 1))
    return facts.select(*FACT_SCHEMA.names).toPandas().round(9)


def test_job_matches_the_plan_and_respects_the_payer_list(spark, sf_dir, tmp_path):
    root, path = str(tmp_path / "staged"), str(tmp_path / "facts")
    stage_lines(billing(spark, sf_dir), root, 2024, 1, shapes.PAYER_IDS)
    args = (payers(spark, sf_dir), accounts(spark, sf_dir), 2024, 1)
    some = shapes.PAYER_IDS[:10]
    run_month(spark, root, path, *args, [*some, some[0]])
    got = read_facts(spark, path).select(*FACT_SCHEMA.names).toPandas().round(9)
    assert differences(got, expected(spark, sf_dir, some)) == []
    run_month(spark, root, path, *args, shapes.PAYER_IDS)
    got = read_facts(spark, path).select(*FACT_SCHEMA.names).toPandas().round(9)
    assert differences(got, expected(spark, sf_dir, shapes.PAYER_IDS)) == []


def test_job_arguments(spark, sf_dir, tmp_path):
    args = (str(tmp_path / "s"), str(tmp_path / "f"), payers(spark, sf_dir), accounts(spark, sf_dir))
    for year, month, payer_ids in ((2019, 1, ["1"]), (2024, 13, ["1"]), (2024, 1, [])):
        with pytest.raises(ValueError):
            run_month(spark, *args, year, month, payer_ids)
    twice = spark.createDataFrame([("1",), ("1",), ("2",)], "account_id string")
    with pytest.raises(ValueError, match="'1'"):
        require_unique(twice, "account_id", "accounts")


def test_stream_reports_each_file_once(spark, sf_dir, tmp_path):
    base, root, checkpoint = (str(tmp_path / n) for n in ("export", "staged", "checkpoint"))
    lines = billing(spark, sf_dir)
    source = billing_period_path(base, 2024, 1)
    calls = []

    def follow():
        stream = export_stream(spark, source, lines.schema, files_per_batch=1000)
        follow_exports(stream, checkpoint, lambda *call: calls.append(call)).awaitTermination()

    one, two = shapes.PAYER_IDS[0:3], shapes.PAYER_IDS[3:9]
    by_payer = "bill_payer_account_id IN ({})".format
    lines.where(by_payer(", ".join(one))).write.mode("append").parquet(source)
    follow()
    lines.where(by_payer(", ".join(two))).write.mode("append").parquet(source)
    follow()
    follow()
    present = {r[0] for r in lines.select("bill_payer_account_id").distinct().collect()}
    want = [(2024, 1, sorted(present & set(ids))) for ids in (one, two)]
    assert calls == [w for w in want if w[2]]
    stage_exports(spark, [(p, base) for c in calls for p in c[2]], root, 2024, 1)


def test_stream_follows_the_billing_period(spark, sf_dir, tmp_path):
    """Lines of another month, without a start or a payer, and files outside any period."""
    source, calls = str(tmp_path / "export"), []
    lines = billing(spark, sf_dir)
    first = lines.where("bill_payer_account_id IS NOT NULL").limit(1)
    odd = first.withColumn("line_item_usage_start_date", F.lit("2023-12-31").cast(lines.schema["line_item_usage_start_date"].dataType))
    odd = odd.unionByName(first.withColumn("line_item_usage_start_date", F.lit(None).cast(lines.schema["line_item_usage_start_date"].dataType)))
    odd = odd.unionByName(first.withColumn("bill_payer_account_id", F.lit(None).cast("string")))
    odd.write.parquet(billing_period_path(source, 2024, 1))
    first.write.parquet(f"{source}/data/elsewhere")
    stream = export_stream(spark, source, lines.schema)
    follow_exports(stream, str(tmp_path / "c"), lambda *call: calls.append(call)).awaitTermination()
    assert calls == [(2024, 1, [first.first().bill_payer_account_id])]


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
