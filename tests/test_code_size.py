"""The JVM compiles no method above 8000 bytes: its rows would be interpreted."""

import pytest

from checks import shapes
from checks.billing import accounts, billing, payers
from idlewatch.operators.lines import billing_lines
from idlewatch.operators.utilization import hourly_sums
from idlewatch.operators.wastage import update_units
from idlewatch.plans.monthly import wastage_plan
from idlewatch.session import OPEN_WRITERS
from idlewatch.sinks.facts import FACT_SCHEMA, read_facts, replace_slices, update_stored_units
from idlewatch.sinks.staging import stage_lines
from idlewatch.sources.billing import month_table

LIMIT = 8000


def largest_method(df) -> int:
    debug = df.sparkSession._jvm.org.apache.spark.sql.execution.debug.__getattr__("package")
    stages = debug.codegenStringSeq(df._jdf.queryExecution().executedPlan())
    return max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.length()))


@pytest.fixture()
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.enabled")


def test_units_are_set_by_compiled_code(static_plans, tmp_path):
    static_plans.createDataFrame([], FACT_SCHEMA).write.parquet(str(tmp_path / "facts"))
    facts = static_plans.read.schema(FACT_SCHEMA).parquet(str(tmp_path / "facts"))
    assert largest_method(update_units(facts, 2024, 1).select(*FACT_SCHEMA.names).repartition(4, "product_name")) <= LIMIT


def test_hours_are_not_exchanged_after_they_grow(static_plans, sf_dir):
    lines = billing_lines(billing(static_plans, sf_dir), shapes.PAYER_IDS)
    plan = wastage_plan(lines, payers(static_plans, sf_dir), accounts(static_plans, sf_dir), 2024, 1)
    above = plan._jdf.queryExecution().executedPlan().toString().split("Generate explode(hours")[0]
    assert "Exchange" not in above and "Sort" not in above
    assert hourly_sums(lines, 2024, 1).count() > 0


def test_stored_units_need_neither_exchange_nor_sort(spark, sf_dir, tmp_path):
    lines = billing_lines(billing(spark, sf_dir), shapes.PAYER_IDS)
    rows = wastage_plan(lines, payers(spark, sf_dir), accounts(spark, sf_dir), 2024, 1)
    units = [f"CAST(NULL AS DOUBLE) AS {u}" for u in ("total_units", "used_units", "unused_units")]
    path, products = str(tmp_path), ["EC2(RIs)", "RDS", "ElastiCache", "OpenSearch", "Redshift"]
    replace_slices(rows.selectExpr("*", *units), path, 2024, 1, shapes.PAYER_IDS, products)
    files = len(read_facts(spark, path).inputFiles())
    before = read_facts(spark, path).count()
    update_stored_units(spark, path, 2024, 1)
    after = read_facts(spark, path)
    assert after.count() == before and len(after.inputFiles()) <= files
    assert after.where("used_units IS NOT NULL").count() > 0
    assert spark.conf.get(OPEN_WRITERS, "0") == "0"


def test_staged_files_hold_one_payer_each(spark, sf_dir, tmp_path):
    """The tasks write many payers with their files open: all lines arrive, each with its payer."""
    lines = billing(spark, sf_dir)
    stage_lines(lines.coalesce(1), str(tmp_path), 2024, 1, shapes.PAYER_IDS)
    for payer in shapes.PAYER_IDS:
        mine = lines.where(f"bill_payer_account_id = '{payer}'").count()
        try:
            staged = month_table(spark, str(tmp_path), 2024, 1, [payer])
        except FileNotFoundError:
            assert mine == 0
            continue
        assert staged.where(f"bill_payer_account_id = '{payer}'").count() == staged.count() == mine
