"""Properties of the physical plans that matter at scale."""

import re

import pytest

from checks import shapes
from checks.billing import accounts, billing, payers
from checks.queries import registry
from idlewatch.operators.lines import billing_lines
from idlewatch.operators.utilization import fee_hours, hourly_sums
from idlewatch.plans.monthly import wastage_plan
from idlewatch.sinks.staging import stage_lines
from idlewatch.sources.billing import month_table


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def staged(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("staged"))
    stage_lines(billing(spark, sf_dir), root, 2024, 1, shapes.PAYER_IDS)
    return root


@pytest.fixture(scope="module")
def lines(spark, staged):
    return billing_lines(month_table(spark, staged, 2024, 1, shapes.PAYER_IDS[:8]))


@pytest.mark.parametrize("name", ["wastage_all", "hourly_utilization", "interval_to_hours", "run_summary", "replace_slice"])
def test_no_nested_loops_and_no_python(spark, sf_dir, name):
    plan = plan_of(registry()[name][0](spark, sf_dir))
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "PythonUDF", "Pandas", "Arrow"):
        assert bad not in plan


def test_filters_reach_the_scan(spark, sf_dir, lines):
    plan = plan_of(wastage_plan(lines, payers(spark, sf_dir), accounts(spark, sf_dir), 2024, 1))
    scans = [s for s in plan.splitlines() if "FileScan parquet" in s and "line_item" in s]
    assert len(scans) == 4  # cutoff, description, fees, usage: each with its own narrow columns
    # Only the slices of the payers asked for are listed at all.
    read = {re.search("/payer=payer-([^/]*)/", f)[1] for f in lines.inputFiles()}
    assert read and read <= set(shapes.PAYER_IDS[:8])
    for scan in scans:
        assert "line_item_line_item_type" in scan.split("PushedFilters")[1]
    for scan in scans:
        if "reservation_reservation_a_r_n" in scan:
            # Plan strings shorten the filter list; the range on the start is first.
            assert re.search(r"PushedFilters: \[.*(line_item_usage_start|\.\.\.)", scan)
    cutoff = [s for s in scans if "reservation_reservation_a_r_n" not in s]
    assert len(cutoff) == 1 and "line_item_usage_amount" not in cutoff[0].split("ReadSchema")[1]


def test_hourly_rows_take_one_exchange_before_the_join(lines):
    plan = plan_of(hourly_sums(lines, 2024, 1))
    exchanges = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    assert sum("hour#" in e for e in exchanges) == 1
    # Map-side combine on both sides of the union, before that exchange.
    assert "partial_sum" in plan.split("Union")[0]


def test_exploded_fees_stay_spread(lines):
    tasks = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    assert fee_hours(lines, 2024, 1).rdd.getNumPartitions() == tasks


def test_a_hot_reservation_leaves_each_task_as_few_rows(spark, sf_dir):
    """Copies of one reservation's usage do not add rows behind the map-side combine."""
    base = billing(spark, sf_dir)
    hot = base.where("line_item_line_item_type = 'DiscountedUsage'").limit(1)
    copies = hot.selectExpr("explode(sequence(1, 30000)) AS copy", "*").drop("copy")
    lines = billing_lines(base.unionByName(copies))
    sums = hourly_sums(lines, 2024, 1)
    assert sums.count() == hourly_sums(billing_lines(base), 2024, 1).count()
