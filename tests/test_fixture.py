"""The derived lines have rows on which every filter matters: without one, the facts change."""

import pytest
from pyspark.sql import functions as F

from checks import shapes
from checks.billing import accounts, billing, payers
from checks.queries import facts, lines
from idlewatch.operators import dimensions, utilization
from idlewatch.operators.lines import billing_lines
from idlewatch.operators.services import SERVICES
from idlewatch.plans import monthly
from idlewatch.plans.monthly import service_plan, wastage_plan

MONTH = (shapes.YEAR, shapes.MONTH)


def content(df):
    row = df.agg(F.count("*"), F.sum(F.hash(*[F.round(c, 6) if t == "double" else F.col(c) for c, t in df.dtypes]).cast("long"))).first()
    return tuple(row)


@pytest.fixture(scope="module")
def sf_dir():
    """The smallest tables hold too few fees for all of these rows."""
    return "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def right(spark, sf_dir):
    return content(facts(spark, sf_dir))


def dims(spark, sf_dir):
    return payers(spark, sf_dir), accounts(spark, sf_dir)


def test_payer_list(spark, sf_dir, right):
    everyone = billing_lines(billing(spark, sf_dir))
    assert content(wastage_plan(everyone, *dims(spark, sf_dir), *MONTH)) != right


@pytest.mark.parametrize("module", [dimensions, utilization])
def test_month(spark, sf_dir, right, module, monkeypatch):
    monkeypatch.setattr(module, "in_month", lambda *_: "true")
    assert content(facts(spark, sf_dir)) != right


def test_cutoff_over_all_months(spark, sf_dir, right, monkeypatch):
    plain = monthly.payer_max_date
    monkeypatch.setattr(monthly, "payer_max_date", lambda rows: plain(rows.where("month(started) = 1")))
    assert content(facts(spark, sf_dir)) != right


def test_payer_without_a_name(spark, sf_dir):
    assert facts(spark, sf_dir).where("payer_name IS NULL").count() > 0


@pytest.mark.parametrize("most", [1000, 0])
def test_one_service_alone_equals_its_part_of_all(spark, sf_dir, most, monkeypatch):
    monkeypatch.setattr(monthly, "MOST_CODES", most)
    whole = facts(spark, sf_dir)
    service = SERVICES[most == 0]
    one = service_plan(lines(spark, sf_dir), *dims(spark, sf_dir), *MONTH, service.key)
    assert content(one.select(*whole.columns)) == content(whole.where(F.col("product_name") == service.report_name))


def test_other_services_leave_before_the_exchange(spark, sf_dir):
    """Without any broadcast: the codes are a filter below the hourly exchange, and no semi join is made."""
    plan = service_plan(lines(spark, sf_dir), *dims(spark, sf_dir), *MONTH, "ec2")._jdf.queryExecution().optimizedPlan().toString()
    assert "split_part(arn" in plan or "ec2" in plan
    assert "LeftSemi" not in plan
