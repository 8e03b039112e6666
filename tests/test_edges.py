"""The whole pipeline on hand-made awkward lines, against the step-by-step SQL.

The SQL joins first, pairs every line with every hour and aggregates last; the library
sums first and joins last. Both must agree on duplicates, fan-out, NULLs and reversed or
sub-second intervals.
"""

import random
from datetime import datetime, timedelta

import duckdb
import pytest

from checks import oracle, queries
from checks.run import differences
from idlewatch.operators.lines import billing_lines, condense
from idlewatch.operators.report import line_item_report
from idlewatch.operators.dimensions import payer_max_date, reservation_dimension
from idlewatch.plans.monthly import utilization_plan, wastage_plan

RAW = (
    "bill_payer_account_id string, line_item_usage_account_id string, line_item_line_item_type string,"
    "line_item_usage_type string, line_item_operation string, line_item_usage_start_date timestamp_ntz,"
    "line_item_usage_end_date timestamp_ntz, line_item_normalization_factor double,"
    "line_item_normalized_usage_amount double, line_item_usage_amount double,"
    "line_item_unblended_cost double, line_item_unblended_rate string,"
    "reservation_reservation_a_r_n string, reservation_number_of_reservations double,"
    "reservation_effective_cost double, reservation_amortized_upfront_fee_for_billing_period double,"
    "pricing_public_on_demand_cost double, pricing_offering_class string, product map<string,string>"
)
BILL_COLUMNS = (
    "payer", "account", "item", "usage_type", "operation", "s", "e", "factor", "norm_amount",
    "amount", "cost", "rate", "arn", "n", "eff_cost", "upfront", "od", "offering", "product_name",
    "region_code",
)
PRODUCTS = [name for s in oracle.SERVICES.values() for name in s[1]]


def awkward_lines(count, seed):
    rng = random.Random(seed)
    pick = rng.choice
    arns = [f"arn:aws:ec2:x:{a}:reserved-instances/ri-{a}{r}" for a in (1, 2, 3) for r in "ab"]
    arns += [f"arn:aws:rds:x:{a}:ri:ri-{a}" for a in (1, 4)] + ["", None]
    # Few ARNs and lopsided: one of them owns a third of the lines.
    arns = arns + [arns[0]] * 5
    rows = []
    for _ in range(count):
        item = pick(["RIFee", "RIFee", "DiscountedUsage", "DiscountedUsage", "VDiscountedUsage", "Credit", "Tax"])
        start = datetime(2024, 2, 1) + timedelta(seconds=rng.randrange(-86_400, 30 * 86_400))
        if rng.random() < 0.6:
            start = start.replace(minute=0, second=0)
        if rng.random() < 0.05:
            start = start.replace(minute=59, second=59, microsecond=pick([0, 250_000]))
        end = start + timedelta(seconds=pick([0, 3599, 3600, 5400, 86_399, 700_000, -7200, -60]))
        product = pick([
            {"product_name": pick(PRODUCTS), "region": pick(["us-east-1", "ap-south-2", None])},
            {"product_name": pick(PRODUCTS)}, {"product_name": PRODUCTS[0], "region": "eu-west-1"},
            {"product_name": "Amazon Other"}, {"region": "us-east-1"}, {}, None,
        ])
        rows.append((
            pick(["p1", "p1", "p2", "p9"]), pick(["u1", "u2"]), item,
            pick(["USE1-HeavyUsage:m5.large", "HeavyUsage:m5.metal", "Multi-AZ:db.r5.xlarge", "HeavyUsage:g5.large", "x"]),
            pick(["RunInstances", "RunInstances:0800", "CreateDBInstance:0014", "CreateCacheCluster:0001", None]),
            start, end, pick([None, 0.0, 2.0]), pick([None, 0.0, 1.5]), pick([0.25, 3.0, None]),
            pick([0.5, None]), pick(["0.125", "", "n/a", None]), pick(arns), pick([1.0, 2.0, 0.0, None]),
            pick([0.25, None]), pick([12.0, None]), pick([0.0, 1.25, None]),
            pick(["standard", "convertible", None]), product,
        ))
    return rows + rows[: count // 10]


@pytest.fixture(scope="module", params=[1, 2, 3])
def case(request, spark):
    rows = awkward_lines(700, request.param)
    billing = spark.createDataFrame(rows, RAW)
    payers = spark.createDataFrame([("p1", "One"), ("p2", "Two")], "payer_account_id string, payer_name string")
    accounts = spark.createDataFrame(
        [("1", "gold", "A"), ("2", "iron", "B"), ("4", None, "D")],
        "account_id string, family_type string, customer_name string",
    )
    con = duckdb.connect()
    types = "VARCHAR VARCHAR VARCHAR VARCHAR VARCHAR TIMESTAMP TIMESTAMP DOUBLE DOUBLE DOUBLE DOUBLE VARCHAR VARCHAR DOUBLE DOUBLE DOUBLE DOUBLE VARCHAR VARCHAR VARCHAR".split()
    con.execute("CREATE TABLE bill (" + ", ".join(f"{c} {t}" for c, t in zip(BILL_COLUMNS, types)) + ")")
    flat = [
        (*r[:-1], (r[-1] or {}).get("product_name"), (r[-1] or {}).get("region")) for r in rows
    ]
    con.executemany(f"INSERT INTO bill VALUES ({', '.join('?' * len(BILL_COLUMNS))})", flat)
    con.execute("CREATE TABLE payer_list AS SELECT * FROM (VALUES ('p1', 'One'), ('p2', 'Two')) t(payer, payer_name)")
    con.execute(
        "CREATE TABLE account_list AS SELECT * FROM (VALUES ('1', 'gold', 'A'), ('2', 'iron', 'B'), ('4', NULL, 'D'))"
        " t(account_id, family_type, customer_name)"
    )
    return billing, payers, accounts, con


@pytest.fixture(params=["plain", "condensed"])
def lines(request, case):
    lines = billing_lines(case[0])
    return condense(lines) if request.param == "condensed" else lines


@pytest.fixture(autouse=True)
def february(monkeypatch):
    monkeypatch.setattr(oracle, "FIRST", "TIMESTAMP '2024-02-01'")
    monkeypatch.setattr(oracle, "IN_MONTH", "year(s) = 2024 AND month(s) = 2")
    grid = oracle.GRID.replace("2024-01-01 00:00:00", "2024-02-01 00:00:00")
    monkeypatch.setattr(oracle, "GRID", grid)
    monkeypatch.setattr(oracle.shapes, "MONTH", 2)


def compare(got, con, sql):
    got = queries.presented(got).toPandas()
    want = con.execute(sql).df()
    assert len(want) > 0
    assert differences(got, want) == []


def test_dimension(case, lines):
    got = reservation_dimension(lines, 2024, 2)
    got = got.selectExpr(
        f"{queries.report_name('service')} AS service", *[c for c in queries.DIMENSION if c != "service"]
    )
    compare(got, case[3], oracle.select("dim", queries.DIMENSION, source=()))


def test_max_date(case, lines):
    got = payer_max_date(lines).selectExpr("payer_id", f"{queries.report_name('service')} AS product", "max_date")
    sql = queries.o_payer_max_date().replace(oracle.LISTED + ",", "")
    compare(got, case[3], sql)


@pytest.mark.parametrize("service", list(oracle.SERVICES))
def test_report(case, lines, service):
    dimension = reservation_dimension(lines, 2024, 2)
    got = line_item_report(lines, dimension, case[1], 2024, 2, service)
    compare(got.select(*queries.REPORT), case[3], oracle.select("report", queries.REPORT, (service,), ()))


def test_utilization(case, lines):
    got = utilization_plan(lines, case[1], case[2], 2024, 2)
    compare(got.select(*queries.UTILIZATION), case[3], oracle.select("hours", queries.UTILIZATION, source=()))


def test_facts(case, lines):
    got = wastage_plan(lines, case[1], case[2], 2024, 2)
    compare(got, case[3], oracle.select("facts", queries.FACTS | {"mycloud_startmonth": "CAST(mycloud_startmonth AS BIGINT)"}, source=()))
