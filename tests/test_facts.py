"""Slice replacement on the stored fact table."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from idlewatch.operators.wastage import update_units, with_units
from idlewatch.sinks.facts import (
    FACT_SCHEMA, SLICES, read_facts, replace_slices, replaced, slice_predicate, update_stored_units,
)
from idlewatch.sinks.versions import folders


def facts(spark, *rows):
    """rows: (product, payer, hour, total_nu[, engine, family, nfapplied])"""
    full = []
    for product, payer, hour, total, *rest in rows:
        engine, family, factor = (*rest, None, None, 2.0)[:3] if rest else (None, "m5", 2.0)
        values = dict.fromkeys(FACT_SCHEMA.names)
        values.update(
            product_name=product, bill_payeraccountid=payer, lineitem_usagestartdate=hour,
            total_nu=total, used_nu=total / 2, unused_nu=total / 2, nfapplied=factor,
            operatingsystem_engine=engine, instancetype_family=family,
            mycloud_startyear=hour.year if hour else None, mycloud_startmonth=hour.month if hour else None,
        )
        full.append(tuple(values[n] for n in FACT_SCHEMA.names))
    return spark.createDataFrame(full, FACT_SCHEMA)


def stored(spark, path):
    rows = read_facts(spark, path).select(
        "product_name", "bill_payeraccountid", "lineitem_usagestartdate", "total_nu"
    ).collect()
    return sorted(tuple(r) for r in rows)


JAN, FEB = datetime(2024, 1, 5, 3), datetime(2024, 2, 1, 0)
PRODUCTS = ["EC2(RIs)", "RDS"]


def test_replace_keeps_other_slices_and_empties_owned_ones(spark, tmp_path):
    path = str(tmp_path / "facts")
    # A leading zero must survive the round trip through the folder name.
    first = [
        ("EC2(RIs)", "0012", JAN, 1.0), ("RDS", "0012", JAN, 2.0), ("EC2(RIs)", "77", JAN, 3.0),
    ]
    replace_slices(facts(spark, *first), path, 2024, 1, ["0012", "77"], PRODUCTS)
    replace_slices(facts(spark, ("EC2(RIs)", "0012", FEB, 9.0)), path, 2024, 2, ["0012"], PRODUCTS)
    assert stored(spark, path) == sorted([*first, ("EC2(RIs)", "0012", FEB, 9.0)])

    # New January run for 0012 only: EC2 changed, RDS has no rows any more.
    second = facts(spark, ("EC2(RIs)", "0012", JAN, 5.0))
    for _ in range(2):
        replace_slices(second, path, 2024, 1, ["0012"], PRODUCTS)
        assert stored(spark, path) == sorted([
            ("EC2(RIs)", "0012", JAN, 5.0), ("EC2(RIs)", "77", JAN, 3.0), ("EC2(RIs)", "0012", FEB, 9.0),
        ])


def test_run_without_rows_empties_its_slices(spark, tmp_path):
    path = str(tmp_path / "facts")
    replace_slices(
        facts(spark, ("RDS", "1", JAN, 1.0), ("RDS", "2", JAN, 2.0)), path, 2024, 1, ["1", "2"], PRODUCTS
    )
    replace_slices(facts(spark).limit(0), path, 2024, 1, ["1"], PRODUCTS)
    assert stored(spark, path) == [("RDS", "2", JAN, 2.0)]


def test_rows_outside_the_owned_slices_are_not_written(spark, tmp_path):
    path = str(tmp_path / "facts")
    rows = facts(spark, ("RDS", "1", JAN, 1.0), ("RDS", "3", JAN, 1.0), ("RDS", "1", FEB, 1.0))
    replace_slices(rows, path, 2024, 1, ["1"], PRODUCTS)
    assert stored(spark, path) == [("RDS", "1", JAN, 1.0)]


def test_replaced_keeps_rows_whose_predicate_is_null(spark):
    existing = facts(spark, ("RDS", None, JAN, 1.0), ("RDS", "1", JAN, 2.0), (None, "1", JAN, 3.0), ("RDS", "1", None, 4.0))
    result = replaced(existing, facts(spark, ("RDS", "1", JAN, 8.0)), slice_predicate(2024, 1, ["1"], PRODUCTS))
    assert sorted(r.total_nu for r in result.collect()) == [1.0, 3.0, 4.0, 8.0]


def test_empty_payer_list_owns_nothing(spark):
    existing = facts(spark, ("RDS", "1", JAN, 2.0))
    assert replaced(existing, existing.limit(0), slice_predicate(2024, 1, [], PRODUCTS)).count() == 1


@pytest.mark.parametrize(
    "product, engine, family, factor, expected",
    [
        ("EC2(RIs)", "Linux/UNIX", "m5", 4.0, 8.0),
        ("EC2(RIs)", "Windows (BYOL)", "m5", 4.0, 8.0),
        ("EC2(RIs)", "Windows", "m5.large", 4.0, 2.0),
        ("EC2(RIs)", "Linux/UNIX", "G5.xlarge", 4.0, 2.0),
        ("EC2(RIs)", "MySQL", "m5", 4.0, 2.0),
        ("RDS", "MySQL", "m5", 4.0, 8.0),
        ("RDS", "Linux/UNIX", "m5", 4.0, 2.0),
        ("ElastiCache", None, "cache.m5.large", 4.0, 8.0),
        ("OpenSearch", "", "m5.large.search", 4.0, 8.0),
        ("Redshift", "", "p5.redshift", 4.0, 2.0),
        ("Redshift", "", None, 4.0, 8.0),
        ("EC2(RIs)", "Windows", "m5.large", 0.0, None),
    ],
)
def test_units(spark, product, engine, family, factor, expected):
    row = with_units(facts(spark, (product, "1", JAN, 8.0, engine, family, factor)).drop("total_units", "used_units", "unused_units")).first()
    assert row.total_units == expected
    assert row.used_units == row.unused_units == (None if expected is None else expected / 2)


def test_unit_update_touches_one_month_of_all_payers(spark, tmp_path):
    path = str(tmp_path / "facts")
    replace_slices(facts(spark, ("Redshift", "1", JAN, 8.0), ("Redshift", "2", JAN, 4.0)), path, 2024, 1, ["1", "2"], ["Redshift"])
    replace_slices(facts(spark, ("Redshift", "1", FEB, 6.0)), path, 2024, 2, ["1"], ["Redshift"])
    for _ in range(2):
        update_stored_units(spark, path, 2024, 1)
    got = {(r.bill_payeraccountid, r.mycloud_startmonth): r.total_units for r in read_facts(spark, path).collect()}
    assert got == {("1", 1): 8.0, ("2", 1): 4.0, ("1", 2): None}
    in_memory = update_units(read_facts(spark, path), 2024, 2).where(F.col("mycloud_startmonth") == 2)
    assert in_memory.first().total_units == 6.0


def test_folders_hold_one_slice_each(spark, tmp_path):
    path = str(tmp_path / "facts")
    replace_slices(facts(spark, ("EC2(RIs)", "0012", JAN, 1.0)), path, 2024, 1, ["0012"], PRODUCTS)
    (folder,) = folders(spark, path, SLICES)
    assert folder.endswith("/product_name=EC2(RIs)/mycloud_startyear=2024/mycloud_startmonth=1/bill_payeraccountid=0012")
    assert os.path.isdir(f"{path}/{folder}")
