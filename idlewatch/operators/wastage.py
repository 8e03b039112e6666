"""Wastage metrics per reservation and hour: the rows of the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from idlewatch.functions.rules import is_accelerator, shares_family
from idlewatch.functions.sql import aliased, first_match, text, text_list
from idlewatch.operators.services import SERVICES

SLICE_COLUMNS = ("product_name", "mycloud_startyear", "mycloud_startmonth", "bill_payeraccountid")
UNITS = {"total_units": "total_nu", "used_units": "used_nu", "unused_units": "unused_nu"}


def _is_product(test) -> str:
    return f"product_name IN {text_list(s.report_name for s in SERVICES if test(s))}"


def wastage_metrics(hourly: DataFrame, counts: Observation | None = None) -> DataFrame:
    """Fact rows out of hourly utilisation that carries ``max_date`` (the payer's cutoff).

    Hours without reserved capacity and hours after the cutoff are left out. Ratios with
    a zero divisor are NULL. ``counts`` observes, in the same pass, what is left out and kept.
    """
    if counts is not None:
        hourly = hourly.observe(
            counts,
            F.expr("count_if(startdate > max_date)").alias("hours_after_cutoff"),
            F.expr("count_if(startdate <= max_date AND reservedhours <> 0)").alias("fact_rows"),
        )
    used_hours = first_match(
        [(_is_product(lambda s: s.counts_instances), "usedhours")],
        "try_divide(usedhours, nfapplied)",
    )
    columns = {
        "reservation_arn": "reservation_id",
        "payer_name": "payer_name",
        "bill_payeraccountid": "bill_payeraccountid",
        "usageaccountid": "linkedaccountid",
        "account_type": "family_type",
        "customer_name": "customer_name",
        "region": "region",
        "product_name": "product_name",
        "operatingsystem_engine": "operatingsystem",
        "instancetype_family": "instancetype_family",
        "savingsplan_type": "''",
        "lineitem_usagestartdate": "startdate",
        "total_nu": "total_nu",
        "used_nu": "used_nu",
        "unused_nu": "unused_nu",
        "wastage_percentage": "try_divide(unused_nu, total_nu)",
        "offering_type": "offering_type",
        "reservation_reservationarn": "reservation_reservationarn",
        "reservedhours": "reservedhours",
        "used_hours": "used_hours",
        "unused_hours": "reservedhours - used_hours",
        "wastage_cost": "(reservedhours - used_hours) * ri_ecost",
        "ri_utilization": "try_divide(used_hours, reservedhours)",
        "mycloud_startmonth": "mycloud_startmonth",
        "mycloud_startyear": "mycloud_startyear",
        "instancetype": "instancetype",
        "nfapplied": "nfapplied",
        "quantity": "quantity",
        "ri_ecost": "ri_ecost",
    }
    return (
        hourly.where("startdate <= max_date AND reservedhours <> 0")
        .selectExpr("*", "total_nu - used_nu AS unused_nu", f"{used_hours} AS used_hours")
        .selectExpr(*aliased(columns))
    )


def _floats() -> str:
    """Whether a reservation floats over sizes, so that its units are normalised ones."""
    shared = [
        (
            f"product_name = {text(s.report_name)}"
            f" AND {shares_family('operatingsystem_engine', s.open_names)}",
            "TRUE",
        )
        for s in SERVICES
        if s.open_names
    ]
    plain = (_is_product(lambda s: not s.open_names), "TRUE")
    return first_match([(is_accelerator("instancetype_family"), "FALSE"), *shared, plain], "FALSE")


def _unit(value: str) -> str:
    """Normalised units where a reservation floats over sizes, instances where it does not."""
    return f"CASE WHEN floats THEN {value} ELSE try_divide({value}, nfapplied) END"


def with_units(facts: DataFrame) -> DataFrame:
    """Unit columns of every row. The rule is looked up once a row and serves all units."""
    ruled = facts.selectExpr("*", f"{_floats()} AS floats")
    return ruled.selectExpr(*facts.columns, *aliased({unit: _unit(nu) for unit, nu in UNITS.items()}))


def update_units(facts: DataFrame, year: int, month: int) -> DataFrame:
    """Set the unit columns on one month, all payers and products; leave other rows alone."""
    in_slice = f"mycloud_startmonth = {month} AND mycloud_startyear = {year}"
    updated = {
        unit: first_match(
            [(in_slice, _unit(nu))], unit if unit in facts.columns else "CAST(NULL AS DOUBLE)"
        )
        for unit, nu in UNITS.items()
    }
    kept = [c for c in facts.columns if c not in UNITS]
    ruled = facts.selectExpr("*", f"{_floats()} AS floats")
    return ruled.selectExpr(*kept, *aliased(updated))
