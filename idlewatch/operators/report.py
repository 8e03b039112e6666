"""Line-item report: billing lines of a month with their reservation's description."""

from __future__ import annotations

from pyspark.sql import DataFrame

from idlewatch.functions.rules import missing_or_zero
from idlewatch.functions.sql import aggregates, aliased, text
from idlewatch.functions.timeops import SECOND, in_month
from idlewatch.operators.dimensions import payer_names, report_weights
from idlewatch.operators.lines import FEE, sum_of_known
from idlewatch.operators.services import BY_KEY, report_name, reservation_id

LINE_KEYS = ("payer_id", "arn", "line_type", "started", "ended", "offering", "reservations")
PAYER_SALTS = 64


def repeated_money(amount: str, copies: str) -> str:
    """amount x copies with all eight places; the types make the product DECIMAL(38,8)."""
    return f"(CAST({amount} AS DECIMAL(28,8)) * CAST({copies} AS DECIMAL(9,0)))"


def line_sums(lines: DataFrame) -> DataFrame:
    """Lines summed per report key, before any join.

    Factors of fee lines stay split in two: the sum over lines that store one, and the
    number of lines that have to borrow it from the reservation's description. Amounts
    are split the same way, so the join only has to weigh two sums.
    """
    borrows = missing_or_zero("stored_factor")
    own = f"CASE WHEN {FEE} THEN CASE WHEN NOT {borrows} THEN stored_factor * line_count END ELSE 0D END"
    sums = {
        "own_factor": f"sum({own})",
        "borrowing_lines": f"sum(CASE WHEN {FEE} AND {borrows} THEN line_count END)",
    }
    plain = (
        "known_amount", "unfactored_amount", "usage_amount", "unblended_cost", "effective_cost",
        "on_demand_cost", "hourly_cost",
    )
    return lines.groupBy(*LINE_KEYS).agg(*aggregates(sums | {m: f"sum({m})" for m in plain}))


def line_item_report(
    lines: DataFrame,
    dimension: DataFrame,
    payers: DataFrame,
    year: int,
    month: int,
    service: str | None = None,
) -> DataFrame:
    """All reported lines of the month; lines of unknown reservations keep NULLs.

    With ``service`` only that service's reservations are looked up, as for one
    service's own report; otherwise every line meets the reservations of all services.
    """
    known = report_weights(dimension)
    short_id = reservation_id("service", "arn")
    if service is not None:
        known = known.where(f"service = {text(service)}")
        short_id = BY_KEY[service].short_id("arn")
    copies = "coalesce(copies, 1L)"
    columns = {
        "service_name": report_name("service"),
        "reservation_id": short_id,
        "lineitem_usagestartdate": "started",
        "lineitem_usageenddate": f"CASE WHEN {FEE} THEN ended + {SECOND} ELSE ended END",
        "bill_payeraccountid": "payer_id",
        "payer_name": "payer_name",
        "lineitem_usageaccountid": "usage_account",
        "instancetype_family": "family",
        "instancetype": "instance_type",
        "mycloud_startmonth": f"{month}",
        "mycloud_startyear": f"{year}",
        "product_productname": "product_name",
        "mycloud_operatingsystem": "engine",
        "mycloud_region": "region",
        "offering_type": "offering",
        "lineitem_lineitemtype": "line_type",
        "reservation_reservationarn": "arn",
        "reservation_numberofreservations": "reservations",
        "lineitem_normalizationfactor": sum_of_known(
            f"own_factor * {copies}", "borrowing_lines * factor_sum"
        ),
        "lineitem_normalizedusageamount": sum_of_known(
            f"known_amount * {copies}", "unfactored_amount * factor_sum"
        ),
        "lineitem_usageamount": f"usage_amount * {copies}",
        "lineitem_unblendedcost": f"unblended_cost * {copies}",
        "reservation_effectivecost": f"effective_cost * {copies}",
        "mycloud_ondemandprice": repeated_money("on_demand_cost", copies),
        "ri_hourly_effective_cost": f"hourly_cost * {copies}",
    }
    # One payer may own a third of all lines: its name is repeated over the salts, so that
    # no task has to take all its lines if the names are not broadcast.
    names = payer_names(payers).selectExpr("*", f"explode(sequence(0, {PAYER_SALTS - 1})) AS salt")
    return (
        line_sums(lines.where(in_month("started", year, month)))
        .join(known, ["payer_id", "arn"], "left")
        .selectExpr("*", f"CAST(pmod(xxhash64(arn, started), {PAYER_SALTS}) AS INT) AS salt")
        .join(names, ["payer_id", "salt"], "left")
        .selectExpr(*aliased(columns))
    )
