"""Hourly utilisation of reservations.

The hour grid is never joined: fee lines are exploded into their own hours, usage lines
fall into one. All measures are summed per (payer, ARN, offering, hour) *before* the
reservation's description is joined, on four narrow keys:

* the only exchange of billing data follows a map-side combine, and an ARN or payer that
  owns a third of all lines shrinks to at most one row per hour and offering in each task;
* the join then meets a few hundred rows per ARN, never a hot key.

Measures that depend on the description are linear in its two weights (``copies`` and
``factor_sum``), so the join multiplies instead of aggregating again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from idlewatch.functions.sql import aggregates, aliased
from idlewatch.functions.timeops import (
    SECOND, covered_hours, hour_end, hours_per_match, in_month,
)
from idlewatch.operators.lines import FEE, USAGE, sum_of_known
from idlewatch.operators.report import line_sums, repeated_money
from idlewatch.operators.services import is_service, report_name

RESERVATION = ("payer_id", "arn")
SPAN_KEYS = (*RESERVATION, "offering")
HOUR_KEYS = (*SPAN_KEYS, "hour")
# Tasks over reservations for each shuffle partition: a reservation grows to hundreds of rows.
TASKS_PER_PARTITION = 4

# What a line adds to its hours: measure -> (fee lines, usage lines). A zero counts a
# line of the other kind as nothing, a NULL leaves the sum to the lines that have it.
CONTRIBUTIONS = {
    "reserved": ("reservations * matches", "0D"),
    "quantity": ("reservations", "0D"),
    "own_factor": ("own_factor", "0D"),
    "borrowing": ("CAST(borrowing_lines AS DOUBLE)", "CAST(NULL AS DOUBLE)"),
    "own_units": ("reservations * own_factor", "0D"),
    "borrowing_units": ("reservations * borrowing_lines", "CAST(NULL AS DOUBLE)"),
    "known_amount": ("0D", "known_amount"),
    "unfactored_amount": ("CAST(NULL AS DOUBLE)", "unfactored_amount"),
    "usage_amount": ("0D", "usage_amount"),
    "usage_cost": ("CAST(0 AS DECIMAL(30,8))", "on_demand_cost"),
    "all_cost": ("on_demand_cost", "on_demand_cost"),
    "hourly_cost": ("hourly_cost", "0D"),
}
USAGE_MEASURES = ("known_amount", "unfactored_amount", "usage_amount", "on_demand_cost")


def _contributions(lines: DataFrame, kind: int, hours: str) -> DataFrame:
    measures = {m: c[kind] for m, c in CONTRIBUTIONS.items()}
    return lines.selectExpr(*SPAN_KEYS, f"{hours} AS hours", *aliased(measures))


def fee_spans(lines: DataFrame, year: int, month: int) -> DataFrame:
    """Fee lines with the array of the hours each covers, not yet one row per hour.

    Fees equal in every report key count their reservations once, so they are grouped
    first (few rows: a reservation has a handful of fees per month).
    """
    fees = line_sums(lines.where(FEE)).selectExpr("*", f"ended + {SECOND} AS until")
    return _contributions(
        fees.selectExpr("*", f"{hours_per_match('started', 'until')} AS matches"),
        0, covered_hours("started", "until", year, month),
    )


def usage_spans(lines: DataFrame) -> DataFrame:
    """Usage lines summed per hour, which is the only one of its array.

    Only what usage lines have is summed: the constants come after, and keep the scan's code small.
    """
    placed = lines.where(USAGE).selectExpr("*", "window(started, '1 hour').start AS hour")
    rows = placed.where(f"started <= {hour_end('hour')}")
    summed = rows.groupBy(*HOUR_KEYS).agg(*aggregates({m: f"sum({m})" for m in USAGE_MEASURES}))
    return _contributions(summed, 1, "array(hour)")


def by_reservation(spans: DataFrame, tasks: int) -> DataFrame:
    """Spans exchanged by reservation, then one row per hour.

    The exchange is by number, because adaptive execution sees the small rows only and would gather
    them in a few tasks. A task holds at most all hours of its reservations, so many small
    tasks bound its memory.
    """
    spread = spans.repartition(tasks, *RESERVATION)
    return spread.selectExpr(*SPAN_KEYS, "explode(hours) AS hour", *CONTRIBUTIONS)


def fee_hours(lines: DataFrame, year: int, month: int) -> DataFrame:
    """Fee lines, one row per covered hour, apart from the usage."""
    tasks = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return by_reservation(fee_spans(lines, year, month), tasks)


def hourly_sums(lines: DataFrame, year: int, month: int) -> DataFrame:
    """Sums per payer, ARN, offering and hour.

    Fees and usage hours are exchanged by reservation while a fee is still one row. A fee grows to
    as many as 744 rows inside its task, and neither the sums nor the join to the
    reservations (`hourly_utilization`) exchange those: both keys contain the reservation.
    """
    in_scope = lines.where(f"{in_month('started', year, month)} AND arn <> ''")
    tasks = TASKS_PER_PARTITION * int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hours = by_reservation(fee_spans(in_scope, year, month).unionByName(usage_spans(in_scope)), tasks)
    return hours.groupBy(*HOUR_KEYS).agg(*aggregates({m: f"sum({m})" for m in CONTRIBUTIONS}))


def hourly_utilization(
    sums: DataFrame,
    reservation_rows: DataFrame,
    year: int,
    month: int,
    counts: Observation | None = None,
) -> DataFrame:
    """Hourly sums of the reported reservations with their description and owner.

    ``counts`` observes, in the same pass, the hourly sums that have no such reservation.
    """
    by_instance = is_service("service", lambda s: s.counts_instances)

    def weighted(own: str, borrowing: str) -> str:
        return sum_of_known(f"{own} * copies", f"{borrowing} * factor_sum")

    def units(instances: str, normalized: str) -> str:
        return f"CASE WHEN {by_instance} THEN {instances} ELSE {normalized} END"

    measures = {
        "reservedhours": "reserved * groups",
        "od_cost": repeated_money("usage_cost", "copies"),
        "ri_ecost": "hourly_cost * copies",
        "used_nu": units("usage_amount * copies", weighted("known_amount", "unfactored_amount")),
        "total_nu": units("quantity * groups", weighted("own_units", "borrowing_units")),
    }
    columns = {
        "product_name": report_name("service"),
        "reservation_id": "reservation_id",
        "bill_payeraccountid": "payer_id",
        "payer_name": "payer_name",
        "family_type": "family_type",
        "customer_name": "customer_name",
        "linkedaccountid": "usage_account",
        "startdate": "hour",
        "enddate": hour_end("hour"),
        "reservation_reservationarn": "arn",
        "mycloud_startmonth": f"{month}",
        "mycloud_startyear": f"{year}",
        "region": "region",
        "offering_type": "offering",
        "operatingsystem": "engine",
        "instancetype_family": "family",
        "instancetype": "instance_type",
        "nfapplied": weighted("own_factor", "borrowing"),
        "ondemandcost": f"coalesce({repeated_money('all_cost', 'copies')}, 0)",
        "reservedhours": "reservedhours",
        "total_nu": "total_nu",
        "quantity": "quantity * groups",
        "used_nu": "used_nu",
        "od_cost": "od_cost",
        "ri_ecost": "ri_ecost",
        "netsavings": "CAST(od_cost AS DOUBLE) - ri_ecost * reservedhours",
        "usedhours": "used_nu",
    }
    if "max_date" in reservation_rows.columns:
        columns["max_date"] = "max_date"
    keys = [*RESERVATION]
    # The hours lie by reservation already; a hashed side of a few reservations needs no sort of them.
    reservation_rows = reservation_rows.hint("shuffle_hash")
    if counts is None:
        described = sums.join(reservation_rows, keys)
    else:
        described = sums.join(reservation_rows, keys, "left").observe(
            counts, F.expr("count_if(service IS NULL)").alias("unknown_hours")
        ).where("service IS NOT NULL")
    return (
        described.selectExpr("*", *aliased(measures))
        .selectExpr(*aliased(columns))
    )
