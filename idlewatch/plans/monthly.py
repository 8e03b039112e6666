"""One month of wastage for all services as a single lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from idlewatch.operators.dimensions import (
    payer_max_date, reservation_dimension, reservations, with_cutoff,
)
from idlewatch.operators.utilization import hourly_sums, hourly_utilization
from idlewatch.operators.wastage import wastage_metrics


def utilization_plan(
    lines: DataFrame, payers: DataFrame, accounts: DataFrame, year: int, month: int
) -> DataFrame:
    dimension = reservation_dimension(lines, year, month)
    owned = reservations(dimension, payers, accounts)
    return hourly_utilization(hourly_sums(lines, year, month), owned, year, month)


def wastage_plan(
    lines: DataFrame,
    payers: DataFrame,
    accounts: DataFrame,
    year: int,
    month: int,
    counts: tuple[Observation, Observation] | None = None,
) -> DataFrame:
    """Fact rows of the month; ``counts`` observe the hours and the facts as they pass.

    The cutoff joins the reservations, not the hours: a payer key on the hourly side
    would gather a large payer's rows in one task.
    """
    dimension = reservation_dimension(lines, year, month)
    owned = with_cutoff(reservations(dimension, payers, accounts), payer_max_date(lines))
    of_hours, of_facts = counts or (None, None)
    hourly = hourly_utilization(hourly_sums(lines, year, month), owned, year, month, of_hours)
    return wastage_metrics(hourly, of_facts)


#: Service codes in ARNs beyond which a pruning by code is not worth a filter.
MOST_CODES = 1000


def service_codes(dimension: DataFrame) -> list[str] | None:
    """The distinct service parts of the described ARNs; None if they are too many to list."""
    found = dimension.where("arn <> ''").selectExpr("split_part(arn, ':', 3) AS code").distinct()
    codes = sorted(r.code for r in found.limit(MOST_CODES + 1).collect())
    return codes if len(codes) <= MOST_CODES else None


def service_plan(
    lines: DataFrame, payers: DataFrame, accounts: DataFrame, year: int, month: int, service: str
) -> DataFrame:
    """Fact rows of one service, without the hours of the others.

    A line counts only if its ARN is described as one of the service, so a line whose ARN names a
    service code that no such description has cannot count. The codes are a handful of values
    (one small job over the fee lines finds them): lines are left out in the scan's own stage,
    before fees grow to hours and before the exchange, and no hot reservation is gathered
    as a semi join with the descriptions would.
    """
    mine = F.col("service") == service
    dimension = reservation_dimension(lines, year, month).where(mine)
    codes = service_codes(dimension)
    some = lines
    if codes is not None:
        code = F.expr("split_part(arn, ':', 3)")
        some = lines.where(code.isin(codes) if codes else F.lit(False))
    owned = with_cutoff(reservations(dimension, payers, accounts), payer_max_date(lines).where(mine))
    return wastage_metrics(hourly_utilization(hourly_sums(some, year, month), owned, year, month))
