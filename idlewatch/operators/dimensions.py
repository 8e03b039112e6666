"""Dimensions derived from the billing lines themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame

from idlewatch.functions import fixed_values as fixed
from idlewatch.functions.rules import region_label, size_factor, size_factor_zoned
from idlewatch.functions.sql import aggregates, text
from idlewatch.functions.timeops import SECOND, in_month
from idlewatch.operators.lines import FEE
from idlewatch.operators.services import (
    engine_name, family_name, is_service, reservation_id, service_of,
)

DESCRIPTION = (
    "service", "product_name", "usage_account", "family", "instance_type", "engine", "region",
)


def payer_max_date(lines: DataFrame) -> DataFrame:
    """One second before the last discounted hour, per payer and service.

    Hours after it are incomplete. All lines of the billing month count, whatever their
    own date. Only a partial aggregate leaves the scan.
    """
    return (
        lines.where(f"line_type = {text(fixed.DISCOUNTED)}")
        .selectExpr("payer_id", f"{service_of('product_name')} AS service", "started")
        .where("service IS NOT NULL")
        .groupBy("payer_id", "service")
        .agg(*aggregates({"max_date": f"max(started) - {SECOND}"}))
    )


def reservation_dimension(lines: DataFrame, year: int, month: int) -> DataFrame:
    """What the fee lines of a month say about each reservation.

    A reservation keeps one row per distinct description, so lines joined to it multiply
    if its fees describe it in more than one way.

    One exchange by ARN and account serves this and all later grouping of the dimension.
    It leaves out the payer on purpose: the join to the hours then adds an exchange of
    its own, whose measured size lets adaptive execution broadcast a small dimension
    instead of exchanging the hours.
    """
    # The factor is a grouping key, its rule depends on the service, and the service is
    # only known per group: group under both rules, keep the groups of the right one.
    plain = size_factor("usage_type", "stored_factor")
    zoned = size_factor_zoned("usage_type", "stored_factor")
    described = (
        lines.where(f"{FEE} AND {in_month('started', year, month)}")
        .selectExpr("*", f"stack(2, FALSE, {plain}, TRUE, {zoned}) AS (zoned, factor)")
        .groupBy("arn", "usage_type", "zoned", "factor", "operation", "payer_id", "usage_account")
        .agg(*aggregates({"region_code": "max(region_code)", "product_name": "max(product_name)"}))
        .selectExpr("*", f"{service_of('product_name')} AS service")
        .where(f"zoned = ({is_service('service', lambda s: s.zoned_sizes)})")
    )
    return (
        described.repartition("arn", "usage_account")
        .selectExpr(
            "*",
            "split_part(usage_type, ':', 2) AS instance_type",
            f"{engine_name('service', 'operation')} AS engine",
            f"{region_label('region_code', 'usage_type')} AS region",
        )
        .selectExpr("*", f"{family_name('service', 'instance_type', 'engine')} AS family")
        .select("payer_id", "arn", *DESCRIPTION, "region_code", "factor")
        .distinct()
    )


def report_weights(dimension: DataFrame) -> DataFrame:
    """Dimension rows that differ only in factor or region code, folded into one.

    ``copies`` is how often a joined line repeats, ``factor_sum`` the sum of the factors
    those repeats carry. Joining the folded rows and weighting the sums equals joining
    the full dimension and summing again.
    """
    return dimension.groupBy("payer_id", "arn", *DESCRIPTION).agg(
        *aggregates({"copies": "count(1)", "factor_sum": "sum(factor)"})
    )


def reservations(dimension: DataFrame, payers: DataFrame, accounts: DataFrame) -> DataFrame:
    """One row per reservation and hourly-report description, with owner and payer name.

    ``groups`` counts the report groups folded into the row (a reservation billed under
    two product names of one service has two). The account is looked up here, on the
    small side, by the account part of the ARN; reservations of unknown accounts drop out.
    """
    hourly = [c for c in DESCRIPTION if c != "product_name"]
    folded = {"copies": "sum(copies)", "factor_sum": "sum(factor_sum)", "groups": "count(1)"}
    return (
        report_weights(dimension.where("arn <> ''"))
        .groupBy("payer_id", "arn", *hourly)
        .agg(*aggregates(folded))
        .selectExpr(
            "*",
            f"{reservation_id('service', 'arn')} AS reservation_id",
            "split_part(arn, ':', 5) AS account_id",
        )
        .join(accounts.select("account_id", "family_type", "customer_name"), "account_id")
        .join(payer_names(payers), "payer_id", "left")
    )


def payer_names(payers: DataFrame) -> DataFrame:
    return payers.selectExpr("payer_account_id AS payer_id", "payer_name")


def with_cutoff(reservation_rows: DataFrame, max_dates: DataFrame) -> DataFrame:
    """Attach the payer's cutoff; payers without discounted usage have no usable hour."""
    return reservation_rows.join(max_dates, ["payer_id", "service"])
