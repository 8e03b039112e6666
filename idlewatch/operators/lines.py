"""Billing line items reduced to what the reports need.

``billing_lines`` is a projection. ``condense`` sums lines that no report can tell
apart; its output has the same columns and can stand in for the projection everywhere,
because every measure is a sum. A month of raw lines is read once, condensed with
map-side combine, and all steps continue on the far smaller result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from idlewatch.functions import fixed_values as fixed
from idlewatch.functions.rules import missing_or_zero
from idlewatch.functions.sql import aggregates, aliased, text, text_list
from idlewatch.functions.timeops import TWO_SECONDS, hours_crossed

# On-demand cost is exact to eight decimals; sums of it are DECIMAL(38,8).
MONEY = "DECIMAL(30,8)"

KEYS = (
    "payer_id", "arn", "line_type", "started", "ended", "offering", "reservations",
    "product_name",
    # Only kept on fee lines, which describe the reservation:
    "usage_account", "usage_type", "operation", "region_code", "stored_factor",
)
MEASURES = (
    "line_count", "known_amount", "unfactored_amount", "usage_amount",
    "unblended_cost", "effective_cost", "on_demand_cost", "hourly_cost",
)

FEE = f"line_type = {text(fixed.FEE)}"
USAGE = f"line_type IN {text_list(fixed.USAGE_TYPES)}"


def product_value(billing: DataFrame, key: str) -> str:
    """One value of the product map; NULL for a missing key, an empty or a NULL map."""
    is_list = isinstance(billing.schema["product"].dataType, T.ArrayType)
    product = "map_from_entries(product)" if is_list else "product"
    return f"try_element_at({product}, {text(key)})"


def product_entries(billing: DataFrame, *columns: str) -> DataFrame:
    """One row per entry of the product map; lines without entries drop out.

    The general form. Reading single keys by ``product_value`` needs no extra rows.
    """
    is_list = isinstance(billing.schema["product"].dataType, T.ArrayType)
    entries = "inline(product)" if is_list else "explode(product)"
    return billing.selectExpr(*columns, f"{entries} AS (key, value)")


def for_payers(billing: DataFrame, payer_ids: Sequence[str], column: str) -> DataFrame:
    """Rows of the listed payers; an empty list keeps nothing.

    Always an IN list: Catalyst makes a long one a hashed set, and it prunes partition folders.
    """
    wanted = sorted(set(payer_ids))
    return billing.where(F.col(column).isin(wanted) if wanted else F.lit(False))


def hourly_effective_cost() -> str:
    """Rate plus the upfront fee spread over the hours and reservations of the line.

    A rate that is no number counts as none; a zero divisor gives NULL.
    """
    hours = hours_crossed("started", f"(ended + {TWO_SECONDS})")
    return f"""(
      coalesce(try_cast(line_item_unblended_rate AS DOUBLE), 0D)
      + CASE WHEN {hours} = 0 THEN 0D ELSE try_divide(
          CAST(reservation_amortized_upfront_fee_for_billing_period AS DOUBLE),
          {hours} * reservations) END)"""


def billing_lines(billing: DataFrame, payer_ids: Sequence[str] | None = None) -> DataFrame:
    """Reported line items of the given payers (all payers if None)."""
    if payer_ids is not None:
        billing = for_payers(billing, payer_ids, "bill_payer_account_id")
    normalized = "CAST(line_item_normalized_usage_amount AS DOUBLE)"
    amount = "CAST(line_item_usage_amount AS DOUBLE)"
    underived = missing_or_zero(normalized)

    def on_fee(expression: str) -> str:
        return f"CASE WHEN {FEE} THEN {expression} END"

    typed = {
        "line_type": "line_item_line_item_type",
        "started": "CAST(line_item_usage_start_date AS TIMESTAMP_NTZ)",
        "ended": "CAST(line_item_usage_end_date AS TIMESTAMP_NTZ)",
        "reservations": "CAST(reservation_number_of_reservations AS DOUBLE)",
    }
    line = {
        "payer_id": "bill_payer_account_id",
        "arn": "reservation_reservation_a_r_n",
        "line_type": "line_type",
        "started": "started",
        "ended": "ended",
        "offering": "pricing_offering_class",
        "reservations": "reservations",
        "product_name": product_value(billing, "product_name"),
        "usage_account": on_fee("line_item_usage_account_id"),
        "usage_type": on_fee("line_item_usage_type"),
        "operation": on_fee("line_item_operation"),
        "region_code": on_fee(product_value(billing, "region")),
        "stored_factor": on_fee("CAST(line_item_normalization_factor AS DOUBLE)"),
        "line_count": "1L",
        "known_amount": f"CASE WHEN NOT {underived} THEN {normalized} END",
        "unfactored_amount": f"CASE WHEN {underived} THEN {amount} END",
        "usage_amount": amount,
        "unblended_cost": "CAST(line_item_unblended_cost AS DOUBLE)",
        "effective_cost": "CAST(reservation_effective_cost AS DOUBLE)",
        "on_demand_cost": f"CAST(pricing_public_on_demand_cost AS {MONEY})",
        "hourly_cost": f"CASE WHEN {FEE} THEN {hourly_effective_cost()} ELSE 0D END",
        "unparsable_rate": f"""{FEE} AND line_item_unblended_rate IS NOT NULL
            AND try_cast(line_item_unblended_rate AS DOUBLE) IS NULL""",
    }
    reported = f"line_item_line_item_type IN {text_list(fixed.REPORTED_TYPES)}"
    return billing.where(reported).selectExpr("*", *aliased(typed)).selectExpr(*aliased(line))


def condense(lines: DataFrame) -> DataFrame:
    """Sum lines that agree in every key. Idempotent up to the order of sums."""
    return lines.groupBy(*KEYS).agg(*aggregates({m: f"sum({m})" for m in MEASURES}))


def sum_of_known(*parts: str) -> str:
    """Sum that skips NULL parts and is NULL only if every part is."""
    total = " + ".join(f"coalesce({p}, 0D)" for p in parts)
    return f"CASE WHEN coalesce({', '.join(parts)}) IS NOT NULL THEN {total} END"
