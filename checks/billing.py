"""Billing-shaped relations derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from checks import shapes
from idlewatch.functions.sql import aliased, text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def literal(node) -> str:
    if isinstance(node, list):
        return "array(" + ", ".join(literal(n) for n in node) + ")"
    return "CAST(NULL AS STRING)" if node is None else text(node)


def pick(values: list, *indexes: str) -> str:
    return literal(values) + "".join(f"[CAST({i} AS INT)]" for i in indexes)


def text_id(base: int, key: str) -> str:
    return f"CAST({base}L + {key} AS STRING)"


def payers(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "nation").where(f"n_nationkey <> {shapes.UNNAMED_NATION}")
    return named.selectExpr(
        f"{text_id(shapes.PAYER_BASE, 'n_nationkey')} AS payer_account_id", "n_name AS payer_name"
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of one segment have no registered account: their reservations drop out."""
    registered = f"c_mktsegment <> {text(shapes.UNREGISTERED_SEGMENT)}"
    return table(spark, sf_dir, "customer").where(registered).selectExpr(
        f"{text_id(shapes.ACCOUNT_BASE, 'c_custkey')} AS account_id",
        "c_mktsegment AS family_type",
        "c_name AS customer_name",
    )


def _keyed(variant: str) -> dict[str, str]:
    """What every line of user k has, whether fee or usage."""
    return {
        "bill_payer_account_id": text_id(shapes.PAYER_BASE, "c_nationkey"),
        "line_item_usage_account_id": text_id(shapes.ACCOUNT_BASE, "k"),
        "line_item_usage_type": pick(shapes.USAGE_TYPES, "k % 5", f"((k div 5) + {variant}) % 8"),
        "line_item_operation": pick(shapes.OPERATIONS, "k % 5", "(k div 5) % 7"),
        "class": "CASE WHEN k % 6 = 0 THEN 'convertible' ELSE 'standard' END",
        "product_name": pick(shapes.PRODUCTS, "k % 5", "k % 2"),
        "region": f"CASE WHEN k % 13 <> 0 THEN {pick(shapes.REGION_CODES, '(k div 5) % 6')} END",
        "arn": "concat('arn:aws:', {}, ':x:', {}, {}, k)".format(
            pick(shapes.ARN_SERVICE, "k % 5"),
            text_id(shapes.ACCOUNT_BASE, "k"),
            pick(shapes.ARN_TAIL, "k % 5"),
        ),
    }


SHARED = (
    "bill_payer_account_id", "line_item_usage_account_id", "line_item_usage_type",
    "line_item_operation",
)
PRODUCT = "map('region', region, 'product_name', product_name)"


def fees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One fee per active user; some with a second usage type, some billed twice, some a month early."""
    active = table(spark, sf_dir, "events").selectExpr("user_id AS k").distinct()
    customer = table(spark, sf_dir, "customer").selectExpr("c_custkey AS k", "c_nationkey")
    rows = (
        active.join(customer, "k")
        .selectExpr("*", "explode(array(0, 1, 2)) AS variant")
        .where("variant = 0 OR (variant = 1 AND k % 11 = 0) OR (variant = 2 AND k % 17 = 0)")
    )
    line = {
        "line_item_line_item_type": "'RIFee'",
        "line_item_usage_start_date":
            "TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(CAST(k % 3 AS INT)) + "
            + f"make_dt_interval({shapes.FEE_SHIFT})",
        "line_item_usage_end_date":
            "CASE WHEN k % 7 = 0 THEN TIMESTAMP_NTZ '2024-01-20 23:59:59'"
            " ELSE TIMESTAMP_NTZ '2024-01-31 23:59:59' END",
        "line_item_normalization_factor": "CASE WHEN k % 4 = 1 THEN 0D WHEN k % 4 > 1 THEN 4D END",
        "line_item_normalized_usage_amount": "CAST(NULL AS DOUBLE)",
        "line_item_usage_amount": "(k % 16) / 8D",
        "line_item_unblended_cost": "(k % 32) / 16D",
        "line_item_unblended_rate": "CASE WHEN k % 8 = 0 THEN '' WHEN k % 8 > 1 THEN '0.0625' END",
        "reservation_reservation_a_r_n": "arn",
        "reservation_number_of_reservations": "CAST(k % 3 + 1 AS DOUBLE)",
        "reservation_effective_cost": "(k % 64) / 32D",
        "reservation_amortized_upfront_fee_for_billing_period":
            "CASE WHEN k % 9 <> 4 THEN (k % 4 + 1) * 10D END",
        "pricing_public_on_demand_cost": "CASE WHEN k % 10 <> 3 THEN 0D END",
        "pricing_offering_class": "class",
        "product": PRODUCT,
    }
    keyed = rows.selectExpr("k", "variant", *aliased(_keyed("CASE WHEN variant = 1 THEN 1 ELSE 0 END")))
    return keyed.selectExpr(*SHARED, *aliased(line))


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per event, some of them a month early or late."""
    customer = table(spark, sf_dir, "customer").selectExpr("c_custkey AS k", "c_nationkey")
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id AS e", "user_id AS k", "event_type",
        "ts - make_dt_interval(0, 0, minute(ts), extract(SECOND FROM ts)) + "
        f"make_dt_interval({shapes.USAGE_SHIFT}) AS hour",
        "CAST(round(value * 100) AS BIGINT) / 1024D AS amount",
    )
    line = {
        "line_item_line_item_type":
            "CASE event_type WHEN 'signup' THEN 'VDiscountedUsage' WHEN 'error' THEN 'Credit'"
            " ELSE 'DiscountedUsage' END",
        "line_item_usage_start_date": "hour",
        "line_item_usage_end_date": "hour + INTERVAL '1' HOUR",
        "line_item_normalization_factor": "CAST(NULL AS DOUBLE)",
        "line_item_normalized_usage_amount":
            "CASE WHEN e % 4 = 1 THEN 0D WHEN e % 4 > 1 THEN amount * 4 END",
        "line_item_usage_amount": "amount",
        "line_item_unblended_cost": "0D",
        "line_item_unblended_rate": "CAST(NULL AS STRING)",
        "reservation_reservation_a_r_n":
            "CASE WHEN e % 50 = 7 THEN '' WHEN e % 50 <> 8 THEN arn END",
        "reservation_number_of_reservations": "CASE WHEN e % 3 = 0 THEN CAST(k % 3 + 1 AS DOUBLE) END",
        "reservation_effective_cost": "amount / 2",
        "reservation_amortized_upfront_fee_for_billing_period": "CAST(NULL AS DOUBLE)",
        "pricing_public_on_demand_cost":
            "CASE WHEN e % 9 = 0 THEN 0D WHEN e % 10 <> 1 THEN amount * 3 END",
        "pricing_offering_class": "CASE WHEN e % 20 <> 3 THEN class END",
        "product": f"CASE WHEN e % 97 <> 0 THEN {PRODUCT} END",
    }
    keyed = events.join(customer, "k").selectExpr(
        "k", "e", "event_type", "hour", "amount", *aliased(_keyed("0"))
    )
    return keyed.selectExpr(*SHARED, *aliased(line))


def billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fees(spark, sf_dir).unionByName(usage(spark, sf_dir))
