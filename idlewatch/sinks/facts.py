"""The fact table on plain Parquet: slice replacement and month updates.

A slice is one product, year, month and payer. Which slices a run owns follows from its
parameters, not from its rows: a slice whose new result is empty has to end up empty. Slices
are replaced by version (`sinks.versions`): a run shows whole or not at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from idlewatch.functions.timeops import check_month, in_month
from idlewatch.operators.wastage import SLICE_COLUMNS, UNITS, update_units
from idlewatch.sinks.versions import commit, manifest, read_slices

_TEXT = (
    "reservation_arn", "payer_name", "usageaccountid", "account_type", "customer_name", "region",
    "operatingsystem_engine", "instancetype_family", "savingsplan_type", "offering_type",
    "reservation_reservationarn", "instancetype",
)
_NUMBERS = (
    "total_nu", "used_nu", "unused_nu", "wastage_percentage", "reservedhours", "used_hours",
    "unused_hours", "wastage_cost", "ri_utilization", "nfapplied", "quantity", "ri_ecost", *UNITS,
)

# Declared rather than inferred: inference would read payer ids as numbers.
FACT_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in _TEXT]
    + [T.StructField("lineitem_usagestartdate", T.TimestampNTZType())]
    + [T.StructField(c, T.DoubleType()) for c in _NUMBERS]
    + [
        T.StructField("product_name", T.StringType()),
        T.StructField("mycloud_startyear", T.IntegerType()),
        T.StructField("mycloud_startmonth", T.IntegerType()),
        T.StructField("bill_payeraccountid", T.StringType()),
    ]
)


def slice_predicate(
    year: int, month: int, payer_ids: Sequence[str], products: Sequence[str]
) -> Column:
    """Rows that a run replaces. NULL wherever a compared column is NULL."""
    return (
        F.expr(in_month("lineitem_usagestartdate", year, month))
        & (F.col("bill_payeraccountid").isin(*payer_ids) if payer_ids else F.lit(False))
        & F.col("product_name").isin(*products)
    )


def replaced(existing: DataFrame, new: DataFrame, owned: Column) -> DataFrame:
    """Delete the owned rows, then append: only rows where ``owned`` is TRUE go."""
    kept = existing.where(~F.coalesce(owned, F.lit(False)))
    return kept.unionByName(new, allowMissingColumns=True)


SLICES = T.StructType([FACT_SCHEMA[c] for c in SLICE_COLUMNS])


def of_month(year: int, month: int) -> Column:
    return (F.col("mycloud_startyear") == year) & (F.col("mycloud_startmonth") == month)


def read_facts(spark: SparkSession, path: str, where: Column | str | None = None) -> DataFrame:
    """The current facts; `where`, a condition on slice columns, picks the slices to be read."""
    return read_slices(spark, path, FACT_SCHEMA, SLICE_COLUMNS, where)


def owned_slices(
    spark: SparkSession, year: int, month: int, payer_ids: Sequence[str], products: Sequence[str]
) -> DataFrame:
    """One row per slice that a run with these parameters replaces."""
    owned = [(p, year, month, payer) for p in sorted(set(products)) for payer in sorted(set(payer_ids))]
    return spark.createDataFrame(owned, SLICES)


def replace_slices(
    new: DataFrame,
    path: str,
    year: int,
    month: int,
    payer_ids: Sequence[str],
    products: Sequence[str],
) -> None:
    """Make the owned slices of the stored table equal to ``new``.

    Rows outside the owned slices are not written, slices that get no rows end up empty.
    """
    check_month(year, month)
    rows = new.where(slice_predicate(year, month, payer_ids, products)).where(of_month(year, month))
    rows = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FACT_SCHEMA])
    owned = owned_slices(new.sparkSession, year, month, payer_ids, products)
    commit(rows, path, SLICE_COLUMNS, owned)


def update_stored_units(spark: SparkSession, path: str, year: int, month: int) -> None:
    """Set the unit columns of a stored month, all payers and products.

    Copy on write: the month's slices are read from their present folders and written into a new
    version, all other slices stay where they are. No exchange: each file holds one slice.
    """
    check_month(year, month)
    touched = manifest(spark, path, SLICES).where(of_month(year, month)).where("folder IS NOT NULL")
    updated = update_units(read_facts(spark, path, of_month(year, month)), year, month)
    commit(updated.select(*FACT_SCHEMA.names), path, SLICE_COLUMNS, touched, rebalance=False)
