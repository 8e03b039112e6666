"""Billing tables: merged schema, month addressing, payer slices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from idlewatch.functions.sql import text
from idlewatch.functions.timeops import check_month
from idlewatch.sinks.versions import folders, paths_of

# Partition value of a payer. The prefix keeps partition discovery from reading the id
# as a number, which would lose leading zeros.
PAYER_PREFIX = "payer-"
# Name of the export file a staged line came from.
SOURCE_FILE = "source_file"
# Billing period in the path of an export file.
PERIOD = r"/BILLING_PERIOD=(20[0-9]{2}-(?:0[1-9]|1[0-2]))/"
STAGED_SLICES = StructType([StructField("payer", StringType())])


def merged_scan(
    spark: SparkSession,
    *paths: str,
    schema: StructType | None = None,
    extra: Sequence[str] = (),
    **options,
) -> DataFrame:
    """Parquet files of differing columns as one table with lower-case names.

    A column missing from a file reads as NULL. Give ``schema`` to skip reading footers.
    ``extra`` are further expressions, over ``_metadata`` too.
    """
    reader = spark.read.options(**options)
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", True)
    table = reader.parquet(*paths)
    return table.selectExpr(*[f"`{name}` AS `{name.lower()}`" for name in table.columns], *extra)


def billing_period_path(base: str, year: int, month: int) -> str:
    """Source folder of one billing month below a payer's export path."""
    check_month(year, month)
    base = base.rstrip("/").removesuffix("/data")
    return f"{base}/data/BILLING_PERIOD={year}-{month:02d}"


def month_path(root: str, year: int, month: int) -> str:
    """Folder of one staged month, a table of versioned slices of its own."""
    check_month(year, month)
    return f"{root.rstrip('/')}/year={year}/month={month}"


def staged_folders(
    spark: SparkSession, root: str, year: int, month: int, payer_ids: Sequence[str] | None = None
) -> list[str]:
    """Folders of the month's staged slices that hold lines."""
    where = None
    if payer_ids is not None:
        where = F.col("payer").isin([f"{PAYER_PREFIX}{p}" for p in sorted(set(payer_ids))])
    return folders(spark, month_path(root, year, month), STAGED_SLICES, where)


def month_table(
    spark: SparkSession,
    root: str,
    year: int,
    month: int,
    payer_ids: Sequence[str] | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Staged lines of one billing month.

    Only the folders of that month's slices, and of the payers asked for, are listed and merged:
    other payers' files and replaced versions are never opened.
    """
    path = month_path(root, year, month)
    names = staged_folders(spark, root, year, month, payer_ids)
    if not names:
        raise FileNotFoundError(f"nothing is staged for these payers in {path}")
    table = merged_scan(spark, *paths_of(path, names), schema=schema, basePath=f"{path}/data")
    return table.drop("version", *STAGED_SLICES.names)


def payer_partition(payer_id: str) -> str:
    """Partition value as an expression; never NULL, so the writer keeps it as it is."""
    return f"concat({text(PAYER_PREFIX)}, coalesce({payer_id}, ''))"
