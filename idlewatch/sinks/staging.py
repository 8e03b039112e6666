"""Staging: source exports of many payers under one prefix, one slice per payer and month.

Each staged month is a table whose slices are replaced by version (`sinks.versions`).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from idlewatch.functions.text import base_name
from idlewatch.operators.lines import for_payers
from idlewatch.sinks.versions import commit, path_exists
from idlewatch.sources.billing import (
    PAYER_PREFIX, SOURCE_FILE, STAGED_SLICES, billing_period_path, merged_scan, month_path,
    month_table, payer_partition,
)
from idlewatch.sources.discovery import file_listing, qualified


def stage_lines(
    billing: DataFrame, root: str, year: int, month: int, payer_ids: Sequence[str]
) -> None:
    """Replace the payers' slices of the staged month by the given lines.

    The whole month of a payer is staged whenever one of its files changed: emptying the
    slice and adding only the new files would lose the others.

    No exchange: an export file belongs to one payer, so tasks write few partitions as
    they are. Inside a file lines are sorted by type, which lets the scans for fee lines
    skip nearly all row groups.
    """
    spark, payer_ids = billing.sparkSession, sorted(set(payer_ids))
    lines = for_payers(billing, payer_ids, "bill_payer_account_id").selectExpr(
        "*", f"{payer_partition('bill_payer_account_id')} AS payer"
    )
    commit(
        # The writer keeps its payers' files open, so that lines are sorted by their short type alone.
        lines.sortWithinPartitions("line_item_line_item_type"),
        month_path(root, year, month),
        STAGED_SLICES.names,
        spark.createDataFrame([(f"{PAYER_PREFIX}{p}",) for p in payer_ids], STAGED_SLICES),
        rebalance=False,
    )


def export_files(
    spark: SparkSession, exports: Iterable[tuple[str, str]], year: int, month: int
) -> DataFrame:
    """(payer_id, key, size, last_modified) of the files of one billing month.

    Files that several payers share count for each. A payer whose folder is absent or empty has
    no row. The folders looked at on the driver are bounded by the payers asked for.
    """
    wanted = sorted({(p, qualified(spark, billing_period_path(base, year, month))) for p, base in exports})
    present = sorted({f for _, f in wanted if path_exists(spark, f)})
    if not present:
        return spark.createDataFrame([], "payer_id string, key string, size bigint, last_modified timestamp")
    folder = F.regexp_extract("key", "^(.*/BILLING_PERIOD=[^/]*)/", 1).alias("folder")
    listed = file_listing(spark, *present).select("*", folder)
    owners = spark.createDataFrame(wanted, "payer_id string, folder string")
    return owners.join(listed, "folder").select("payer_id", "key", "size", "last_modified")


def stage_exports(
    spark: SparkSession,
    exports: Sequence[tuple[str, str]],
    root: str,
    year: int,
    month: int,
    schema: StructType | None = None,
) -> list[str]:
    """Stage one billing month out of (payer_id, export path) pairs, all read in one scan.

    A payer keeps its staged slice unless each of its exports holds files of the month: a missing
    or empty folder (an interrupted copy, a folder marker) says nothing about its lines. The
    payers that were staged are returned, the others are for the caller to report. Each line keeps
    the name of its file in ``source_file``. A given schema spares reading the footers of the month.
    """
    paths: dict[str, set[str]] = {}
    for payer_id, base in exports:
        paths.setdefault(payer_id, set()).add(qualified(spark, billing_period_path(base, year, month)))
    files = export_files(spark, exports, year, month)
    folder = F.regexp_extract("key", "^(.*/BILLING_PERIOD=[^/]*)/", 1).alias("folder")
    there = {r.folder for r in files.select(folder).distinct().collect()}
    staged = sorted(payer for payer, needed in paths.items() if needed <= there)
    if not staged:
        raise FileNotFoundError(f"no export holds billing period {year}-{month:02d}")
    found = sorted(set().union(*(paths[p] for p in staged)))
    lines = merged_scan(spark, *found, schema=schema, extra=[f"{base_name('_metadata.file_path')} AS {SOURCE_FILE}"])
    stage_lines(lines, root, year, month, staged)
    return staged


def stage_each(
    spark: SparkSession,
    exports: Sequence[tuple[str, str]],
    root: str,
    year: int,
    month: int,
    schema: StructType | None = None,
) -> dict[str, str]:
    """Stage the exports; the payers that could not be staged, with the reason.

    All are tried in one scan. If that fails, each payer is staged on its own, so that one broken
    file costs its own payer only.
    """
    payer_ids = sorted({p for p, _ in exports})
    absent = "no file of the month"
    try:
        staged = set(stage_exports(spark, exports, root, year, month, schema))
        return {p: absent for p in payer_ids if p not in staged}
    except FileNotFoundError:
        return dict.fromkeys(payer_ids, absent)
    except (PySparkException, Py4JJavaError):
        failed = {}
    for payer_id in payer_ids:
        try:
            stage_exports(spark, [e for e in exports if e[0] == payer_id], root, year, month, schema)
        except FileNotFoundError:
            failed[payer_id] = absent
        except (PySparkException, Py4JJavaError) as error:
            failed[payer_id] = str(error).splitlines()[0][:500]
    return failed


def withdraw_files(
    spark: SparkSession, root: str, year: int, month: int, files: DataFrame
) -> list[str]:
    """Take the lines of the named files (payer_id, source_file) out of the staged month.

    Only the slices of these payers are rewritten. Returns the payers.
    """
    payer_ids = sorted(r.payer_id for r in files.select("payer_id").distinct().collect())
    if not payer_ids:
        return []
    lines = month_table(spark, root, year, month, payer_ids)
    gone = files.select(F.col("payer_id").alias("bill_payer_account_id"), F.col(SOURCE_FILE)).distinct()
    stage_lines(lines.join(gone, ["bill_payer_account_id", SOURCE_FILE], "left_anti"), root, year, month, payer_ids)
    return payer_ids
