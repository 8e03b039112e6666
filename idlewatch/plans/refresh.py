"""The incremental run: resolve, list, compare, stage, recompute, report.

The state of a run is one relation of payers, carried from resolution to summary:

    payer_id, source, status, files, success, failed, reason

What was processed is known from a ledger of files (key, size, time per payer and month). It is
advanced only after the facts of a run are stored, so whatever stops a run earlier is found
again by the next one.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from idlewatch.functions.timeops import check_month
from idlewatch.plans.job import run_month
from idlewatch.session import through_shared_table
from idlewatch.sinks.staging import export_files, stage_each
from idlewatch.sinks.summary import payer_status, run_summary
from idlewatch.sinks.versions import commit, path_exists, read_slices
from idlewatch.sources.billing import PERIOD
from idlewatch.sources.discovery import file_diff, file_listing, qualified

LEDGER_SLICES = ("year", "month", "payer_id")
LEDGER = T.StructType(
    [
        T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType()),
        T.StructField("payer_id", T.StringType()), T.StructField("key", T.StringType()),
        T.StructField("size", T.LongType()), T.StructField("last_modified", T.TimestampType()),
    ]
)


@dataclass(frozen=True)
class Places:
    """Where a deployment keeps its tables, and its two dimensions."""

    staged_root: str
    fact_path: str
    ledger_path: str
    payers: DataFrame
    accounts: DataFrame


def processed_files(spark: SparkSession, ledger_path: str, year: int, month: int) -> DataFrame:
    """(payer_id, key, size, last_modified) of the month's files whose facts are stored."""
    of_month = (F.col("year") == year) & (F.col("month") == month)
    return read_slices(spark, ledger_path, LEDGER, LEDGER_SLICES, of_month).drop("year", "month")


def mark_processed(
    files: DataFrame, ledger_path: str, year: int, month: int, payer_ids: Sequence[str]
) -> None:
    """The month's files of these payers, and no others, are processed."""
    spark = files.sparkSession
    rows = files.where(F.col("payer_id").isin(list(payer_ids))).withColumns({"year": F.lit(year), "month": F.lit(month)})
    owned = spark.createDataFrame([(year, month, p) for p in payer_ids], T.StructType(LEDGER.fields[:3]))
    commit(rows.select(*LEDGER.names), ledger_path, LEDGER_SLICES, owned)


def refresh_run(
    spark: SparkSession,
    resolved: DataFrame,
    location: str,
    places: Places,
    year: int,
    month: int,
    schema: T.StructType | None = None,
) -> DataFrame:
    """One run over the resolved payers; the payers with their outcomes.

    ``location`` is the expression of a payer's export path over the resolved columns. Payers with
    added, changed or removed files are staged whole. A payer none of whose known files is left
    keeps its staged lines; its files count as failed, as do those of a payer whose staging fails.
    After any failure the facts and the ledger stay as they are, for all payers, and the next run
    takes up the same files. Payers without configuration fail and hold up no one.
    """
    check_month(year, month)
    run = f"refresh/{uuid.uuid4().hex}"
    resolved = through_shared_table(resolved, f"{run}/configs")
    exports = [
        (r.payer_id, r.base)
        for r in resolved.where("source != 'missing'").selectExpr("payer_id", f"{location} AS base").collect()
    ]
    files = through_shared_table(export_files(spark, exports, year, month), f"{run}/files")
    known = processed_files(spark, places.ledger_path, year, month).join(
        resolved.where("source != 'missing'").select("payer_id"), "payer_id", "left_semi"
    )
    status = through_shared_table(payer_status(resolved, file_diff(known, files)), f"{run}/status")
    changed = status.where("status = 'HAS_NEW_FILES'").select("payer_id")
    here = changed.join(files.select("payer_id").distinct().withColumn("listed", F.lit(True)), "payer_id", "left")
    ready, failures = [], {}
    for row in here.select("payer_id", "listed").collect():
        if row.listed:
            ready.append(row.payer_id)
        else:
            failures[row.payer_id] = "no file of the month is left"
    if ready:
        failures |= stage_each(spark, [e for e in exports if e[0] in set(ready)], places.staged_root, year, month, schema)
    if ready and not failures:
        run_month(
            spark, places.staged_root, places.fact_path, places.payers, places.accounts, year, month,
            sorted(ready), schema,
        )
        mark_processed(files, places.ledger_path, year, month, sorted(ready))
    reasons = spark.createDataFrame(sorted(failures.items()), "payer_id string, reason string")
    outcomes = status.join(resolved.select("payer_id", "source"), "payer_id").join(reasons, "payer_id", "left")
    outcomes = outcomes.selectExpr(
        "payer_id", "source", "status", "files",
        "CASE WHEN reason IS NULL THEN files ELSE 0L END AS success",
        "CASE WHEN reason IS NOT NULL THEN files ELSE 0L END AS failed",
        "CASE WHEN source = 'missing' THEN 'no configuration' ELSE reason END AS reason",
    )
    return through_shared_table(outcomes, f"{run}/outcomes")


def summary_of(outcomes: DataFrame) -> DataFrame:
    """The run's one-row summary."""
    return run_summary(
        outcomes.select("payer_id", "status", "files"), outcomes.select("payer_id", "success", "failed")
    )


def reopened_months(spark: SparkSession, exports: Sequence[tuple[str, str]], ledger_path: str) -> DataFrame:
    """(year, month, payer_id, files): months that were processed before and whose files changed since.

    A late file reopens its own month, whichever month is being run. Months never processed, and
    files outside any billing period, are not reopened.
    """
    bases = {b: qualified(spark, b.rstrip("/").removesuffix("/data")) for _, b in exports}
    owners = spark.createDataFrame(sorted({(p, bases[b]) for p, b in exports}), "payer_id string, base string")
    known = read_slices(spark, ledger_path, LEDGER, LEDGER_SLICES)
    present = [f"{b}/data" for b in sorted(set(bases.values())) if path_exists(spark, f"{b}/data")]
    period = F.regexp_extract("key", PERIOD, 1)
    if present:
        listed = file_listing(spark, *present)
    else:
        listed = known.select("key", "size", "last_modified").limit(0)
    base = F.regexp_extract("key", "^(.*)/data/BILLING_PERIOD=", 1).alias("base")
    now = listed.where(period != "").select("*", base).join(owners, "base").select(
        F.substring(period, 1, 4).cast("int").alias("year"), F.substring(period, 6, 2).cast("int").alias("month"),
        "payer_id", "key", "size", "last_modified",
    )
    slices = known.select(*LEDGER_SLICES).distinct()
    asked = owners.select("payer_id").distinct()
    changes = file_diff(known.join(asked, "payer_id", "left_semi"), now.join(slices, list(LEDGER_SLICES), "left_semi"))
    return changes.select(
        F.substring(period, 1, 4).cast("int").alias("year"), F.substring(period, 6, 2).cast("int").alias("month"), "payer_id"
    ).groupBy("year", "month", "payer_id").agg(F.count("*").alias("files"))


def refresh_reopened(
    spark: SparkSession,
    resolved: DataFrame,
    location: str,
    places: Places,
    schema: T.StructType | None = None,
) -> list[tuple[int, int, DataFrame]]:
    """Run every month that late files reopened, for the payers they belong to; (year, month, outcomes)."""
    resolved = through_shared_table(resolved, f"refresh/{uuid.uuid4().hex}/configs")
    rows = resolved.where("source != 'missing'").selectExpr("payer_id", f"{location} AS base").collect()
    months: dict[tuple[int, int], list[str]] = {}
    for r in reopened_months(spark, [(r.payer_id, r.base) for r in rows], places.ledger_path).collect():
        months.setdefault((r.year, r.month), []).append(r.payer_id)
    return [
        (year, month, refresh_run(spark, resolved.where(F.col("payer_id").isin(ids)), location, places, year, month, schema))
        for (year, month), ids in sorted(months.items())
    ]
