"""Run summary: status per payer and overall."""

from __future__ import annotations

from pyspark.sql import DataFrame

from idlewatch.functions.sql import aggregates


def payer_status(resolved: DataFrame, new_files: DataFrame) -> DataFrame:
    """``resolved`` as from ``resolve_configs``; ``new_files`` with payer_id per file.

    A payer without configuration failed, whatever files were found.
    """
    counts = new_files.groupBy("payer_id").agg(*aggregates({"found": "count(1)"}))
    return resolved.join(counts, "payer_id", "left").selectExpr(
        "payer_id",
        "CASE WHEN source = 'missing' THEN 'FAILED' WHEN found > 0 THEN 'HAS_NEW_FILES'"
        " ELSE 'UP_TO_DATE' END AS status",
        "CASE WHEN source = 'missing' THEN 0L ELSE coalesce(found, 0L) END AS files",
    )


def run_summary(status: DataFrame, outcomes: DataFrame | None = None) -> DataFrame:
    """One row: overall status, file counts, number of failed payers.

    ``outcomes`` (payer_id, success, failed: files staged and not staged) defaults to
    every found file staged.
    """
    if outcomes is None:
        staged = status.selectExpr("status", "files AS success", "0L AS failed")
    else:
        staged = status.join(outcomes, "payer_id", "left").select("status", "success", "failed")
    totals = staged.agg(
        *aggregates(
            {
                "failed_payers": "count_if(status = 'FAILED')",
                "changed_payers": "count_if(status = 'HAS_NEW_FILES')",
                "success": "coalesce(sum(success), 0L)",
                "failed": "coalesce(sum(failed), 0L)",
            }
        )
    )
    return totals.selectExpr(
        "CASE WHEN changed_payers = 0 AND failed_payers = 0 THEN 'UP_TO_DATE'"
        " WHEN changed_payers > 0 AND failed_payers = 0 AND failed = 0 THEN 'SUCCESS'"
        " ELSE 'FAILED' END AS status",
        "success",
        "failed",
        "success + failed AS total",
        "failed_payers",
        "changed_payers",
    )
