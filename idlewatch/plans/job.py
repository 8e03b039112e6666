"""The monthly job: staged lines in, fact table slices out."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from idlewatch.functions.timeops import check_month
from idlewatch.operators.lines import billing_lines, condense
from idlewatch.operators.payers import require_unique
from idlewatch.operators.services import SERVICES
from idlewatch.operators.wastage import with_units
from idlewatch.plans.monthly import wastage_plan
from idlewatch.session import through_shared_table
from idlewatch.sinks.facts import FACT_SCHEMA, replace_slices
from idlewatch.sinks.versions import snapshots
from idlewatch.sources.billing import month_path, month_table, staged_folders


COUNTS = ("lines_read", "unparsable_rates", "unknown_hours", "hours_after_cutoff", "fact_rows")


def observed(counts: Observation) -> dict[str, int]:
    """What was observed. Nothing, if Spark left the observed step out because one of its inputs
    turned out empty; the row it hands back then has no columns and cannot be read.
    """
    try:
        return counts.get
    except Py4JJavaError:
        return {}


def checked_payers(payer_ids: Sequence[str]) -> list[str]:
    wanted = sorted({str(p) for p in payer_ids})
    if not wanted:
        raise ValueError("no payer given")
    return wanted


def run_month(
    spark: SparkSession,
    staged_root: str,
    fact_path: str,
    payers: DataFrame,
    accounts: DataFrame,
    year: int,
    month: int,
    payer_ids: Sequence[str],
    schema: StructType | None = None,
) -> dict[str, int | None]:
    """Recompute the month for the given payers and replace their slices.

    The billing lines are read once: their condensed form goes to the shared folder, and
    cutoff, dimension, fees and usage are all computed from there. Units are set while
    writing. Any error is raised; the stored slices are then unchanged. ``schema`` (of the
    staged lines) spares the pass over all file footers that merging schemas takes.

    Returns row counts that were observed while the lines and the facts were written, without a
    pass of their own: reported lines read, fee rates that are no number, hourly sums without a
    reported reservation, hours after their payer's cutoff, and fact rows. Without any reported
    reservation there is no hour to compare: ``unknown_hours`` is then None, the last two are 0.
    """
    check_month(year, month)
    wanted = checked_payers(payer_ids)
    require_unique(payers, "payer_account_id", "payers")
    require_unique(accounts, "account_id", "accounts")
    products = [s.report_name for s in SERVICES]
    if snapshots(spark, month_path(staged_root, year, month)) and not staged_folders(
        spark, staged_root, year, month, wanted
    ):
        # Staged, but without any line: the slices end up empty.
        replace_slices(spark.createDataFrame([], FACT_SCHEMA), fact_path, year, month, wanted, products)
        return dict.fromkeys(COUNTS, 0)
    billing = month_table(spark, staged_root, year, month, wanted, schema)
    read, hours, stored = Observation(), Observation(), Observation()
    seen = billing_lines(billing, wanted).observe(
        read, F.count("*").alias("lines_read"), F.count_if("unparsable_rate").alias("unparsable_rates")
    )
    run = hashlib.sha256("|".join([fact_path, *wanted]).encode()).hexdigest()[:16]
    lines = through_shared_table(
        condense(seen).sortWithinPartitions("line_type"),
        f"lines/year={year}/month={month}/run={run}",
    )
    facts = with_units(wastage_plan(lines, payers, accounts, year, month, (hours, stored)))
    replace_slices(facts, fact_path, year, month, wanted, products)
    found = observed(read) | observed(hours) | observed(stored)
    unseen = dict.fromkeys(COUNTS, 0) | {"unknown_hours": None}
    return {name: found.get(name, unseen[name]) for name in COUNTS}
