"""Measure the two structural choices: python -m benchmarks.compare [sf_dir]

* hours by theta join with an hour grid against the closed form (per-row expansion);
* cutoff, description, fees and usage each read from the lines, for one service at a time
  and for all at once, against the condensed table that is written once.
"""

from __future__ import annotations

import json
import sys
import time

from pyspark.sql import functions as F

from checks.billing import accounts, billing, payers
from checks.queries import MONTH, YEAR, intervals
from checks.shapes import PAYER_IDS
from idlewatch.functions import timeops
from idlewatch.operators.lines import billing_lines, condense
from idlewatch.operators.services import SERVICES
from idlewatch.plans.monthly import service_plan, wastage_plan
from idlewatch.session import local_session, shared_folder, through_shared_table
from idlewatch.sinks.staging import stage_lines
from idlewatch.sources.billing import month_table


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def best(action, runs: int = 2) -> float:
    times = []
    for _ in range(runs):
        began = time.perf_counter()
        action()
        times.append(time.perf_counter() - began)
    return round(min(times), 2)


def theta(spark, sf_dir):
    # A proper interval bills the hours whose end it crosses, a reversed one that of its start.
    closing = timeops.hour_floor("e")
    overlap = f"""(s <= e AND s <= enddate AND startdate < {closing})
        OR (s > e AND startdate = {timeops.hour_floor('s')} AND s <= enddate AND startdate <> {closing})"""
    grid = timeops.hour_grid(spark, YEAR, MONTH)
    return intervals(spark, sf_dir).join(grid, F.expr(overlap)).select("event_id", "startdate")


def closed(spark, sf_dir):
    hours = timeops.covered_hours("s", "e", YEAR, MONTH)
    return intervals(spark, sf_dir).selectExpr("event_id", f"explode({hours}) AS startdate")


def main(sf_dir: str) -> None:
    spark = local_session(8)
    root = f"{shared_folder(spark)}/compare"
    stage_lines(billing(spark, sf_dir), root, YEAR, MONTH, PAYER_IDS)
    lines = billing_lines(month_table(spark, root, YEAR, MONTH), PAYER_IDS)
    dims = payers(spark, sf_dir), accounts(spark, sf_dir)

    def one_by_one():
        for service in SERVICES:
            run(service_plan(lines, *dims, YEAR, MONTH, service.key))

    def condensed():
        table = through_shared_table(condense(lines).sortWithinPartitions("line_type"), "compare-lines")
        run(wastage_plan(table, *dims, YEAR, MONTH))

    print(json.dumps({
        "hours by theta join": best(lambda: run(theta(spark, sf_dir)), 1),
        "hours in closed form": best(lambda: run(closed(spark, sf_dir))),
        "wastage, one service at a time": best(one_by_one),
        "wastage, all services in one plan": best(lambda: run(wastage_plan(lines, *dims, YEAR, MONTH))),
        "wastage, condensed once": best(condensed),
    }, indent=1))


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
