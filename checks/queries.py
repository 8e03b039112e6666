"""Registered queries: every operator over the given tables, with its SQL twin."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import oracle, shapes
from checks.billing import accounts, billing, payers, pick, table, text_id, usage
from idlewatch.functions import fixed_values as fixed
from idlewatch.functions import rules, timeops
from idlewatch.functions.sql import aggregates, aliased
from idlewatch.operators.dimensions import payer_max_date, reservation_dimension
from idlewatch.operators.lines import billing_lines, product_entries, product_value
from idlewatch.operators.payers import resolve_configs
from idlewatch.operators.report import line_item_report
from idlewatch.operators.services import SERVICES, report_name, service_of
from idlewatch.operators.wastage import update_units
from idlewatch.plans.job import run_month
from idlewatch.plans.refresh import Places, refresh_reopened, refresh_run, summary_of
from idlewatch.plans.monthly import service_plan, utilization_plan, wastage_plan
from idlewatch.session import shared_folder, through_shared_table
from idlewatch.sinks.facts import (
    SLICES, read_facts, replace_slices, replaced, slice_predicate, update_stored_units,
)
from idlewatch.sinks.staging import stage_exports, stage_lines
from idlewatch.sinks.summary import payer_status, run_summary
from idlewatch.sinks.versions import manifest
from idlewatch.sources.billing import billing_period_path, merged_scan, month_table
from idlewatch.sources.discovery import (
    changed_files, file_diff, file_listing, file_marks, high_water_marks, modified_after,
)
from idlewatch.streaming.intake import export_stream, follow_exports, follow_to_facts

YEAR, MONTH = shapes.YEAR, shapes.MONTH
DIGITS = 6


# --- presentation: the same types and rounding on both sides ------------------------------


def presented(df: DataFrame) -> DataFrame:
    def shown(field: T.StructField) -> str:
        if isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            return f"round(CAST({field.name} AS DOUBLE), {DIGITS}) AS {field.name}"
        if isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            return f"CAST({field.name} AS BIGINT) AS {field.name}"
        return field.name

    return df.selectExpr(*[shown(f) for f in df.schema])


def number(expression: str) -> str:
    return f"round(CAST({expression} AS DOUBLE), {DIGITS})"


def whole(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


# --- shared inputs ------------------------------------------------------------------------


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return billing_lines(billing(spark, sf_dir), shapes.PAYER_IDS)


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wastage_plan(
        lines(spark, sf_dir), payers(spark, sf_dir), accounts(spark, sf_dir), YEAR, MONTH
    )


def utilization(spark: SparkSession, sf_dir: str) -> DataFrame:
    return utilization_plan(
        lines(spark, sf_dir), payers(spark, sf_dir), accounts(spark, sf_dir), YEAR, MONTH
    )


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/checks/{uuid.uuid4().hex}"


# --- dimensions, report, utilisation, wastage ------------------------------------------------


def q_payer_max_date(spark, sf_dir):
    dates = payer_max_date(lines(spark, sf_dir))
    return presented(
        dates.selectExpr("payer_id", f"{report_name('service')} AS product", "max_date")
    )


def o_payer_max_date() -> str:
    ctes = [oracle.LISTED] + [oracle.cutoff(k) for k in oracle.SERVICES]
    body = " UNION ALL ".join(
        f"SELECT payer AS payer_id, {oracle.quote(s[0])} AS product, max_date FROM {k}_cutoff"
        for k, s in oracle.SERVICES.items()
    )
    return "WITH " + ",".join(ctes) + " " + body


def q_map_pivot_product(spark, sf_dir):
    """Key/value pivot: maximum per group of a looked-up map key."""
    lines_ = billing(spark, sf_dir)
    name = product_value(lines_, "product_name")
    pivoted = {
        "region_code": f"max({product_value(lines_, 'region')})",
        "product_name": f"max({name})",
        "named": f"count({name})",
    }
    return lines_.groupBy("bill_payer_account_id", "line_item_line_item_type").agg(
        *aggregates(pivoted)
    )


def o_map_pivot_product() -> str:
    return f"""WITH {oracle.BILL}
      SELECT payer AS bill_payer_account_id, item AS line_item_line_item_type,
        max(region_code) AS region_code, max(product_name) AS product_name,
        count(product_name) AS named
      FROM bill GROUP BY ALL"""


def q_map_explode_product(spark, sf_dir):
    """The same maps unnested, one row per entry."""
    keys = ("bill_payer_account_id", "line_item_line_item_type")
    entries = product_entries(billing(spark, sf_dir), *keys)
    return entries.groupBy(*keys, "key").agg(
        *aggregates({"value": "max(value)", "n_entries": "count(1)", "n_values": "count(value)"})
    )


def o_map_explode_product() -> str:
    return f"""WITH {oracle.BILL}, entries AS (
        SELECT payer, item, 'region' AS key, region_code AS value FROM bill WHERE product_name IS NOT NULL
        UNION ALL
        SELECT payer, item, 'product_name', product_name FROM bill WHERE product_name IS NOT NULL)
      SELECT payer AS bill_payer_account_id, item AS line_item_line_item_type, key,
        max(value) AS value, count(*) AS n_entries, count(value) AS n_values
      FROM entries GROUP BY ALL"""


DIMENSION = {
    "service": "'{name}'", "arn": "arn", "instance_type": "instance_type", "factor": number("nf"),
    "engine": "engine", "family": "family", "region_code": "region_code",
    "product_name": "product_name", "region": "region", "payer_id": "payer",
    "usage_account": "account",
}


def q_reservation_dim(spark, sf_dir):
    dimension = reservation_dimension(lines(spark, sf_dir), YEAR, MONTH)
    return presented(
        dimension.withColumn("service", F.expr(report_name("service"))).select(*DIMENSION)
    )


REPORT = {
    "reservation_id": "reservation_id", "lineitem_usagestartdate": "s",
    "lineitem_usageenddate": "e", "bill_payeraccountid": "payer", "payer_name": "payer_name",
    "lineitem_usageaccountid": "account", "instancetype_family": "family",
    "instancetype": "instance_type", "mycloud_startmonth": whole("month(s)"),
    "mycloud_startyear": whole("year(s)"), "product_productname": "product_name",
    "mycloud_operatingsystem": "engine", "mycloud_region": "region", "offering_type": "offering",
    "lineitem_lineitemtype": "item", "reservation_reservationarn": "arn",
    "reservation_numberofreservations": number("n"), "lineitem_normalizationfactor": number("nf"),
    "lineitem_normalizedusageamount": number("norm_amount"),
    "lineitem_usageamount": number("amount"), "lineitem_unblendedcost": number("cost"),
    "reservation_effectivecost": number("eff_cost"), "mycloud_ondemandprice": number("od"),
    "ri_hourly_effective_cost": number("hourly_cost"),
}


def q_report(service: str):
    def query(spark, sf_dir):
        all_lines = lines(spark, sf_dir)
        dimension = reservation_dimension(all_lines, YEAR, MONTH)
        report = line_item_report(
            all_lines, dimension, payers(spark, sf_dir), YEAR, MONTH, service
        )
        return presented(report.select(*REPORT))

    return query


UTILIZATION = {
    "product_name": "product_name", "reservation_id": "reservation_id",
    "bill_payeraccountid": "payer", "payer_name": "payer_name", "family_type": "family_type",
    "customer_name": "customer_name", "linkedaccountid": "account", "startdate": "h",
    "enddate": "h_end", "reservation_reservationarn": "arn",
    "mycloud_startmonth": whole("month(h)"), "mycloud_startyear": whole("year(h)"),
    "region": "region", "offering_type": "offering", "operatingsystem": "engine",
    "instancetype_family": "family", "instancetype": "instance_type", "nfapplied": number("nf"),
    "ondemandcost": number("all_od"), "reservedhours": number("reserved"),
    "total_nu": number("total_nu"), "quantity": number("quantity"), "used_nu": number("used_nu"),
    "od_cost": number("od"), "ri_ecost": number("ecost"),
    "netsavings": number("CAST(od AS DOUBLE) - ecost * reserved"), "usedhours": number("used_nu"),
}


def q_hourly_utilization(spark, sf_dir):
    return presented(utilization(spark, sf_dir).select(*UTILIZATION))


FACT_TEXT = (
    "reservation_arn", "payer_name", "bill_payeraccountid", "usageaccountid", "account_type",
    "customer_name", "region", "product_name", "operatingsystem_engine", "instancetype_family",
    "savingsplan_type", "lineitem_usagestartdate", "offering_type", "reservation_reservationarn",
    "instancetype",
)
FACT_NUMBERS = (
    "total_nu", "used_nu", "unused_nu", "wastage_percentage", "reservedhours", "used_hours",
    "unused_hours", "wastage_cost", "ri_utilization", "nfapplied", "quantity", "ri_ecost",
)
FACTS = (
    {c: c for c in FACT_TEXT}
    | {c: number(c) for c in FACT_NUMBERS}
    | {c: whole(c) for c in ("mycloud_startmonth", "mycloud_startyear")}
)
UNITS = {
    f"{kind}_units": number(oracle.unit_sql(f"{kind}_nu")).replace("{", "{{").replace("}", "}}")
    for kind in ("total", "used", "unused")
}


def q_wastage_all(spark, sf_dir):
    return presented(facts(spark, sf_dir))


def q_wastage(service):
    return lambda spark, sf_dir: presented(
        service_plan(
            lines(spark, sf_dir), payers(spark, sf_dir), accounts(spark, sf_dir), YEAR, MONTH, service.key
        )
    )


def q_wastage_units(spark, sf_dir):
    return presented(update_units(facts(spark, sf_dir), YEAR, MONTH))


# --- rules over generated codes, one per line item or part -----------------------------------

SIZES = [s.lstrip(".") + ("arge" if s.endswith("l") else "") for s, _ in fixed.SIZE_FACTORS]
SIZES += ["48xlarge", "metal", "56xlarge"]
USAGE_PREFIXES = [
    "USE1-HeavyUsage", "HeavyUsage", "EUC1-InstanceUsage", "Multi-AZ", "APS2-MirrorUsage", "Other",
]
FAMILIES = ["m5", "db.r5", "cache.t3", "G4dn", "p5", "db.g6e", "u7i-6tb", "hpc7a", "x1"]
OS_CODES = [f"RunInstances:{c}" for c, _ in fixed.COMPUTE_CODES]
OS_CODES += ["RunInstances", "RunInstances:0002:0001", "RunInstances:9999", "runinstances", None]
ENGINE_CODES = [f"CreateDBInstance:{c}" for c, _ in fixed.DATABASE_CODES]
ENGINE_CODES += ["CreateDBInstance:00021", "CreateDBInstance", None]
CACHE_CODES = [f"CreateCacheCluster:{c}" for c, _ in fixed.CACHE_CODES]
CACHE_CODES += ["CreateCacheCluster:9999", "", None]
REGION_CODES = [code for code, _, _ in fixed.REGIONS] + ["us-east-1-wl1", "zz-none-1", "", None]
REGION_PREFIXES = [f"{prefix}-" for _, prefix, _ in fixed.REGIONS] + ["", "ZZZ9-", "EUS-"]


def coded(spark, sf_dir, **columns) -> DataFrame:
    """lineitem with one text per column, picked by a key column's remainder."""
    picked = {
        name: pick(values, f"{key} % {len(values)}") for name, (key, values) in columns.items()
    }
    return table(spark, sf_dir, "lineitem").selectExpr("l_quantity", *aliased(picked))


def coded_sql(**columns) -> str:
    texts = ", ".join(
        f"{oracle.quote(values)}[CAST({key} % {len(values)} AS INTEGER) + 1] AS {name}"
        for name, (key, values) in columns.items()
    )
    return f"(SELECT l_quantity, {texts} FROM lineitem)"


def counted(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        *aggregates({"n_lines": "count(1)", "quantity": "sum(l_quantity)"})
    )


def counted_sql(rows: str, **keys: str) -> str:
    shown = ", ".join(f"{expression} AS {name}" for name, expression in keys.items())
    return (
        f"SELECT {shown}, count(*) AS n_lines, sum(l_quantity) AS quantity FROM {rows} GROUP BY ALL"
    )


USAGE_PARTS = {
    "prefix": ("l_suppkey", USAGE_PREFIXES),
    "family": ("l_linenumber", FAMILIES),
    "size": ("l_partkey", SIZES),
}


def usage_types(spark, sf_dir) -> DataFrame:
    rows = coded(spark, sf_dir, **USAGE_PARTS)
    return rows.selectExpr("*", "concat(prefix, ':', family, '.', size) AS usage_type")


USAGE_TYPES_SQL = (
    f"(SELECT *, prefix || ':' || family || '.' || size AS usage_type FROM {coded_sql(**USAGE_PARTS)})"
)


def q_size_factor(spark, sf_dir):
    rows = usage_types(spark, sf_dir)
    factor = rules.size_factor("usage_type", "7.5D")
    return counted(rows.selectExpr("*", f"{factor} AS factor"), "usage_type", "factor")


def q_size_factor_multi_az(spark, sf_dir):
    rows = usage_types(spark, sf_dir)
    factor = rules.size_factor_zoned("usage_type", "7.5D")
    return counted(rows.selectExpr("*", f"{factor} AS factor"), "usage_type", "factor")


def o_factor(sql) -> str:
    factor = f"CAST({sql('usage_type', '7.5')} AS DOUBLE)"
    return counted_sql(USAGE_TYPES_SQL, usage_type="usage_type", factor=factor)


def q_label(codes, rule):
    def query(spark, sf_dir):
        rows = coded(spark, sf_dir, operation=("l_partkey", codes))
        labelled = rows.selectExpr("*", f"{rule('operation')} AS label")
        return counted(labelled, "operation", "label")

    return query


def o_label(codes, sql) -> str:
    return counted_sql(
        coded_sql(operation=("l_partkey", codes)), operation="operation", label=sql("operation")
    )


FAMILY_CODES = {
    "operation": ("l_partkey", ENGINE_CODES), "family": ("l_linenumber", FAMILIES),
    "size": ("l_suppkey", SIZES),
}


def q_family_label(spark, sf_dir):
    rows = coded(spark, sf_dir, **FAMILY_CODES).selectExpr(
        "*", "concat(family, '.', size) AS instance_type",
        f"{rules.engine_label('operation')} AS engine",
    )
    label = rules.family_label("instance_type", "engine", fixed.OPEN_ENGINES, 2)
    return counted(rows.selectExpr("*", f"{label} AS label"), "instance_type", "engine", "label")


def o_family_label() -> str:
    rows = f"""(SELECT *, family || '.' || size AS instance_type,
      {oracle.engine_sql('operation')} AS engine FROM {coded_sql(**FAMILY_CODES)})"""
    label = oracle.family_sql("instance_type", "engine", list(fixed.OPEN_ENGINES), 2)
    return counted_sql(rows, instance_type="instance_type", engine="engine", label=label)


REGION_PARTS = {"region_code": ("l_partkey", REGION_CODES), "prefix": ("l_suppkey", REGION_PREFIXES)}


def q_region_label(spark, sf_dir):
    rows = coded(spark, sf_dir, **REGION_PARTS)
    label = rules.region_label("region_code", "concat(prefix, 'BoxUsage')")
    return counted(rows.selectExpr("*", f"{label} AS label"), "region_code", "prefix", "label")


def o_region_label() -> str:
    label = oracle.region_sql("region_code", "(prefix || 'BoxUsage')")
    return counted_sql(
        coded_sql(**REGION_PARTS), region_code="region_code", prefix="prefix", label=label
    )


# --- hours ------------------------------------------------------------------------------------


def q_hour_grid(spark, sf_dir):
    """Hour grid of every month that has orders, with the orders per hour."""
    orders = table(spark, sf_dir, "orders").select("o_orderdate")
    months = orders.selectExpr(
        f"{timeops.first_of_month('o_orderdate')} AS first",
        f"{timeops.first_of_next_month('o_orderdate')} AS after",
    ).distinct()
    placed = orders.selectExpr(f"{timeops.hour_floor('o_orderdate')} AS startdate")
    grid = months.selectExpr(
        f"explode({timeops.hours_between('first', 'after')}) AS startdate",
        f"{timeops.days_crossed('first', 'after')} AS days",
    )
    counted_ = placed.groupBy("startdate").agg(*aggregates({"n": "count(1)"}))
    return presented(
        grid.join(counted_, "startdate", "left").selectExpr(
            "startdate", f"{timeops.hour_end('startdate')} AS enddate", "days",
            "coalesce(n, 0L) AS n_orders",
        )
    )


O_HOUR_GRID = """
    WITH months AS (SELECT DISTINCT date_trunc('month', o_orderdate) AS m FROM orders),
    grid AS (
      SELECT unnest(generate_series(m::TIMESTAMP, m::TIMESTAMP + INTERVAL 1 MONTH - INTERVAL 1 HOUR,
               INTERVAL 1 HOUR)) AS startdate, day(last_day(m)) AS days
      FROM months),
    placed AS (SELECT date_trunc('hour', o_orderdate) AS startdate, count(*) AS n
               FROM orders GROUP BY 1)
    SELECT g.startdate, g.startdate + INTERVAL 1 HOUR - INTERVAL 1 SECOND AS enddate,
      CAST(days AS BIGINT) AS days, coalesce(n, 0) AS n_orders
    FROM grid g LEFT JOIN placed p ON p.startdate = g.startdate"""


def intervals(spark, sf_dir) -> DataFrame:
    """One interval per event: sub-second starts, 0 to 55 hours long, some reversed."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", "ts AS s",
        "ts + make_dt_interval(0, 0, 0, (event_id % 200) * 1000 - 5000) AS e",
    )


INTERVALS_SQL = f"""
    iv AS (SELECT event_id, ts AS s,
             ts + INTERVAL 1 SECOND * ((event_id % 200) * 1000 - 5000) AS e FROM events),
    {oracle.GRID.strip()}"""


COVERED = f"explode({timeops.covered_hours('s', 'e', YEAR, MONTH)}) AS hour"


def q_interval_to_hours(spark, sf_dir):
    return intervals(spark, sf_dir).selectExpr("event_id", COVERED)


O_INTERVAL_TO_HOURS = f"""WITH {INTERVALS_SQL}
    SELECT event_id, h AS hour FROM {oracle.billed("iv")}"""


def q_clipped_overlap_hours(spark, sf_dir):
    """Summed in each row's own array of hours: no explode and no exchange."""
    hours = intervals(spark, sf_dir).selectExpr(
        "*", f"{timeops.covered_hours('s', 'e', YEAR, MONTH)} AS hours"
    )
    overlap = timeops.overlap_hours("s", "e", "hour")
    overlaps = {
        "overlap": f"aggregate(hours, 0L, (total, hour) -> total + {overlap})",
        "overlap_closed_form": f"size(hours) * {timeops.hours_per_match('s', 'e')}",
        "crossed": timeops.hours_crossed("s", "e"),
    }
    return hours.where("size(hours) > 0").selectExpr("event_id", *aliased(overlaps))


O_CLIPPED_OVERLAP_HOURS = f"""WITH {INTERVALS_SQL},
    hit AS (
      SELECT event_id, s, e, date_diff('hour', greatest(s, h),
          least(e, h + {oracle.LAST_SECOND}) + INTERVAL 2 SECOND) AS o
      FROM {oracle.billed("iv")})
    SELECT event_id, CAST(sum(o) AS BIGINT) AS overlap, CAST(sum(o) AS BIGINT) AS overlap_closed_form,
      max(date_diff('hour', s, e)) AS crossed
    FROM hit GROUP BY event_id"""


def q_point_to_hour(spark, sf_dir):
    placed = table(spark, sf_dir, "events").where(timeops.starts_in_an_hour("ts"))
    hours = placed.selectExpr(f"{timeops.hour_floor('ts')} AS hour")
    return hours.groupBy("hour").agg(*aggregates({"n_events": "count(1)"}))


O_POINT_TO_HOUR = f"""WITH {oracle.GRID.strip()}
    SELECT h AS hour, count(*) AS n_events FROM events JOIN grid ON ts BETWEEN h AND h_end
    GROUP BY h"""


# --- fact table -----------------------------------------------------------------------------

OWNED_PAYERS = shapes.PAYER_IDS[:12]
OWNED_PRODUCTS = ["EC2(RIs)", "RDS"]


def usage_by_hour(spark, sf_dir, line_type: str) -> DataFrame:
    """A small stand-in for the fact table: usage per product, payer and hour."""
    rows = usage(spark, sf_dir).where(F.col("line_item_line_item_type") == line_type)
    product = report_name(f"({service_of(product_value(rows, 'product_name'))})")
    columns = {
        "product_name": product,
        "bill_payeraccountid": "bill_payer_account_id",
        "lineitem_usagestartdate": "line_item_usage_start_date",
    }
    return (
        rows.selectExpr(*aliased(columns), "line_item_usage_amount AS amount")
        .groupBy(*columns)
        .agg(*aggregates({"amount": "sum(amount)"}))
    )


def q_replace_slice(spark, sf_dir):
    owned = slice_predicate(YEAR, MONTH, OWNED_PAYERS, OWNED_PRODUCTS)
    new = usage_by_hour(spark, sf_dir, fixed.VM_DISCOUNTED).where(owned)
    new = new.selectExpr("*", "1 AS revised")
    return presented(replaced(usage_by_hour(spark, sf_dir, fixed.DISCOUNTED), new, owned))


def o_replace_slice() -> str:
    name = oracle.case(
        [(f"product_name IN {oracle.in_list(s[1])}", oracle.quote(s[0])) for s in oracle.SERVICES.values()]
    )
    owned = (
        f"month(hour) = {MONTH} AND year(hour) = {YEAR}"
        f" AND payer IN {oracle.in_list(OWNED_PAYERS)} AND product IN {oracle.in_list(OWNED_PRODUCTS)}"
    )
    shown = (
        "product AS product_name, payer AS bill_payeraccountid, hour AS lineitem_usagestartdate, "
        + number("amount") + " AS amount"
    )
    return f"""WITH {oracle.BILL},
      hourly AS (SELECT item, {name} AS product, payer, s AS hour, sum(amount) AS amount
                 FROM bill WHERE item <> 'RIFee' GROUP BY ALL)
      SELECT {shown}, NULL::BIGINT AS revised FROM hourly
      WHERE item = 'DiscountedUsage' AND ({owned}) IS NOT TRUE
      UNION ALL
      SELECT {shown}, 1 FROM hourly WHERE item = 'VDiscountedUsage' AND {owned}"""


def q_high_water_mark(spark, sf_dir):
    requested = payers(spark, sf_dir).selectExpr("payer_account_id AS payer_id")
    return high_water_marks(facts(spark, sf_dir), requested)


def o_high_water_mark() -> str:
    inner = oracle.select(
        "facts", {"payer": "bill_payeraccountid", "hour": "lineitem_usagestartdate"}
    )
    return f"""SELECT p.payer_id, max(hour) AS mark
      FROM (SELECT CAST({shapes.PAYER_BASE} + n_nationkey AS VARCHAR) AS payer_id FROM nation
        WHERE n_nationkey <> {shapes.UNNAMED_NATION}) p
      LEFT JOIN ({inner}) f ON f.payer = p.payer_id GROUP BY p.payer_id"""


# --- payers, files, summary -----------------------------------------------------------------


def exports(spark, sf_dir):
    """Payer configurations out of customers: requested, refresh table, fallback."""
    customer = table(spark, sf_dir, "customer")
    payer_id = text_id(shapes.ACCOUNT_BASE, "c_custkey")
    location = """concat(
        CASE WHEN c_custkey % 2 = 0 THEN 's3://' ELSE '' END,
        CASE WHEN c_custkey % 5 = 0 THEN ' bill-nonprod-' ELSE 'bill-' END, c_custkey,
        CASE WHEN c_custkey % 7 <> 0 THEN concat('/exports/', lower(c_mktsegment), '/ ') ELSE '' END)"""
    config = customer.selectExpr(
        f"{shapes.ACCOUNT_BASE}L + c_custkey AS payer_account_id", "c_name AS payer_name",
        f"{location} AS payer_bucket_path", "c_acctbal >= 2000 AS enable_refresh_payer",
    )
    fallback = customer.where("c_nationkey >= 8").selectExpr(
        f"{payer_id} AS payer_id", "lower(c_name) AS name",
        "concat('local-nonprod-', c_custkey) AS bucket", "'exports' AS path",
        "'LOCAL' AS access_type",
    )
    return customer.selectExpr(f"{payer_id} AS payer_id"), config, fallback


CONFIG_SQL = f"""
    wanted AS (SELECT *, CAST({shapes.ACCOUNT_BASE} + c_custkey AS VARCHAR) AS payer_id,
      (CASE WHEN c_custkey % 2 = 0 THEN 's3://' ELSE '' END)
        || (CASE WHEN c_custkey % 5 = 0 THEN ' bill-nonprod-' ELSE 'bill-' END) || c_custkey
        || (CASE WHEN c_custkey % 7 <> 0 THEN '/exports/' || lower(c_mktsegment) || '/ ' ELSE '' END) AS loc
      FROM customer),
    split AS (SELECT *, CASE WHEN starts_with(loc, 's3://') THEN substr(loc, 6) ELSE loc END AS bare
      FROM wanted),
    resolved AS (
      SELECT payer_id, CASE WHEN c_acctbal >= 2000 THEN 'primary' WHEN c_nationkey >= 8 THEN 'fallback'
          ELSE 'missing' END AS source,
        CASE WHEN c_acctbal >= 2000 THEN c_name WHEN c_nationkey >= 8 THEN lower(c_name) END AS name,
        replace(CASE WHEN c_acctbal >= 2000 THEN trim(split_part(bare, '/', 1))
             WHEN c_nationkey >= 8 THEN 'local-nonprod-' || c_custkey END, '-nonprod', '') AS bucket,
        CASE WHEN c_acctbal >= 2000 THEN
               CASE WHEN strpos(bare, '/') > 0 THEN trim(substr(bare, strpos(bare, '/') + 1)) ELSE '' END
             WHEN c_nationkey >= 8 THEN 'exports' END AS path,
        CASE WHEN c_acctbal >= 2000 THEN 'CROSS_ACCOUNT' WHEN c_nationkey >= 8 THEN 'LOCAL' END
          AS access_type
      FROM split)"""


def q_payer_config(spark, sf_dir):
    return resolve_configs(*exports(spark, sf_dir), "prod")


O_PAYER_CONFIG = f"WITH {CONFIG_SQL} SELECT * FROM resolved"


def listing(spark, sf_dir):
    """A file listing out of orders: one file per order, newest marks out of urgent orders."""
    files = table(spark, sf_dir, "orders").selectExpr(
        f"{text_id(shapes.ACCOUNT_BASE, 'o_custkey')} AS payer_id",
        "concat('data/', o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '/' ELSE '.parquet' END) AS key",
        "o_orderdate AS last_modified",
        "o_orderpriority IN ('1-URGENT', '2-HIGH') AS urgent",
    )
    return files.drop("urgent"), file_marks(files.where("urgent"))


LISTING_SQL = f"""
    files AS (SELECT CAST({shapes.ACCOUNT_BASE} + o_custkey AS VARCHAR) AS payer_id,
        'data/' || o_orderkey || CASE WHEN o_orderstatus = 'P' THEN '/' ELSE '.parquet' END AS key,
        o_orderdate AS last_modified, o_orderpriority AS priority FROM orders),
    marks AS (SELECT payer_id, max(last_modified) AS mark FROM files
              WHERE priority IN ('1-URGENT', '2-HIGH') GROUP BY payer_id),
    fresh AS (SELECT f.payer_id, f.key, f.last_modified FROM files f
              LEFT JOIN marks m ON m.payer_id = f.payer_id
              WHERE f.key NOT LIKE '%/' AND (mark IS NULL OR last_modified > mark))"""


def q_changed_files(spark, sf_dir):
    return changed_files(*listing(spark, sf_dir))


O_CHANGED_FILES = f"WITH {LISTING_SQL} SELECT * FROM fresh"


def status(spark, sf_dir):
    resolved = resolve_configs(*exports(spark, sf_dir), "prod")
    return payer_status(resolved, changed_files(*listing(spark, sf_dir)))


STATUS_SQL = f"""{CONFIG_SQL}, {LISTING_SQL},
    per_payer AS (
      SELECT r.payer_id, count(f.key) AS found, any_value(source) = 'missing' AS gone
      FROM resolved r LEFT JOIN fresh f ON f.payer_id = r.payer_id GROUP BY r.payer_id),
    status AS (
      SELECT payer_id, CASE WHEN gone THEN 'FAILED' WHEN found > 0 THEN 'HAS_NEW_FILES'
          ELSE 'UP_TO_DATE' END AS status, CASE WHEN gone THEN 0 ELSE found END AS files
      FROM per_payer)"""

O_PAYER_STATUS = f"WITH {STATUS_SQL} SELECT * FROM status"

O_RUN_SUMMARY = f"""WITH {STATUS_SQL},
    t AS (SELECT count(*) FILTER (WHERE status = 'FAILED') AS f,
            count(*) FILTER (WHERE status = 'HAS_NEW_FILES') AS c,
            CAST(sum(files) AS BIGINT) AS n FROM status)
    SELECT CASE WHEN c = 0 AND f = 0 THEN 'UP_TO_DATE' WHEN c > 0 AND f = 0 THEN 'SUCCESS'
             ELSE 'FAILED' END AS status,
      n AS success, CAST(0 AS BIGINT) AS failed, n AS total, f AS failed_payers, c AS changed_payers
    FROM t"""


def q_run_summary(spark, sf_dir):
    return run_summary(status(spark, sf_dir))


# --- files and jobs -------------------------------------------------------------------------


LINE_TOTALS = {
    "n_lines": "count(1)",
    "amount": f"round(sum(line_item_usage_amount), {DIGITS})",
    "n_arns": "count(reservation_reservation_a_r_n)",
}
PER_PAYER_SQL = f"count(*) AS n_lines, {number('sum(amount)')} AS amount, count(arn) AS n_arns"


def per_payer(lines_: DataFrame) -> DataFrame:
    named = lines_.withColumnRenamed("bill_payer_account_id", "payer_id")
    return named.groupBy("payer_id").agg(*aggregates(LINE_TOTALS))


def q_merged_schema_scan(spark, sf_dir):
    """Two exports with other columns and other name case, read as one table."""
    root = new_folder(spark)
    lines_ = billing(spark, sf_dir)
    kind = F.col("line_item_line_item_type")
    lines_.where(kind == fixed.FEE).write.parquet(f"{root}/part=fees")
    plain = lines_.where(kind != fixed.FEE).drop("product", "line_item_operation")
    plain.toDF(*[c.upper() for c in plain.columns]).write.parquet(f"{root}/part=usage")
    merged = merged_scan(spark, root)
    return merged.groupBy("line_item_line_item_type").agg(
        *aggregates(
            LINE_TOTALS
            | {"n_products": "count(product)", "n_operations": "count(line_item_operation)"}
        )
    )


O_MERGED_SCHEMA_SCAN = f"""WITH {oracle.BILL}
    SELECT item AS line_item_line_item_type, {PER_PAYER_SQL},
      count(*) FILTER (WHERE item = 'RIFee') AS n_products,
      count(operation) FILTER (WHERE item = 'RIFee') AS n_operations
    FROM bill GROUP BY item"""

MIDDLE = "TIMESTAMP '2024-01-16 00:00:00'"
LATE = "line_item_usage_start_date >= TIMESTAMP_NTZ '2024-01-16 00:00:00'"


def write_export(lines_: DataFrame, base: str) -> None:
    lines_.write.mode("append").parquet(billing_period_path(base, YEAR, MONTH))


def q_incremental_files(spark, sf_dir):
    """Files written after the first wave's newest one, found by modification time."""
    base = new_folder(spark)
    lines_ = billing(spark, sf_dir)
    write_export(lines_.where(f"NOT ({LATE})"), base)
    first_wave = file_listing(spark, base).withColumn("payer_id", F.lit("all"))
    # File times are compared in milliseconds; one more keeps the waves apart.
    mark = file_marks(first_wave).first().mark + timedelta(milliseconds=1)
    write_export(lines_.where(LATE), base)
    source = billing_period_path(base, YEAR, MONTH)
    return per_payer(merged_scan(spark, source, **modified_after(mark)))


O_INCREMENTAL_FILES = f"""WITH {oracle.BILL}
    SELECT payer AS payer_id, {PER_PAYER_SQL} FROM bill WHERE s >= {MIDDLE} GROUP BY payer"""


def q_staged_slice(spark, sf_dir):
    """Export, stage, stage again with a payer's month changed: each slice is whole once."""
    base, root = new_folder(spark), new_folder(spark)
    lines_ = billing(spark, sf_dir)
    write_export(lines_.where(f"NOT ({LATE})"), base)
    stage_exports(spark, [(p, base) for p in shapes.PAYER_IDS], root, YEAR, MONTH)
    write_export(lines_.where(LATE), base)
    stage_exports(spark, [(p, base) for p in OWNED_PAYERS], root, YEAR, MONTH)
    return per_payer(month_table(spark, root, YEAR, MONTH, shapes.PAYER_IDS))


O_STAGED_SLICE = f"""WITH {oracle.LISTED}
    SELECT payer AS payer_id, {PER_PAYER_SQL} FROM bill
    WHERE s < {MIDDLE} OR payer IN {oracle.in_list(OWNED_PAYERS)} GROUP BY payer"""


def q_monthly_job(spark, sf_dir):
    """Staged lines to stored facts."""
    root, path = new_folder(spark), new_folder(spark)
    stage_lines(billing(spark, sf_dir), root, YEAR, MONTH, shapes.PAYER_IDS)
    run_month(
        spark, root, path, payers(spark, sf_dir), accounts(spark, sf_dir), YEAR, MONTH,
        shapes.PAYER_IDS,
    )
    return presented(read_facts(spark, path))


def q_run_counts(spark, sf_dir):
    """What a run counts while it writes, of payers with staged lines."""
    root = new_folder(spark)
    stage_lines(billing(spark, sf_dir), f"{root}/staged", YEAR, MONTH, shapes.PAYER_IDS)
    counts = run_month(
        spark, f"{root}/staged", f"{root}/facts", payers(spark, sf_dir), accounts(spark, sf_dir), YEAR, MONTH,
        shapes.PAYER_IDS,
    )
    return spark.createDataFrame([tuple(counts.values())], [*counts])


def o_run_counts() -> str:
    parts = [oracle.LISTED, oracle.GRID] + [text for key in oracle.SERVICES for text in oracle.steps(key, "facts")]

    def union(body: str) -> str:
        return " UNION ALL ".join(body.format(key=key) for key in oracle.SERVICES)

    scope = f"item IN ('RIFee', 'DiscountedUsage', 'VDiscountedUsage') AND {oracle.IN_MONTH} AND arn <> ''"
    fees = f"(SELECT payer, arn, offering, s, e + INTERVAL 1 SECOND AS e FROM bill WHERE {scope} AND item = 'RIFee')"
    known = union("SELECT d.payer, d.arn FROM {key}_dim d JOIN {key}_cutoff c ON c.payer = d.payer")
    return f"""WITH {','.join(parts)},
      known AS (SELECT DISTINCT payer, arn FROM ({known}) JOIN account_list ON account_id = split_part(arn, ':', 5)),
      sums AS (SELECT DISTINCT payer, arn, offering, h FROM {oracle.billed(fees)}
        UNION SELECT DISTINCT payer, arn, offering, date_trunc('hour', s) FROM bill WHERE {scope} AND item <> 'RIFee'),
      late AS ({union("SELECT h.h > c.max_date AS late FROM {key}_hours h JOIN {key}_cutoff c ON c.payer = h.payer")}),
      facts AS ({union("SELECT 1 AS one FROM {key}_facts")})
      SELECT (SELECT count(*) FROM bill WHERE item IN ('RIFee', 'DiscountedUsage', 'VDiscountedUsage')) AS lines_read,
        (SELECT count(*) FROM bill WHERE item = 'RIFee' AND rate IS NOT NULL AND try_cast(rate AS DOUBLE) IS NULL) AS unparsable_rates,
        (SELECT count(*) FROM sums s WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.payer = s.payer AND k.arn = s.arn)) AS unknown_hours,
        (SELECT count(*) FROM late WHERE late) AS hours_after_cutoff, (SELECT count(*) FROM facts) AS fact_rows"""


def stored_facts(spark, sf_dir, path: str, payer_ids) -> None:
    """Facts without units, stored for the payers."""
    rows = facts(spark, sf_dir)
    products = [s.report_name for s in SERVICES]
    replace_slices(
        rows.selectExpr("*", *[f"CAST(NULL AS DOUBLE) AS {u}" for u in UNITS]), path, YEAR, MONTH, payer_ids, products
    )


def q_emptied_slice(spark, sf_dir):
    """All payers stored, then a run of two products that has rows for some of its payers only."""
    path = new_folder(spark)
    stored_facts(spark, sf_dir, path, shapes.PAYER_IDS)
    some = read_facts(spark, path, F.col("bill_payeraccountid").isin(OWNED_PAYERS[:4]))
    replace_slices(some.where("used_nu > 0"), path, YEAR, MONTH, OWNED_PAYERS, OWNED_PRODUCTS)
    left = read_facts(spark, path).groupBy("product_name", "bill_payeraccountid").agg(
        *aggregates({"n_rows": "count(1)", "used_nu": f"round(sum(round(used_nu, {DIGITS})), {DIGITS})"})
    )
    slices = manifest(spark, path, SLICES).select("product_name", "bill_payeraccountid")
    return slices.join(left, ["product_name", "bill_payeraccountid"], "left").selectExpr(
        "product_name", "bill_payeraccountid", "coalesce(n_rows, 0L) AS n_rows", "used_nu"
    )


def o_emptied_slice() -> str:
    inner = oracle.select("facts", FACTS)
    owned = f"""bill_payeraccountid IN {oracle.in_list(OWNED_PAYERS)}
      AND product_name IN {oracle.in_list(OWNED_PRODUCTS)}"""
    kept = f"({owned}) IS NOT TRUE OR (used_nu > 0 AND bill_payeraccountid IN {oracle.in_list(OWNED_PAYERS[:4])})"
    return f"""SELECT product_name, bill_payeraccountid, count(*) FILTER (WHERE {kept}) AS n_rows,
      round(sum(used_nu) FILTER (WHERE {kept}), {DIGITS}) AS used_nu FROM ({inner}) GROUP BY ALL"""


def q_stored_units(spark, sf_dir):
    """Units set on the stored month, twice: the second time their own output is read."""
    path = new_folder(spark)
    stored_facts(spark, sf_dir, path, shapes.PAYER_IDS)
    for _ in range(2):
        update_stored_units(spark, path, YEAR, MONTH)
    return presented(read_facts(spark, path))


# Export buckets by nation key: a and b hold files, c has no folder, d an empty one, e none at all.
BUCKETS = {"a": range(0, 12), "b": range(12, 20), "c": range(20, 22), "d": range(22, 24), "e": range(24, 25)}
IN_A, IN_B = ([shapes.PAYER_IDS[i] for i in BUCKETS[b]] for b in "ab")


def requested_payers(spark, sf_dir, names: str = "abcd"):
    """(requested, refresh table, fallback) of the buckets' payers; payers of bucket e have no configuration."""
    bucket = "CASE " + " ".join(f"WHEN n_nationkey < {r.stop} THEN '{b}'" for b, r in BUCKETS.items()) + " END"
    nation = table(spark, sf_dir, "nation").selectExpr("*", f"{bucket} AS b").where(F.col("b").isin([*names, "e"]))
    config = nation.where("b IN ('a', 'c', 'd')").selectExpr(
        f"{shapes.PAYER_BASE}L + n_nationkey AS payer_account_id", "n_name AS payer_name",
        "concat('s3://bill-nonprod-', b, '/exports') AS payer_bucket_path", "true AS enable_refresh_payer",
    )
    fallback = nation.where("b = 'b'").selectExpr(
        f"{text_id(shapes.PAYER_BASE, 'n_nationkey')} AS payer_id", "n_name AS name", "'bill-b' AS bucket",
        "'exports' AS path", "'LOCAL' AS access_type",
    )
    return nation.selectExpr(f"{text_id(shapes.PAYER_BASE, 'n_nationkey')} AS payer_id"), config, fallback


def remove_files(spark, folder: str) -> None:
    """Leave the folder empty."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    system.delete(hadoop_path, True)
    system.mkdirs(hadoop_path)


#: Bytes of a row group in export files: one file of many lines is still read and staged by many tasks.
EXPORT_BLOCK = 8 << 20


def exported_lines(spark, sf_dir):
    """The billing lines, computed once for all exports that a query writes."""
    return through_shared_table(billing(spark, sf_dir), f"checks/{uuid.uuid4().hex}/lines")


def export_lines(lines_: DataFrame, folder: str, one_file: bool = False) -> None:
    """Add the lines to a folder. A single file is written by one task, which computes nothing else."""
    spread = lines_.repartition(1) if one_file else lines_
    spread.write.mode("append").option("parquet.block.size", EXPORT_BLOCK).parquet(folder)


def refreshed(spark, sf_dir, one_file: bool):
    """Three runs. Before the second, bucket a gets late lines and b loses its files; before the
    third, b gets others. Facts path and outcomes of each run. An export is one file, if asked for."""
    root = new_folder(spark)
    places = Places(f"{root}/staged", f"{root}/facts", f"{root}/ledger", payers(spark, sf_dir), accounts(spark, sf_dir))
    lines_ = exported_lines(spark, sf_dir)
    resolved = resolve_configs(*requested_payers(spark, sf_dir), "prod")
    folder = {b: billing_period_path(f"{root}/bill-{b}/exports", YEAR, MONTH) for b in "abcd"}

    def export(payer_ids, late: bool, bucket: str) -> None:
        chosen = lines_.where(F.col("bill_payer_account_id").isin(payer_ids)).where(LATE if late else f"NOT ({LATE})")
        export_lines(chosen, folder[bucket], one_file)

    def run():
        return refresh_run(spark, resolved, f"concat('{root}/', bucket, '/', path)", places, YEAR, MONTH)

    export(IN_A, False, "a")
    export(IN_B, False, "b")
    remove_files(spark, folder["d"])
    outcomes = [run()]
    export(IN_A, True, "a")
    remove_files(spark, folder["b"])
    outcomes.append(run())
    export(IN_B, True, "b")
    outcomes.append(run())
    return places.fact_path, outcomes


def q_refresh_run(spark, sf_dir):
    return presented(read_facts(spark, refreshed(spark, sf_dir, False)[0]))


REFRESHED = f"payer IN {oracle.in_list(IN_A)} OR (payer IN {oracle.in_list(IN_B)} AND s >= {MIDDLE})"


def q_refresh_outcomes(spark, sf_dir):
    """Every payer and the summary (payer 'all') of each run."""
    rows = None
    for number, outcomes in enumerate(refreshed(spark, sf_dir, True)[1], 1):
        payers_ = outcomes.select("payer_id", "source", "status", "success", "failed", "reason")
        total = summary_of(outcomes).selectExpr(
            "'all' AS payer_id", "concat(failed_payers, ' failed') AS source", "status", "success", "failed",
            "concat(changed_payers, ' changed') AS reason",
        )
        both = payers_.unionByName(total).selectExpr(f"{number}L AS run", "*")
        rows = both if rows is None else rows.unionByName(both)
    return rows


def o_refresh_outcomes() -> str:
    def state(bucket: str, run: int) -> str:
        known = {
            ("a", 1): (1, 0), ("b", 1): (1, 0), ("a", 2): (1, 0), ("b", 2): (0, 1), ("a", 3): (1, 0), ("b", 3): (2, 0),
        }
        success, failed = known.get((bucket, run), (0, 0))
        source = {"b": "fallback", "e": "missing"}.get(bucket, "primary")
        status = "FAILED" if bucket == "e" else "HAS_NEW_FILES" if success + failed else "UP_TO_DATE"
        reason = "'no configuration'" if bucket == "e" else "'no file of the month is left'" if failed else "NULL"
        keys = BUCKETS[bucket]
        return f"""SELECT {run} AS run, CAST({shapes.PAYER_BASE} + n_nationkey AS VARCHAR) AS payer_id, '{source}' AS source,
          '{status}' AS status, {success} AS success, {failed} AS failed, {reason} AS reason
          FROM nation WHERE n_nationkey BETWEEN {keys.start} AND {keys.stop - 1}"""

    rows = " UNION ALL ".join(state(b, run) for run in (1, 2, 3) for b in BUCKETS)
    return f"""WITH p AS ({rows}),
      t AS (SELECT run, count(*) FILTER (WHERE status = 'FAILED') AS f, sum(success) AS s, sum(failed) AS x,
        count(*) FILTER (WHERE status = 'HAS_NEW_FILES') AS c FROM p GROUP BY run)
      SELECT CAST(run AS BIGINT) AS run, payer_id, source, status, CAST(success AS BIGINT) AS success,
        CAST(failed AS BIGINT) AS failed, reason FROM p
      UNION ALL
      SELECT run, 'all', f || ' failed', CASE WHEN f + x > 0 THEN 'FAILED' WHEN c > 0 THEN 'SUCCESS' ELSE 'UP_TO_DATE' END,
        CAST(s AS BIGINT), CAST(x AS BIGINT), c || ' changed' FROM t"""


def q_file_diff(spark, sf_dir):
    """Two listings out of orders: files overwritten within the clock's resolution, later, unchanged, gone and new."""
    files = table(spark, sf_dir, "orders").selectExpr(
        f"{text_id(shapes.ACCOUNT_BASE, 'o_custkey')} AS payer_id",
        "concat('data/', o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '/' ELSE '.parquet' END) AS key",
        "o_orderkey AS size", "o_orderdate AS last_modified", "o_orderkey % 7 AS kind",
    )
    after = files.where("kind <> 1").selectExpr(
        "payer_id", "key", "CASE WHEN kind = 2 THEN size + 1 ELSE size END AS size",
        "CASE WHEN kind = 3 THEN last_modified + INTERVAL 1 SECOND ELSE last_modified END AS last_modified",
    )
    return file_diff(files.where("kind <> 4").drop("kind"), after)


O_FILE_DIFF = f"""SELECT CAST({shapes.ACCOUNT_BASE} + o_custkey AS VARCHAR) AS payer_id,
    'data/' || o_orderkey || '.parquet' AS key,
    ['removed', 'changed', 'changed', 'added'][CAST(o_orderkey % 7 AS INTEGER)] AS change
    FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 7 BETWEEN 1 AND 4"""


def q_late_files(spark, sf_dir):
    """Two months run for the first time; then late January files of bucket a reopen January alone.

    February's export holds January's lines moved by a month.
    """
    root = new_folder(spark)
    places = Places(f"{root}/staged", f"{root}/facts", f"{root}/ledger", payers(spark, sf_dir), accounts(spark, sf_dir))
    resolved = resolve_configs(*requested_payers(spark, sf_dir, "ab"), "prod")
    location = f"concat('{root}/', bucket, '/', path)"
    lines_ = exported_lines(spark, sf_dir)
    moved = lines_.withColumns({
        c: F.expr(f"{c} + INTERVAL '31' DAY") for c in ("line_item_usage_start_date", "line_item_usage_end_date")
    })
    early = lines_.where(f"NOT ({LATE})")
    for bucket, ids in (("a", IN_A), ("b", IN_B)):
        mine = F.col("bill_payer_account_id").isin(ids)
        export_lines(early.where(mine), billing_period_path(f"{root}/bill-{bucket}/exports", YEAR, MONTH))
        export_lines(moved.where(mine), billing_period_path(f"{root}/bill-{bucket}/exports", YEAR, MONTH + 1))
    for month in (MONTH, MONTH + 1):
        refresh_run(spark, resolved, location, places, YEAR, month)
    february = F.col("mycloud_startmonth") == MONTH + 1
    before = read_facts(spark, places.fact_path, february).inputFiles()
    late = lines_.where(F.col("bill_payer_account_id").isin(IN_A)).where(LATE)
    export_lines(late, billing_period_path(f"{root}/bill-a/exports", YEAR, MONTH))
    runs = refresh_reopened(spark, resolved, location, places)
    after = read_facts(spark, places.fact_path, february).inputFiles()
    stays = "true" if [r[:2] for r in runs] == [(YEAR, MONTH)] and sorted(before) == sorted(after) else "false"
    january = presented(read_facts(spark, places.fact_path, F.col("mycloud_startmonth") == MONTH))
    return january.selectExpr("*", f"{stays} AS february_stays")


LATE_FILES = f"payer IN {oracle.in_list(IN_A)} OR (payer IN {oracle.in_list(IN_B)} AND s < {MIDDLE})"


def q_unreadable_primary(spark, sf_dir):
    """Active configurations whose bucket gives no access."""
    requested, config, fallback = exports(spark, sf_dir)
    shut = table(spark, sf_dir, "customer").where("c_custkey % 3 = 0").selectExpr("concat('bill-', c_custkey) AS bucket")
    return resolve_configs(requested, config, fallback, "prod", shut)


O_UNREADABLE_PRIMARY = "WITH " + CONFIG_SQL.replace("FROM customer)", "FROM (SELECT * REPLACE (CASE WHEN c_custkey % 3 = 0 THEN -1 ELSE c_acctbal END AS c_acctbal) FROM customer))", 1) + " SELECT * FROM resolved"


def q_streaming_intake(spark, sf_dir):
    """Two waves of export files, each followed once; touched slices are restaged whole."""
    base, root, checkpoint = new_folder(spark), new_folder(spark), new_folder(spark)
    lines_ = billing(spark, sf_dir)
    for wave in (lines_.where(f"NOT ({LATE})"), lines_.where(LATE)):
        write_export(wave, base)
        source = billing_period_path(base, YEAR, MONTH)
        stream = export_stream(spark, source, lines_.schema)

        def restage(year: int, month: int, payer_ids) -> None:
            stage_exports(spark, [(p, base) for p in payer_ids], root, year, month)

        follow_exports(stream, checkpoint, restage).awaitTermination()
    return per_payer(month_table(spark, root, YEAR, MONTH))


def q_streaming_facts(spark, sf_dir):
    """The same waves followed to the stored facts; files outside any billing period change nothing."""
    root = new_folder(spark)
    places = Places(f"{root}/staged", f"{root}/facts", f"{root}/ledger", payers(spark, sf_dir), accounts(spark, sf_dir))
    lines_ = billing(spark, sf_dir)
    lines_.limit(100).write.parquet(f"{root}/export/data/elsewhere")
    for wave in (lines_.where(f"NOT ({LATE})"), lines_.where(LATE)):
        write_export(wave, f"{root}/export")
        stream = export_stream(spark, f"{root}/export", lines_.schema)
        follow_to_facts(
            stream, f"{root}/checkpoint", f"{root}/batches", lambda ids: [(p, f"{root}/export") for p in ids], places,
        ).awaitTermination()
    return presented(read_facts(spark, places.fact_path))


O_STREAMING_INTAKE = f"""WITH {oracle.BILL}
    SELECT payer AS payer_id, {PER_PAYER_SQL} FROM bill GROUP BY payer"""


# --- registry ---------------------------------------------------------------------------------


def registry() -> dict[str, tuple]:
    """name -> (query, SQL twin)."""
    entries = {
        "wastage_all": (q_wastage_all, oracle.select("facts", FACTS)),
        "wastage_units": (q_wastage_units, oracle.select("facts", FACTS | UNITS)),
        "hourly_utilization": (q_hourly_utilization, oracle.select("hours", UTILIZATION)),
        "payer_max_date": (q_payer_max_date, o_payer_max_date()),
        "map_pivot_product": (q_map_pivot_product, o_map_pivot_product()),
        "map_explode_product": (q_map_explode_product, o_map_explode_product()),
        "reservation_dim": (q_reservation_dim, oracle.select("dim", DIMENSION)),
        "size_factor": (q_size_factor, o_factor(oracle.size_sql)),
        "size_factor_multi_az": (q_size_factor_multi_az, o_factor(oracle.zoned_size_sql)),
        "os_label": (q_label(OS_CODES, rules.os_label), o_label(OS_CODES, oracle.os_sql)),
        "engine_label": (
            q_label(ENGINE_CODES, rules.engine_label), o_label(ENGINE_CODES, oracle.engine_sql),
        ),
        "cache_engine_label": (
            q_label(CACHE_CODES, rules.cache_engine_label), o_label(CACHE_CODES, oracle.cache_sql),
        ),
        "family_label": (q_family_label, o_family_label()),
        "region_label": (q_region_label, o_region_label()),
        "hour_grid": (q_hour_grid, O_HOUR_GRID),
        "interval_to_hours": (q_interval_to_hours, O_INTERVAL_TO_HOURS),
        "clipped_overlap_hours": (q_clipped_overlap_hours, O_CLIPPED_OVERLAP_HOURS),
        "point_to_hour": (q_point_to_hour, O_POINT_TO_HOUR),
        "replace_slice": (q_replace_slice, o_replace_slice()),
        "high_water_mark": (q_high_water_mark, o_high_water_mark()),
        "payer_config": (q_payer_config, O_PAYER_CONFIG),
        "changed_files": (q_changed_files, O_CHANGED_FILES),
        "payer_status": (status, O_PAYER_STATUS),
        "run_summary": (q_run_summary, O_RUN_SUMMARY),
        "merged_schema_scan": (q_merged_schema_scan, O_MERGED_SCHEMA_SCAN),
        "incremental_files": (q_incremental_files, O_INCREMENTAL_FILES),
        "staged_slice": (q_staged_slice, O_STAGED_SLICE),
        "monthly_job": (q_monthly_job, oracle.select("facts", FACTS | UNITS)),
        "streaming_facts": (q_streaming_facts, oracle.select("facts", FACTS | UNITS, source=(oracle.BILL,))),
        "run_counts": (q_run_counts, o_run_counts()),
        "refresh_run": (q_refresh_run, oracle.select("facts", FACTS | UNITS, source=(oracle.only_lines(REFRESHED),))),
        "refresh_outcomes": (q_refresh_outcomes, o_refresh_outcomes()),
        "file_diff": (q_file_diff, O_FILE_DIFF),
        "late_files": (
            q_late_files, oracle.select("facts", FACTS | UNITS | {"february_stays": "true"}, source=(oracle.only_lines(LATE_FILES),)),
        ),
        "unreadable_primary": (q_unreadable_primary, O_UNREADABLE_PRIMARY),
        "emptied_slice": (q_emptied_slice, o_emptied_slice()),
        "stored_units": (q_stored_units, oracle.select("facts", FACTS | UNITS)),
        "streaming_intake": (q_streaming_intake, O_STREAMING_INTAKE),
    }
    for service in SERVICES:
        key = service.key
        entries[f"wastage_{key}"] = (q_wastage(service), oracle.select("facts", FACTS, (key,)))
        entries[f"line_item_report_{key}"] = (
            q_report(key), oracle.select("report", REPORT, (key,)),
        )
    return entries
