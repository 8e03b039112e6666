"""Merged scans, listings, staging, payer configuration, run summary."""

import glob
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from checks import shapes
from checks.billing import billing
from idlewatch.functions.text import base_name, bucket_of, environment_bucket, path_of
from idlewatch.operators.lines import for_payers, product_entries, product_value
from idlewatch.operators.payers import resolve_configs
from idlewatch.sinks.staging import stage_exports, stage_lines
from idlewatch.sinks.summary import payer_status, run_summary
from idlewatch.sources.billing import billing_period_path, merged_scan, month_table
from idlewatch.sources.discovery import changed_files, file_listing, file_marks


def test_locations(spark):
    rows = [("s3://b/p/q",), ("b/p",), ("s3://b",), ("b",), (" s3://b /  p ",), ("s3:// b /\tp\n",), (None,)]
    df = spark.createDataFrame(rows, "v string")
    got = [tuple(r) for r in df.selectExpr(f"{bucket_of('v')} AS b", f"{path_of('v')} AS p").collect()]
    assert got == [
        ("b", "p/q"), ("b", "p"), ("b", ""), ("b", ""), ("s3:", "/b /  p"), ("b", "p"), (None, None),
    ]
    named = spark.createDataFrame([("a/b/c.parquet",), ("c",)], "v string").selectExpr(f"{base_name('v')} AS n")
    assert [r.n for r in named.collect()] == ["c.parquet", "c"]


def test_environment_bucket(spark):
    df = spark.createDataFrame([("x-nonprod-y",), ("plain",)], "v string")
    for environment, expected in (("PROD", ["x-y", "plain"]), ("uat", ["x-nonprod-y", "plain"])):
        assert [r.b for r in df.selectExpr(f"{environment_bucket('v', environment)} AS b").collect()] == expected


@pytest.mark.parametrize("base", ["s3://b/p", "s3://b/p/", "s3://b/p/data", "s3://b/p/data/"])
def test_billing_period_path(base):
    assert billing_period_path(base, 2024, 3) == "s3://b/p/data/BILLING_PERIOD=2024-03"


def test_merged_scan_unites_columns_of_any_case(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "Id int, Extra string").write.parquet(str(tmp_path / "x"))
    spark.createDataFrame([(2, 5.0)], "ID int, Cost double").write.parquet(str(tmp_path / "y"))
    merged = merged_scan(spark, str(tmp_path / "x"), str(tmp_path / "y"))
    assert set(merged.columns) == {"id", "extra", "cost"}
    assert {tuple(r[c] for c in ("id", "extra", "cost")) for r in merged.collect()} == {(1, "a", None), (2, None, 5.0)}


def test_product_maps_and_entry_lists(spark):
    rows = [(1, {"region": "r", "product_name": "p"}), (2, {"product_name": None}), (3, {}), (4, None)]
    maps = spark.createDataFrame(rows, "id int, product map<string,string>")
    lists = maps.selectExpr("id", "map_entries(product) AS product")
    for df in (maps, lists):
        got = {tuple(r) for r in product_entries(df, "id").collect()}
        assert got == {(1, "region", "r"), (1, "product_name", "p"), (2, "product_name", None)}
        values = df.selectExpr("id", f"{product_value(df, 'region')} AS v").collect()
        assert {tuple(r) for r in values} == {(1, "r"), (2, None), (3, None), (4, None)}


def test_listing_since_is_strict(spark, tmp_path):
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "f"))
    files = file_listing(spark, str(tmp_path / "f"))
    (row,) = files.collect()
    assert row.key.endswith(".parquet") and row.size > 0
    mark, before = row.last_modified, spark.conf.get("spark.sql.session.timeZone")
    for zone in ("UTC", "Asia/Tokyo", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        assert file_listing(spark, str(tmp_path / "f"), since=mark - timedelta(seconds=1)).count() == 1
        assert file_listing(spark, str(tmp_path / "f"), since=mark).count() == 0
        assert file_listing(spark, str(tmp_path / "f"), since=mark + timedelta(seconds=1)).count() == 0
    spark.conf.set("spark.sql.session.timeZone", before)
    assert "content" not in files._jdf.queryExecution().executedPlan().toString()


def test_changed_files(spark):
    t = datetime(2024, 1, 1)
    listing = spark.createDataFrame(
        [("a", "k1", t), ("a", "k2", t + timedelta(seconds=1)), ("a", "folder/", t + timedelta(days=1)), ("b", "k3", t)],
        "payer_id string, key string, last_modified timestamp",
    )
    marks = spark.createDataFrame([("a", t), ("c", t)], "payer_id string, mark timestamp")
    assert {r.key for r in changed_files(listing, marks).collect()} == {"k2", "k3"}
    assert {(r.payer_id, r.mark) for r in file_marks(listing).collect()} == {("a", t + timedelta(days=1)), ("b", t)}


def test_payer_filter_short_long_and_empty(spark):
    df = spark.range(2000).selectExpr("CAST(id AS STRING) AS payer")
    assert for_payers(df, [], "payer").count() == 0
    assert for_payers(df, ["5", "5", "x"], "payer").count() == 1
    assert for_payers(df, [str(i) for i in range(900)], "payer").count() == 900


def test_config_resolution(spark):
    config = spark.createDataFrame(
        [(1, "One", "s3://b1-nonprod/p", True), (2, "Two", "b2/p", False), (3, "Three", "b3", True)],
        "payer_account_id bigint, payer_name string, payer_bucket_path string, enable_refresh_payer boolean",
    )
    fallback = spark.createDataFrame(
        [("1", "f1", "fb1", "q", "LOCAL"), ("2", "f2", "fb2-nonprod", None, "LOCAL")],
        "payer_id string, name string, bucket string, path string, access_type string",
    )
    requested = spark.createDataFrame([("1",), ("2",), ("3",), ("4",), ("1",)], "payer_id string")
    got = {tuple(r) for r in resolve_configs(requested, config, fallback, "prod").collect()}
    assert got == {
        ("1", "primary", "One", "b1", "p", "CROSS_ACCOUNT"),
        # Only in the fallback: the whole fallback row, its NULL path included.
        ("2", "fallback", "f2", "fb2", None, "LOCAL"),
        ("3", "primary", "Three", "b3", "", "CROSS_ACCOUNT"),
        ("4", "missing", None, None, None, None),
    }


@pytest.mark.parametrize(
    "sources, files, failed, expected",
    [
        ("pp", "", 0, "UP_TO_DATE"), ("pp", "aab", 0, "SUCCESS"), ("pm", "aa", 0, "FAILED"),
        ("mm", "", 0, "FAILED"), ("pp", "a", 1, "FAILED"),
    ],
)
def test_run_summary(spark, sources, files, failed, expected):
    names = {"p": "primary", "m": "missing"}
    resolved = spark.createDataFrame([(p, names[s]) for p, s in zip("ab", sources)], "payer_id string, source string")
    new = spark.createDataFrame([(f,) for f in files], "payer_id string")
    status = payer_status(resolved, new)
    outcomes = spark.createDataFrame([("a", len(files) - failed, failed)], "payer_id string, success bigint, failed bigint")
    row = run_summary(status, outcomes).first()
    assert (row.status, row.total, row.failed) == (expected, len(files), failed)


def test_staging_replaces_whole_payer_months(spark, sf_dir, tmp_path):
    base, root = str(tmp_path / "export"), str(tmp_path / "staged")
    lines = billing(spark, sf_dir).where(F.col("bill_payer_account_id").isin(shapes.PAYER_IDS))
    lines.write.parquet(billing_period_path(base, 2024, 1))
    pairs = [(p, base) for p in shapes.PAYER_IDS]
    assert stage_exports(spark, [*pairs, ("x", str(tmp_path / "absent"))], root, 2024, 1) == sorted(shapes.PAYER_IDS)
    staged = month_table(spark, root, 2024, 1, shapes.PAYER_IDS)
    assert staged.count() == lines.count()
    payers = sorted(r[0] for r in staged.select("bill_payer_account_id").distinct().collect())

    # Restage: the first payer lost all lines, the second keeps its fees, others are untouched.
    gone, reduced = payers[:2]
    kept = lines.where(f"bill_payer_account_id = '{reduced}' AND line_item_line_item_type = 'RIFee'")
    for _ in range(2):
        stage_lines(kept, root, 2024, 1, [gone, reduced])
        counts = {
            r[0]: r[1]
            for r in month_table(spark, root, 2024, 1).groupBy("bill_payer_account_id").count().collect()
        }
        assert gone not in counts and counts[reduced] == kept.count()
        assert set(counts) == set(payers[1:])


def test_staged_files_are_sorted_by_line_type(spark, sf_dir, tmp_path):
    """What lets a scan for fee lines skip row groups."""
    root = str(tmp_path / "staged")
    stage_lines(billing(spark, sf_dir), root, 2024, 1, shapes.PAYER_IDS)
    files = glob.glob(f"{root}/year=2024/month=1/data/version=*/payer=*/*.parquet")
    assert files
    for file in files:
        types = pq.read_table(file, columns=["line_item_line_item_type"], partitioning=None)[0].to_pylist()
        assert types == sorted(types)


def test_missing_export(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        stage_exports(spark, [("1", str(tmp_path / "none"))], str(tmp_path / "s"), 2024, 1)


def test_an_absent_export_keeps_the_staged_lines(spark, sf_dir, tmp_path):
    base, root = str(tmp_path / "export"), str(tmp_path / "staged")
    lines = billing(spark, sf_dir)
    lines.write.parquet(billing_period_path(base, 2024, 1))
    one, two = sorted(r[0] for r in lines.select("bill_payer_account_id").distinct().collect())[:2]
    stage_exports(spark, [(one, base), (two, base)], root, 2024, 1)
    before = month_table(spark, root, 2024, 1, [one]).count()
    assert before and stage_exports(spark, [(one, str(tmp_path / "gone")), (two, base)], root, 2024, 1) == [two]
    assert month_table(spark, root, 2024, 1, [one]).count() == before


def test_duplicate_configurations_are_refused(spark):
    config = spark.createDataFrame(
        [(1, "One", "s3://b/p", True), (1, "Uno", "s3://c/p", True)],
        "payer_account_id bigint, payer_name string, payer_bucket_path string, enable_refresh_payer boolean",
    )
    empty = spark.createDataFrame([], "payer_id string, name string, bucket string, path string, access_type string")
    with pytest.raises(ValueError, match="'1'"):
        resolve_configs(spark.createDataFrame([("1",)], "payer_id string"), config, empty, "prod")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_money_beyond_whole_numbers(spark, ansi):
    from idlewatch.operators.report import repeated_money

    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        lines = spark.sql("SELECT CAST(60e9BD AS DECIMAL(30,8)) AS cost FROM range(2)").selectExpr("sum(cost) AS cost")
        assert lines.selectExpr(f"CAST({repeated_money('cost', '3L')} AS STRING) AS m").first().m == "360000000000.00000000"
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
