import random
from datetime import datetime, timedelta

import duckdb
import pytest

from checks import oracle
from idlewatch.functions import timeops

NAMES = "a timestamp_ntz, b timestamp_ntz"


def at(text):
    return datetime.fromisoformat(text)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_hours_crossed_in_any_session_zone(spark, zone):
    pairs = [
        (at("2024-01-01 10:59:59"), at("2024-01-01 11:00:01"), 1),
        (at("2024-01-01 10:00:00"), at("2024-01-01 10:59:59"), 0),
        (at("2024-01-01 23:59:59"), at("2024-01-02 00:00:01"), 1),
        (at("2024-03-10 01:30:00"), at("2024-03-10 03:30:00"), 2),
        (at("2024-01-01 11:00:00"), at("2024-01-01 09:59:59"), -2),
        (at("1969-12-31 22:30:00"), at("1970-01-01 01:10:00.5"), 3),
        (None, at("2024-01-01 11:00:00"), None),
    ]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([p[:2] for p in pairs], NAMES)
        got = [r.x for r in df.selectExpr(f"{timeops.hours_crossed('a', 'b')} AS x").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [p[2] for p in pairs]


@pytest.mark.parametrize("year, month, hours", [(2024, 2, 696), (2025, 2, 672), (2024, 4, 720), (2024, 12, 744)])
def test_hour_grid(spark, year, month, hours):
    grid = timeops.hour_grid(spark, year, month).orderBy("startdate").collect()
    assert len(grid) == hours
    assert grid[0].startdate == datetime(year, month, 1)
    assert grid[-1].enddate - grid[-1].startdate == timedelta(minutes=59, seconds=59)


@pytest.mark.parametrize("year, month", [(2019, 1), (2036, 1), (2024, 0), (2024, 13)])
def test_month_range(year, month):
    with pytest.raises(ValueError):
        timeops.month_bounds(year, month)


def test_greatest_and_least_keep_null(spark):
    df = spark.createDataFrame([(at("2024-01-01"), None), (at("2024-01-01"), at("2024-01-02"))], NAMES)
    rows = df.selectExpr(
        f"{timeops.strict_greatest('a', 'b')} AS g", f"{timeops.strict_least('a', 'b')} AS l"
    ).collect()
    assert [tuple(r) for r in rows] == [(None, None), (at("2024-01-02"), at("2024-01-01"))]


def random_intervals(count):
    rng = random.Random(7)
    first = datetime(2024, 1, 1)
    rows = []
    for i in range(count):
        start = first + timedelta(seconds=rng.randrange(-90_000, 32 * 86_400))
        length = rng.choice([0, 1, 59, 3599, 3600, 3601, 7200, -1, -3600, -90_000, rng.randrange(400_000)])
        end = start + timedelta(seconds=length)
        snap = rng.randrange(8)
        if snap < 2:
            start = start.replace(minute=0, second=0)
        if snap in (1, 2):
            end = end.replace(minute=0, second=0)
        if snap == 3:
            end = end.replace(minute=59, second=59)
        if snap == 4:
            start = start.replace(minute=59, second=59, microsecond=rng.choice([0, 1, 500_000]))
        if snap == 5:
            end = end.replace(microsecond=300_000)
        rows.append((i, start, end))
    return rows + [(count, first, None)]


def test_covered_hours_equal_billed_hours(spark):
    """Closed form against the billed hours line by line, all edge kinds."""
    rows = random_intervals(1500)
    df = spark.createDataFrame(rows, "event_id int, s timestamp_ntz, e timestamp_ntz")
    exploded = df.selectExpr("*", f"explode({timeops.covered_hours('s', 'e', 2024, 1)}) AS h")
    got = {
        (r.event_id, r.h, r.o, r.m)
        for r in exploded.selectExpr(
            "event_id", "h", f"{timeops.overlap_hours('s', 'e', 'h')} AS o",
            f"{timeops.hours_per_match('s', 'e')} AS m",
        ).collect()
    }
    con = duckdb.connect()
    con.execute("CREATE TABLE iv (event_id INT, s TIMESTAMP, e TIMESTAMP)")
    con.executemany("INSERT INTO iv VALUES (?, ?, ?)", rows)
    overlap = f"date_diff('hour', greatest(s, h), least(e, h + {oracle.LAST_SECOND}) + INTERVAL 2 SECOND)"
    want = set(
        con.execute(
            f"SELECT event_id, h, {overlap}, billed FROM {oracle.billed('iv')}"
        ).fetchall()
    )
    assert len(want) > 5_000
    assert got == want
