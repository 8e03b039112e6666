"""Hour arithmetic on timestamps without time zone, as SQL expressions.

Everything works on ``timestamp_ntz`` through interval arithmetic, so results do not
depend on the session time zone (``date_trunc`` and ``timestampdiff`` do: both go
through the zoned type).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

HOUR = "INTERVAL '1' HOUR"
SECOND = "INTERVAL '1' SECOND"
TWO_SECONDS = "INTERVAL '2' SECOND"
LAST_OF_SECOND = "INTERVAL '0.999999' SECOND"
START = "TIMESTAMP_NTZ '0001-01-01 00:00:00'"


def check_month(year: int, month: int) -> None:
    if not 2020 <= year <= 2035:
        raise ValueError(f"year {year} is outside 2020-2035")
    if not 1 <= month <= 12:
        raise ValueError(f"month {month} is outside 1-12")


def month_bounds(year: int, month: int) -> tuple[str, str]:
    """First instant of the month and of the next month, as literals."""
    check_month(year, month)
    following = (year + 1, 1) if month == 12 else (year, month + 1)
    first, after = (
        f"TIMESTAMP_NTZ '{y:04d}-{m:02d}-01 00:00:00'" for y, m in ((year, month), following)
    )
    return first, after


def in_month(ts: str, year: int, month: int) -> str:
    """Half-open range instead of EXTRACT, so that it reaches the Parquet scan."""
    first, after = month_bounds(year, month)
    return f"({ts} >= {first} AND {ts} < {after})"


def first_of_month(ts: str) -> str:
    return f"make_timestamp_ntz(year({ts}), month({ts}), 1, 0, 0, 0)"


def first_of_next_month(ts: str) -> str:
    return f"({first_of_month(ts)} + INTERVAL '1' MONTH)"


def _since_start(ts: str) -> str:
    """Whole hours since a fixed midnight before all data; names ``ts`` only once."""
    return f"CAST({ts} - {START} AS INTERVAL DAY TO HOUR)"


def hour_floor(ts: str) -> str:
    return f"({START} + {_since_start(ts)})"


def hour_end(hour: str) -> str:
    """Last whole second of the hour that starts at ``hour``."""
    return f"({hour} + {HOUR} - {SECOND})"


def hours_crossed(earlier: str, later: str) -> str:
    """Number of hour boundaries between two timestamps (not elapsed whole hours)."""
    crossed = f"{_since_start(later)} - {_since_start(earlier)}"
    return f"CAST(CAST({crossed} AS INTERVAL HOUR) AS BIGINT)"


def days_crossed(earlier: str, later: str) -> str:
    return f"datediff({later}, {earlier})"


def strict_greatest(a: str, b: str) -> str:
    """NULL if either side is NULL (the built-in skips NULLs)."""
    return f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN greatest({a}, {b}) END"


def strict_least(a: str, b: str) -> str:
    return f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN least({a}, {b}) END"


def hours_between(first: str, after: str) -> str:
    """All whole hours of [first, after) as one array."""
    return f"sequence({first}, {after} - {HOUR}, {HOUR})"


def hour_grid(spark: SparkSession, year: int, month: int) -> DataFrame:
    hours = hours_between(*month_bounds(year, month))
    grid = spark.range(1).selectExpr(f"explode({hours}) AS startdate")
    return grid.selectExpr("startdate", f"{hour_end('startdate')} AS enddate")


def first_hour(start: str) -> str:
    """First hour a start can belong to.

    An hour ends at its last whole second, so a start within the final fraction of a
    second belongs to no hour and the next hour is the first one it can touch.
    """
    return hour_floor(f"({start} + {LAST_OF_SECOND})")


def starts_in_an_hour(start: str) -> str:
    return f"({first_hour(start)} = {hour_floor(start)})"


def covered_hours(start: str, end: str, year: int, month: int) -> str:
    """Hours of the month that the interval [start, end] is billed for (NULL if none).

    This is the closed form of "interval overlaps the hour, and the hour is not the one
    in which the interval ends": linear in the output, where the same predicate against
    an hour grid is a nested-loop join. A reversed interval touches only the hour its
    start lies in.
    """
    first, after = month_bounds(year, month)
    low = f"greatest({first_hour(start)}, {first})"
    high = f"(least({hour_floor(end)}, {after}) - {HOUR})"
    return f"""CASE
      WHEN {start} <= {end} AND {low} <= {high} THEN sequence({low}, {high}, {HOUR})
      WHEN {start} > {end} AND {hour_floor(end)} <> {hour_floor(start)}
        AND {starts_in_an_hour(start)} AND {in_month(start, year, month)}
        THEN array({hour_floor(start)})
    END"""


def overlap_hours(start: str, end: str, hour: str) -> str:
    """Billed hours of the interval clipped to one hour."""
    clipped_end = f"({strict_least(end, hour_end(hour))} + {TWO_SECONDS})"
    return hours_crossed(f"({strict_greatest(start, hour)})", clipped_end)


def hours_per_match(start: str, end: str) -> str:
    """``overlap_hours`` for any hour out of ``covered_hours``, without that hour.

    Inside a proper interval every covered hour counts as exactly one.
    """
    return (
        f"CASE WHEN {start} <= {end} THEN 1L"
        f" ELSE {hours_crossed(start, f'({end} + {TWO_SECONDS})')} END"
    )
