"""Compare registered queries with their SQL twins: python -m checks.run [sf_dir] [names...]"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

from checks.queries import registry
from idlewatch.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normalized(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        if str(frame[name].dtype).startswith("datetime"):
            frame[name] = frame[name].astype("datetime64[us]").astype(str)
        elif frame[name].dtype == object:
            frame[name] = frame[name].map(lambda v: None if v is None or v != v else str(v))
        else:
            frame[name] = frame[name].astype("float64")
    return frame.sort_values(list(frame.columns), na_position="first").reset_index(drop=True)


def differences(got: pd.DataFrame, want: pd.DataFrame) -> list[str]:
    if sorted(got.columns) != sorted(want.columns):
        return [f"columns {sorted(set(got.columns) ^ set(want.columns))}"]
    if len(got) != len(want):
        return [f"rows {len(got)} != {len(want)}"]
    got, want = normalized(got), normalized(want)
    bad = []
    for name in got.columns:
        same = (got[name] == want[name]) | (got[name].isna() & want[name].isna())
        if not same.all():
            i = int((~same).idxmax())
            bad.append(f"{name}: {int((~same).sum())} rows, e.g. {got[name][i]!r} != {want[name][i]!r}")
    return bad


def main(sf_dir: str, names: list[str]) -> int:
    spark, con = local_session(), connect(sf_dir)
    failed = 0
    for name, (query, sql) in registry().items():
        if names and name not in names:
            continue
        began = time.time()
        got = query(spark, sf_dir).toPandas()
        took = time.time() - began
        began = time.time()
        bad = differences(got, con.execute(sql).df()) if sql else ["no SQL twin"]
        failed += bool(bad)
        print(f"{'BAD ' if bad else 'ok  '}{name:28} {len(got):8} rows {took:6.2f}s spark "
              f"{time.time() - began:6.2f}s sql  {'; '.join(bad)}", flush=True)
    return failed


if __name__ == "__main__":
    directory = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(main(directory, sys.argv[2:]))
