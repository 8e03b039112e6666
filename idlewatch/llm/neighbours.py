"""Exact nearest neighbours: shifted Hilbert orderings bound them, a pass over all rows completes.

Equal vectors become one row that keeps its ids (the k + 1 smallest; no query needs more).
Each ordering projects the vectors to a few dimensions, shifts them and sorts by Hilbert key
(`repartitionByRange`). Ranks cut the order into blocks of `window` rows; a query meets its own
block and both neighbours, in tasks that hold one block, and the windows of all orderings merge
in an exact ranking (double precision, ties to the smaller id).

Vectors that are null, zero, or hold null or non-finite components take no part, nor do those
whose dimension is not the commonest. Repeated ids stand for one vector each. An empty table
gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from idlewatch.llm.common import stored

ORDERINGS, DIMENSIONS, DIGITS, WINDOW = 12, 6, 10, 2000
#: Queries sent to the executors at once, and neighbouring rows that share one bound.
QUERIES, STRETCH = 10_000, 256


def hilbert(points: np.ndarray, digits: int) -> np.ndarray:
    """Hilbert index of points on a grid of 2^digits a side (transposed form, then interleaved)."""
    x = points.astype(np.int64).T.copy()
    n, q = len(x), 1 << (digits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, 0) ^ swap
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip, q = np.zeros_like(x[0]), 1 << (digits - 1)
    while q > 1:
        flip ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for bit in range(digits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | ((x[i] >> bit) & 1)
    return key


def vectors(df: DataFrame, key: str, column: str) -> DataFrame:
    """(id, vec as packed doubles) of the vectors that take part."""
    good = (
        F.col(column).isNotNull() & F.col(key).isNotNull() & ~F.exists(column, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
        & F.exists(column, lambda v: v != 0)
    )
    told = df.select(F.col(key).cast("long").alias("id"), F.col(column).cast("array<double>").alias("v")).where(
        F.coalesce(F.expr("true") & F.col(key).isNotNull(), F.lit(False))
    ).withColumnRenamed("v", column).withColumnRenamed("id", key).where(good)

    def pack(batches):
        for batch in batches:
            data = [np.asarray(v, "<f8").tobytes() for v in batch[column].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch[key], pa.array(data, pa.binary())], names=["id", "vec"])

    return told.select(key, column).mapInArrow(pack, "id long, vec binary")


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """(gid, vec, ids): gid is the smallest id of equal vectors, ids its `keep` smallest."""
    def local(batches):
        for batch in batches:
            df = batch.to_pandas().sort_values("id").drop_duplicates()
            yield pa.RecordBatch.from_pandas(df[df.groupby("vec").cumcount() < keep], preserve_index=False)

    few = rows.mapInArrow(local, "id long, vec binary").distinct()
    place = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    few = few.withColumn("place", place).where(F.col("place") <= keep)
    return few.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids")).select(F.col("ids")[0].alias("gid"), "vec", "ids")


def centre_and_spread(rows: DataFrame, dim: int) -> tuple[np.ndarray, float]:
    """Mean vector and mean deviation of the components, of all rows."""
    def sums(batches):
        n, total, squares = 0, np.zeros(dim), 0.0
        for batch in batches:
            if batch.num_rows:
                x = np.frombuffer(b"".join(batch["vec"].to_pylist()), "<f8").reshape(-1, dim)
                n, total, squares = n + len(x), total + x.sum(axis=0), squares + float((x * x).sum())
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total.tobytes()], pa.binary()), pa.array([squares])], names=["n", "total", "squares"])

    parts = rows.select("vec").mapInArrow(sums, "n long, total binary, squares double").collect()  # one row a task
    n = sum(r["n"] for r in parts)
    if not n:
        return np.zeros(dim), 1.0
    centre = sum(np.frombuffer(r["total"], "<f8") for r in parts) / n
    variance = sum(r["squares"] for r in parts) / (n * dim) - float((centre * centre).mean())
    spread = float(np.sqrt(max(0.0, variance)))
    return (centre, spread) if np.isfinite(centre).all() and np.isfinite(spread) and spread > 0 else (np.zeros(dim), 1.0)


def closest(ids: np.ndarray, dist: np.ndarray, keep: int) -> np.ndarray:
    """The places of the `keep` smallest by distance, then id."""
    if len(ids) <= keep:
        return np.arange(len(ids))
    some = np.flatnonzero(dist <= np.partition(dist, keep - 1)[keep - 1])
    return some[np.lexsort((ids[some], dist[some]))][:keep]


def within_bounds(rows: DataFrame, asked: DataFrame, dim: int, keep: int) -> DataFrame:
    """(gid, near, score): all of `rows` (gid, vec) that can be among the `keep` nearest of a query.

    asked: gid, vec and bound, a distance that `keep` distinct vectors are known not to exceed
    (infinite if fewer are known). One pass over the rows for each QUERIES of them.
    """
    context = rows.sparkSession.sparkContext
    blocks = -(-asked.count() // QUERIES)
    out = rows.select("gid", F.col("gid").alias("near"), F.lit(0.0).alias("score")).limit(0)
    for b in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("gid"), F.lit(blocks)) == b).toPandas()
        if not len(block):
            continue
        sent = context.broadcast((block["gid"].to_numpy(), np.frombuffer(b"".join(block["vec"]), "<f8").reshape(-1, dim), block["bound"].to_numpy(float)))

        def compare(batches, sent=sent):
            gids, queries, bounds = sent.value
            held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            limits = bounds.copy()
            for batch in batches:
                near = batch["gid"].to_numpy()
                x = np.frombuffer(b"".join(batch["vec"].to_pylist()), "<f8").reshape(-1, dim)
                for first in range(0, len(x), STRETCH):
                    some, names = x[first : first + STRETCH], near[first : first + STRETCH]
                    centre = some.mean(axis=0)
                    radius = np.sqrt(((some - centre) ** 2).sum(axis=1)).max()
                    away = np.sqrt(((queries - centre) ** 2).sum(axis=1))
                    # A little slack, so that rounding skips nothing; not (>) keeps what overflows.
                    live = np.flatnonzero(~((away - radius) * (1 - 1e-9) > limits + 1e-9 * (away + radius)))
                    from_q, from_x = queries[live] - centre, some - centre
                    total = (from_q**2).sum(axis=1)[:, None] + (from_x**2).sum(axis=1)
                    far = total * (1 - 1e-9) - 2 * (from_q @ from_x.T) > (limits[live] ** 2)[:, None] * (1 + 1e-9)
                    for i in live[~far.all(axis=1)]:
                        dist = np.sqrt(((some - queries[i]) ** 2).sum(axis=1))
                        on = np.flatnonzero(dist <= limits[i])
                        if not len(on):
                            continue
                        ids, dist = names[on], dist[on]
                        if i in held:
                            ids, dist = np.concatenate([held[i][0], ids]), np.concatenate([held[i][1], dist])
                        best = closest(ids, dist, keep)
                        held[i] = ids[best], dist[best]
                        if len(best) == keep:
                            limits[i] = min(limits[i], dist[best].max())
            if held:
                lens = [len(v[0]) for v in held.values()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(gids[list(held)], lens)), pa.array(np.concatenate([v[0] for v in held.values()])), pa.array(np.concatenate([v[1] for v in held.values()]))],
                    names=["gid", "near", "score"])

        out = out.unionByName(stored(rows.select("gid", "vec").mapInArrow(compare, "gid long, near long, score double"), "vector-completed"))
        sent.unpersist()
    return out


def search(df: DataFrame, queries: DataFrame, key: str = "vec_id", column: str = "embedding", k: int = 10,
           orderings: int = ORDERINGS, dimensions: int = DIMENSIONS, window: int = WINDOW, seed: int = 3) -> DataFrame:
    """query_id, rank, vec_id, score; `queries` holds the ids (column `key`) of rows of `df`."""
    spark = df.sparkSession
    rows = vectors(df, key, column)
    sizes = rows.groupBy(F.length("vec").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").limit(1).collect()
    width = sizes[0]["n"] if sizes else 8
    rows = stored(rows.where(F.length("vec") == width), "vectors")
    groups = stored(distinct_vectors(rows, k + 1), "vector-groups")
    asked = stored(
        rows.join(queries.select(F.col(key).cast("long").alias("id")).distinct(), "id", "left_semi").distinct()
        .join(groups.select("gid", "vec"), "vec").select(F.col("id").alias("query_id"), "gid"), "vector-queries",
    )
    marked = groups.select("gid", "vec").join(asked.select("gid").distinct().withColumn("asks", F.lit(True)), "gid", "left").withColumn("asks", F.coalesce("asks", F.lit(False)))
    rng = np.random.default_rng(seed)
    dim = width // 8
    d = min(dimensions, dim)
    turns = [np.linalg.qr(rng.normal(size=(dim, d)))[0] for _ in range(orderings)]
    shifts = rng.uniform(0, 0.3, size=(orderings, d))
    centre, spread = centre_and_spread(rows, dim)
    top = (1 << DIGITS) - 1

    def keyed(batches):
        for batch in batches:
            x = np.frombuffer(b"".join(batch["vec"].to_pylist()), "<f8").reshape(-1, dim)
            for o in range(orderings):
                # The normal curve's sigmoid spreads the projections over the grid.
                unit = 1 / (1 + np.exp(-np.clip(1.7 * ((x - centre) @ turns[o]) / spread, -40, 40)))
                cell = np.floor((0.75 * unit + shifts[o] * 0.8) * top).clip(0, top)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), o, np.int32)), pa.array(hilbert(cell, DIGITS)), batch["gid"], batch["vec"], batch["asks"]],
                    names=["o", "h", "gid", "vec", "asks"])

    def placed(batches):
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n, dtype=np.int64)), *(batch[c] for c in ("o", "gid", "vec", "asks"))],
                names=["part", "at", "o", "gid", "vec", "asks"])
            at += n

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = marked.mapInArrow(keyed, "o int, h long, gid long, vec binary, asks boolean").repartitionByRange(parts, "o", "h", "gid").sortWithinPartitions("o", "h", "gid")
    order = stored(order.mapInArrow(placed, "part int, at long, o int, gid long, vec binary, asks boolean"), "vector-order")
    runs = order.groupBy("o", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("o").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = runs.select("o", "part", (before - F.col("first")).alias("shift"))
    ranked = order.join(starts, ["o", "part"]).withColumn("block", F.floor((F.col("at") + F.col("shift")) / window))
    meets = ranked.select("o", "gid", "vec", "asks", F.explode(F.expr("IF(asks, array(0, -1, 1), array(0))")).alias("by"), "block")
    meets = meets.select("o", (F.col("block") + F.col("by")).alias("block"), "gid", "vec", (F.col("by") == 0).alias("here"), "asks")

    def nearest(df: pd.DataFrame) -> pd.DataFrame:
        x = np.frombuffer(b"".join(df["vec"]), "<f8").reshape(-1, dim)
        here, asks, gid = df["here"].to_numpy(bool), df["asks"].to_numpy(bool), df["gid"].to_numpy()
        base, ids = x[here], gid[here]
        out = []
        for i in np.flatnonzero(asks) if len(ids) else ():
            dist = np.sqrt(((base - x[i]) ** 2).sum(axis=1))
            some = closest(ids, dist, k + 1)
            out.append(pd.DataFrame({"gid": gid[i], "near": ids[some], "score": dist[some]}))
        return pd.concat(out) if out else pd.DataFrame({"gid": np.zeros(0, "int64"), "near": np.zeros(0, "int64"), "score": np.zeros(0)})

    found = meets.groupBy("o", "block").applyInPandas(nearest, "gid long, near long, score double")
    met = found.groupBy("gid", "near").agg(F.min("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("gid").orderBy("score", "near"))
    met = met.withColumn("place", place).where(F.col("place") <= k + 1)
    bounds = met.groupBy("gid").agg(F.when(F.count("*") == k + 1, F.max("score")).otherwise(F.lit(float("inf"))).alias("bound"))
    bounded = stored(groups.select("gid", "vec").join(bounds, "gid"), "vector-bounds")
    best = within_bounds(order.where("o = 0"), bounded, dim, k + 1)
    best = best.withColumn("place", place).where(F.col("place") <= k + 1).drop("place")
    near_ids = groups.select(F.col("gid").alias("near"), "ids")
    best = best.join(near_ids, "near").select("gid", "score", F.explode("ids").alias("vec_id"))
    answers = asked.join(best, "gid").where("query_id != vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return answers.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
