"""Mixing sources to target weights by systematic sampling (DataFrame functions only).

Weights 5, 2, 1 repeat over the sources in code-point order, null last. The sources share
all sizes by weight; a target stops at `most` times its source's size and the excess is
shared again. Within a source, documents stand in order of (size, doc_id mod 256, doc_id);
each expects target / source size copies, the prefix sums start at one random offset of the
source, and a document is emitted once for each whole number its sum crosses.

Order by size makes the words taken follow the target closely: neighbours have about the
same size. Ranks are prefix sums over counts by (source, size) and (source, size, bucket),
so no window holds a whole source. One row per source meets in one task.

Null text or id: size 0, id first in order. Equal rows are emitted independently. An empty
table, or one without words, gives targets of 0. Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from idlewatch.llm.common import WORDS

SEED = "mix-1"


def size_of(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, most: int = 3, seed: str = SEED) -> DataFrame:
    """(source, source_size, target, rate, offset) from (source, source_size)."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_cap = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(0, Window.unboundedFollowing)
    weighed = sizes.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, (5, 2, 1))), (F.row_number().over(by_name) - 1) % 3 + 1)
    ).withColumn("cap", F.col("source_size") * most)
    filled = (
        weighed.withColumn("ratio", F.col("cap").cast("double") / F.col("weight"))
        .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("open", F.sum("weight").over(after))
        .withColumn("all_words", F.sum("source_size").over(Window.partitionBy()))
        .withColumn("full", F.col("cap") * F.col("open") <= (F.col("all_words") - F.col("capped")) * F.col("weight"))
    )
    level = F.min(F.expr("CASE WHEN NOT full THEN struct(ratio, CAST(all_words - capped AS DOUBLE) / open AS level) END"))
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit(seed + "/"), F.coalesce("source", F.lit("")))), 1, 8), 16, 10)
    return (
        filled.withColumn("first_open", level.over(Window.partitionBy()))
        .withColumn("target", F.expr("CASE WHEN full THEN CAST(cap AS DOUBLE) ELSE weight * first_open.level END"))
        .withColumn("rate", F.expr("CASE WHEN source_size = 0 THEN 0D ELSE target / source_size END"))
        .withColumn("offset", drawn.cast("double") / F.lit(4294967296.0))
        .select("source", "source_size", "target", "rate", "offset")
    )


def mixed_copies(docs: DataFrame, most: int = 3, seed: str = SEED) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, copies."""
    cells = docs.select(
        "doc_id", "source", size_of("text").alias("size"),
        F.coalesce(F.expr("pmod(doc_id, 256)"), F.lit(0)).cast("int").alias("bucket"),
    )
    counts = cells.groupBy("source", "size", "bucket").agg(F.count("*").alias("n"))
    by_size = counts.groupBy("source", "size").agg(F.sum("n").alias("n_size"))
    upto = (Window.unboundedPreceding, -1)
    sizes = by_size.groupBy("source").agg(F.sum(F.col("size") * F.col("n_size")).alias("source_size"))
    before_size = by_size.select(
        "source", "size",
        F.coalesce(F.sum("n_size").over(Window.partitionBy("source").orderBy("size").rowsBetween(*upto)), F.lit(0)).alias("before_size"),
    )
    before_bucket = counts.select(
        "source", "size", "bucket",
        F.coalesce(F.sum("n").over(Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(*upto)), F.lit(0)).alias("before_bucket"),
    )
    drawn = targets(sizes, most, seed)

    def on(df: DataFrame, other: DataFrame, *keys: str) -> DataFrame:
        other = other.select(*[F.col(k).alias(f"_{k}") if k in keys else F.col(k) for k in other.columns])
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        joined = df
        match = same[0]
        for s in same[1:]:
            match = match & s
        return joined.join(other, match).drop(*[f"_{k}" for k in keys])

    starts = on(on(before_bucket, before_size, "source", "size"), drawn, "source").withColumn(
        "start", F.col("before_size") + F.col("before_bucket")
    ).drop("before_size", "before_bucket")
    place = F.row_number().over(
        Window.partitionBy("source", "size", "bucket").orderBy(F.col("doc_id").asc_nulls_first())
    )
    ranked = on(cells.withColumn("place", place), starts, "source", "size", "bucket")
    rank = F.col("start") + F.col("place")
    crossed = F.floor(F.col("rate") * rank + F.col("offset")) - F.floor(F.col("rate") * (rank - 1) + F.col("offset"))
    return ranked.select("doc_id", "source", "size", "source_size", "target", crossed.cast("long").alias("copies"))


def mixture(docs: DataFrame, most: int = 3, seed: str = SEED) -> DataFrame:
    """The documents themselves, each as often as the mix takes it."""
    taken = mixed_copies(docs, most, seed).where("copies > 0").select(
        F.col("doc_id").alias("_id"), F.col("copies").alias("_copies")
    )
    # Repeated ids: the copies of equal ids are dealt by place, so both sides number them.
    w_left = Window.partitionBy("doc_id").orderBy(F.xxhash64("text", "source"))
    w_right = Window.partitionBy("_id").orderBy("_copies")
    left = docs.withColumn("_place", F.row_number().over(w_left))
    right = taken.withColumn("_there", F.row_number().over(w_right))
    return (
        left.join(right, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_place") == F.col("_there")))
        .withColumn("_copy", F.explode(F.expr("sequence(1L, _copies)")))
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )


ORACLE = r"""
WITH s AS (SELECT doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM {docs}),
t AS (SELECT source, sum(size)::BIGINT AS source_size FROM s GROUP BY source),
w AS (SELECT *, 3 * source_size AS cap,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
    sum(source_size) OVER ()::BIGINT AS whole FROM t),
f AS (SELECT *, (coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS used,
    (sum(weight) OVER (ORDER BY cap::DOUBLE / weight, source NULLS LAST
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS open FROM w),
l AS (SELECT *, cap * open <= (whole - used) * weight AS is_full FROM f),
m AS (SELECT arg_min((whole - used)::DOUBLE / open, cap::DOUBLE / weight) AS level FROM l WHERE NOT is_full),
g AS (SELECT source, source_size,
    CASE WHEN is_full THEN cap::DOUBLE ELSE weight * (SELECT level FROM m) END AS target,
    ('0x' || substr(md5('mix-1/' || coalesce(source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM l),
r AS (SELECT s.*, g.source_size, g.target, g.u,
    CASE WHEN g.source_size = 0 THEN 0::DOUBLE ELSE g.target / g.source_size END AS rate,
    row_number() OVER (PARTITION BY s.source ORDER BY size, coalesce(((doc_id % 256) + 256) % 256, 0),
        doc_id NULLS FIRST) AS rank
    FROM s JOIN g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
    (floor(rate * rank + u) - floor(rate * (rank - 1) + u))::BIGINT * size AS taken FROM r
"""
