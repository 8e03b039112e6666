"""Continuous intake: new export files trigger the months and payers they touch.

`follow_exports` calls a handler for each month a batch touches. `follow_to_facts` takes the batch
all the way: stage, recompute, and remember which of these steps the batch has behind it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from idlewatch.plans.job import run_month
from idlewatch.plans.refresh import Places
from idlewatch.session import through_shared_table
from idlewatch.sinks.staging import stage_exports
from idlewatch.sinks.versions import commit, read_slices
from idlewatch.sources.billing import PERIOD

STEPS = T.StructType(
    [
        T.StructField("stream", T.StringType()), T.StructField("batch_id", T.LongType()),
        T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType()),
        T.StructField("step", T.StringType()), T.StructField("payer_ids", T.ArrayType(T.StringType())),
    ]
)
REJECTED = T.StructType(
    [
        T.StructField("batch_id", T.LongType()), T.StructField("file_path", T.StringType()),
        T.StructField("payer_id", T.StringType()), T.StructField("reason", T.StringType()),
    ]
)
OnSlices = Callable[[int, int, Sequence[str]], None]


def export_stream(
    spark: SparkSession, source: str, schema: StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Stream of export files below ``source``; every file is delivered once."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(source)


def touched_slices(lines: DataFrame) -> DataFrame:
    """(year, month, payer_id) by the billing period of the files' folders.

    Usage may start before its billing period, so line dates do not tell the slice. Lines
    without a payer, and files outside any billing period, touch nothing.
    """
    period = F.regexp_extract("file_path", PERIOD, 1)
    return lines.where("bill_payer_account_id IS NOT NULL").where(period != "").select(
        F.substring(period, 1, 4).cast("int").alias("year"),
        F.substring(period, 6, 2).cast("int").alias("month"),
        F.col("bill_payer_account_id").alias("payer_id"),
    ).distinct()


def follow_exports(
    stream: DataFrame, checkpoint: str, on_slices: OnSlices, once: bool = True
) -> StreamingQuery:
    """Call ``on_slices(year, month, payer_ids)`` for each month a batch of files touches.

    Only one column and the path of the new files are read here: the handler recomputes whole slices
    from the staged table. A batch replayed after a failure repeats the same replacement,
    which changes nothing. The list per batch is bounded by months x payers.
    """
    narrow = stream.select("_metadata.file_path", "bill_payer_account_id")

    def handle(batch: DataFrame, _batch_id: int) -> None:
        months: dict[tuple[int, int], list[str]] = {}
        for row in touched_slices(batch).collect():
            months.setdefault((row.year, row.month), []).append(row.payer_id)
        for (year, month), payer_ids in sorted(months.items()):
            on_slices(year, month, sorted(payer_ids))

    writer = narrow.writeStream.option("checkpointLocation", checkpoint).foreachBatch(handle)
    return (writer.trigger(availableNow=True) if once else writer).start()


def rejected_files(lines: DataFrame) -> DataFrame:
    """(file_path, payer_id, reason) of files that touch no slice, or hold lines that touch none."""
    outside = F.regexp_extract("file_path", PERIOD, 1) == ""
    reason = F.when(outside, "no billing period").otherwise("lines without payer")
    touching_none = lines.where(outside | F.col("bill_payer_account_id").isNull())
    return touching_none.select(
        "file_path", F.col("bill_payer_account_id").alias("payer_id"), reason.alias("reason")
    ).distinct()


class BatchLedger:
    """The steps that the current batch has behind it, and all rejected files.

    Only the last batch of a stream can be replayed, so only its steps are kept.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def steps(self, batch_id: int) -> dict[tuple[int, int, str], list[str]]:
        """(year, month, step) -> payers, of this batch."""
        rows = read_slices(self.spark, f"{self.path}/steps", STEPS, ["stream"]).where(F.col("batch_id") == batch_id)
        return {(r.year, r.month, r.step): list(r.payer_ids) for r in rows.collect()}

    def record(self, batch_id: int, done: dict[tuple[int, int, str], list[str]]) -> None:
        rows = [("all", batch_id, *key, payer_ids) for key, payer_ids in done.items()]
        owned = self.spark.createDataFrame([("all",)], T.StructType(STEPS.fields[:1]))
        commit(self.spark.createDataFrame(rows, STEPS).coalesce(1), f"{self.path}/steps", ["stream"], owned, rebalance=False)

    def reject(self, batch_id: int, rows: DataFrame) -> None:
        """A replayed batch replaces what it rejected before."""
        owned = self.spark.createDataFrame([(batch_id,)], T.StructType(REJECTED.fields[:1]))
        rows = rows.withColumn("batch_id", F.lit(batch_id).cast("long")).select(*REJECTED.names)
        commit(rows, f"{self.path}/rejected", ["batch_id"], owned)

    def rejected(self) -> DataFrame:
        """batch_id, file_path, payer_id and reason of everything that never reached a slice."""
        return read_slices(self.spark, f"{self.path}/rejected", REJECTED, ["batch_id"])


def follow_to_facts(
    stream: DataFrame,
    checkpoint: str,
    ledger_path: str,
    exports: Callable[[Sequence[str]], Sequence[tuple[str, str]]],
    places: Places,
    schema: StructType | None = None,
    once: bool = True,
) -> StreamingQuery:
    """Restage the payer months a batch of files touches and recompute their facts.

    ``exports`` names the export paths of payers, as (payer_id, path) pairs. A batch that is replayed
    after a failure skips the steps it has behind it: a month staged before the failure is not
    staged again, a month whose facts are stored is done. Files outside any billing period, lines
    without a payer and payers that could not be staged are kept as rejected rows.
    """
    narrow = stream.select("_metadata.file_path", "bill_payer_account_id")

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # The new files are read once; what is left is a row per file and payer.
        batch = through_shared_table(batch.distinct(), f"stream/{uuid.uuid4().hex}")
        ledger = BatchLedger(spark, ledger_path)
        done = ledger.steps(batch_id)
        months: dict[tuple[int, int], list[str]] = {}
        for row in touched_slices(batch).collect():
            months.setdefault((row.year, row.month), []).append(row.payer_id)
        unstaged = []
        for (year, month), payer_ids in sorted(months.items()):
            if (year, month, "staged") not in done:
                try:
                    staged = stage_exports(spark, exports(sorted(payer_ids)), places.staged_root, year, month, schema)
                except FileNotFoundError:
                    staged = []
                done[year, month, "staged"] = staged
                ledger.record(batch_id, done)
            staged = done[year, month, "staged"]
            period = f"BILLING_PERIOD={year}-{month:02d}"
            unstaged += [(period, p, "not staged") for p in sorted(set(payer_ids) - set(staged))]
            if staged and (year, month, "facts") not in done:
                run_month(
                    spark, places.staged_root, places.fact_path, places.payers, places.accounts, year, month,
                    staged, schema,
                )
                done[year, month, "facts"] = staged
                ledger.record(batch_id, done)
        rejected = rejected_files(batch)
        if unstaged:
            rejected = rejected.unionByName(spark.createDataFrame(unstaged, "file_path string, payer_id string, reason string"))
        if not rejected.isEmpty():
            ledger.reject(batch_id, rejected)

    writer = narrow.writeStream.option("checkpointLocation", checkpoint).foreachBatch(handle)
    return (writer.trigger(availableNow=True) if once else writer).start()
