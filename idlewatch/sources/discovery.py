"""Which files are new: listings, high-water marks, change detection."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def modified_after(since: datetime) -> dict[str, str]:
    """Read options for files modified strictly later, whatever the session zone.

    A datetime without zone is local time, as collected timestamps are. The reader
    compares in the zone of its ``timeZone`` option, so both options go together.
    """
    utc = since.astimezone(timezone.utc).replace(tzinfo=None)
    return {"modifiedAfter": utc.isoformat(), "timeZone": "UTC"}


def qualified(spark: SparkSession, path: str) -> str:
    """The path as file listings show it, with its file system."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop_path).toString()


def file_listing(
    spark: SparkSession,
    *paths: str,
    since: datetime | None = None,
    pattern: str | None = None,
    checksum: bool = False,
) -> DataFrame:
    """Files below the paths: key, size, last_modified; whatever a scan of the paths reads.

    ``since`` keeps files modified strictly later, ``pattern`` those whose names fit. File contents
    are never read, only the metadata columns of the source, unless a ``checksum`` is asked for.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    if since is not None:
        reader = reader.options(**modified_after(since))
    return reader.load(list(paths)).select(
        F.col("path").alias("key"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("last_modified"),
        *([F.md5("content").alias("checksum")] if checksum else []),
    )


def changed_files(listing: DataFrame, marks: DataFrame) -> DataFrame:
    """Listed files newer than their payer's mark; without a mark every file counts.

    ``listing`` has payer_id, key, last_modified; ``marks`` one row per payer with
    payer_id, mark. Folder placeholders (keys ending in ``/``) are no files.
    """
    return (
        listing.where(~F.col("key").endswith("/"))
        .join(marks.select("payer_id", "mark"), "payer_id", "left")
        .where(F.col("mark").isNull() | (F.col("last_modified") > F.col("mark")))
        .drop("mark")
    )


def file_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """(payer_id, key, change): how one listing became another.

    `added` and `removed` files, and `changed` ones: another size, modification time or, where both
    listings have the column, checksum. A file overwritten within the clock's resolution still shows
    by its size or checksum. Folder placeholders (keys ending in ``/``) are no files.
    """
    marks = ["size", "last_modified"]
    if "checksum" in before.columns and "checksum" in after.columns:
        marks.append("checksum")

    def side(listing: DataFrame, name: str) -> DataFrame:
        packed = F.struct(*marks).alias(name)
        return listing.where(~F.col("key").endswith("/")).select("payer_id", "key", packed)

    both = side(before, "old").join(side(after, "new"), ["payer_id", "key"], "full")
    change = """CASE WHEN old IS NULL THEN 'added' WHEN new IS NULL THEN 'removed'
        WHEN NOT (old <=> new) THEN 'changed' END"""
    return both.withColumn("change", F.expr(change)).where("change IS NOT NULL").select("payer_id", "key", "change")


def high_water_marks(facts: DataFrame, requested: DataFrame) -> DataFrame:
    """Last reported hour of each requested payer, NULL for a payer never reported."""
    last = facts.groupBy(F.col("bill_payeraccountid").alias("payer_id")).agg(
        F.max("lineitem_usagestartdate").alias("mark")
    )
    return requested.select("payer_id").distinct().join(last, "payer_id", "left")


def file_marks(listing: DataFrame) -> DataFrame:
    """Newest modification per payer.

    To be compared with later listings; a usage timestamp says nothing about when a
    file arrived, so it must not be used for that.
    """
    return listing.groupBy("payer_id").agg(F.max("last_modified").alias("mark"))
