"""Tables of slices, replaced by version.

A slice is one combination of values of a table's slice columns. A commit writes its rows into a
data folder of its own, then a complete manifest: which folder holds each slice. The table is
what its newest complete manifest names, so a commit shows whole or not at all:

    <path>/data/version=<id>/<column>=<value>/...    rows, never changed once written
    <path>/manifest/<number>/                        slice columns and folder, one row per slice

An emptied slice is a manifest row without folder; it needs no job and no file. A run that fails
before its manifest is complete leaves the table as it was, and its folder is removed later
(`remove_unreferenced`). What the driver holds is one folder name per slice it reads. One writer at
a time: a commit that finds another one published meanwhile is refused.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from idlewatch.session import open_writers
from idlewatch.sources.discovery import file_listing


class ConcurrentCommit(RuntimeError):
    """Another commit was published while this one was written."""


def _files(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    system, hadoop_path = _files(spark, path)
    return system.exists(hadoop_path)


def _names(spark: SparkSession, path: str) -> list[str]:
    system, folder = _files(spark, path)
    return [f.getPath().getName() for f in system.listStatus(folder)] if system.exists(folder) else []


def snapshots(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete manifests, ascending."""
    root = f"{path.rstrip('/')}/manifest"
    numbers = (n for n in _names(spark, root) if n.isdigit())
    return sorted(int(n) for n in numbers if path_exists(spark, f"{root}/{n}/_SUCCESS"))


def manifest(
    spark: SparkSession, path: str, slice_schema: StructType, number: int | None = None
) -> DataFrame:
    """Slice columns and folder (below the table's path; NULL for an emptied slice)."""
    schema = StructType([*slice_schema, StructField("folder", StringType())])
    number = max(snapshots(spark, path), default=None) if number is None else number
    if number is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path.rstrip('/')}/manifest/{number}")


def slice_schema_of(rows: DataFrame, columns: Sequence[str]) -> StructType:
    return StructType([rows.schema[c] for c in columns])


def written_slices(spark: SparkSession, path: str, version: str, slice_schema: StructType) -> DataFrame:
    """Slices of one data folder by the names of its files; no row is read."""
    inside = f"data/version={version}"
    listed = file_listing(spark, f"{path.rstrip('/')}/{inside}").select(
        F.regexp_extract("key", f"/({inside}/.*)/[^/]*$", 1).alias("folder")
    )
    def value(field: StructField) -> Column:
        # Folder names escape special characters by percent signs; a plus stands for itself.
        raw = F.regexp_extract("folder", f"/{field.name}=([^/]*)", 1)
        return F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))).cast(field.dataType).alias(field.name)

    return listed.where("folder != ''").distinct().select(*map(value, slice_schema), "folder")


def commit(
    rows: DataFrame, path: str, columns: Sequence[str], owned: DataFrame, rebalance: bool = True
) -> int:
    """Make the owned slices hold exactly `rows` (none of which lies outside); the new number.

    `owned` has one row per slice. Rebalancing on the slice columns gives few files per slice,
    while adaptive execution splits the slice of a payer that owns a third of the rows.
    """
    spark, path = rows.sparkSession, path.rstrip("/")
    base = max(snapshots(spark, path), default=0)
    version = uuid.uuid4().hex
    spread = rows.hint("rebalance", *columns) if rebalance else rows
    with open_writers(spark):
        spread.write.partitionBy(*columns).parquet(f"{path}/data/version={version}")
    slices = slice_schema_of(rows, columns)
    publish(spark, path, columns, owned, written_slices(spark, path, version, slices), base, slices)
    return base + 1


def publish(
    spark: SparkSession, path: str, columns: Sequence[str], owned: DataFrame, written: DataFrame,
    base: int, slices: StructType,
) -> None:
    """The manifest after `base`, in which the owned slices are the written ones."""
    keys = list(columns)
    before = manifest(spark, path, slices, base or None)
    kept = before.join(owned.select(*keys), keys, "left_anti")
    emptied = before.join(owned.select(*keys), keys, "left_semi").join(written.select(*keys), keys, "left_anti")
    after = kept.unionByName(written).unionByName(emptied.withColumn("folder", F.lit(None).cast("string")))
    if max(snapshots(spark, path), default=0) != base:
        raise ConcurrentCommit(f"{path} was changed after manifest {base}")
    after.select(*keys, "folder").write.parquet(f"{path}/manifest/{base + 1}")


def folders(
    spark: SparkSession, path: str, slice_schema: StructType, where: Column | str | None = None
) -> list[str]:
    """Folders of the slices that fulfil `where` and are not emptied."""
    found = manifest(spark, path, slice_schema)
    found = found if where is None else found.where(where)
    return sorted(r.folder for r in found.where("folder IS NOT NULL").select("folder").collect())


def paths_of(path: str, names: Sequence[str]) -> list[str]:
    """Read paths of the folders; characters that would be taken for patterns are escaped."""
    return [re.sub(r"([\[\]{}*?\\])", r"\\\1", f"{path.rstrip('/')}/{n}") for n in names]


def read_slices(
    spark: SparkSession, path: str, schema: StructType, columns: Sequence[str],
    where: Column | str | None = None,
) -> DataFrame:
    """Rows of the current slices that fulfil `where`, a condition on slice columns.

    Only their folders are listed: files of replaced versions are never looked at.
    """
    names = folders(spark, path, StructType([schema[c] for c in columns]), where)
    if not names:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", f"{path.rstrip('/')}/data")
    return reader.parquet(*paths_of(path, names)).select(*schema.names)


def remove_unreferenced(spark: SparkSession, path: str, columns: StructType, keep: int = 2) -> list[str]:
    """Delete all but the newest manifests and the data folders that none of those names.

    Not to be run beside a commit, whose folder no manifest names yet. Returns what was deleted.
    """
    path, numbers = path.rstrip("/"), snapshots(spark, path)
    used: set[str] = set()
    for number in numbers[-keep:]:
        version = F.regexp_extract("folder", "^data/(version=[^/]*)/", 1).alias("version")
        used |= {r.version for r in manifest(spark, path, columns, number).select(version).distinct().collect()}
    gone = [f"data/{n}" for n in _names(spark, f"{path}/data") if n not in used]
    gone += [f"manifest/{n}" for n in _names(spark, f"{path}/manifest") if not (n.isdigit() and int(n) in numbers[-keep:])]
    for name in gone:
        system, folder = _files(spark, f"{path}/{name}")
        system.delete(folder, True)
    return sorted(gone)
