"""Payer configuration: active payers, locations, fallback."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idlewatch.functions.sql import text
from idlewatch.functions.text import bucket_of, environment_bucket, path_of

CONFIG = ("name", "bucket", "path", "access_type")
ACCESS_TYPE = "CROSS_ACCOUNT"  # fixed value of configurations from the refresh table


def require_unique(dimension: DataFrame, key: str, name: str) -> None:
    """A duplicate key would silently double every joined amount."""
    repeated = dimension.groupBy(key).count().where("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"{name} has several rows for {key} {repeated[0][0]!r}")


def active_configs(refresh_config: DataFrame) -> DataFrame:
    """Enabled payers with their location split into bucket and path."""
    return refresh_config.where("enable_refresh_payer").selectExpr(
        "CAST(payer_account_id AS STRING) AS payer_id",
        "payer_name AS name",
        f"{bucket_of('payer_bucket_path')} AS bucket",
        f"{path_of('payer_bucket_path')} AS path",
        f"{text(ACCESS_TYPE)} AS access_type",
    )


def resolve_configs(
    requested: DataFrame,
    refresh_config: DataFrame,
    fallback: DataFrame,
    environment: str,
    unreadable: DataFrame | None = None,
) -> DataFrame:
    """Configuration of each requested payer.

    The whole active row wins over the whole fallback row; ``source`` says which one was
    taken and is ``missing`` if there is none. Several rows of one payer are refused: they
    would double its files and amounts.

    ``unreadable`` lists buckets (as the environment names them) that gave no access: an active
    row that points there gives way to the fallback, and to nothing if there is none.
    """
    active = active_configs(refresh_config)
    require_unique(active, "payer_id", "active configurations")
    if unreadable is not None:
        shut = unreadable.selectExpr("bucket AS shut").where("shut IS NOT NULL").distinct()
        active = active.withColumn("shut", F.expr(environment_bucket("bucket", environment)))
        active = active.join(shut, "shut", "left_anti").drop("shut")
    require_unique(fallback, "payer_id", "fallback configurations")

    def packed(df: DataFrame, name: str) -> DataFrame:
        return df.selectExpr("payer_id", f"struct({', '.join(CONFIG)}) AS {name}")

    return (
        requested.select("payer_id").distinct()
        .join(packed(active, "primary"), "payer_id", "left")
        .join(packed(fallback, "fallback"), "payer_id", "left")
        .selectExpr(
            "payer_id",
            "CASE WHEN primary IS NOT NULL THEN 'primary' WHEN fallback IS NOT NULL THEN 'fallback'"
            " ELSE 'missing' END AS source",
            "coalesce(primary, fallback) AS config",
        )
        .selectExpr(
            "payer_id",
            "source",
            "config.name",
            f"{environment_bucket('config.bucket', environment)} AS bucket",
            "config.path",
            "config.access_type",
        )
    )
