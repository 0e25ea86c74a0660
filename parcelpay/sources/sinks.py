"""Publishing reports that other reports read again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from parcelpay.session import shuffles_freed

# Months are told apart by these columns in every summary.
MONTH_COLUMNS = ("pay_out_year", "pay_out_month")


def publish_summary(summary: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a month summary as parquet, one directory per month, in a folder all executors share.

    Overwriting replaces the months that the summary has and leaves all others as they are.
    """
    with shuffles_freed(summary.sparkSession):
        summary.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*MONTH_COLUMNS).parquet(path)


def read_summary(like: DataFrame, path: str) -> DataFrame:
    """A published summary with the columns of `like`, in their order and types; nothing of `like` runs."""
    schema = like.schema
    return like.sparkSession.read.schema(schema).parquet(path).select(*schema.names)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below `spark.checkpoint.dir`, which all executors share; a temporary one on a single machine without it."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="parcelpay-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
