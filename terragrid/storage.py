"""Tables written to the folder that the driver and all executors share, so that lineage ends there."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only in local mode, where it may be unset, a folder of this application."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at and not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return at.rstrip("/") if at else f"/tmp/checkpoints/{spark.sparkContext.applicationId}"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written and read back: a lost executor costs a reread, and nothing is computed twice."""
    path = f"{shared_folder(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
