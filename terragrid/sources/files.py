"""Inputs of several files, named by a glob of Spark's file systems."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession


def listed(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, sorted; the files themselves are not read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(x.getPath().toString() for x in found or ())


def latest(spark: SparkSession, pattern: str) -> str:
    """The last path in order of names; names are to sort by date."""
    found = listed(spark, pattern)
    if not found:
        raise FileNotFoundError(pattern)
    return found[-1]


def merged(spark: SparkSession, pattern: str, keys: list[str]) -> DataFrame:
    """Parquet files of different variables on the same keys as one frame; a row that a file lacks has nulls there."""
    found = listed(spark, pattern)
    if not found:
        raise FileNotFoundError(pattern)
    frames = [spark.read.parquet(p) for p in found]
    names = [c for f in frames for c in f.columns if c not in keys]
    again = sorted({c for c in names if names.count(c) > 1})
    if again:
        raise ValueError(f"in several files: {again}")
    return reduce(lambda a, b: a.join(b, keys, "full_outer"), frames)


def inline_points(spark: SparkSession) -> DataFrame:
    """Four fixed points for trials: latitudes 60 and 61, longitudes 10 and 11."""
    return spark.createDataFrame([(0, 10.0, 60.0), (1, 10.0, 61.0), (2, 11.0, 60.0), (3, 11.0, 61.0)], "target_id long, lon double, lat double")
