"""Incremental aggregation of raster tiles as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import finite
from ..operators.match import native
from ..sources.grid import Grid


def tile_statistics(tiles: DataFrame, grid: Grid, origin: float = 0.0) -> DataFrame:
    """Mean and deviation by cell over a stream (or table) of pixels with lon, lat, value and weight.

    The state is a few sums a cell, so it is bounded by the grid; run it in
    ``update`` or ``complete`` mode.  ``origin`` shifts values before squaring.
    """
    ok = finite(F.col("value"))
    d = F.when(ok, F.col("value") - origin)
    w = F.when(ok, F.col("weight"))
    sums = native(tiles, grid).groupBy("cell").agg(F.sum(w).alias("w"), F.sum(w * d).alias("wd"), F.sum(w * d * d).alias("wdd"), F.count("*").alias("source_count"), F.count_if(ok).alias("valid_count"))
    mean = F.try_divide("wd", "w")
    return sums.select("cell", (mean + origin).alias("mean"), F.sqrt(F.greatest(F.try_divide("wdd", "w") - mean * mean, F.lit(0.0))).alias("std"), "source_count", "valid_count")
