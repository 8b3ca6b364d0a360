"""Statistics of matched pixels by target: fractions, means, deviations and slopes, with coverage diagnostics."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import finite

#: Land-cover categories (fixed values); codes may be in several.
CATEGORIES = {"sea": [1], "lake": [2, 3], "nature": list(range(4, 24)), "urban": list(range(24, 34)), "forest": list(range(7, 15)), "glacier": [6]}
MODES = ("fractions", "mean", "std", "slope")
RESERVED = {"x", "y", "latitude", "longitude", "crs", "source_area", "valid_area", "source_count", "valid_count", "fractions_data_status"}


def check_categories(categories: dict[str, list]) -> dict[str, list[int]]:
    """Categories as integer codes; empty, non-integer or reserved ones are errors."""
    if not categories or any(not len(c) for c in categories.values()):
        raise ValueError("categories must not be empty")
    for name, codes in categories.items():
        if any(isinstance(c, bool) or not math.isfinite(c) or c != int(c) for c in codes):
            raise ValueError(f"category {name!r} has codes that are not integers")
    if taken := RESERVED & set(categories):
        raise ValueError(f"reserved names: {sorted(taken)}")
    return {n: [int(c) for c in codes] for n, codes in categories.items()}


def check_codes(pixels: DataFrame, categories: dict[str, list[int]]) -> None:
    """An error that names up to twenty codes in no category."""
    known = sorted({c for codes in categories.values() for c in codes})
    bad = pixels.where(finite(F.col("value")) & ~F.col("value").isin([float(c) for c in known])).select("value").distinct().orderBy("value").limit(20).collect()
    if bad:
        raise ValueError(f"unknown source codes: {[r.value for r in bad]}")


def _diagnostics(valid) -> list:
    return [
        F.sum("weight").alias("source_area"), F.coalesce(F.sum(F.when(valid, F.col("weight"))), F.lit(0.0)).alias("valid_area"),
        F.count("*").alias("source_count"), F.count_if(valid).alias("valid_count"),
    ]


def _mean(column: str, valid):
    return F.try_divide(F.sum(F.when(valid, F.col("weight") * F.col(column))), F.sum(F.when(valid, F.col("weight"))))


def summarise(matched: DataFrame, mode: str, key: str = "cell", categories: dict[str, list[int]] | None = None, single_pass: bool = False) -> DataFrame:
    """One row per ``key``: the mode's columns and the diagnostics.

    ``matched`` has ``key``, ``weight`` and ``value`` (slope mode: slope_x and
    slope_y).  All modes read the pixels once and shuffle partial results only.
    std merges centred moments of equal weights, a target's raster rows;
    ``single_pass`` shifts by the overall mean instead, which loses about
    (mean - overall mean)^2 / variance ulps.
    """
    if mode == "slope":
        valid = finite(F.col("slope_x")) & finite(F.col("slope_y"))
        return matched.groupBy(key).agg(_mean("slope_x", valid).alias("slope_x"), _mean("slope_y", valid).alias("slope_y"), *_diagnostics(valid))
    valid = finite(F.col("value"))
    if mode == "fractions":
        part = lambda codes: F.try_divide(F.sum(F.when(valid, F.when(F.col("value").isin([float(c) for c in codes]), F.col("weight")).otherwise(0.0))), F.sum(F.when(valid, F.col("weight"))))
        return matched.groupBy(key).agg(*[part(codes).alias(n) for n, codes in check_categories(categories or CATEGORIES).items()], *_diagnostics(valid))
    if mode == "mean":
        return matched.groupBy(key).agg(_mean("value", valid).alias("mean"), *_diagnostics(valid))
    if mode != "std":
        raise ValueError(f"mode {mode!r} is none of {MODES}")
    if single_pass:
        origin = matched.where(valid).agg(F.avg("value")).first()[0] or 0.0
        d = F.when(valid, F.col("value") - origin)
        w = F.sum(F.when(valid, F.col("weight")))
        m1, m2 = F.try_divide(F.sum(F.col("weight") * d), w), F.try_divide(F.sum(F.col("weight") * d * d), w)
        return matched.groupBy(key).agg((m1 + origin).alias("mean"), F.when(F.count_if(valid) == 1, 0.0).otherwise(F.sqrt(F.greatest(m2 - m1 * m1, F.lit(0.0)))).alias("std"), *_diagnostics(valid))
    # Pixels of one weight (a raster row's) are counted, averaged and spread by Spark's centred moments; these few rows then merge.
    v = F.when(valid, F.col("value").cast("double"))
    part = matched.groupBy(key, "weight").agg(F.count("*").alias("all"), F.count(v).alias("n"), F.avg(v).alias("m"), F.var_pop(v).alias("v"))
    own = part.groupBy(key).agg(F.collect_list(F.struct("weight", "all", "n", "m", "v")).alias("parts"))
    total = lambda e: F.aggregate("parts", F.lit(0.0), lambda s, x: s + e(x))
    w = total(lambda x: x["weight"] * x["n"])
    out = own.withColumns({"source_area": total(lambda x: x["weight"] * x["all"]), "valid_area": w, "source_count": F.aggregate("parts", F.lit(0).cast("long"), lambda s, x: s + x["all"]), "valid_count": F.aggregate("parts", F.lit(0).cast("long"), lambda s, x: s + x["n"])})
    out = out.withColumn("mean", F.try_divide(total(lambda x: F.when(x["n"] > 0, x["weight"] * x["n"] * x["m"]).otherwise(0.0)), F.col("valid_area")))
    off = lambda x: F.when(x["n"] > 0, x["weight"] * x["n"] * (x["v"] + (x["m"] - F.col("mean")) * (x["m"] - F.col("mean")))).otherwise(0.0)
    out = out.withColumn("std", F.sqrt(F.try_divide(total(off), F.col("valid_area"))))
    return out.select(key, "mean", "std", "source_area", "valid_area", "source_count", "valid_count")


def value_columns(mode: str, categories: dict | None = None) -> list[str]:
    return {"mean": ["mean"], "std": ["mean", "std"], "slope": ["slope_x", "slope_y"]}.get(mode) or list(categories or CATEGORIES)
