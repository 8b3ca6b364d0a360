"""Terrain descriptors of a model grid: position index, local deviation, smoothed gradient, shelter and valleys.

Own definitions over disks of cells.  Every pixel adds to the cells whose disk
holds it, so a descriptor is one explode over a short literal list of offsets,
partially aggregated before its shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import finite


def disk(radius_cells: float, centre: bool = True) -> list[tuple[int, int]]:
    """(row, col) offsets within a distance, in cells."""
    r = int(radius_cells)
    return [(i, j) for i in range(-r, r + 1) for j in range(-r, r + 1) if i * i + j * j <= radius_cells * radius_cells + 1e-9 and (centre or i or j)]


def _spread(df: DataFrame, offsets: list[tuple[int, int]], weights: list[list[float]] | None = None) -> DataFrame:
    """Each pixel under the cells it is an offset of; ``w`` holds the offset's weights."""
    weights = weights or [[1.0]] * len(offsets)
    around = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.array(*map(F.lit, w)).alias("w")) for (i, j), w in zip(offsets, weights, strict=True)])
    z = F.when(finite(F.col("value")), F.col("value").cast("double"))
    return df.select("row", "col", z.alias("z"), F.explode(around).alias("o")).where("z is not null").select((F.col("row") - F.col("o.i")).alias("row"), (F.col("col") - F.col("o.j")).alias("col"), "z", F.col("o.w").alias("w"))


def tpi(df: DataFrame, scale_m: float, dx_m: float) -> DataFrame:
    """row, col, tpi: the value less the mean of cells within half the scale, itself not among them; null without neighbours."""
    around = _spread(df, disk(scale_m / 2 / dx_m, centre=False)).groupBy("row", "col").agg(F.avg("z").alias("m"))
    return df.join(around, ["row", "col"], "left").select("row", "col", (F.col("value") - F.col("m")).alias("tpi"))


def local_std(df: DataFrame, scale_m: float, dx_m: float) -> DataFrame:
    """row, col, std: population deviation over the disk."""
    around = _spread(df, disk(scale_m / 2 / dx_m)).groupBy("row", "col").agg(F.stddev_pop("z").alias("std"))
    return df.select("row", "col").join(around, ["row", "col"], "left")


def smoothed(df: DataFrame, sigma_cells: float) -> DataFrame:
    """row, col, value: Gaussian mean over three deviations, missing cells left out."""
    offsets = disk(max(1.0, 3 * sigma_cells))
    weights = [[math.exp(-(i * i + j * j) / (2 * sigma_cells**2))] for i, j in offsets]
    around = _spread(df, offsets, weights).groupBy("row", "col").agg((F.sum(F.col("z") * F.col("w")[0]) / F.sum(F.col("w")[0])).alias("value"))
    return df.select("row", "col").join(around, ["row", "col"], "left")


def gradient(df: DataFrame, scale_m: float, dx_m: float, sigma_ratio: float = 1.0) -> DataFrame:
    """row, col, we, sn, slope, aspect: central differences of the smoothed field; null at the edges of data."""
    s = smoothed(df, sigma_ratio * scale_m / (4 * dx_m))
    by_row, by_col = Window.partitionBy("row").orderBy("col"), Window.partitionBy("col").orderBy("row")
    at = lambda w, d: F.first("value").over(w.rangeBetween(d, d))
    d = s.withColumns({"we": (at(by_row, 1) - at(by_row, -1)) / (2 * dx_m)}).withColumns({"sn": (at(by_col, 1) - at(by_col, -1)) / (2 * dx_m)})
    return d.select("row", "col", "we", "sn", F.hypot("we", "sn").alias("slope"), F.atan2("we", "sn").alias("aspect"))


def ray(azimuth_deg: float, radius_m: float, dx_m: float) -> list[tuple[int, int]]:
    """Distinct offsets along an azimuth (0: growing rows, 90: growing columns), without the centre."""
    a = math.radians(azimuth_deg)
    out = [(round(k * math.cos(a)), round(k * math.sin(a))) for k in range(1, int(radius_m / dx_m) + 1)]
    return list(dict.fromkeys(out))


def sx(df: DataFrame, azimuth_deg: float, radius_m: float, dx_m: float) -> DataFrame:
    """row, col, sx: the greatest angle (radians) up to a cell on the ray; null where none has a value."""
    offsets = ray(azimuth_deg, radius_m, dx_m)
    pairs = _spread(df, offsets, [[dx_m * math.hypot(i, j)] for i, j in offsets])
    here = df.select("row", "col", F.col("value").cast("double").alias("z0"))
    return here.join(pairs, ["row", "col"], "left").groupBy("row", "col").agg(F.max(F.atan2(F.col("z") - F.col("z0"), F.col("w")[0])).alias("sx"))


def valley_ridge(df: DataFrame, scale_m: float, dx_m: float, mode: str = "valley", directions: int = 8) -> DataFrame:
    """row, col, norm, dir: the best response of V-shaped kernels over ``directions`` axes, and its axis in radians."""
    if mode not in ("valley", "ridge"):
        raise ValueError("mode is valley or ridge")
    r = max(1.0, scale_m / 2 / dx_m)
    offsets = disk(r)
    kernels = []
    for k in range(directions):
        t = math.pi * k / directions
        v = [abs(-i * math.sin(t) + j * math.cos(t)) / r for i, j in offsets]
        mean = sum(v) / len(v)
        size = math.sqrt(sum((x - mean) ** 2 for x in v)) or 1.0
        kernels.append([(x - mean) / size * (1 if mode == "valley" else -1) for x in v])
    sums = _spread(df, offsets, [list(w) for w in zip(*kernels, strict=True)]).groupBy("row", "col").agg(*[F.sum(F.col("z") * F.col("w")[k]).alias(f"r{k}") for k in range(directions)], F.count("*").alias("n"))
    best = F.greatest(*[F.struct(F.col(f"r{k}").alias("norm"), F.lit(-k).alias("k")) for k in range(directions)])
    found = sums.where(F.col("n") == len(offsets)).select("row", "col", best.alias("b")).select("row", "col", F.col("b.norm").alias("norm"), (-F.col("b.k") * (math.pi / directions)).alias("dir"))
    return df.select("row", "col").join(found, ["row", "col"], "left")


#: Descriptors by name; each takes (df, scale in metres, metres a cell, **options).
DESCRIPTORS = {"tpi": tpi, "std": local_std, "gradient": gradient, "valley_ridge": valley_ridge, "sx": lambda df, scale, dx, azimuth=180: sx(df, azimuth, scale, dx)}


def descriptor_plan(recipe: dict) -> list[tuple[str, str, float, dict]]:
    """(variable, descriptor, scale, options) from a recipe of defaults and per-variable descriptors; azimuths multiply."""
    out = []
    for variable, own in recipe["variables"].items():
        for name, options in own["descriptors"].items():
            if name not in DESCRIPTORS:
                raise ValueError(f"unknown descriptor {name!r}")
            merged = {**recipe.get("default", {}), **(options or {})}
            for scale in merged.pop("scales"):
                azimuths = merged.get("azimuths")
                rest = {k: v for k, v in merged.items() if k != "azimuths"}
                out += [(variable, name, scale, rest | {"azimuth": a}) for a in azimuths] if azimuths else [(variable, name, scale, rest)]
    return out


def zero_sea(df: DataFrame, nature: str = "nature") -> DataFrame:
    """Elevation zero where no land nature is."""
    return df.withColumn("value", F.when(F.col(nature) == 0, 0.0).otherwise(F.col("value")))
