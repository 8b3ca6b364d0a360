"""The entry point: a raster's statistics on a target grid."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import R_AREA
from ..operators import match, output, slope, stats
from ..sources.grid import Grid
from ..sources.raster import Raster
from .windows import neighbourhood_rows, pruned, source_windows, widened


def check_options(mode: str, radius_m: float | None, fill_missing_mean: float | None, fill_uncovered: float | None, fill_uncovered_mean: float | None) -> float | None:
    """Errors for options that do not go together; gives the uncovered fill."""
    if mode not in stats.MODES:
        raise ValueError(f"mode {mode!r} is none of {stats.MODES}")
    if radius_m is not None and mode not in ("std", "slope"):
        raise ValueError("a radius needs std or slope mode")
    if radius_m is not None and not (math.isfinite(radius_m) and 0 < radius_m <= math.pi * R_AREA):
        raise ValueError("the radius must be finite and lie in (0, pi R]")
    if fill_uncovered is not None and fill_uncovered_mean is not None and fill_uncovered != fill_uncovered_mean:
        raise ValueError("conflicting fills for uncovered targets")
    fill = fill_uncovered if fill_uncovered is not None else fill_uncovered_mean
    if fill_missing_mean is not None and mode != "mean":
        raise ValueError("fill_missing_mean needs mean mode")
    if any(v is not None and not math.isfinite(v) for v in (fill_missing_mean, fill)):
        raise ValueError("fills must be finite")
    if mode == "fractions" and fill is not None and not 0 <= fill <= 1:
        raise ValueError("a fraction's fill must lie in [0, 1]")
    return fill


def _pixels(raster: Raster, mode: str, rows: list | None, cols: list | None) -> DataFrame:
    """The weighted pixels in the windows; slopes are made of the windows and one pixel around them, so the scan is pruned all the same."""
    if mode != "slope":
        return pruned(raster.weighted(), rows, cols)
    halo = pruned(raster.df, rows and widened(rows, len(raster.lats)), cols and widened(cols, len(raster.lons), raster.periodic))
    return pruned(slope.slopes(raster.with_df(halo)), rows, cols)


def aggregate(
    raster: Raster, grid: Grid, mode: str = "fractions", categories: dict | None = None, points: DataFrame | None = None, radius_m: float | None = None,
    fill_missing_mean: float | None = None, fill_uncovered: float | None = None, fill_uncovered_mean: float | None = None, prune: bool = True, check: bool = True, single_pass: bool = False,
) -> DataFrame:
    """Statistics of ``raster`` on every cell of ``grid``, or on the cells that ``points`` select.

    Window predicates, a computed (or hash-grid) key and one partial
    aggregation; only cells that are asked for are accumulated.  With points
    the rows carry point_idx and the supplied coordinates.  Nothing is
    collected but row counts of checks.
    """
    fill = check_options(mode, radius_m, fill_missing_mean, fill_uncovered, fill_uncovered_mean)
    spark = raster.df.sparkSession
    codes = stats.check_categories(categories or stats.CATEGORIES) if mode == "fractions" else None
    selected = grid.select_points(points) if points is not None else None
    rows = cols = None
    if radius_m is not None:
        targets = selected if selected is not None else grid.located(grid.cells(spark))
        if prune:
            low, high = targets.agg(F.min("lat"), F.max("lat")).first()
            if low is None or not (math.isfinite(low) and math.isfinite(high)):
                raise ValueError("neighbourhood targets are not finite")
            rows = neighbourhood_rows(raster.lats, (low, high), radius_m)
        pixels = _pixels(raster, mode, rows, cols)
        matched = match.radius(pixels, targets.select("cell", "lon", "lat"), radius_m, R_AREA)
    else:
        if prune:
            rows, cols = source_windows(grid, raster.lats, raster.lons)
        pixels = _pixels(raster, mode, rows, cols)
        matched = match.native(pixels, grid)
        if selected is not None:
            matched = matched.join(selected.select("cell"), "cell", "left_semi")
    if mode == "fractions" and check:
        stats.check_codes(matched, codes)
    found = stats.summarise(matched, mode, "cell", codes, single_pass)
    targets = selected if selected is not None else grid.cells(spark)
    values = stats.value_columns(mode, codes)
    if check and found.isEmpty():
        raise ValueError("no source pixel lies inside the target")
    done = output.complete(found, targets, "cell", values, mode, fill_missing_mean, fill)
    if mode == "fractions" and fill is None:
        done = done.drop("fractions_data_status")
    units = {v: "1" if mode in ("fractions", "slope") else "" for v in values} | {"source_area": "m2", "valid_area": "m2", "source_count": "1", "valid_count": "1"}
    return output.with_units(done, {k: u for k, u in units.items() if u}, {v: "area: standard_deviation" if v == "std" else "area: mean" for v in values})
