"""Terrain slopes by central differences over a long-form raster, as window functions."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import R_AREA, R_LEGACY, finite
from ..sources.raster import Raster


#: Rows of a block, whose pixels one task sees with a row more on each side.
BLOCK = 64


def _neighbours(df: DataFrame, n_rows: int, n_cols: int, periodic: bool) -> DataFrame:
    """Columns n, s (next and previous row), e, w (next and previous column) of ``value``; holes stay holes.

    One shuffle, by block of rows: a block's first and last rows are sent to the
    blocks beside it as well, and across a seam the first and last columns are
    sent beyond each other.  Copies are dropped in the end.
    """
    row, col = F.col("row"), F.col("col")
    own = F.expr(f"row div {BLOCK}")
    sent = [F.array(F.struct(own.alias("block"), col.alias("at")))]
    for test, block in ((F.pmod(row, F.lit(BLOCK)) == 0, own - 1), (F.pmod(row, F.lit(BLOCK)) == BLOCK - 1, own + 1)):
        sent.append(F.when(test, F.array(F.struct(block.alias("block"), col.alias("at")))))
    if periodic:
        for test, at in ((col == 0, F.lit(n_cols).cast("long")), (col == n_cols - 1, F.lit(-1).cast("long"))):
            sent.append(F.when(test, F.array(F.struct(own.alias("block"), at.alias("at")))))
    none = F.array().cast("array<struct<block:bigint,at:bigint>>")
    spread = df.withColumns({"row": row.cast("long"), "col": col.cast("long")}).withColumn("_s", F.explode(F.concat(*[F.coalesce(x.cast("array<struct<block:bigint,at:bigint>>"), none) for x in sent])))
    dealt = spread.select(*df.columns, F.col("_s.block").alias("_block"), F.col("_s.at").alias("_at")).repartition("_block")
    by_col, by_row = Window.partitionBy("_block", "_at").orderBy("row"), Window.partitionBy("_block", "row").orderBy("_at")
    at = lambda w, d: F.first("value").over(w.rangeBetween(d, d))
    out = dealt.withColumns({"n": at(by_col, 1), "s": at(by_col, -1)}).withColumns({"e": at(by_row, 1), "w": at(by_row, -1)})
    return out.where((F.col("_block") == own) & (F.col("_at") == F.col("col"))).drop("_block", "_at")


def slopes(raster: Raster, sphere: float = R_AREA) -> DataFrame:
    """slope_x (east) and slope_y (north) of elevation in metres, with the pixel's weight.

    One-sided at physical edges, across the seam where longitudes are periodic;
    a missing centre or stencil value leaves both undefined (null), and so does
    the pole eastward.
    """
    n_rows, n_cols = len(raster.lats), len(raster.lons)
    clean = raster.with_df(raster.df.withColumn("value", F.when(finite(F.col("value")), F.col("value").cast("double"))))
    d = _neighbours(clean.weighted(), n_rows, n_cols, raster.periodic)
    lat, lon, here = math.radians(raster.lat_step) * sphere, math.radians(float(raster.lon_step)) * sphere, F.col("value")
    north = F.when(F.col("row") == 0, (F.col("n") - here) / lat).when(F.col("row") == n_rows - 1, (here - F.col("s")) / lat).otherwise((F.col("n") - F.col("s")) / (2 * lat))
    east = (F.col("e") - F.col("w")) / (2 * lon)
    if not raster.periodic:
        east = F.when(F.col("col") == 0, (F.col("e") - here) / lon).when(F.col("col") == n_cols - 1, (here - F.col("w")) / lon).otherwise(east)
    cos = F.cos(F.radians("lat"))
    out = d.withColumns({"slope_y": F.when(here.isNotNull(), north), "slope_x": F.when(here.isNotNull() & (F.abs(cos) > 1e-12), east / cos)})
    return out.drop("n", "s", "e", "w")


def legacy_slopes(df: DataFrame, lat_step: float, lon_step: float, wrap_after: int | None = None, fill: float | None = None, sphere: float = R_LEGACY) -> DataFrame:
    """The older slopes: differences of indices over a cropped raster, one-sided at its edge.

    The centre's own value is not asked for; columns whose eastward metre step
    is under one, and the two columns at a wrap seam, are undefined.  ``fill``
    replaces non-finite elevations before differencing.
    """
    value = F.when(finite(F.col("value")), F.col("value").cast("double")).otherwise(F.lit(fill).cast("double"))
    low = df.agg(F.min("row"), F.max("row"), F.min("col"), F.max("col")).first()
    d = _neighbours(df.withColumn("value", value), 0, 0, False)
    ym, xm = sphere * math.radians(lat_step), sphere * math.radians(lon_step) * F.cos(F.radians("lat"))
    here = F.col("value")
    dy = F.when(F.col("row") == low[0], F.col("n") - here).when(F.col("row") == low[1], here - F.col("s")).otherwise((F.col("n") - F.col("s")) / 2)
    dx = F.when(F.col("col") == low[2], F.col("e") - here).when(F.col("col") == low[3], here - F.col("w")).otherwise((F.col("e") - F.col("w")) / 2)
    seam = F.lit(False) if wrap_after is None else F.col("col").isin([wrap_after, wrap_after + 1])
    return d.withColumns({"slope_x": F.when((F.abs(xm) >= 1) & ~seam, dx / xm), "slope_y": dy / ym}).drop("n", "s", "e", "w")
