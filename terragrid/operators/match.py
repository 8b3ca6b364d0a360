"""Matching source pixels to targets: native cell, radius neighbourhoods, nearest points."""

from __future__ import annotations

import itertools
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import chord, geodesic_distance, unit_vector
from ..sources.grid import Grid
from ..storage import stored


def native(pixels: DataFrame, grid: Grid) -> DataFrame:
    """Pixels with the one cell each lies in: a computed key, no join."""
    return pixels.withColumn("cell", grid.locate(F.col("lon"), F.col("lat"))).where("cell is not null")


def _keyed(df: DataFrame, size: float) -> DataFrame:
    x, y, z = unit_vector(F.col("lon"), F.col("lat"))
    out = df.withColumns({"_x": x, "_y": y, "_z": z})
    return out.withColumns({f"_k{c}": F.floor(F.col(f"_{c}") / size) for c in "xyz"})


def _near(targets: DataFrame, size: float) -> DataFrame:
    """Targets under the 27 hash cells around their own, coordinates renamed."""
    around = F.explode(F.array(*[F.struct(*[F.lit(v).cast("long").alias(c) for v, c in zip(d, "xyz", strict=True)]) for d in itertools.product((-1, 0, 1), repeat=3)]))
    t = _keyed(targets, size).withColumn("_d", around)
    return t.select(*[c for c in targets.columns if c not in ("lon", "lat")], F.col("lon").alias("_tlon"), F.col("lat").alias("_tlat"), *[F.col(f"_{c}").alias(f"_t{c}") for c in "xyz"], *[(F.col(f"_k{c}") + F.col(f"_d.{c}")).alias(f"_k{c}") for c in "xyz"])


def _d2():
    return sum((F.col(f"_{c}") - F.col(f"_t{c}")) ** 2 for c in "xyz")


def _drop(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def radius(pixels: DataFrame, targets: DataFrame, radius_m: float, sphere: float) -> DataFrame:
    """All (pixel, target) pairs within a great-circle radius, both ends included.

    An equi-join on a three-dimensional hash grid whose cells are one chord
    wide: targets stand under 27 cells, pixels under one, and the chord decides.
    """
    if not (math.isfinite(radius_m) and 0 < radius_m <= math.pi * sphere):
        raise ValueError("the radius must be finite and lie in (0, pi R]")
    c = chord(radius_m, sphere)
    return _drop(_keyed(pixels, c).join(_near(targets, c), [f"_k{k}" for k in "xyz"]).where(_d2() <= c * c))


def geodesic_radius(pixels: DataFrame, targets: DataFrame, radius_m: float, sphere: float = 6371000.0) -> DataFrame:
    """Pairs within a WGS84 geodesic radius: chord candidates one hundredth wider, then the geodesic decides."""
    c = 1.01 * chord(radius_m, sphere)
    pairs = _keyed(pixels, c).join(_near(targets, c), [f"_k{k}" for k in "xyz"]).where(_d2() <= c * c)
    return _drop(pairs.withColumn("_m", geodesic_distance()(F.col("lon"), F.col("lat"), F.col("_tlon"), F.col("_tlat"))).where(F.col("_m") <= radius_m))


def nearest(pixels: DataFrame, targets: DataFrame, pixel_key: list[str], k: int = 1, spacing: float | None = None) -> DataFrame:
    """The ``k`` nearest targets (target_id) of every pixel on the sphere, with ``d2``, the squared chord, and ``rank`` from 1.

    Rings of hash cells, each twice as wide as the last: a pixel is settled once
    its k-th candidate is no farther than a cell is wide, for then no target
    outside the ring is nearer.  Of equal distances the smallest id comes first.
    """
    n = targets.count()
    if not n:
        raise ValueError("there are no targets")
    size = spacing or min(2.0, 2 * math.sqrt(4 * math.pi / n))
    k, rest, out = min(k, n), pixels, None
    by_pixel = Window.partitionBy(*pixel_key)
    while True:
        pairs = _keyed(rest, size).join(_near(targets, size), [f"_k{c}" for c in "xyz"]).select(*pixels.columns, "target_id", _d2().alias("d2"))
        best = pairs.withColumn("rank", F.row_number().over(by_pixel.orderBy("d2", "target_id"))).where(F.col("rank") <= k)  # limited before the shuffle
        last = size >= 2
        if not last:
            best = best.withColumn("_far", F.max("d2").over(by_pixel)).withColumn("_n", F.max("rank").over(by_pixel)).where((F.col("_n") == k) & (F.col("_far") <= size * size)).drop("_far", "_n")
        done = stored(best, "nearest")
        out = done if out is None else out.unionByName(done)
        if last:
            return out
        rest = stored(rest.join(done.where("rank = 1").select(*pixel_key), pixel_key, "left_anti"), "unsettled")
        if rest.isEmpty():
            return out
        size = min(2.0, 2 * size)


def planar_nearest(pixels: DataFrame, grid: Grid, max_radius_m: float | None = None) -> DataFrame:
    """The older cell assignment: edges of a north-up rectangle, no snapping; with a radius, far pixels are dropped."""
    xmin, _, xmax, ymax = grid.extent
    dx, dy = abs(grid.dx), abs(grid.dy)
    x, y = grid.projection.forward(F.col("lon"), F.col("lat"))
    col, row = F.floor((F.col("_x") - xmin) / dx).cast("long"), F.floor((ymax - F.col("_y")) / dy).cast("long")
    out = pixels.withColumns({"_x": x, "_y": y}).withColumns({"_c": col, "_r": row}).where((F.col("_c") >= 0) & (F.col("_c") < grid.nx) & (F.col("_r") >= 0) & (F.col("_r") < grid.ny))
    if max_radius_m is not None:
        off = F.hypot(F.col("_x") - (xmin + (F.col("_c") + 0.5) * dx), F.col("_y") - (ymax - (F.col("_r") + 0.5) * dy))
        out = out.where(off <= max_radius_m)
    return _drop(out.withColumn("cell", F.col("_r") * grid.nx + F.col("_c")))


def planar_radius(pixels: DataFrame, grid: Grid, max_radius_m: float) -> DataFrame:
    """All cells whose centres lie within a planar radius of a pixel; pixels outside the rectangle count too."""
    xmin, _, _, ymax = grid.extent
    dx, dy = abs(grid.dx), abs(grid.dy)
    x, y = grid.projection.forward(F.col("lon"), F.col("lat"))
    around = lambda d: F.explode(F.sequence(F.lit(-math.ceil(max_radius_m / d)).cast("long"), F.lit(math.ceil(max_radius_m / d)).cast("long")))
    p = pixels.withColumns({"_x": x, "_y": y}).withColumns({"_c": F.floor((F.col("_x") - xmin) / dx).cast("long"), "_r": F.floor((ymax - F.col("_y")) / dy).cast("long")})
    reach_x, reach_y = math.ceil(max_radius_m / dx), math.ceil(max_radius_m / dy)
    p = p.where((F.col("_c") >= -reach_x) & (F.col("_c") < grid.nx + reach_x) & (F.col("_r") >= -reach_y) & (F.col("_r") < grid.ny + reach_y))
    p = p.withColumn("_i", around(dx)).withColumn("_j", around(dy)).withColumns({"_c": F.col("_c") + F.col("_i"), "_r": F.col("_r") + F.col("_j")})
    near = F.hypot(F.col("_x") - (xmin + (F.col("_c") + 0.5) * dx), F.col("_y") - (ymax - (F.col("_r") + 0.5) * dy)) <= max_radius_m
    inside = (F.col("_c") >= 0) & (F.col("_c") < grid.nx) & (F.col("_r") >= 0) & (F.col("_r") < grid.ny)
    return _drop(p.where(inside & near).withColumn("cell", F.col("_r") * grid.nx + F.col("_c")))


def clipped(pairs: DataFrame, radius_m: float) -> DataFrame:
    """Matches (lon, lat, tlon, tlat) no farther apart than a WGS84 geodesic radius, end included."""
    away = geodesic_distance()(F.col("lon"), F.col("lat"), F.col("tlon"), F.col("tlat"))
    return pairs.withColumn("_m", away).where(F.col("_m") <= radius_m).drop("_m")


#: Halvings of the extent in the search for the closest pair.
LEVELS = 40


def closest_spacing(points: DataFrame) -> float | None:
    """The least distance between two of the points (x, y); None with fewer than two, an error if two coincide.

    The extent is halved until no cell holds two points; one step above that, a
    cell holds four at most and the closest pair lies two cells apart at most.
    So no task compares many points, however they are clustered.
    """
    own = stored(points.select(F.col("x").cast("double"), F.col("y").cast("double")).where("x is not null and y is not null and not isnan(x) and not isnan(y)"), "points")
    w = own.agg(F.count("*").alias("n"), F.min("x").alias("x"), F.min("y").alias("y"), F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y")).alias("size")).first()
    if w.n < 2:
        return None
    if not own.groupBy("x", "y").count().where("count > 1").isEmpty():
        raise ValueError("two points coincide")
    cell = lambda v, at, size: F.floor((F.col(v) - at) / size).cast("long")
    size = w["size"] / F.pow(F.lit(2.0), F.col("level"))
    held = own.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS)))).groupBy("level", cell("x", w.x, size).alias("i"), cell("y", w.y, size).alias("j")).count()
    level = held.where("count > 1").agg(F.max("level")).first()[0]
    width = w["size"] if level is None else w["size"] / 2.0**level
    placed = own.withColumns({"i": cell("x", w.x, width), "j": cell("y", w.y, width)})
    around = lambda k: F.explode(F.sequence(F.col(k) - 2, F.col(k) + 2))
    other = placed.select(F.col("x").alias("x2"), F.col("y").alias("y2"), around("i").alias("i"), "j").withColumn("j", around("j"))
    return placed.join(other, ["i", "j"]).where("x <> x2 or y <> y2").agg(F.min(F.hypot(F.col("x") - F.col("x2"), F.col("y") - F.col("y2")))).first()[0]


def marker_area(spacing: float, dpi: float) -> float:
    """Area in square points of the largest marker that leaves a twentieth of the closest spacing (in dots) free."""
    return (0.95 * spacing * 72 / dpi) ** 2
