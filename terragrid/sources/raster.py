"""Source rasters in long form: one row per pixel, with axes checked on the driver."""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import pixel_area
from .grid import regular_axis

LAT_NAMES, LON_NAMES = ("lat", "latitude", "lats"), ("lon", "longitude", "lons")


@dataclass(frozen=True)
class Raster:
    """``df``: row, col, lat, lon, value; ``lats`` and ``lons`` are the axes that row and col index."""

    df: DataFrame
    lats: np.ndarray
    lons: np.ndarray
    periodic: bool

    @classmethod
    def of(cls, df: DataFrame, lats, lons, lat_bounds=None, lon_bounds=None) -> Raster:
        """A raster whose axes are checked: regular, latitudes within the poles, longitudes within one turn, bounds agreeing."""
        missing = {"row", "col", "value"} - set(df.columns)
        if missing:
            raise ValueError(f"the source lacks columns {sorted(missing)}")
        lats = regular_axis(lats, "latitude")
        raw = np.asarray(lons)
        turns = np.unwrap(np.asarray(raw, float), period=360)
        lons = regular_axis(turns.astype(raw.dtype if raw.dtype.kind == "f" else float), "longitude")
        if np.abs(lats).max() > 90 + 1e-9:
            raise ValueError("latitude centres lie beyond a pole")
        step = (lons[-1] - lons[0]) / (len(lons) - 1)
        cover = abs(step) * len(lons)
        if abs(step) >= 180 or cover > 360 * (1 + 1e-5):
            raise ValueError("longitudes cover more than one globe")
        periodic = bool(np.isclose(cover, 360, rtol=0, atol=max(1e-5, 1e-5 * 360 * (raw.dtype == np.float32))))
        for name, axis, bounds in (("latitude", lats, lat_bounds), ("longitude", lons, lon_bounds)):
            if bounds is not None:
                check_bounds(name, axis, np.asarray(bounds, float))
        if not {"lat", "lon"} <= set(df.columns):
            a = (lats[-1] - lats[0]) / (len(lats) - 1)
            df = df.withColumns({"lat": F.lit(float(lats[0])) + F.col("row") * float(a), "lon": F.lit(float(lons[0])) + F.col("col") * float(step)})
        return cls(df.select("row", "col", "lat", "lon", "value"), lats, lons, periodic)

    @property
    def lat_step(self) -> float:
        return float((self.lats[-1] - self.lats[0]) / (len(self.lats) - 1))

    @property
    def lon_step(self) -> float:
        return 360.0 / len(self.lons) * np.sign(self.lons[1] - self.lons[0]) if self.periodic else float((self.lons[-1] - self.lons[0]) / (len(self.lons) - 1))

    def weighted(self) -> DataFrame:
        """The pixels with ``weight``, their spherical area."""
        return self.df.withColumn("weight", pixel_area(F.col("lat"), self.lat_step, float(self.lon_step)))

    def with_df(self, df: DataFrame) -> Raster:
        return replace(self, df=df)


def check_bounds(name: str, axis: np.ndarray, bounds: np.ndarray) -> None:
    """Bounds (n, 2) must lie half a step from the centres; longitudes are compared around them."""
    if bounds.shape != (len(axis), 2):
        raise ValueError(f"{name} bounds have the wrong shape")
    half = abs(axis[1] - axis[0]) / 2
    off = np.sort(bounds - axis[:, None], axis=1)
    if name == "longitude":
        off = np.sort((bounds - axis[:, None] + 180) % 360 - 180, axis=1)
    else:
        off = np.sort(np.clip(bounds, -90, 90) - axis[:, None], axis=1)
    want = np.array([-half, half])
    if name == "latitude":
        want = np.clip(axis[:, None] + want, -90, 90) - axis[:, None]
    if not np.allclose(off, want, rtol=1e-5, atol=1e-6):
        raise ValueError(f"{name} bounds do not agree with the centres")


def find_axis(names: dict[str, str | None], kind: str) -> str:
    """The one column that is the ``lat`` or ``lon`` axis, by standard name or usual name; ``names`` gives each column's standard name."""
    usual, standard = (LAT_NAMES, "latitude") if kind == "lat" else (LON_NAMES, "longitude")
    found = [c for c, s in names.items() if s == standard or c.lower() in usual]
    if len(found) != 1:
        raise ValueError(f"{kind} axis is ambiguous or absent: {found}")
    return found[0]


def find_coord_loose(columns: list[str], kind: str) -> str | None:
    """The older matching: an exact dimension name, else the shortest name that contains lat or lon."""
    exact = [c for c in columns if c.lower() in (("y", "nj") if kind == "lat" else ("x", "ni"))]
    near = sorted((c for c in columns if kind in c.lower()), key=lambda c: (len(c), c))
    return near[0] if near else exact[0] if exact else None


def find_latlon_2d(shapes: dict[str, int]) -> tuple[str, str]:
    """Latitude and longitude names of a target file: two-dimensional ones first, then the shortest; ``shapes`` gives ranks."""
    pick = lambda k: min((c for c in shapes if k in c.lower()), key=lambda c: (-shapes[c], len(c), c), default=None)
    lat, lon = pick("lat"), pick("lon")
    if lat is None or lon is None:
        raise ValueError("no latitude and longitude in the target")
    return lat, lon


def tile_id(rows: int, cols: int):
    """The tile (a ``rows`` x ``cols`` block) of a pixel, as a Column."""
    return F.struct((F.col("row") / rows).cast("long").alias("r"), (F.col("col") / cols).cast("long").alias("c"))


def tile_shape(max_pixels: int, cols: int) -> tuple[int, int]:
    """Rows and columns of the largest tile of ``max_pixels``: whole rows if one fits, else part of one."""
    if max_pixels < 1 or cols < 1:
        raise ValueError("a tile has a pixel at least")
    return max(1, max_pixels // cols), min(cols, max_pixels)


def tile_count(windows: list[tuple[int, int, int, int]], shape: tuple[int, int]) -> int:
    """Tiles of windows (first row, end row, first column, end column), each window cut from its own corner."""
    return sum(-(-max(0, b - a) // shape[0]) * -(-max(0, d - c) // shape[1]) for a, b, c, d in windows)


def spatial_variables(ranks: dict[str, tuple[str, ...]], types: dict[str, str], horizontal: tuple[str, ...]) -> list[str]:
    """Names of the numeric variables that have all ``horizontal`` dimensions, in order of the file."""
    numeric = ("byte", "short", "int", "long", "float", "double", "decimal")
    return [k for k, dims in ranks.items() if set(horizontal) <= set(dims) and types[k].split("(")[0] in numeric]
