"""Spherical geometry and map projections as Column expressions (and the same for driver-side floats)."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Earth figures (fixed values): areas, new slope and radius; legacy slope and margins; model geometry; WGS84.
R_AREA, R_LEGACY, R_MODEL = 6371229.0, 6371000.0, 6371220.0
WGS84_A, WGS84_F = 6378137.0, 1 / 298.257223563
EPS = 2.220446049250313e-16


class _Numeric:
    """The functions that the formulas use, for numpy values."""

    sin, cos, tan, atan, atan2, sqrt, log, exp, floor, rint, hypot = np.sin, np.cos, np.tan, np.arctan, np.arctan2, np.sqrt, np.log, np.exp, np.floor, np.rint, np.hypot
    pow = staticmethod(np.power)
    pmod = staticmethod(np.mod)
    radians, degrees = np.radians, np.degrees


def _ops(*values):
    return F if any(isinstance(v, Column) for v in values) else _Numeric


def finite(v: Column) -> Column:
    """Neither null, NaN nor infinite (never null itself)."""
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))


def nan_to_num(v: Column, fill: float) -> Column:
    """NaN and infinities replaced by one value; nulls too."""
    return F.when(finite(v), v).otherwise(F.lit(float(fill)))


def unit_vector(lon, lat) -> tuple:
    f = _ops(lon, lat)
    lam, phi = f.radians(lon), f.radians(lat)
    return f.cos(phi) * f.cos(lam), f.cos(phi) * f.sin(lam), f.sin(phi)


def chord(radius_m: float, sphere: float = R_AREA) -> float:
    """Chord of the unit sphere under a great-circle distance."""
    return 2 * math.sin(radius_m / (2 * sphere))


def half_angle_degrees(radius_m: float, sphere: float = R_AREA) -> float:
    return math.degrees(radius_m / sphere)


def wrap180(lon):
    """Longitude in [-180, 180)."""
    f = _ops(lon)
    return f.pmod(lon + 180.0, F.lit(360.0) if f is F else 360.0) - 180.0


def match_convention(lon: Column, reference_max: float) -> Column:
    """Longitudes in the reference's convention: 0 to 360 if it exceeds 180, else -180 to 180."""
    return F.pmod(lon, F.lit(360.0)) if reference_max > 180 else wrap180(lon)


def pixel_area(lat: Column, lat_step: float, lon_step: float, sphere: float = R_AREA) -> Column:
    """Area of a pixel whose edges lie half a step away, clipped at the poles."""
    half = abs(lat_step) / 2
    top, low = F.least(lat + half, F.lit(90.0)), F.greatest(lat - half, F.lit(-90.0))
    return F.lit(sphere * sphere) * F.abs(F.sin(F.radians(top)) - F.sin(F.radians(low))) * F.lit(math.radians(abs(lon_step)))


def snapped(v: Column) -> Column:
    """Values within 16 ulp of an integer put on it, so that exact edges stay exact."""
    near = F.rint(v)
    return F.when(F.abs(v - near) <= 16 * EPS * F.greatest(F.lit(1.0), F.abs(v)), near).otherwise(v)


@dataclass(frozen=True)
class Projection:
    """A spherical map projection in metres: ``stere`` (polar) or ``lcc``."""

    kind: str
    lat_0: float
    lon_0: float
    radius: float = R_AREA
    lat_1: float | None = None
    lat_2: float | None = None
    false_easting: float = 0.0
    false_northing: float = 0.0

    def __post_init__(self):
        if self.kind not in ("stere", "lcc"):
            raise ValueError(f"projection {self.kind!r} is not supported: stere and lcc on a sphere are")
        if self.kind == "stere" and abs(self.lat_0) != 90:
            raise ValueError("a stereographic projection must be polar (lat_0 = 90 or -90)")
        if not self.radius > 0:
            raise ValueError("the sphere's radius must be positive")
        if self.kind == "lcc" and any(abs(p) >= 90 or p == 0 for p in self.parallels):
            raise ValueError("standard parallels must lie between the equator and a pole")

    @property
    def parallels(self) -> tuple[float, float]:
        one = self.lat_0 if self.lat_1 is None else self.lat_1
        return one, one if self.lat_2 is None else self.lat_2

    def _cone(self) -> tuple[float, float, float]:
        p1, p2 = map(math.radians, self.parallels)
        up = lambda p: math.tan(math.pi / 4 + p / 2)
        n = math.sin(p1) if abs(p1 - p2) < 1e-12 else math.log(math.cos(p1) / math.cos(p2)) / math.log(up(p2) / up(p1))
        big = math.cos(p1) * up(p1) ** n / n
        return n, big, self.radius * big / up(math.radians(self.lat_0)) ** n

    def forward(self, lon, lat) -> tuple:
        """Degrees to metres."""
        f = _ops(lon, lat)
        lam, phi = f.radians(wrap180(lon - self.lon_0)), f.radians(lat)
        if self.kind == "stere":
            s = 1.0 if self.lat_0 > 0 else -1.0
            rho = 2 * self.radius * f.tan(math.pi / 4 - s * phi / 2)
            return self.false_easting + rho * f.sin(lam), self.false_northing - s * rho * f.cos(lam)
        n, big, rho0 = self._cone()
        rho = self.radius * big / f.pow(f.tan(math.pi / 4 + phi / 2), n)
        return self.false_easting + rho * f.sin(n * lam), self.false_northing + rho0 - rho * f.cos(n * lam)

    def inverse(self, x, y) -> tuple:
        """Metres to degrees."""
        f = _ops(x, y)
        dx, dy = x - self.false_easting, y - self.false_northing
        if self.kind == "stere":
            s = 1.0 if self.lat_0 > 0 else -1.0
            rho = f.hypot(dx, dy)
            lam, phi = f.atan2(dx, -s * dy), s * (math.pi / 2 - 2 * f.atan(rho / (2 * self.radius)))
        else:
            n, big, rho0 = self._cone()
            s = 1.0 if n > 0 else -1.0
            rho = s * f.hypot(dx, rho0 - dy)
            lam = f.atan2(s * dx, s * (rho0 - dy)) / n
            phi = 2 * f.atan(f.pow(self.radius * big / rho, 1 / n)) - math.pi / 2
        return wrap180(f.degrees(lam) + self.lon_0), f.degrees(phi)


def geodesic_distance():
    """WGS84 geodesic length in metres of (lon1, lat1, lon2, lat2), Vincenty's inverse in Arrow batches."""
    @F.pandas_udf("double")
    def distance(lon1: pd.Series, lat1: pd.Series, lon2: pd.Series, lat2: pd.Series) -> pd.Series:
        return pd.Series(vincenty(*(np.asarray(v, float) for v in (lon1, lat1, lon2, lat2))))

    return distance


def vincenty(lon1, lat1, lon2, lat2) -> np.ndarray:
    """Vincenty's inverse formula; near-antipodal pairs, where it does not settle, get the great-circle length."""
    a, f = WGS84_A, WGS84_F
    b = a * (1 - f)
    big_l = np.radians((lon2 - lon1 + 180) % 360 - 180)
    u1, u2 = (np.arctan((1 - f) * np.tan(np.radians(v))) for v in (lat1, lat2))
    s1, c1, s2, c2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    lam = np.array(big_l, float)
    with np.errstate(divide="ignore", invalid="ignore"):
        for _ in range(100):
            sl, cl = np.sin(lam), np.cos(lam)
            ss = np.hypot(c2 * sl, c1 * s2 - s1 * c2 * cl)
            cs = s1 * s2 + c1 * c2 * cl
            sigma = np.arctan2(ss, cs)
            sa = np.where(ss > 0, c1 * c2 * sl / ss, 0.0)
            ca2 = 1 - sa * sa
            cm = np.where(ca2 > 1e-15, cs - 2 * s1 * s2 / ca2, 0.0)
            c = f / 16 * ca2 * (4 + f * (4 - 3 * ca2))
            new = big_l + (1 - c) * f * sa * (sigma + c * ss * (cm + c * cs * (2 * cm * cm - 1)))
            done = np.abs(new - lam) < 1e-13
            lam = new
            if np.all(done):
                break
        k2 = ca2 * (a * a - b * b) / (b * b)
        ca = 1 + k2 / 16384 * (4096 + k2 * (-768 + k2 * (320 - 175 * k2)))
        cb = k2 / 1024 * (256 + k2 * (-128 + k2 * (74 - 47 * k2)))
        ds = cb * ss * (cm + cb / 4 * (cs * (2 * cm * cm - 1) - cb / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3)))
        out = b * ca * (sigma - ds)
    return np.where(done, out, a * np.arctan2(ss, cs))
