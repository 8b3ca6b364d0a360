"""The older, count-based statistics: every sample weighs one, and missing classes stay in the denominator."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import finite, nan_to_num
from .stats import CATEGORIES, check_categories


def legacy_fractions(matched: DataFrame, key: str = "cell", categories: dict | None = None, nan_fill: float | None = None) -> DataFrame:
    """Share of samples in each category; non-finite values count as code 0, or the fill, and codes are clipped to [0, greatest]."""
    codes = check_categories(categories or CATEGORIES)
    most = max(c for own in codes.values() for c in own)
    v = F.least(F.greatest(F.floor(nan_to_num(F.col("value"), nan_fill or 0.0)), F.lit(0)), F.lit(most))
    return matched.groupBy(key).agg(*[(F.count_if(v.isin(own)) / F.count("*")).alias(n) for n, own in codes.items()])


def _valid(fill_value: float | None, nan_fill: float | None) -> tuple:
    v = F.col("value") if nan_fill is None else nan_to_num(F.col("value"), nan_fill)
    ok = finite(v)
    if fill_value is not None:  # compared with the raw value
        ok = ok & ~F.coalesce(F.col("value") == F.lit(float(fill_value)), F.lit(False))
    return v, ok


def legacy_mean(matched: DataFrame, key: str = "cell", name: str = "mean", fill_value: float | None = None, nan_fill: float | None = None) -> DataFrame:
    """Mean of valid samples; null without one."""
    v, ok = _valid(fill_value, nan_fill)
    return matched.groupBy(key).agg(F.avg(F.when(ok, v)).alias(name))


def legacy_std(matched: DataFrame, key: str = "cell", name: str = "std", mean_name: str | None = None, fill_value: float | None = None, nan_fill: float | None = None) -> DataFrame:
    """Sample deviation of valid samples; null for fewer than two."""
    v, ok = _valid(fill_value, nan_fill)
    more = [F.avg(F.when(ok, v)).alias(mean_name)] if mean_name else []
    return matched.groupBy(key).agg(F.stddev_samp(F.when(ok, v)).alias(name), *more)


def legacy_slope(matched: DataFrame, key: str = "cell", variable: str = "orography") -> DataFrame:
    """Means of each slope component over its own valid samples."""
    names = field_names("slope", variable)
    return matched.groupBy(key).agg(*[F.avg(F.when(finite(F.col(c)), F.col(c))).alias(n) for c, n in zip(("slope_x", "slope_y"), names, strict=True)])


def field_names(mode: str, variable: str) -> list[str]:
    """Output names of the older continuous modes."""
    v = variable.lower()
    names = {"mean": [f"{v}_mean"], "std": [f"{v}_std"], "slope": [f"{v}_slope_x", f"{v}_slope_y"]}
    if mode not in names:
        raise ValueError(f"mode {mode!r} is none of {sorted(names)}")
    return names[mode]


def compute_statistics(matched: DataFrame, mode: str = "fractions", key: str = "cell", variable: str = "cover", output_name: str | None = None, include_mean: bool = False, **options) -> DataFrame:
    """The older dispatch by mode."""
    if mode == "fractions":
        return legacy_fractions(matched, key, **options)
    if mode == "mean":
        return legacy_mean(matched, key, output_name or field_names("mean", variable)[0], **options)
    if mode == "std":
        return legacy_std(matched, key, output_name or field_names("std", variable)[0], field_names("mean", variable)[0] if include_mean else None, **options)
    if mode == "slope":
        return legacy_slope(matched, key, variable)
    raise ValueError(f"unknown mode {mode!r}")
