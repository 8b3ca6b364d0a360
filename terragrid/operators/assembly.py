"""Dataset assembly: merging, model-file cleaning, derived columns."""

from __future__ import annotations

import functools
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import finite

#: Land-cover class names (fixed values), from code 1 on.
COVER_NAMES = (
    "sea and oceans", "lakes", "rivers", "bare land", "bare rock", "permanent snow", "boreal broadleaf deciduous", "temperate broadleaf deciduous", "tropical broadleaf deciduous",
    "temperate broadleaf evergreen", "tropical broadleaf evergreen", "boreal needleleaf evergreen", "temperate needleleaf evergreen", "boreal needleleaf deciduous", "shrubs",
    "boreal grassland", "temperate grassland", "tropical grassland", "winter C3 crops", "summer C3 crops", "C4 crops", "flooded trees", "flooded grassland",
    "LCZ1: compact high-rise", "LCZ2: compact midrise", "LCZ3: compact low-rise", "LCZ4: open high-rise", "LCZ5: open midrise", "LCZ6: open low-rise",
    "LCZ7: lightweight low-rise", "LCZ8: large low-rise", "LCZ9: sparsely built", "LCZ10: heavy industry",
)
#: Missing value of model files.
SENTINEL = 1e20


def merge(frames: list[DataFrame], on: list[str]) -> DataFrame:
    """Frames joined on shared coordinates, rows of any kept."""
    return functools.reduce(lambda a, b: a.join(b, on, "full_outer"), frames)


def cover_name(code: Column) -> Column:
    """A class's name, or the code as text."""
    names = F.create_map(*[F.lit(x) for i, n in enumerate(COVER_NAMES, 1) for x in (i, n)])
    return F.coalesce(F.try_element_at(names, code.cast("int")), code.cast("int").cast("string"))


def clean_sentinel(df: DataFrame, columns: list[str], zs: str | None = None) -> DataFrame:
    """The sentinel becomes null; of ``zs`` values under -100 become -99.9."""
    out = df.withColumns({c: F.when(finite(F.col(f"`{c}`")) & (F.col(f"`{c}`") != SENTINEL), F.col(f"`{c}`")) for c in columns})
    return out.withColumn(zs, F.when(F.col(f"`{zs}`") < -100, -99.9).otherwise(F.col(f"`{zs}`"))) if zs else out


def where_nature(value: Column, patch: Column, nature: Column) -> Column:
    """Zero where a patch is missing though there is nature, else the value."""
    return F.when(~finite(patch) & (nature > 0), 0.0).otherwise(value)


def axial(df: DataFrame, pairs: list[tuple[str, str]], angle_unit: str = "radians") -> DataFrame:
    """For every (norm, direction) the columns norm_x and norm_y of the doubled angle."""
    turn = F.radians if angle_unit == "degrees" else lambda c: c
    return df.withColumns({f"{m}_{k}": F.col(m) * f(2 * turn(F.col(d))) for m, d in pairs for k, f in (("x", F.cos), ("y", F.sin))})


def valley_pairs(columns: list[str]) -> list[tuple[str, str]]:
    """Norm columns with their direction columns, by name."""
    return [(c, d) for c in columns if "VALLEY_NORM" in c and (d := re.sub("NORM", "DIR", c)) in columns]


def fill_gaps(df: DataFrame, first: dict[str, float] | None = None) -> DataFrame:
    """Nulls and NaN filled: named columns first, then zero."""
    own = {c: v for c, v in (first or {"SSO_ANIS": 1.0}).items() if c in df.columns}
    return (df.fillna(own) if own else df).fillna(0.0)


def prefixed(df: DataFrame, variable: str, keys: list[str]) -> DataFrame:
    """All columns but the keys renamed to ``variable_column``."""
    return df.withColumnsRenamed({c: f"{variable}_{c}" for c in df.columns if c not in keys})


def stacked(df: DataFrame, keys: list[str]) -> DataFrame:
    """Wide to long: keys, variable, value."""
    return df.unpivot(keys, [c for c in df.columns if c not in keys], "variable", "value")


def first_available(name: str, *frames: DataFrame) -> DataFrame:
    """The first frame that has the variable; none is an error."""
    for f in frames:
        if name in f.columns:
            return f.select(name)
    raise ValueError(f"variable {name!r} is in none of the files")


def accumulated_difference(df: DataFrame, column: str, lag: int, keys: list[str], time: str = "time") -> DataFrame:
    """Values less those ``lag`` steps before, by key and in order of time."""
    from pyspark.sql import Window

    return df.withColumn(f"{column}_diff", F.col(column) - F.lag(column, lag).over(Window.partitionBy(*keys).orderBy(time)))


def zoomed(df: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Finite values inside (west, east, south, north), ends included."""
    w, e, s, n = box
    return df.where(F.col("lon").between(w, e) & F.col("lat").between(s, n) & finite(F.col("value")))


def inside_open(df: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Rows inside (west, east, south, north), ends left out."""
    w, e, s, n = box
    return df.where((F.col("lon") > w) & (F.col("lon") < e) & (F.col("lat") > s) & (F.col("lat") < n))


def celsius(df: DataFrame, columns: list[str]) -> DataFrame:
    """Kelvin columns in degrees Celsius."""
    return df.withColumns({c: F.col(f"`{c}`") - 273.15 for c in columns})


def at_time(df: DataFrame, stamp: str) -> DataFrame:
    """``df`` with a constant column ``time``."""
    return df.withColumn("time", F.lit(stamp).cast("timestamp_ntz"))
