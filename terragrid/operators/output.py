"""Results on the whole target set: status, fills, warnings, metadata, sinks."""

from __future__ import annotations

import json
import re
import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MISSING, UNCOVERED = 1, 2


def complete(stats: DataFrame, targets: DataFrame, key: str, values: list[str], mode: str, fill_missing: float | None = None, fill_uncovered: float | None = None, tell: bool = False) -> DataFrame:
    """Every target with its statistics and ``<name>_data_status``: 1 pixels but none valid, 2 no pixels, else 0."""
    out = targets.join(stats, key, "left")
    covered, valid = F.coalesce("source_count", F.lit(0)) > 0, F.coalesce("valid_count", F.lit(0)) > 0
    status = F.when(~covered, UNCOVERED).when(~valid, MISSING).otherwise(0).cast("byte")
    name = f"{mode}_data_status"
    zero = {c: F.coalesce(c, F.lit(0.0 if "area" in c else 0)) for c in ("source_area", "valid_area", "source_count", "valid_count")}
    out = out.withColumn(name, status).withColumns(zero)
    if tell:
        n = out.agg(F.count_if(F.col(name) == MISSING).alias("missing"), F.count_if(F.col(name) == UNCOVERED).alias("uncovered")).first()
        for what, count, fill in (("have no valid source value", n.missing, fill_missing), ("have no source pixel", n.uncovered, fill_uncovered)):
            if count:
                warnings.warn(f"{count} targets {what}; " + ("left undefined" if fill is None else f"filled with {fill:g}"), stacklevel=2)
    for v in values:
        if fill_missing is not None:
            out = out.withColumn(v, F.when(F.col(name) == MISSING, F.lit(float(fill_missing))).otherwise(F.col(v)))
        if fill_uncovered is not None:
            out = out.withColumn(v, F.when(F.col(name) == UNCOVERED, F.lit(float(fill_uncovered))).otherwise(F.col(v)))
    return out


def with_units(df: DataFrame, units: dict[str, str], methods: dict[str, str] | None = None) -> DataFrame:
    """Columns with units and cell methods in their metadata."""
    for c in df.columns:
        if c in units:
            df = df.withMetadata(c, {"units": units[c]} | ({"cell_methods": methods[c]} if methods and c in methods else {}))
    return df


def category_text(categories: dict[str, list[int]]) -> str:
    """Categories as ``name: a,b; ...``."""
    return "; ".join(f"{n}: {','.join(map(str, c))}" for n, c in categories.items())


def write_result(df: DataFrame, path: str, provenance: dict, undefined: str = "null", sort: list[str] | None = None) -> None:
    """Parquet at ``path``, and the provenance beside it at ``path_provenance`` as JSON lines; ``undefined="nan"`` writes NaN for null doubles."""
    if undefined == "nan":
        df = df.withColumns({c: F.coalesce(c, F.lit(float("nan"))) for c, t in df.dtypes if t == "double"})
    (df.sortWithinPartitions(*sort) if sort else df).write.mode("overwrite").parquet(path)
    df.sparkSession.createDataFrame([(json.dumps(provenance, sort_keys=True),)], "value string").write.mode("overwrite").text(f"{path.rstrip('/')}_provenance")


def finite_or(df: DataFrame, columns: list[str], fill: float) -> DataFrame:
    """Older output filling: every non-finite or null value of continuous columns becomes ``fill``."""
    from ..functions.geo import nan_to_num

    return df.withColumns({c: nan_to_num(F.col(c), fill) for c in columns})


def safe_names(names: list[str]) -> list[str]:
    """Names with anything but letters, digits, dot, underscore and hyphen replaced; two alike are an error."""
    out = [re.sub(r"[^A-Za-z0-9_.-]", "_", n) for n in names]
    if len(set(out)) < len(out):
        raise ValueError("two variables have the same file name")
    return out
