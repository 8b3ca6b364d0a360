"""Declarative dataset recipes: sources, renames, joins on points, constants repeated over dates."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import finite
from ..storage import stored

#: Recipes in brief (fixed values): source name, its variables, their output names; dates from, to, hours.
DATES = ("1979-01-01", "2027-01-01", 8760)
RECIPES = {
    "carra2": [
        ("fractions", ["sea", "lake", "nature", "urban", "glacier", "forest"], ["sea", "lake", "nature", "urban", "glacier", "forest"]),
        ("tree_height", ["mean"], ["treeheight"]),
        ("std_100", ["std_oro_100km"], ["sdor_100"]),
        ("std_30", ["std_oro_30km"], ["sdor_30"]),
        ("std_2p5", ["std"], ["sdor_2p5"]),
        ("slope_100", ["orography_slope_x", "orography_slope_y"], ["slor_x_100", "slor_y_100"]),
        ("slope_30", ["orography_slope_x", "orography_slope_y"], ["slor_x_30", "slor_y_30"]),
        ("slope_2p5", ["slope_x", "slope_y"], ["slor_x_2p5", "slor_y_2p5"]),
    ],
    "metcoop": [
        ("fractions", ["sea", "lake", "nature", "urban", "glacier", "forest"], ["sea", "lake", "nature", "urban", "glacier", "forest"]),
        ("tree_height", ["mean"], ["treeheight"]),
        ("std_100", ["std"], ["sdor_100"]),
        ("std_30", ["std"], ["sdor_30"]),
        ("std_2p5", ["std"], ["sdor_2p5"]),
        ("slope_100", ["slope_x", "slope_y"], ["slor_x_100", "slor_y_100"]),
        ("slope_30", ["slope_x", "slope_y"], ["slor_x_30", "slor_y_30"]),
        ("slope_2p5", ["slope_x", "slope_y"], ["slor_x_2p5", "slor_y_2p5"]),
    ],
    "n320": [
        ("fractions", None, None),
        ("tree_height", ["h_tree_mean"], ["h_tree_mean"]),
        ("std_100", ["orography_std"], ["sdor_100"]),
        ("std_30", ["orography_std"], ["sdor_30"]),
        ("slope_100", ["orography_slope_x", "orography_slope_y"], ["slor_x_100", "slor_y_100"]),
        ("slope_30", ["orography_slope_x", "orography_slope_y"], ["slor_x_30", "slor_y_30"]),
    ],
    "o96": [
        ("fractions", None, None),
        ("tree_height", ["h_tree_mean"], ["h_tree_mean"]),
        ("std_100", ["orography_std"], ["sdor_100"]),
        ("slope_100", ["orography_slope_x", "orography_slope_y"], ["slor_x_100", "slor_y_100"]),
    ],
}


def source(df: DataFrame, key: str, variables: list[str] | None = None, names: list[str] | None = None) -> DataFrame:
    """A source's key and chosen variables (None: all), renamed."""
    variables = variables or [c for c in df.columns if c != key]
    return df.select(key, *[F.col(f"`{v}`").alias(n) for v, n in zip(variables, names or variables, strict=True)])


def joined(frames: list[DataFrame], key: str, check: bool = True) -> DataFrame:
    """Sources joined by point; all must have the same points, which one pass over the outer join decides."""
    if not check:
        return functools.reduce(lambda a, b: a.join(b, key), frames)
    names = [c for f in frames for c in f.columns if c != key]
    if clash := sorted({c for c in names if names.count(c) > 1}):
        raise ValueError(f"several sources have {clash}")
    marks = [f"_has{i}" for i in range(len(frames))]
    every = stored(functools.reduce(lambda a, b: a.join(b, key, "full_outer"), [f.withColumn(m, F.lit(True)) for f, m in zip(frames, marks, strict=True)]), "recipe")
    gaps = every.agg(*[F.count_if(F.col(m).isNull()).alias(m) for m in marks]).first()
    if any(gaps):
        raise ValueError(f"the sources' points differ: they lack {list(gaps)} of all")
    return every.drop(*marks)


def piped(df: DataFrame, steps: list[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Transforms in order."""
    return functools.reduce(lambda d, f: d.transform(f), steps, df)


def dates(spark: SparkSession, start: str = DATES[0], end: str = DATES[1], hours: int = DATES[2]) -> DataFrame:
    """The stamps of a range, ends included."""
    return spark.range(1).select(F.explode(F.expr(f"sequence(timestamp_ntz'{start}', timestamp_ntz'{end}', interval {int(hours)} hours)")).alias("date"))


def repeated(df: DataFrame, stamps: DataFrame) -> DataFrame:
    """Constant fields at every date; the few dates are the small side."""
    return F.broadcast(stamps).crossJoin(df)


def statistics(df: DataFrame, variables: list[str], allow_nans: bool = False) -> DataFrame:
    """(variable, mean, stdev, minimum, maximum); a missing value is an error unless allowed."""
    if not allow_nans:
        bad = df.agg(*[F.count_if(~finite(F.col(v))).alias(v) for v in variables]).first().asDict()
        if any(bad.values()):
            raise ValueError(f"missing values: { {k: n for k, n in bad.items() if n} }")
    row = df.agg(*[e for i, v in enumerate(variables) for e in (F.avg(v).alias(f"a{i}"), F.stddev_pop(v).alias(f"s{i}"), F.min(v).alias(f"l{i}"), F.max(v).alias(f"h{i}"))])
    return row.select(F.inline(F.array(*[F.struct(F.lit(v).alias("variable"), F.col(f"a{i}").alias("mean"), F.col(f"s{i}").alias("stdev"), F.col(f"l{i}").alias("minimum"), F.col(f"h{i}").alias("maximum")) for i, v in enumerate(variables)])))


def build(name: str, sources: dict[str, DataFrame], key: str = "point_idx", check: bool = True) -> DataFrame:
    """A named recipe's dataset: joined sources at all dates."""
    frames = [source(sources[s], key, v, n) for s, v, n in RECIPES[name]]
    out = joined(frames, key, check)
    return repeated(out, dates(out.sparkSession))


def write_dataset(df: DataFrame, path: str) -> None:
    """Parquet by date."""
    df.write.mode("overwrite").partitionBy("date").parquet(path)
