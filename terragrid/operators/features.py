"""Feature similarity: correlations, cosines, quantiles, histograms and clusters."""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import finite

#: Features compared by default (fixed values), in alphabetical order.
FEATURES = (
    "FOREST", "H_TREE", "SFX.AVG_ZS", "SFX.CLAY", "SFX.COVER006", "SFX.FRAC_NATURE", "SFX.FRAC_NATURE_TPI_12500M", "SFX.FRAC_SEA", "SFX.FRAC_TOWN", "SFX.FRAC_WATER",
    "SFX.MAX_ZS", "SFX.MIN_ZS", "SFX.SAND", "SFX.SIL_ZS", "SFX.SSO_ANIS", "SFX.SSO_STDEV", "SFX.ZS_SN_DERIVATIVE_12500M_SIGRATIO1", "SFX.ZS_STD_17500M",
    "SFX.ZS_SX_RADIUS12500_AZIMUTH180", "SFX.ZS_TPI_12500M", "SFX.ZS_VALLEY_NORM_12500M_x", "SFX.ZS_VALLEY_NORM_12500M_y", "SFX.ZS_WE_DERIVATIVE_12500M_SIGRATIO1",
    "subgrid_slope_x", "subgrid_slope_y",
)


def _q(name: str):
    return F.col(f"`{name}`").cast("double")


def _pairs(df: DataFrame, columns: list[str], measure, name: str) -> DataFrame:
    """(a, b, measure) of all ordered pairs, from one aggregation over the rows."""
    both = list(itertools.combinations_with_replacement(columns, 2))
    row = df.agg(*[measure(a, b).alias(f"m{i}") for i, (a, b) in enumerate(both)])
    out = F.array(*[F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"m{i}").alias(name)) for i, (a, b) in enumerate(both) for x, y in dict.fromkeys([(a, b), (b, a)])])
    return row.select(F.inline(out))


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlations of all pairs; each pair over the rows where both are finite."""

    def measure(a, b):
        ok = finite(_q(a)) & finite(_q(b))
        return F.corr(F.when(ok, _q(a)), F.when(ok, _q(b)))

    return _pairs(df, columns, measure, "corr")


def cosines(df: DataFrame, columns: list[str]) -> DataFrame:
    """Cosine similarities of all pairs; zero where a norm is zero."""
    return _pairs(df, columns, lambda a, b: F.coalesce(F.try_divide(F.sum(_q(a) * _q(b)), F.sqrt(F.sum(_q(a) * _q(a))) * F.sqrt(F.sum(_q(b) * _q(b)))), F.lit(0.0)), "cosine")


def land_only(df: DataFrame, mask: str = "SFX.FRAC_SEA") -> DataFrame:
    """Rows without sea."""
    return df.where(F.col(f"`{mask}`") == 0)


def quantiles(df: DataFrame, columns: list[str], low: float = 0.05, high: float = 0.95) -> DataFrame:
    """(variable, low, high): linear-interpolated quantiles of the finite values."""
    row = df.agg(*[F.percentile(F.when(finite(_q(c)), _q(c)), F.array(F.lit(low), F.lit(high))).alias(f"q{i}") for i, c in enumerate(columns)])
    return row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"q{i}")[0].alias("low"), F.col(f"q{i}")[1].alias("high")) for i, c in enumerate(columns)])))


def ranges(df: DataFrame, columns: list[str]) -> DataFrame:
    """(variable, min, max, max_abs) over finite values, one pass."""
    v = lambda c: F.when(finite(_q(c)), _q(c))
    row = df.agg(*[e for i, c in enumerate(columns) for e in (F.min(v(c)).alias(f"a{i}"), F.max(v(c)).alias(f"b{i}"), F.max(F.abs(v(c))).alias(f"c{i}"))])
    return row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"a{i}").alias("min"), F.col(f"b{i}").alias("max"), F.col(f"c{i}").alias("max_abs")) for i, c in enumerate(columns)])))


def histogram(df: DataFrame, column: str) -> DataFrame:
    """(value, n, log_n) of the finite values."""
    return df.where(finite(_q(column))).groupBy(_q(column).alias("value")).agg(F.count("*").alias("n")).withColumn("log_n", F.log("n"))


def mean_abs_correlation(df: DataFrame, columns: list[str]) -> DataFrame:
    """(variable, mean_abs_corr): each variable's mean absolute correlation with the others."""
    return correlations(df, columns).where("a <> b").groupBy(F.col("a").alias("variable")).agg(F.avg(F.abs("corr")).alias("mean_abs_corr"))


def correlation_within(df: DataFrame, groups: dict[int, list[str]]) -> DataFrame:
    """(cluster, variable, mean_abs_corr) by the other variables of each group; null for one alone.  All groups in one pass."""
    rows = [(k, c) for k, own in groups.items() for c in own]
    of = df.sparkSession.createDataFrame(rows, "cluster int, variable string")  # a row a variable
    every = sorted({c for _, c in rows})
    pairs = correlations(df, every).where("a <> b").join(of.withColumnRenamed("variable", "a"), "a").join(of.select(F.col("cluster").alias("k"), F.col("variable").alias("b")), "b").where("cluster = k")
    means = pairs.groupBy("cluster", F.col("a").alias("variable")).agg(F.avg(F.abs("corr")).alias("mean_abs_corr"))
    return of.join(means, ["cluster", "variable"], "left")


def average_linkage(distance: np.ndarray, cut: float = 0.3) -> list[int]:
    """Cluster numbers (from 1, by first member) of average-linkage clustering cut at a distance; the matrix is symmetrised first."""
    d = (np.asarray(distance, float) + np.asarray(distance, float).T) / 2
    groups = [[i] for i in range(len(d))]
    while len(groups) > 1:
        best = min(((float(d[np.ix_(a, b)].mean()), i, j) for (i, a), (j, b) in itertools.combinations(enumerate(groups), 2)), key=lambda x: x)
        if best[0] > cut:
            break
        _, i, j = best
        groups[i] += groups.pop(j)
    out = [0] * len(d)
    for k, g in enumerate(sorted(groups, key=min), 1):
        for i in g:
            out[i] = k
    return out


def clusters(df: DataFrame, columns: list[str], by: str = "corr", cut: float = 0.3) -> DataFrame:
    """(cluster, members): variables whose similarity joins them, one group a row.  Only the small matrix reaches the driver."""
    at = {c: i for i, c in enumerate(columns)}
    m = {k: np.eye(len(columns)) for k in ("corr", "cosine")}
    for k, f in (("corr", correlations), ("cosine", cosines)):
        if by in (k, "both"):
            for a, b, v in f(df, columns).collect():
                m[k][at[a], at[b]] = 0.0 if v is None or v != v else v
    distance = {"corr": 1 - np.abs(m["corr"]), "cosine": 1 - np.abs(m["cosine"]), "both": 2 - np.hypot(m["corr"], m["cosine"])}[by]
    np.fill_diagonal(distance, 0)
    found = average_linkage(distance, cut)
    rows = [(k, ", ".join(sorted(c for c, x in zip(columns, found, strict=True) if x == k))) for k in sorted(set(found))]
    return df.sparkSession.createDataFrame(rows, "cluster int, members string")
