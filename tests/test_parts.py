"""Small operators against brute force."""

import itertools
import math

import numpy as np
import pytest

from terragrid.functions.geo import vincenty
from terragrid.operators import assembly, features, match
from terragrid.sources import files
from terragrid.sources.raster import spatial_variables, tile_count, tile_shape


@pytest.mark.parametrize("spread", ["even", "clustered"])
def test_closest_spacing(spark, spread):
    rng = np.random.default_rng(3)
    p = rng.uniform(0, 10, (300, 2)) if spread == "even" else np.concatenate([rng.normal(0, 1e-5, (200, 2)), rng.normal(50, 1, (50, 2))])
    want = min(math.dist(a, b) for a, b in itertools.combinations(p.tolist(), 2))
    df = spark.createDataFrame(p.tolist() + [[None, 1.0]], "x double, y double")
    assert match.closest_spacing(df) == pytest.approx(want, rel=1e-9)


def test_closest_spacing_of_few_and_equal_points(spark):
    df = lambda rows: spark.createDataFrame(rows, "x double, y double")
    assert match.closest_spacing(df([])) is None and match.closest_spacing(df([(1.0, 2.0)])) is None
    assert match.closest_spacing(df([(0.0, 0.0), (3.0, 4.0)])) == 5.0
    with pytest.raises(ValueError, match="coincide"):
        match.closest_spacing(df([(1.0, 2.0), (1.0, 2.0), (3.0, 3.0)]))
    assert match.marker_area(10, 72) == pytest.approx(90.25)


def test_matches_are_clipped_by_the_geodesic(spark):
    rows = [(10.0, 60.0, 10.0 + k / 100, 60.0) for k in range(30)]
    away = [float(vincenty(*(np.array([v]) for v in r))[0]) for r in rows]
    got = match.clipped(spark.createDataFrame(rows, "lon double, lat double, tlon double, tlat double"), 5000.0).count()
    assert got == sum(d <= 5000 for d in away) and 1 < got < 30


def test_correlation_within_groups(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(50, 4))
    df = spark.createDataFrame(x.tolist(), "a double, b double, c double, d double")
    m = np.abs(np.corrcoef(x.T))
    got = {(r.cluster, r.variable): r.mean_abs_corr for r in features.correlation_within(df, {1: ["a", "b", "c"], 2: ["d"]}).collect()}
    assert got[2, "d"] is None and len(got) == 4
    for i, c in enumerate("abc"):
        assert got[1, c] == pytest.approx(np.mean([m[i, j] for j in range(3) if j != i]))


def test_tiles_and_variables():
    assert tile_shape(1000, 64) == (15, 64) and tile_shape(10, 64) == (1, 10)
    windows = [(0, 31, 0, 64), (5, 6, 3, 4), (9, 9, 0, 64)]
    assert tile_count(windows, (15, 64)) == 3 + 1 + 0
    with pytest.raises(ValueError):
        tile_shape(0, 64)
    ranks, types = {"t": ("time", "y", "x"), "name": ("y", "x"), "crs": ()}, {"t": "float", "name": "string", "crs": "int"}
    assert spatial_variables(ranks, types, ("y", "x")) == ["t"]


def test_files_by_glob(spark, tmp_path):
    for day, c in (("20240101", "a"), ("20240102", "b")):
        spark.createDataFrame([(1, 2.0), (int(day[-1]) + 5, 3.0)], f"cell int, {c} double").write.parquet(f"{tmp_path}/f_{day}.parquet")
    assert files.latest(spark, f"{tmp_path}/f_*.parquet").endswith("f_20240102.parquet")
    got = {tuple(r) for r in files.merged(spark, f"{tmp_path}/f_*.parquet", ["cell"]).collect()}
    assert got == {(1, 2.0, 2.0), (6, 3.0, None), (7, None, 3.0)}
    with pytest.raises(FileNotFoundError):
        files.latest(spark, f"{tmp_path}/none_*.parquet")
    assert files.inline_points(spark).count() == 4


def test_parts_without_a_query(spark):
    df = spark.createDataFrame([(1, 273.15, 3.0), (2, 283.15, None)], "cell int, t double, u double")
    assert [round(r.t, 9) for r in assembly.celsius(df, ["t"]).collect()] == [0.0, 10.0]
    assert assembly.prefixed(df, "p", ["cell"]).columns == ["cell", "p_t", "p_u"]
    assert assembly.stacked(df, ["cell"]).count() == 4
    assert assembly.first_available("u", df.drop("u"), df).columns == ["u"]
    with pytest.raises(ValueError):
        assembly.first_available("v", df)
    steps = spark.createDataFrame([(1, i, float(i * i)) for i in range(5)], "cell int, time int, v double")
    assert [r.v_diff for r in assembly.accumulated_difference(steps, "v", 2, ["cell"]).orderBy("time").collect()] == [None, None, 4.0, 8.0, 12.0]
    box = spark.createDataFrame([(0.0, 0.0, 1.0), (1.0, 1.0, 2.0), (0.5, 0.5, float("nan")), (0.5, 0.6, 5.0)], "lon double, lat double, value double")
    assert assembly.zoomed(box, (0, 1, 0, 1)).count() == 3 and assembly.inside_open(box, (0, 1, 0, 1)).count() == 2
