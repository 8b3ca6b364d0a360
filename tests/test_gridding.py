"""Queries against DuckDB on the shared tables, properties, and one negative test per rule."""

import glob
import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from terragrid import queries
from terragrid.functions.geo import Projection, finite, vincenty
from terragrid.operators import assembly, features, legacy, match, output, slope, stats, terrain
from terragrid.plans import aggregate as plan
from terragrid.plans import recipe, windows
from terragrid.sources.grid import Grid, fit_lattice, grid_step, regular_axis
from terragrid.sources.raster import Raster, find_axis
from terragrid.sources.surfex import parse_header, record_dtype

SF = "/root/testdata/sf0.001"
GRID = Grid(Projection("stere", 90.0, -30.0), -450000.0, 100000.0, 10, 450000.0, -100000.0, 10)


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def plain(rows):
    out = [tuple(float(x) if type(x).__name__ == "Decimal" else x for x in r) for r in rows]
    return sorted(out, key=lambda r: tuple(f"{x:030.3f}" if isinstance(x, int | float) else str(x) for x in r))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    df = queries.queries()[name](spark, SF)
    want = db.sql(queries.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    cols = sorted(df.columns)
    assert plain(df.select(cols).collect()) == plain(want.select(*[f'"{c}"' for c in cols]).fetchall())


def raster(spark, f, n=60, m=72, lats=(90.0, 50.0)):
    la, lo = np.linspace(*lats, 2 * n + 1)[1::2], -180 + (np.arange(m) + 0.5) * 360 / m
    rows = [(i, j, float(a), float(o), f(i, j, a, o)) for i, a in enumerate(la) for j, o in enumerate(lo)]
    return Raster.of(spark.createDataFrame(rows, "row long, col long, lat double, lon double, value double"), la, lo)


def test_constant_field_and_exclusive_fractions(spark):
    r = raster(spark, lambda *_: 7.0)
    for mode in ("std", "slope"):
        got = plan.aggregate(r, GRID, mode, check=False).where("valid_count > 0").collect()
        assert got and all(x["std"] < 1e-9 and abs(x["mean"] - 7) < 1e-9 if mode == "std" else x["slope_x"] == x["slope_y"] == 0 for x in got)
    r = raster(spark, lambda i, j, *_: float(1 + (i * 72 + j) % 33) if (i + j) % 5 else float("nan"))
    got = plan.aggregate(r, GRID).where("valid_count > 0").collect()
    assert all(abs(x.sea + x.lake + x.nature + x.urban - 1) < 1e-12 for x in got)


def test_std_does_not_lose_small_spread_to_an_offset(spark):
    a, b = (plan.aggregate(raster(spark, lambda i, j, *_, o=o: o + (i * 7 + j) % 5), GRID, "std", check=False, single_pass=s).where("valid_count > 1").select("cell", "std").collect() for o, s in ((0.0, False), (1e6, True)))
    assert np.allclose(sorted(x.std for x in a), sorted(x.std for x in b), atol=1e-6)


def test_pruned_equals_full_for_both_projections(spark):
    r = raster(spark, lambda i, j, *_: float(i - j))
    for g in (Grid(Projection("stere", 90.0, -30.0), 500000.0, 90000.0, 8, -200000.0, -90000.0, 6), Grid(Projection("lcc", 63.3, 15.0, 6371000.0, 63.3, 63.3), -400000.0, 120000.0, 6, 300000.0, -120000.0, 5)):
        a, b = (plan.aggregate(r, g, "mean", prune=p, check=False).orderBy("cell").collect() for p in (True, False))
        assert sum(x.source_count for x in a) > 0
        assert [(x.source_count, x.mean and round(x.mean, 9)) for x in a] == [(x.source_count, x.mean and round(x.mean, 9)) for x in b]
        rows, cols = windows.source_windows(g, r.lats, r.lons)
        assert windows.selected_share(r, rows, cols) < 1


def test_windows_hold_every_pixel_inside(spark):
    """Against brute force: polar and conic grids, both hemispheres, with the apex inside, outside, and across the date line."""
    lats, lons = -90 + (np.arange(90) + 0.5) * 2, -180 + (np.arange(120) + 0.5) * 3
    lon, lat = (x.ravel() for x in np.meshgrid(lons, lats))
    cases = [(("stere", s * 90.0, lon0), x0, y0) for s in (1, -1) for lon0 in (-30.0, 170.0) for x0, y0 in ((-500000.0, 500000.0), (900000.0, 2500000.0), (-3000000.0, -900000.0), (-400000.0, -1500000.0))]
    cases += [(("lcc", s * 50.0, lon0, 6371000.0, s * 45.0, s * 60.0), x0, y0) for s in (1, -1) for lon0 in (10.0, 178.0) for x0, y0 in ((-500000.0, 500000.0), (900000.0, 1500000.0))]
    pruned = 0
    for p, x0, y0 in cases:
        g = Grid(Projection(*p), x0, 150000.0, 8, y0, -150000.0, 7)
        with np.errstate(all="ignore"):
            x, y = g.projection.forward(lon, lat)
        xmin, ymin, xmax, ymax = g.extent
        inside = ((x >= xmin) & (x <= xmax) & (y >= ymin) & (y <= ymax)).reshape(90, 120)
        rows, cols = windows.source_windows(g, lats, lons)
        kept = np.zeros_like(inside)
        for a, b in rows:
            for c, d in cols:
                kept[a : b + 1, c : d + 1] = True
        assert inside.any() and not (inside & ~kept).any(), (p, x0, y0)
        pruned += kept.mean() < 0.25
    assert pruned > len(cases) * 0.7
    assert windows.widened([(0, 2), (5, 6)], 10, True) == [(0, 7), (9, 9)] and windows.widened([(0, 2)], 10) == [(0, 3)]


@pytest.mark.parametrize("radius_m", [None, 300000.0])
def test_slope_mode_prunes_and_equals_the_full_scan(spark, tmp_path, radius_m):
    r = raster(spark, lambda i, j, *_: float((i * 31 + j * j * 7) % 50) if (i + j) % 9 else float("nan"), n=60, m=72)
    r.df.repartition(2).write.parquet(str(tmp_path / "px"))
    r = r.with_df(spark.read.parquet(str(tmp_path / "px")))
    g = Grid(Projection("stere", 90.0, -30.0), 500000.0, 200000.0, 6, -1200000.0, -200000.0, 6)
    a, b = (plan.aggregate(r, g, "slope", prune=p, radius_m=radius_m) for p in (True, False))
    key = lambda df: [(x.cell, x.source_count, x.valid_count, x.slope_x and round(x.slope_x, 12), x.slope_y and round(x.slope_y, 12)) for x in df.orderBy("cell").collect()]
    assert key(a) == key(b) and any(x[2] for x in key(a))
    text = a._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(row," in text


def test_std_merges_rows_as_one_pass(spark):
    rng = np.random.default_rng(2)
    rows = [(int(c), float(w), None if rng.random() < 0.2 else float(1e6 + rng.normal())) for c in range(6) for w in rng.integers(1, 5, 40)] + [(9, 1.0, None)]
    from terragrid.operators import stats

    got = {r.cell: r for r in stats.summarise(spark.createDataFrame(rows, "cell long, weight double, value double"), "std").collect()}
    for c in range(6):
        w, v = (np.array([x[i] for x in rows if x[0] == c and x[2] is not None]) for i in (1, 2))
        mean = (w * v).sum() / w.sum()
        assert abs(got[c]["mean"] - mean) < 1e-6 and abs(got[c]["std"] - np.sqrt((w * (v - mean) ** 2).sum() / w.sum())) < 1e-8
        assert got[c].valid_count == len(v) and got[c].source_count == 40
    assert got[9]["std"] is None and got[9].valid_count == 0 and got[9].source_count == 1


def test_older_crop_has_a_degree_or_the_radius():
    lats, lons = np.arange(-89.5, 90), np.arange(-179.5, 180)
    rows, cols = windows.legacy_crop(lats, lons, np.array([60.0, 70.0]), np.array([10.0, 20.0]))
    assert (lats[rows[0][0]], lats[rows[0][1]], lons[cols[0][0]], lons[cols[0][1]]) == (59.5, 70.5, 9.5, 20.5)
    _, cols = windows.legacy_crop(lats, lons, np.array([60.0, 70.0]), np.array([10.0, 20.0]), radius_m=500000.0)
    wide = np.degrees(500000 / 6371000) / np.cos(np.radians(70))
    assert lons[cols[0][0]] >= 10 - wide > lons[cols[0][0]] - 1
    with pytest.raises(ValueError):
        windows.legacy_crop(lats[:10], lons, np.array([60.0]), np.array([10.0]))


def test_radius_join_equals_brute_force(spark):
    r = raster(spark, lambda i, j, *_: float(i), n=12, m=36)
    t = spark.createDataFrame([(k, -20.0 + 37 * k, 52.0 + 5 * k) for k in range(7)], "cell long, lon double, lat double")
    got = {(x["row"], x["col"], x["cell"]) for x in match.radius(r.df, t, 700000.0, 6371229.0).collect()}
    v = lambda lo, la: np.array([np.cos(np.radians(la)) * np.cos(np.radians(lo)), np.cos(np.radians(la)) * np.sin(np.radians(lo)), np.sin(np.radians(la))])
    c = 2 * np.sin(700000 / (2 * 6371229.0))
    want = {(p["row"], p["col"], q["cell"]) for p in r.df.collect() for q in t.collect() if np.linalg.norm(v(p.lon, p.lat) - v(q.lon, q.lat)) <= c}
    assert got == want and got


def test_projections_invert():
    lon, lat = np.array([-170.0, -30.0, 15.0, 100.0]), np.array([55.0, 60.0, 70.0, 88.0])
    for p in (Projection("stere", 90.0, -30.0), Projection("lcc", 63.3, 15.0, 6371000.0, 63.3, 63.3), Projection("lcc", 50.0, 10.0, 6371000.0, 40.0, 60.0)):
        a, b = p.inverse(*p.forward(lon, lat))
        assert np.allclose(a, lon) and np.allclose(b, lat)
    lon, lat = Projection("stere", -90.0, 0.0).inverse(*Projection("stere", -90.0, 0.0).forward(40.0, -70.0))
    assert abs(lon - 40) < 1e-9 and abs(lat + 70) < 1e-9


def test_preset_corner_and_model_geometry():
    g = Grid.preset("metcoop")
    assert (round(g.x0, 2), round(g.y0 + (g.ny - 1) * g.dy, 2)) == (-1060126.65, -1332565.87) and g.dy < 0
    m = Grid.model(80, -34, 74, 26, 789, 989, 2500)
    assert m.projection.kind == "lcc" and m.dy > 0 and m.projection.radius == 6371220.0


def test_vincenty_known_length():
    assert abs(vincenty(np.array([0.0]), np.array([0.0]), np.array([1.0]), np.array([0.0]))[0] - 111319.491) < 0.01
    assert vincenty(np.array([5.0]), np.array([5.0]), np.array([5.0]), np.array([5.0]))[0] == 0


def test_edges_go_to_the_later_cell(spark):
    lon, lat = GRID.projection.inverse(0.0, 100000.0)
    df = spark.createDataFrame([(float(lon), float(lat))], "lon double, lat double")
    assert df.select(GRID.locate(F.col("lon"), F.col("lat"))).first()[0] == 4 * GRID.nx + 5


def test_points_errors_and_lattice(spark):
    cells = GRID.located(GRID.placed(spark.range(8).select((F.col("id") * 11).alias("cell"))))
    pts = cells.select("cell", "lat", "lon")
    g = fit_lattice(pts, GRID.projection, 100000.0)
    assert (g.nx, g.ny) == (8, 8)
    ok = cells.select(F.col("cell").alias("point_idx"), "lat", "lon")
    assert {r["cell"] for r in GRID.select_points(ok).collect()} == {i * 11 for i in range(8)}
    for bad, text in ((ok.withColumn("lat", F.col("lat") - 0.1), "align"), (ok.unionByName(ok), "multiple"), (ok.where("false"), "no points"), (ok.withColumn("lat", F.lit(float("nan"))), "no place")):
        with pytest.raises(ValueError, match=text):
            GRID.select_points(bad)
    with pytest.raises(ValueError, match="spacing"):
        fit_lattice(pts, GRID.projection, 0.0)
    with pytest.raises(ValueError, match="lattice"):
        fit_lattice(ok.withColumn("lat", F.col("lat") - F.col("point_idx") * 0.01), GRID.projection, 100000.0)
    with pytest.raises(ValueError, match="two occupied"):
        fit_lattice(pts.limit(1), GRID.projection, 100000.0)


@pytest.mark.parametrize("bad", [[1.0], [1.0, float("nan")], [1.0, 2.0, 4.0], [1.0, 2.0, 1.5], [[1.0, 2.0]]])
def test_irregular_axes(bad):
    with pytest.raises(ValueError):
        regular_axis(bad)


def test_raster_errors(spark):
    df = spark.createDataFrame([(0, 0, 1.0)], "row long, col long, value double")
    with pytest.raises(ValueError, match="globe"):
        Raster.of(df, [1.0, 2.0], np.arange(0, 370, 1.0))
    with pytest.raises(ValueError, match="pole"):
        Raster.of(df, [89.0, 91.0], [0.0, 1.0])
    with pytest.raises(ValueError, match="bounds"):
        Raster.of(df, [1.0, 2.0], [0.0, 1.0], lat_bounds=[[0.0, 1.0], [1.0, 2.0]])
    with pytest.raises(ValueError, match="lacks"):
        Raster.of(df.drop("value"), [1.0, 2.0], [0.0, 1.0])
    with pytest.raises(ValueError, match="ambiguous"):
        find_axis({"lat": None, "latitude": None}, "lat")
    assert Raster.of(df, [1.0, 2.0], np.array([350.0, 355.0, 0.0, 5.0])).lons[-1] == 365.0


@pytest.mark.parametrize(
    ("args", "text"),
    [(("median", None, None, None, None), "none of"), (("mean", 5.0, None, None, None), "radius needs"), (("std", -1.0, None, None, None), "lie in"), (("mean", None, None, 1.0, 2.0), "conflicting"), (("std", None, 1.0, None, None), "mean mode"), (("mean", None, float("nan"), None, None), "finite"), (("fractions", None, None, 2.0, None), "lie in")],
)
def test_option_errors(args, text):
    with pytest.raises(ValueError, match=text):
        plan.check_options(*args)


def test_category_errors(spark):
    for bad in ({}, {"a": []}, {"a": [1.5]}, {"x": [1]}):
        with pytest.raises(ValueError):
            stats.check_categories(bad)
    with pytest.raises(ValueError, match="unknown source codes"):
        plan.aggregate(raster(spark, lambda *_: 99.0), GRID)
    with pytest.raises(ValueError, match="no source pixel"):
        plan.aggregate(raster(spark, lambda *_: 1.0, lats=(-50.0, -90.0)), GRID)


def test_crs_errors():
    for bad in (("utm", 0.0, 0.0), ("stere", 60.0, 0.0), ("lcc", 0.0, 0.0)):
        with pytest.raises(ValueError):
            Projection(*bad)
    with pytest.raises(ValueError, match="kilometres"):
        Grid.from_cf({}, [0, 1], [0, 1], "deg")
    g = Grid.from_cf({"grid_mapping_name": "polar_stereographic", "earth_radius": 6371229.0, "latitude_of_projection_origin": 90.0, "straight_vertical_longitude_from_pole": -30.0}, [0, 2.5], [5, 2.5], "km")
    assert g.dx == 2500 and g.dy == -2500


def test_fills_and_units(spark):
    out = plan.aggregate(raster(spark, lambda i, *_: None if i < 3 else 1.0, lats=(90.0, 70.0), n=40), GRID, "mean", fill_missing_mean=-1.0, fill_uncovered=-2.0, check=False)
    by = {x.mean_data_status: x.mean for x in out.collect()}
    assert by[0] == 1.0 and by.get(1, -1.0) == -1.0
    assert out.schema["source_area"].metadata["units"] == "m2"


def test_nearest_settles_far_pixels(spark):
    t = spark.createDataFrame([(1, 0.0, 0.0), (2, 90.0, 0.0), (3, 0.0, 1.0)], "target_id long, lon double, lat double")
    p = spark.createDataFrame([(0, 179.0, -80.0), (1, 0.1, 0.4), (2, 80.0, 10.0)], "pix long, lon double, lat double")
    got = {(x.pix, x["rank"]): x.target_id for x in match.nearest(p, t, ["pix"], k=2, spacing=0.05).collect()}
    assert got[1, 1] == 1 and got[1, 2] == 3 and got[2, 1] == 2 and len(got) == 6


def test_knn_covers_every_pixel(spark):
    n = queries._raster(spark, SF).df.select("row").distinct().count()
    got = queries.queries()["knn_k8"](spark, SF).toPandas()
    i = np.arange(300)
    unit = lambda lat, lon: np.stack([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat) + 0 * lon], -1)
    targets = unit(np.radians(-60 + i * 37 % 120), np.radians(-180 + i * 83 % 360))
    lats, lons = np.radians(90 - (np.arange(n) + 0.5) * 180 / n), np.radians(-180 + (np.arange(64) + 0.5) * 5.625)
    want = np.stack([np.sort(((unit(a, lons)[:, None] - targets) ** 2).sum(-1), 1)[:, :8] for a in lats])
    assert len(got) == n * 64 * 8
    out = np.full(want.shape, np.nan)
    out[got["row"], got["col"], got["rank"] - 1] = got["d2"]
    assert np.abs(out - want).max() < 1e-9


def test_small_helpers(spark, tmp_path):
    assert grid_step([359.0, 0.0, 1.0]) == 1.0 and grid_step([1.0]) is None
    assert output.safe_names(["a b", "c"]) == ["a_b", "c"]
    with pytest.raises(ValueError):
        output.safe_names(["a b", "a_b"])
    assert output.category_text({"a": [1, 2]}) == "a: 1,2"
    assert legacy.field_names("slope", "ORO") == ["oro_slope_x", "oro_slope_y"]
    assert parse_header(["North: 5", "cell resolution 3"]) == {"north": "5", "resolution": "3"}
    with pytest.raises(ValueError):
        record_dtype("complex 16")
    assert features.average_linkage(np.array([[0, 0.1, 0.9], [0.1, 0, 0.9], [0.9, 0.9, 0]])) == [1, 1, 2]
    assert [len(terrain.descriptor_plan({"default": {"scales": [1, 2]}, "variables": {"z": {"descriptors": {"std": {}, "sx": {"azimuths": [0, 90], "scales": [5]}}}}}))] == [4]
    df = spark.createDataFrame([(1, float("nan")), (2, 1.0)], "k long, v double")
    assert [r.v for r in assembly.fill_gaps(df).orderBy("k").collect()] == [0.0, 1.0]
    assert df.where(finite(F.col("v"))).count() == 1
    with pytest.raises(ValueError):
        recipe.statistics(df, ["v"])
    with pytest.raises(ValueError):
        recipe.joined([df, df.where("k = 1")], "k")
    with pytest.raises(ValueError, match="lack"):
        recipe.joined([df, df.where("k = 1").withColumnRenamed("v", "w")], "k")
    assert recipe.joined([df, df.withColumnRenamed("v", "w")], "k").columns == ["k", "v", "w"]
    output.write_result(df, str(tmp_path / "out"), {"mode": "mean"}, undefined="nan", sort=["k"])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    assert recipe.dates(spark).count() == 49


def test_stream_equals_batch(spark, tmp_path):
    from terragrid.streaming.tiles import tile_statistics

    pixels = raster(spark, lambda i, j, *_: float((i * j) % 17), n=20, m=36).weighted()
    pixels.repartition(3).write.parquet(str(tmp_path / "tiles"))
    stream = spark.readStream.schema(pixels.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "tiles"))
    q = tile_statistics(stream, GRID).writeStream.format("memory").queryName("tiles").outputMode("complete").option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    got = {r["cell"]: (round(r["mean"], 9), r.source_count) for r in spark.table("tiles").collect()}
    assert got == {r["cell"]: (round(r["mean"], 9), r.source_count) for r in tile_statistics(pixels, GRID).collect()} and got


def test_slope_is_the_gradient(spark):
    r = raster(spark, lambda i, j, *_: float(i * i + 3 * np.sin(j)), n=10, m=12)
    got = {(x["row"], x["col"]): x.slope_y for x in slope.slopes(r).collect()}
    z = np.array([[float(i * i + 3 * np.sin(j)) for j in range(12)] for i in range(10)])
    want = np.gradient(z, np.radians(r.lats) * 6371229.0, axis=0)
    assert all(abs(got[i, j] - want[i, j]) < 1e-12 for i in range(10) for j in range(12))
