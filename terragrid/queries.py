"""Driver queries of the gridding engine and their DuckDB equivalents, over the shared test tables.

``embeddings`` serves as a dense raster: vec_id is the row, the array position
the column; 180/N degrees by 5.625, north to south, periodic in longitude.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.geo import R_AREA, Projection, geodesic_distance, match_convention
from .operators import assembly, features, legacy, match, output, slope, stats, terrain
from .plans import recipe, windows
from .plans.aggregate import aggregate
from .shipping import ensure_shipped
from .sources.grid import Grid, fit_lattice, grid_step
from .sources.raster import Raster, tile_id
from .storage import shared_folder

COLS, STEP = 64, 5.625
GRID = Grid(Projection("stere", 90.0, -30.0), -2875000.0, 250000.0, 24, 2875000.0, -250000.0, 24)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ensure_shipped(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _raster(spark: SparkSession, sf_dir: str, kind: str = "value") -> Raster:
    emb = _table(spark, sf_dir, "embeddings")
    n = emb.count()
    df = emb.select(F.col("vec_id").cast("long").alias("row"), F.posexplode("embedding").alias("c", "e")).withColumn("col", F.col("c").cast("long"))
    idx = F.col("row") * COLS + F.col("col")
    value = F.col("e").cast("double") * 1000
    value = {"value": value, "cover": (1 + F.pmod(idx, F.lit(33))).cast("double"), "holes": F.when(F.pmod(idx, F.lit(7)) != 0, value), "cover_holes": F.when(F.pmod(idx, F.lit(7)) != 0, (1 + F.pmod(idx, F.lit(33))).cast("double"))}[kind]
    lat, lon = F.lit(90.0) - (F.col("row") + 0.5) * (180.0 / n), F.lit(-180.0) + (F.col("col") + 0.5) * STEP
    return Raster.of(df.select("row", "col", lat.alias("lat"), lon.alias("lon"), value.alias("value")), 90 - (np.arange(n) + 0.5) * (180.0 / n), -180 + (np.arange(COLS) + 0.5) * STEP)


def _r(name: str, digits: int = 6, alias: str | None = None):
    return F.round(F.col(name), digits).alias(alias or name)


_PX = f"""n AS (SELECT count(*) AS n FROM embeddings),
px AS (SELECT vec_id::BIGINT AS row, (i - 1)::BIGINT AS col, embedding[i]::DOUBLE * 1000 AS z, 1 + (vec_id * 64 + i - 1) % 33 AS cover, (vec_id * 64 + i - 1) % 7 = 0 AS hole,
    90 - (vec_id + 0.5) * (180.0::DOUBLE / n) AS lat, -180 + (i - 0.5)::DOUBLE * 5.625 AS lon, 90.0::DOUBLE / n AS h, n
  FROM embeddings, n, (SELECT unnest(generate_series(1, 64)) AS i)),
wx AS (SELECT *, {R_AREA}::DOUBLE * {R_AREA} * abs(sin(radians(least(lat + h, 90))) - sin(radians(greatest(lat - h, -90)))) * radians(5.625::DOUBLE) AS w,
    2 * {R_AREA}::DOUBLE * tan(pi() / 4 - radians(lat) / 2) AS rho, radians(lon + 30) AS th FROM px),
xyp AS (SELECT *, rho * sin(th) AS x, -rho * cos(th) AS y FROM wx),
cell AS (SELECT *, floor((y - 3000000) / -250000)::BIGINT * 24 + floor((x + 3000000) / 250000)::BIGINT AS cell
  FROM xyp WHERE x >= -3000000 AND x < 3000000 AND y <= 3000000 AND y > -3000000),
cells AS (SELECT unnest(generate_series(0, 575))::BIGINT AS cell)"""
_DIAG = "sum(w) AS source_area, coalesce(sum(w) FILTER ({ok}), 0) AS valid_area, count(*) AS source_count, count(*) FILTER ({ok}) AS valid_count"
Q, SQL = {}, {}


def _query(name: str, sql: str | None = None):
    def keep(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return keep


def _diag_cols():
    return [F.round(F.col("source_area") / 1e6, 2).alias("source_km2"), F.round(F.col("valid_area") / 1e6, 2).alias("valid_km2"), "source_count", "valid_count"]


_DIAG_OUT = "round(coalesce(source_area, 0) / 1e6, 2) AS source_km2, round(coalesce(valid_area, 0) / 1e6, 2) AS valid_km2, coalesce(source_count, 0) AS source_count, coalesce(valid_count, 0) AS valid_count"


@_query("raster_scan", f"WITH {_PX} SELECT row, col, round(lat, 6) AS lat, round(lon, 6) AS lon, round(z, 6) AS value, round(w / 1e6, 3) AS km2 FROM wx")
def raster_scan(spark, sf_dir):
    return _raster(spark, sf_dir).weighted().select("row", "col", _r("lat"), _r("lon"), _r("value"), F.round(F.col("weight") / 1e6, 3).alias("km2"))


@_query("native_mean", f"WITH {_PX}, s AS (SELECT cell, sum(w * z) / sum(w) AS mean, {_DIAG.format(ok='WHERE true')} FROM cell GROUP BY cell) SELECT cell, round(mean, 6) AS mean, {_DIAG_OUT}, CASE WHEN source_count IS NULL THEN 2 ELSE 0 END AS status FROM cells LEFT JOIN s USING (cell)")
def native_mean(spark, sf_dir):
    out = aggregate(_raster(spark, sf_dir), GRID, "mean", check=False)
    return out.select("cell", _r("mean"), *_diag_cols(), F.col("mean_data_status").cast("int").alias("status"))


def _fractions_sql(ok: str) -> str:
    part = ", ".join(f"sum(CASE WHEN {ok} AND cover IN ({', '.join(map(str, c))}) THEN w ELSE 0 END) / sum(w) FILTER (WHERE {ok}) AS {n}" for n, c in stats.CATEGORIES.items())
    return f"WITH {_PX}, s AS (SELECT cell, {part}, {_DIAG.format(ok='WHERE ' + ok)} FROM cell GROUP BY cell) SELECT cell, {', '.join(f'round({n}, 6) AS {n}' for n in stats.CATEGORIES)}, {_DIAG_OUT} FROM cells LEFT JOIN s USING (cell)"


@_query("native_fractions", _fractions_sql("true"))
def native_fractions(spark, sf_dir):
    return aggregate(_raster(spark, sf_dir, "cover"), GRID, "fractions").select("cell", *[_r(n) for n in stats.CATEGORIES], *_diag_cols())


@_query("native_fractions_missing", _fractions_sql("NOT hole"))
def native_fractions_missing(spark, sf_dir):
    return aggregate(_raster(spark, sf_dir, "cover_holes"), GRID, "fractions").select("cell", *[_r(n) for n in stats.CATEGORIES], *_diag_cols())


@_query("native_std", f"WITH {_PX}, m AS (SELECT *, sum(w * z) OVER (PARTITION BY cell) / sum(w) OVER (PARTITION BY cell) AS mu FROM cell), s AS (SELECT cell, any_value(mu) AS mean, sqrt(sum(w * (z - mu) * (z - mu)) / sum(w)) AS std FROM m GROUP BY cell) SELECT cell, round(mean, 6) AS mean, round(std, 6) AS std FROM cells LEFT JOIN s USING (cell)")
def native_std(spark, sf_dir):
    return aggregate(_raster(spark, sf_dir), GRID, "std", check=False).select("cell", _r("mean"), _r("std"))


_SLOPE = f"""v AS (SELECT *, CASE WHEN hole THEN NULL ELSE z END AS v FROM wx),
nb AS (SELECT *, lag(v) OVER c AS vs, lead(v) OVER c AS vn, coalesce(lead(v) OVER r, CASE WHEN col = 63 THEN first_value(v) OVER r END) AS ve, CASE WHEN col = 0 THEN last_value(v) OVER whole ELSE lag(v) OVER r END AS vw
  FROM v WINDOW c AS (PARTITION BY col ORDER BY row), r AS (PARTITION BY row ORDER BY col), whole AS (PARTITION BY row ORDER BY col ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
sl AS (SELECT *, CASE WHEN v IS NULL THEN NULL WHEN row = 0 THEN (vn - v) / dlat WHEN row = n - 1 THEN (v - vs) / dlat ELSE (vn - vs) / (2 * dlat) END AS sy,
    CASE WHEN v IS NULL THEN NULL ELSE (ve - vw) / (2 * {R_AREA}::DOUBLE * radians(5.625::DOUBLE)) / cos(radians(lat)) END AS sx
  FROM (SELECT *, {R_AREA}::DOUBLE * radians(-180.0::DOUBLE / n) AS dlat FROM nb)),
slp AS (SELECT *, sx IS NOT NULL AND sy IS NOT NULL AS ok, rho * sin(th) AS x, -rho * cos(th) AS y FROM sl),
slc AS (SELECT *, floor((y - 3000000) / -250000)::BIGINT * 24 + floor((x + 3000000) / 250000)::BIGINT AS cell FROM slp WHERE x >= -3000000 AND x < 3000000 AND y <= 3000000 AND y > -3000000)"""


@_query("slope_pixels", f"WITH {_PX}, {_SLOPE} SELECT row, col, round(sx, 12) AS slope_x, round(sy, 12) AS slope_y FROM sl")
def slope_pixels(spark, sf_dir):
    return slope.slopes(_raster(spark, sf_dir, "holes")).select("row", "col", _r("slope_x", 12), _r("slope_y", 12))


@_query("native_slope", f"WITH {_PX}, {_SLOPE}, s AS (SELECT cell, sum(w * sx) FILTER (WHERE ok) / sum(w) FILTER (WHERE ok) AS slope_x, sum(w * sy) FILTER (WHERE ok) / sum(w) FILTER (WHERE ok) AS slope_y, count(*) FILTER (WHERE ok) AS valid_count FROM slc GROUP BY cell) SELECT cell, round(slope_x, 10) AS slope_x, round(slope_y, 10) AS slope_y, coalesce(valid_count, 0) AS valid_count FROM cells LEFT JOIN s USING (cell)")
def native_slope(spark, sf_dir):
    return aggregate(_raster(spark, sf_dir, "holes"), GRID, "slope", check=False).select("cell", _r("slope_x", 10), _r("slope_y", 10), "valid_count")


@_query("fill_status", f"WITH {_PX}, s AS (SELECT cell, sum(w * z) FILTER (WHERE NOT hole) / sum(w) FILTER (WHERE NOT hole) AS mean, count(*) AS source_count, count(*) FILTER (WHERE NOT hole) AS valid_count FROM cell GROUP BY cell) SELECT cell, CASE WHEN source_count IS NULL THEN -2.0 WHEN valid_count = 0 THEN -1.0 ELSE round(mean, 6) END AS mean, CASE WHEN source_count IS NULL THEN 2 WHEN valid_count = 0 THEN 1 ELSE 0 END AS status FROM cells LEFT JOIN s USING (cell)")
def fill_status(spark, sf_dir):
    out = aggregate(_raster(spark, sf_dir, "holes"), GRID, "mean", fill_missing_mean=-1.0, fill_uncovered=-2.0, check=False)
    return out.select("cell", _r("mean"), F.col("mean_data_status").cast("int").alias("status"))


def _points(spark: SparkSession) -> DataFrame:
    ids = spark.range(20).select(F.col("id").alias("point_idx"), (F.col("id") * 28 + 5).alias("cell"))
    return GRID.located(GRID.placed(ids)).select("point_idx", "lat", "lon")


@_query("points_subset", f"WITH {_PX}, p AS (SELECT i::BIGINT AS point_idx, (i * 28 + 5)::BIGINT AS cell FROM (SELECT unnest(generate_series(0, 19)) AS i)), s AS (SELECT cell, sum(w * z) / sum(w) AS mean, count(*) AS source_count FROM cell GROUP BY cell) SELECT point_idx, cell, round(mean, 6) AS mean, coalesce(source_count, 0) AS source_count FROM p LEFT JOIN s USING (cell)")
def points_subset(spark, sf_dir):
    return aggregate(_raster(spark, sf_dir), GRID, "mean", points=_points(spark), check=False).select("point_idx", "cell", _r("mean"), "source_count")


@_query("lattice_fit", "SELECT 24 AS nx, 24 AS ny, -2875000.0::DOUBLE AS x0, -2875000.0::DOUBLE AS y0, 250000.0::DOUBLE AS spacing")
def lattice_fit(spark, sf_dir):
    ids = ensure_shipped(spark).range(GRID.nx * GRID.ny).select(F.col("id").alias("cell"))
    g = fit_lattice(GRID.located(GRID.placed(ids)), GRID.projection, 250000.0)
    return spark.createDataFrame([(g.nx, g.ny, round(g.x0, 3), round(g.y0, 3), g.dx)], "nx int, ny int, x0 double, y0 double, spacing double")


@_query("window_pruned_equals_full", f"WITH {_PX}, s AS (SELECT cell, sum(w * z) / sum(w) AS mean, count(*) AS n FROM cell WHERE x >= 500000 AND x < 2000000 AND y <= -500000 AND y > -1500000 GROUP BY cell) SELECT count(*) AS cells, sum(n)::BIGINT AS pixels, 0::BIGINT AS differing FROM s")
def window_pruned_equals_full(spark, sf_dir):
    g = Grid(GRID.projection, 625000.0, 250000.0, 6, -625000.0, -250000.0, 4)
    r = _raster(spark, sf_dir)
    a, b = (aggregate(r, g, "mean", prune=p, check=False).where("source_count > 0").select("cell", F.round("mean", 6).alias(f"m{p}"), F.col("source_count").alias(f"n{p}")) for p in (True, False))
    same = F.col("mTrue").eqNullSafe(F.col("mFalse")) & F.col("nTrue").eqNullSafe(F.col("nFalse"))
    return a.join(b, "cell", "full_outer").agg(F.count("*").alias("cells"), F.sum("nFalse").alias("pixels"), F.count_if(~same).alias("differing"))


_TARGETS = "t AS (SELECT i::BIGINT AS target_id, -60 + (i * 37 % 120)::DOUBLE AS lat, -180 + (i * 83 % 360)::DOUBLE AS lon FROM (SELECT unnest(generate_series(0, 299)) AS i)), tv AS (SELECT *, cos(radians(lat)) * cos(radians(lon)) AS tx, cos(radians(lat)) * sin(radians(lon)) AS ty, sin(radians(lat)) AS tz FROM t)"


def _targets(spark: SparkSession) -> DataFrame:
    i = F.col("id")
    return ensure_shipped(spark).range(300).select(i.alias("target_id"), (F.lit(-60.0) + F.pmod(i * 37, F.lit(120))).alias("lat"), (F.lit(-180.0) + F.pmod(i * 83, F.lit(360))).alias("lon"))


_CHORD2 = (2 * math.sin(400000 / (2 * R_AREA))) ** 2
_RADIUS = f"pv AS (SELECT *, cos(radians(lat)) * cos(radians(lon)) AS ux, cos(radians(lat)) * sin(radians(lon)) AS uy, sin(radians(lat)) AS uz FROM wx), pair AS (SELECT target_id, w, z FROM pv JOIN tv ON (ux - tx) * (ux - tx) + (uy - ty) * (uy - ty) + (uz - tz) * (uz - tz) <= {_CHORD2!r})"


@_query("radius_std", f"WITH {_PX}, {_TARGETS}, {_RADIUS}, m AS (SELECT *, sum(w * z) OVER (PARTITION BY target_id) / sum(w) OVER (PARTITION BY target_id) AS mu FROM pair) SELECT target_id, round(any_value(mu), 6) AS mean, round(sqrt(sum(w * (z - mu) * (z - mu)) / sum(w)), 6) AS std, count(*) AS source_count FROM m GROUP BY target_id")
def radius_std(spark, sf_dir):
    pairs = match.radius(_raster(spark, sf_dir).weighted(), _targets(spark), 400000.0, R_AREA)
    return stats.summarise(pairs, "std", "target_id").select("target_id", _r("mean"), _r("std"), "source_count")


@_query("radius_slope", f"WITH {_PX}, {_SLOPE}, {_TARGETS}, pair AS (SELECT target_id, w, sx, sy, ok FROM (SELECT *, cos(radians(lat)) * cos(radians(lon)) AS ux, cos(radians(lat)) * sin(radians(lon)) AS uy, sin(radians(lat)) AS uz FROM slp) JOIN tv ON (ux - tx) * (ux - tx) + (uy - ty) * (uy - ty) + (uz - tz) * (uz - tz) <= {_CHORD2!r}) SELECT target_id, round(sum(w * sx) FILTER (WHERE ok) / sum(w) FILTER (WHERE ok), 10) AS slope_x, round(sum(w * sy) FILTER (WHERE ok) / sum(w) FILTER (WHERE ok), 10) AS slope_y, count(*) AS source_count, count(*) FILTER (WHERE ok) AS valid_count FROM pair GROUP BY target_id")
def radius_slope(spark, sf_dir):
    pairs = match.radius(slope.slopes(_raster(spark, sf_dir, "holes")), _targets(spark), 400000.0, R_AREA)
    return stats.summarise(pairs, "slope", "target_id").select("target_id", _r("slope_x", 10), _r("slope_y", 10), "source_count", "valid_count")


_LEG = "lg AS (SELECT *, floor((3000000 - y) / 250000)::BIGINT * 24 + floor((x + 3000000) / 250000)::BIGINT AS cell FROM xyp WHERE floor((3000000 - y) / 250000) BETWEEN 0 AND 23 AND floor((x + 3000000) / 250000) BETWEEN 0 AND 23)"


@_query("legacy_nearest_mean", f"WITH {_PX}, {_LEG} SELECT cell, round(avg(CASE WHEN hole THEN NULL ELSE z END), 6) AS orography_mean FROM lg GROUP BY cell")
def legacy_nearest_mean(spark, sf_dir):
    m = match.planar_nearest(_raster(spark, sf_dir, "holes").df, GRID)
    return legacy.compute_statistics(m, "mean", variable="orography").select("cell", _r("orography_mean"))


@_query("legacy_nearest_std", f"WITH {_PX}, {_LEG} SELECT cell, round(stddev_samp(z), 6) AS orography_std, round(avg(z), 6) AS orography_mean FROM lg GROUP BY cell")
def legacy_nearest_std(spark, sf_dir):
    m = match.planar_nearest(_raster(spark, sf_dir).df, GRID)
    return legacy.compute_statistics(m, "std", variable="orography", include_mean=True).select("cell", _r("orography_std"), _r("orography_mean"))


@_query("legacy_nearest_fractions", f"WITH {_PX}, {_LEG} SELECT cell, {', '.join(f'round(count(*) FILTER (WHERE NOT hole AND cover IN ({chr(44).join(map(str, c))})) / count(*), 6) AS {n}' for n, c in stats.CATEGORIES.items())} FROM lg GROUP BY cell")
def legacy_nearest_fractions(spark, sf_dir):
    m = match.planar_nearest(_raster(spark, sf_dir, "cover_holes").df, GRID)
    return legacy.legacy_fractions(m).select("cell", *[_r(n) for n in stats.CATEGORIES])


@_query("legacy_overlap_mean", f"WITH {_PX}, c AS (SELECT cell, -3000000 + (cell % 24 + 0.5)::DOUBLE * 250000 AS cx, 3000000 - (cell // 24 + 0.5)::DOUBLE * 250000 AS cy FROM cells) SELECT cell, round(avg(z), 6) AS mean, count(*) AS n FROM xyp JOIN c ON sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy)) <= 400000 GROUP BY cell")
def legacy_overlap_mean(spark, sf_dir):
    m = match.planar_radius(_raster(spark, sf_dir).df, GRID, 400000.0)
    return m.groupBy("cell").agg(F.round(F.avg("value"), 6).alias("mean"), F.count("*").alias("n"))


_NN = f"{_TARGETS}, d AS (SELECT row, col, z, target_id, round((cos(radians(p.lat)) * cos(radians(p.lon)) - tx)^2 + (cos(radians(p.lat)) * sin(radians(p.lon)) - ty)^2 + (sin(radians(p.lat)) - tz)^2, 12) AS d2 FROM px p, tv)"


@_query("legacy_nn_sphere", f"WITH {_PX}, {_NN} SELECT row, col, min(d2) AS d2 FROM d GROUP BY row, col")
def legacy_nn_sphere(spark, sf_dir):
    return match.nearest(_raster(spark, sf_dir).df, _targets(spark), ["row", "col"]).select("row", "col", F.round("d2", 12).alias("d2"))


@_query("knn_k8")
def knn_k8(spark, sf_dir):
    """The eight nearest targets of every pixel; tests hold it against brute force, since the all-pairs SQL is too slow."""
    return match.nearest(_raster(spark, sf_dir).df, _targets(spark), ["row", "col"], k=8).select("row", "col", F.col("rank").cast("long").alias("rank"), F.round("d2", 12).alias("d2"))


@_query("legacy_slope", f"WITH {_PX}, e AS (SELECT *, lag(z) OVER c AS vs, lead(z) OVER c AS vn, lead(z) OVER r AS ve, lag(z) OVER r AS vw FROM px WINDOW c AS (PARTITION BY col ORDER BY row), r AS (PARTITION BY row ORDER BY col)) SELECT row, col, round((CASE WHEN col = 0 THEN ve - z WHEN col = 63 THEN z - vw ELSE (ve - vw) / 2 END) / (6371000.0::DOUBLE * radians(5.625::DOUBLE) * cos(radians(lat))), 12) AS slope_x, round((CASE WHEN row = 0 THEN vn - z WHEN row = n - 1 THEN z - vs ELSE (vn - vs) / 2 END) / (6371000.0::DOUBLE * radians(-180.0::DOUBLE / n)), 12) AS slope_y FROM e")
def legacy_slope(spark, sf_dir):
    r = _raster(spark, sf_dir)
    return slope.legacy_slopes(r.df, r.lat_step, STEP).select("row", "col", _r("slope_x", 12), _r("slope_y", 12))


@_query("radius_geodesic")
def radius_geodesic(spark, sf_dir):
    m = match.geodesic_radius(_raster(spark, sf_dir).df, _targets(spark), 300000.0)
    return m.groupBy("target_id").agg(F.round(F.avg("value"), 6).alias("mean"), F.count("*").alias("n"))


_LI = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _pairs_sql(expr: str, name: str) -> str:
    return " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round({expr.format(a=a, b=b)}, 6) AS {name} FROM lineitem" for a in _LI for b in _LI)


@_query("corr_matrix", _pairs_sql("corr({a}, {b})", "corr"))
def corr_matrix(spark, sf_dir):
    return features.correlations(_table(spark, sf_dir, "lineitem"), _LI).select("a", "b", _r("corr"))


@_query("cosine_matrix", _pairs_sql("sum({a} * {b}) / (sqrt(sum({a} * {a})) * sqrt(sum({b} * {b})))", "cosine"))
def cosine_matrix(spark, sf_dir):
    return features.cosines(_table(spark, sf_dir, "lineitem"), _LI).select("a", "b", _r("cosine"))


@_query("quantiles", " UNION ALL ".join(f"SELECT '{c}' AS variable, round(quantile_cont({c}, 0.05), 6) AS low, round(quantile_cont({c}, 0.95), 6) AS high FROM lineitem" for c in _LI))
def quantiles(spark, sf_dir):
    return features.quantiles(_table(spark, sf_dir, "lineitem"), _LI).select("variable", _r("low"), _r("high"))


@_query("value_ranges", " UNION ALL ".join(f"SELECT '{c}' AS variable, min({c}) AS min, max({c}) AS max, max(abs({c})) AS max_abs FROM lineitem" for c in _LI))
def value_ranges(spark, sf_dir):
    return features.ranges(_table(spark, sf_dir, "lineitem"), _LI)


@_query("feature_clusters")
def feature_clusters(spark, sf_dir):
    return features.clusters(_table(spark, sf_dir, "lineitem"), _LI)


@_query("pairwise_mean_abs_corr", "SELECT a AS variable, round(avg(abs(c)), 6) AS mean_abs_corr FROM (" + " UNION ALL ".join(f"SELECT '{a}' AS a, corr({a}, {b}) AS c FROM lineitem" for a in _LI for b in _LI if a != b) + ") GROUP BY a")
def pairwise_mean_abs_corr(spark, sf_dir):
    return features.mean_abs_correlation(_table(spark, sf_dir, "lineitem"), _LI).select("variable", _r("mean_abs_corr"))


@_query("value_histogram", f"WITH {_PX} SELECT cover::DOUBLE AS value, count(*) AS n, round(ln(count(*)), 9) AS log_n FROM px GROUP BY cover")
def value_histogram(spark, sf_dir):
    return features.histogram(_raster(spark, sf_dir, "cover").df, "value").select("value", "n", _r("log_n", 9))


@_query("cover_names", f"WITH {_PX}, names AS (SELECT * FROM (VALUES {', '.join(f'({i}, $${n}$$)' for i, n in enumerate(assembly.COVER_NAMES, 1))}) AS t(code, name)) SELECT coalesce(name, code2::VARCHAR) AS name, count(*) AS n FROM (SELECT cover + 2 AS code2 FROM px) LEFT JOIN names ON code = code2 GROUP BY 1")
def cover_names(spark, sf_dir):
    return _raster(spark, sf_dir, "cover").df.select(assembly.cover_name(F.col("value") + 2).alias("name")).groupBy("name").agg(F.count("*").alias("n"))


def _cell_frames(spark, sf_dir):
    r = _raster(spark, sf_dir)
    return aggregate(r, GRID, "std", check=False), aggregate(_raster(spark, sf_dir, "cover"), GRID, "fractions", check=False)


_RECIPE = f"{_PX}, m AS (SELECT *, sum(w * z) OVER (PARTITION BY cell) / sum(w) OVER (PARTITION BY cell) AS mu FROM cell), s AS (SELECT cell AS point_idx, sqrt(sum(w * (z - mu) * (z - mu)) / sum(w)) AS sdor_100, any_value(mu) AS treeheight, sum(CASE WHEN cover = 1 THEN w ELSE 0 END) / sum(w) AS sea FROM m GROUP BY cell)"


def _joined(spark, sf_dir):
    std, frac = _cell_frames(spark, sf_dir)
    key = lambda d: d.where("source_count > 0").withColumnRenamed("cell", "point_idx")
    return recipe.joined([recipe.source(key(frac), "point_idx", ["sea"]), recipe.piped(key(std), [lambda d: recipe.source(d, "point_idx", ["std"], ["sdor_100"])]), recipe.source(key(std), "point_idx", ["mean"], ["treeheight"])], "point_idx")


@_query("recipe_join", f"WITH {_RECIPE} SELECT point_idx, round(sea, 6) AS sea, round(sdor_100, 6) AS sdor_100, round(treeheight, 6) AS treeheight FROM s")
def recipe_join(spark, sf_dir):
    return _joined(spark, sf_dir).select("point_idx", _r("sea"), _r("sdor_100"), _r("treeheight"))


@_query("repeated_dates", f"WITH {_RECIPE}, dates AS (SELECT unnest(generate_series(TIMESTAMP '1979-01-01', TIMESTAMP '2027-01-01', INTERVAL 8760 HOUR)) AS date) SELECT date, count(*) AS n, round(sum(sea), 4) AS sea FROM s, dates GROUP BY date")
def repeated_dates(spark, sf_dir):
    d = recipe.repeated(_joined(spark, sf_dir), recipe.dates(spark))
    return d.groupBy("date").agg(F.count("*").alias("n"), F.round(F.sum("sea"), 4).alias("sea"))


@_query("recipe_statistics", f"WITH {_RECIPE} " + " UNION ALL ".join(f"SELECT '{c}' AS variable, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS stdev, round(min({c}), 6) AS minimum, round(max({c}), 6) AS maximum FROM s" for c in ("sea", "sdor_100")))
def recipe_statistics(spark, sf_dir):
    return recipe.statistics(_joined(spark, sf_dir), ["sea", "sdor_100"]).select("variable", *[_r(c) for c in ("mean", "stdev", "minimum", "maximum")])


@_query("merge_outer", "SELECT coalesce(a.k, b.k) AS k, na, nb FROM (SELECT l_partkey % 50 AS k, count(*) AS na FROM lineitem WHERE l_partkey % 50 < 40 GROUP BY 1) a FULL JOIN (SELECT p_partkey % 50 AS k, count(*) AS nb FROM part WHERE p_partkey % 50 >= 10 GROUP BY 1) b ON a.k = b.k")
def merge_outer(spark, sf_dir):
    a = _table(spark, sf_dir, "lineitem").withColumn("k", F.col("l_partkey") % 50).where("k < 40").groupBy("k").agg(F.count("*").alias("na"))
    b = _table(spark, sf_dir, "part").withColumn("k", F.col("p_partkey") % 50).where("k >= 10").groupBy("k").agg(F.count("*").alias("nb"))
    return assembly.merge([a, b], ["k"])


@_query("forest_where", f"WITH {_PX} SELECT row, col, CASE WHEN hole AND cover BETWEEN 4 AND 23 THEN 0.0 ELSE round(z, 6) END AS forest FROM px")
def forest_where(spark, sf_dir):
    r = _raster(spark, sf_dir, "holes").df.select("row", "col", F.col("value").alias("patch"))
    d = r.join(_raster(spark, sf_dir).df.select("row", "col", "value"), ["row", "col"]).join(_raster(spark, sf_dir, "cover").df.select("row", "col", F.col("value").between(4, 23).cast("double").alias("nature")), ["row", "col"])
    return d.select("row", "col", F.round(assembly.where_nature(F.col("value"), F.col("patch"), F.col("nature")), 6).alias("forest"))


@_query("sentinel_clean", "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 3 THEN NULL WHEN l_quantity * -10 < -100 THEN -99.9 ELSE l_quantity * -10 END AS zs FROM lineitem")
def sentinel_clean(spark, sf_dir):
    d = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") == 3, 1e20).otherwise(F.col("l_quantity") * -10).alias("zs"))
    return assembly.clean_sentinel(d, ["zs"], "zs")


@_query("axial_decompose", "SELECT l_orderkey, l_linenumber, round(l_extendedprice * cos(2 * l_discount), 4) AS norm_x, round(l_extendedprice * sin(2 * l_discount), 4) AS norm_y FROM lineitem")
def axial_decompose(spark, sf_dir):
    d = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("norm"), F.col("l_discount").alias("dir"))
    return assembly.axial(d, [("norm", "dir")]).select("l_orderkey", "l_linenumber", _r("norm_x", 4), _r("norm_y", 4))


#: Sums over the disk of 3.5 cells: half rows of 3, 3, 2 and 1 cells at 0 to 3 rows away.
_DISK = "rows_ AS (SELECT *, " + ", ".join(f"sum({e}) OVER (PARTITION BY row ORDER BY col ROWS BETWEEN {k} PRECEDING AND {k} FOLLOWING) AS {n}{k}" for k in (1, 2, 3) for n, e in (("n", "1"), ("s", "z"), ("q", "z * z"))) + " FROM px), disk AS (SELECT *, " + ", ".join(" + ".join([f"{n}3", *(f"coalesce({f}({n}{k}, {d}) OVER c, 0)" for d, k in ((1, 3), (2, 2), (3, 1)) for f in ("lag", "lead"))]) + f" AS d{n}" for n in "nsq") + " FROM rows_ WINDOW c AS (PARTITION BY col ORDER BY row))"


@_query("tpi", f"WITH {_PX}, {_DISK} SELECT row, col, round(z - (ds - z) / (dn - 1), 6) AS tpi FROM disk")
def tpi(spark, sf_dir):
    return terrain.tpi(_raster(spark, sf_dir).df, 17500, 2500).select("row", "col", _r("tpi"))


@_query("local_std", f"WITH {_PX}, {_DISK} SELECT row, col, round(sqrt(greatest(dq / dn - (ds / dn) * (ds / dn), 0)), 6) AS std FROM disk")
def local_std(spark, sf_dir):
    return terrain.local_std(_raster(spark, sf_dir).df, 17500, 2500).select("row", "col", _r("std"))


@_query("sx", f"WITH {_PX} SELECT a.row, a.col, round(max(atan2(b.z - a.z, 2500.0 * k)), 9) AS sx FROM px a LEFT JOIN (SELECT row, col, z, k FROM px, (SELECT unnest(generate_series(1, 5)) AS k)) b ON b.col = a.col AND b.row = a.row - k GROUP BY a.row, a.col")
def sx(spark, sf_dir):
    return terrain.sx(_raster(spark, sf_dir).df, 180, 12500, 2500).select("row", "col", _r("sx", 9))


@_query("gradient_scale")
def gradient_scale(spark, sf_dir):
    return terrain.gradient(_raster(spark, sf_dir).df, 12500, 2500).select("row", "col", _r("we", 9), _r("sn", 9))


@_query("valley_ridge")
def valley_ridge(spark, sf_dir):
    return terrain.valley_ridge(_raster(spark, sf_dir).df, 12500, 2500).select("row", "col", _r("norm"), _r("dir"))


@_query("axis_step", "SELECT 0.25::DOUBLE AS step")
def axis_step(spark, sf_dir):
    return ensure_shipped(spark).createDataFrame([(grid_step((np.arange(0, 360, 0.25) + 100) % 360),)], "step double")


@_query("dir_roundtrip", f"WITH {_PX} SELECT row, col, CASE WHEN (row * 64 + col) % 11 = 0 THEN NULL ELSE ((row * 64 + col) % 1000)::DOUBLE END AS value, round(90 - row * 180.0::DOUBLE / (n - 1), 3) AS lat, round(-180 + col * 5.625::DOUBLE, 3) AS lon FROM px")
def dir_roundtrip(spark, sf_dir):
    from .sources.surfex import read_surfex

    n = _table(spark, sf_dir, "embeddings").count()
    at = f"{shared_folder(ensure_shipped(spark))}/dem"
    i = np.arange(n * COLS)
    body = np.where(i % 11 == 0, -32768, i % 1000).astype("i2")
    jvm = spark._jvm.org.apache.hadoop.fs
    fs = jvm.Path(at).getFileSystem(spark._jsc.hadoopConfiguration())
    header = f"nodata: -32768\nnorth: 90\nsouth: -90\nwest: -180\neast: 174.375\nrows: {n}\ncols: {COLS}\nrecordtype: integer 16 bits\n"
    for name, data in (("dem.hdr", header.encode()), ("dem.dir", body.tobytes())):
        out = fs.create(jvm.Path(f"{at}/{name}"), True)
        out.write(bytearray(data))
        out.close()
    return read_surfex(spark, f"{at}/dem.hdr", f"{at}/dem.dir").df.select("row", "col", "value", _r("lat", 3), _r("lon", 3))


@_query("sea_zeroed", f"WITH {_PX} SELECT row, col, round(CASE WHEN cover BETWEEN 4 AND 23 THEN z ELSE 0 END, 6) AS value FROM px")
def sea_zeroed(spark, sf_dir):
    df = _raster(spark, sf_dir).df.withColumn("nature", (1 + F.pmod(F.col("row") * COLS + F.col("col"), F.lit(33))).between(4, 23).cast("int"))
    return terrain.zero_sea(df).select("row", "col", _r("value"))


@_query("zoom_box", f"WITH {_PX} SELECT row, col FROM px WHERE NOT hole AND lon BETWEEN -30 AND 60 AND lat BETWEEN 50 AND 70")
def zoom_box(spark, sf_dir):
    return assembly.zoomed(_raster(spark, sf_dir, "holes").df, (-30.0, 60.0, 50.0, 70.0)).select("row", "col")


@_query("open_box", f"WITH {_PX} SELECT row, col FROM px WHERE lon > -30 AND lon < 60 AND lat > 50 AND lat < 70")
def open_box(spark, sf_dir):
    return assembly.inside_open(_raster(spark, sf_dir).df, (-30.0, 60.0, 50.0, 70.0)).select("row", "col")


@_query("longitude_convention", f"WITH {_PX} SELECT row, col, round(((lon % 360) + 360) % 360, 6) AS turned, round(lon, 6) AS centred FROM px")
def longitude_convention(spark, sf_dir):
    df = _raster(spark, sf_dir).df
    turned = df.withColumn("turned", match_convention(F.col("lon"), 359.0))
    return turned.select("row", "col", _r("turned"), F.round(match_convention(F.col("turned"), 180.0), 6).alias("centred"))


@_query("celsius", "SELECT event_id, round(value - 273.15, 6) AS value FROM events")
def celsius(spark, sf_dir):
    return assembly.celsius(_table(spark, sf_dir, "events").select("event_id", "value"), ["value"]).select("event_id", _r("value"))


@_query("accumulated", "SELECT event_id, round(value - lag(value, 6) OVER (PARTITION BY user_id ORDER BY ts, event_id), 6) AS value_diff FROM events")
def accumulated(spark, sf_dir):
    d = _table(spark, sf_dir, "events").withColumn("time", F.struct("ts", "event_id"))
    return assembly.accumulated_difference(d, "value", 6, ["user_id"]).select("event_id", _r("value_diff"))


@_query("stacked_features", "SELECT l_orderkey, l_linenumber, 'raw_' || variable AS variable, value FROM (SELECT l_orderkey, l_linenumber, l_quantity, l_tax FROM lineitem) UNPIVOT (value FOR variable IN (l_quantity, l_tax))")
def stacked_features(spark, sf_dir):
    d = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    return assembly.stacked(assembly.prefixed(d, "raw", ["l_orderkey", "l_linenumber"]), ["l_orderkey", "l_linenumber"])


@_query("legacy_cropped", f"WITH {_PX} SELECT row, col FROM px WHERE lat BETWEEN 54.0 AND 66.0 AND lon BETWEEN 0.0 AND 30.0")
def legacy_cropped(spark, sf_dir):
    """The older crop without a radius: a degree all around, in longitude too."""
    r = _raster(spark, sf_dir)
    own = windows.legacy_crop(r.lats, r.lons, np.array([55.0, 65.0]), np.array([1.0, 29.0]))
    return windows.pruned(r.df, *own).select("row", "col")


@_query("tile_counts", f"WITH {_PX} SELECT row // 40 AS tile_row, col // 24 AS tile_col, count(*) AS pixels FROM px GROUP BY 1, 2")
def tile_counts(spark, sf_dir):
    found = _raster(spark, sf_dir).df.groupBy(tile_id(40, 24).alias("tile")).agg(F.count("*").alias("pixels"))
    return found.select(F.col("tile.r").alias("tile_row"), F.col("tile.c").alias("tile_col"), "pixels")


@_query("land_similarity", "SELECT round(corr(l_quantity, l_extendedprice), 9) AS corr FROM lineitem WHERE l_linenumber = 1")
def land_similarity(spark, sf_dir):
    """Correlations over rows without sea only (line numbers stand for sea)."""
    d = _table(spark, sf_dir, "lineitem").withColumn("SFX.FRAC_SEA", F.col("l_linenumber") - 1)
    return features.correlations(features.land_only(d), ["l_quantity", "l_extendedprice"]).where("a = 'l_quantity' and b = 'l_extendedprice'").select(_r("corr", 9))


@_query("recipe_dates", "SELECT date, c_custkey AS point_idx, c_acctbal AS sea FROM customer, (SELECT unnest(generate_series(TIMESTAMP '1979-01-01', TIMESTAMP '2027-01-01', INTERVAL 8760 HOURS)) AS date) WHERE c_nationkey = 3")
def recipe_dates(spark, sf_dir):
    d = _table(spark, sf_dir, "customer").where("c_nationkey = 3").select(F.col("c_custkey").alias("point_idx"), F.col("c_acctbal").alias("sea"))
    return recipe.repeated(d, recipe.dates(spark)).select("date", "point_idx", "sea")


@_query("tile_sums", f"WITH {_PX}, m AS (SELECT *, sum(w * z) OVER (PARTITION BY cell) / sum(w) OVER (PARTITION BY cell) AS mu FROM cell) SELECT cell, round(any_value(mu), 6) AS mean, count(*) AS source_count FROM m GROUP BY cell")
def tile_sums(spark, sf_dir):
    from .streaming.tiles import tile_statistics

    return tile_statistics(_raster(spark, sf_dir).weighted(), GRID).select("cell", _r("mean"), "source_count")


@_query("window_share", None)
def window_share(spark, sf_dir):
    r = _raster(spark, sf_dir)
    rows, cols = windows.source_windows(GRID, r.lats, r.lons)
    return spark.createDataFrame([(sum(b - a + 1 for a, b in rows), sum(b - a + 1 for a, b in cols), windows.selected_share(r, rows, cols))], "rows long, cols long, share double")


def queries() -> dict:
    return dict(Q)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
