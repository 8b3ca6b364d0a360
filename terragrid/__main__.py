"""Command line: ``python -m terragrid --source-file F --domain D --mode M --output O``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .operators.output import write_result
from .plans.aggregate import aggregate
from .sources.grid import Grid
from .sources.netcdf import read_netcdf
from .sources.raster import Raster
from .sources.zarr import read_zarr


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="terragrid", description="Statistics of a raster on a target grid.")
    p.add_argument("--source-file", required=True, help=".nc (classic), .zarr, or Parquet with row, col, lat, lon and the variable")
    p.add_argument("--source-var", default="value")
    p.add_argument("--mode", default="fractions", choices=("fractions", "mean", "std", "slope"))
    p.add_argument("--domain", required=True, help="a preset's name")
    p.add_argument("--point-file", help="Parquet with point_idx, lat and lon")
    p.add_argument("--latitude")
    p.add_argument("--longitude")
    p.add_argument("--memory-mb", type=int, default=128, help="accepted and not used: Spark owns partitioning")
    p.add_argument("--radius-m", type=float)
    p.add_argument("--fill-missing-mean", type=float)
    p.add_argument("--fill-uncovered", "--fill-uncovered-mean", dest="fill_uncovered", type=float)
    p.add_argument("--output", required=True)
    return p


def open_raster(spark: SparkSession, path: str, variable: str, latitude: str | None = None, longitude: str | None = None) -> Raster:
    """A raster from a file by its ending."""
    if path.endswith(".nc"):
        return read_netcdf(spark, path, variable, latitude, longitude)
    if path.rstrip("/").endswith(".zarr"):
        return read_zarr(spark, path, variable, latitude or "latitude", longitude or "longitude")
    df = spark.read.parquet(path)
    df = df.select("row", "col", df[latitude or "lat"].alias("lat"), df[longitude or "lon"].alias("lon"), df[variable].alias("value"))
    axis = lambda key, name: [r[1] for r in sorted(df.groupBy(key).agg({name: "min"}).collect())]  # noqa: E731  (an axis, not the pixels)
    return Raster.of(df, axis("row", "lat"), axis("col", "lon"))


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    if args.memory_mb < 1:
        raise ValueError("memory-mb must be positive")
    spark = SparkSession.builder.appName("terragrid").getOrCreate()
    raster = open_raster(spark, args.source_file, args.source_var, args.latitude, args.longitude)
    points = spark.read.parquet(args.point_file) if args.point_file else None
    done = aggregate(raster, Grid.preset(args.domain), args.mode, points=points, radius_m=args.radius_m, fill_missing_mean=args.fill_missing_mean, fill_uncovered=args.fill_uncovered)
    write_result(done, args.output, {k: v for k, v in vars(args).items() if v is not None}, undefined="nan")


if __name__ == "__main__":
    main()
