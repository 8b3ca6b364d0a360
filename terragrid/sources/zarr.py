"""Zarr (version 2) arrays, decoded by Spark tasks, one chunk each.

Metadata is read on the driver; chunks are read by Spark's ``binaryFile``
source, so any file system works.  A chunk that is not stored holds missing values.
"""

from __future__ import annotations

import json
import math
import zlib

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .netcdf import pixels, plane
from .raster import Raster


def metadata(spark: SparkSession, path: str) -> dict:
    """The parsed ``.zarray`` of an array."""
    jvm = spark.sparkContext._jvm  # Spark's sources skip names that begin with a dot
    at = jvm.org.apache.hadoop.fs.Path(f"{path}/.zarray")
    stream = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(at)
    try:
        meta = json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    if meta["zarr_format"] != 2 or meta.get("filters"):
        raise ValueError("only version 2 arrays without filters are read")
    return meta


def inflate(raw: bytes, compressor: dict | None) -> bytes:
    """A chunk's bytes; no compressor, zlib, gzip and zstd are known."""
    kind = (compressor or {}).get("id")
    if kind is None:
        return raw
    if kind in ("zlib", "gzip"):
        return zlib.decompress(raw, 47)
    if kind == "zstd":
        import zstandard

        return zstandard.ZstdDecompressor().decompressobj().decompress(raw)
    raise ValueError(f"unknown compressor {kind}")


def decode_chunk(raw: bytes, meta: dict) -> np.ndarray:
    """A chunk's values as doubles; the fill value is NaN."""
    stored = np.frombuffer(inflate(raw, meta["compressor"]), meta["dtype"]).reshape(meta["chunks"], order=meta["order"])
    out = stored.astype(float)
    fill = meta["fill_value"]
    if fill is not None and not isinstance(fill, str):
        out[stored == np.asarray(fill).astype(stored.dtype)] = np.nan
    return out


def read_vector(spark: SparkSession, path: str) -> np.ndarray:
    """A one-dimensional array (an axis), on the driver."""
    meta = metadata(spark, path)
    n, size = meta["shape"][0], meta["chunks"][0]
    found = {int(r.path.rsplit("/", 1)[1]): r.content for r in spark.read.format("binaryFile").option("pathGlobFilter", "[0-9]*").load(path).select("path", "content").collect()}
    parts = [np.frombuffer(inflate(found[i], meta["compressor"]), meta["dtype"]) for i in range(-(-n // size))]
    return np.concatenate(parts)[:n]


def read_zarr(spark: SparkSession, path: str, variable: str, latitude: str = "latitude", longitude: str = "longitude", dims: tuple[str, ...] | None = None, index: dict[str, int] | None = None) -> Raster:
    """A variable of a group as a raster.

    ``dims`` names its dimensions (None: the last two are latitude and
    longitude, earlier ones dim_0, dim_1 ...); those other than latitude and
    longitude are taken at ``index``.
    """
    at = f"{path.rstrip('/')}/{variable}"
    meta = metadata(spark, at)
    shape, chunks = meta["shape"], meta["chunks"]
    dims = dims or (*(f"dim_{i}" for i in range(len(shape) - 2)), latitude, longitude)
    if len(dims) != len(shape):
        raise ValueError(f"{variable} has {len(shape)} dimensions, not {dims}")
    index = {d: 0 for d in dims if d not in (latitude, longitude)} | (index or {})
    plane(np.empty([0 if d in (latitude, longitude) else n for d, n in zip(dims, shape, strict=True)], "u1"), dims, latitude, longitude, index)
    dot = meta.get("dimension_separator", ".")
    wanted = [[index[d] // c] if d in index else range(-(-n // c)) for d, n, c in zip(dims, shape, chunks, strict=True)]
    inner = {d: index[d] % c for d, c in zip(dims, chunks, strict=True) if d in index}
    rank_lat, rank_lon = dims.index(latitude), dims.index(longitude)

    def cut(values: np.ndarray, key: list[int]):
        row, col = (key[r] * chunks[r] for r in (rank_lat, rank_lon))
        own = plane(values, dims, latitude, longitude, inner)
        return pixels(own[: shape[rank_lat] - row, : shape[rank_lon] - col], row, col)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "[0-9]*").load(at)
    key = F.substring_index("path", dot if dot == "/" else "/", -len(shape) if dot == "/" else -1)
    keyed = files.select(F.transform(F.split(key, r"\." if dot == "." else "/"), lambda x: x.cast("int")).alias("key"), "content")
    for i, d in enumerate(dims):
        if d in index:
            keyed = keyed.where(F.col("key")[i] == wanted[i][0])
    numbers, parts = [len(w) for w in wanted], []
    for i, w in enumerate(wanted):
        parts.append((F.lit(w[0]) + F.expr(f"(id div {math.prod(numbers[i + 1 :])}) % {numbers[i]}")).cast("int"))
    absent = spark.range(math.prod(numbers)).select(F.array(*parts).alias("key")).join(keyed.select("key"), "key", "left_anti")  # names only: content is pruned

    def decoded(batches):
        for batch in batches:
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                yield from cut(decode_chunk(raw.as_py(), meta), k)

    def missing(batches):
        for batch in batches:
            for k in batch.column(0).to_pylist():
                yield from cut(np.full(chunks, np.nan), k)

    schema = "row long, col long, value double"
    df = keyed.mapInArrow(decoded, schema).unionByName(absent.mapInArrow(missing, schema))
    return Raster.of(df, *(read_vector(spark, f"{path.rstrip('/')}/{n}") for n in (latitude, longitude)))
