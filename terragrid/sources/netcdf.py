"""NetCDF classic files (CDF-1, CDF-2 and CDF-5), decoded by Spark tasks, one file each.

Files are read by Spark's ``binaryFile`` source, so any file system works and
many files are read at once; one file may hold 2 GB at most (a Spark limit).
NetCDF-4 files are HDF5 and need a library that is not a dependency here.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from .raster import Raster, find_axis

#: External types by their codes (fixed values of the file format).
TYPES = {1: "i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8", 7: "u1", 8: ">u2", 9: ">u4", 10: ">i8", 11: ">u8"}


class Classic:
    """Header and variables of one classic file.

    ``dims``: lengths by name (the record dimension has its number of records);
    ``attrs``: of the file; ``variables``: name to (dimension names, attributes, type, begin, is a record variable).
    """

    def __init__(self, raw: bytes):
        if raw[:3] != b"CDF" or raw[3] not in (1, 2, 5):
            raise ValueError("not a NetCDF classic file")
        self.raw, self._at = raw, 4
        self._count = 8 if raw[3] == 5 else 4
        self._offset = 4 if raw[3] == 1 else 8
        records = self._int(self._count)
        names, lengths = [], []
        for _ in range(self._list()):
            names.append(self._name())
            lengths.append(self._int(self._count))
        self.attrs = self._attrs()
        self.variables, padded = {}, []
        for _ in range(self._list()):
            name = self._name()
            ids = [self._int(self._count) for _ in range(self._int(self._count))]
            own, kind = self._attrs(), np.dtype(TYPES[self._int(4)])
            self._int(self._count)
            begin = self._int(self._offset)
            record = bool(ids) and lengths[ids[0]] == 0
            if record:
                size = kind.itemsize * math.prod(lengths[i] for i in ids[1:])
                padded.append((size, size + -size % 4))
            self.variables[name] = (tuple(names[i] for i in ids), own, kind, begin, record)
        self._record = padded[0][0] if len(padded) == 1 else sum(p for _, p in padded)
        if records == (1 << 8 * self._count) - 1:  # a stream: as many as the file has room for
            first = min(v[3] for v in self.variables.values() if v[4])
            records = (len(raw) - first) // self._record
        self.dims = {n: k or records for n, k in zip(names, lengths, strict=True)}

    def _int(self, size: int) -> int:
        self._at += size
        return int.from_bytes(self.raw[self._at - size : self._at], "big")

    def _list(self) -> int:
        self._int(4)
        return self._int(self._count)

    def _bytes(self, n: int) -> bytes:
        out = self.raw[self._at : self._at + n]
        self._at += n + -n % 4
        return out

    def _name(self) -> str:
        return self._bytes(self._int(self._count)).decode()

    def _attrs(self) -> dict:
        out = {}
        for _ in range(self._list()):
            name, kind = self._name(), np.dtype(TYPES[self._int(4)])
            n = self._int(self._count)
            raw = self._bytes(n * kind.itemsize)
            values = np.frombuffer(raw, kind)
            out[name] = raw.decode(errors="replace") if kind.kind == "S" else values[0].item() if n == 1 else values.tolist()
        return out

    def values(self, name: str) -> np.ndarray:
        """A variable's stored values."""
        dims, _, kind, begin, record = self.variables[name]
        shape = [self.dims[d] for d in dims]
        if not record:
            return np.frombuffer(self.raw, kind, math.prod(shape), begin).reshape(shape)
        each = math.prod(shape[1:])
        parts = [np.frombuffer(self.raw, kind, each, begin + i * self._record) for i in range(shape[0])]
        return np.concatenate(parts or [np.zeros(0, kind)]).reshape(shape)

    def decoded(self, name: str) -> np.ndarray:
        """A variable as doubles: fill values are NaN, scale and offset applied."""
        raw, attrs = self.values(name), self.variables[name][1]
        out = raw.astype(float)
        for key in ("_FillValue", "missing_value"):
            if key in attrs:
                out[np.isin(raw, np.asarray(attrs[key]).astype(raw.dtype))] = np.nan
        return out * attrs.get("scale_factor", 1) + attrs.get("add_offset", 0)


def plane(values: np.ndarray, dims: tuple, lat: str, lon: str, index: dict[str, int] | None = None) -> np.ndarray:
    """The (lat, lon) plane of an array; other dimensions are taken at ``index`` (0 unless given)."""
    index = index or {}
    if unknown := set(index) - set(dims):
        raise ValueError(f"unknown dimensions {sorted(unknown)}")
    if lat not in dims or lon not in dims:
        raise ValueError(f"the variable has dimensions {dims}, not {lat} and {lon}")
    for axis, name in reversed(list(enumerate(dims))):
        if name not in (lat, lon):
            k = index.get(name, 0)
            if not 0 <= k < values.shape[axis]:
                raise ValueError(f"index {k} is outside dimension {name}")
            values = values.take(k, axis)
    return values if dims.index(lat) < dims.index(lon) else values.T


def pixels(values: np.ndarray, first_row: int = 0, first_col: int = 0):
    """A plane as record batches (row, col, value) of one row of pixels each; what is not a number is null."""
    import pyarrow as pa

    for i, line in enumerate(values):
        yield pa.RecordBatch.from_pydict({
            "row": pa.array(np.full(len(line), first_row + i, np.int64)), "col": pa.array(np.arange(first_col, first_col + len(line), dtype=np.int64)),
            "value": pa.array(line.astype(float), mask=np.isnan(line.astype(float))),
        })


def read_netcdf(spark: SparkSession, path: str, variable: str, latitude: str | None = None, longitude: str | None = None, index: dict[str, int] | None = None) -> Raster:
    """A variable of one file as a raster; axes by the names given, else by standard or usual names."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def axes(batches):
        import pyarrow as pa

        for batch in batches:
            for raw in batch.column(0):
                file = Classic(raw.as_py())
                if variable not in file.variables:
                    raise ValueError(f"no variable {variable} among {sorted(file.variables)}")
                own = {d: file.variables[d][1].get("standard_name") for d in file.variables[variable][0] if d in file.variables}
                lat, lon = latitude or find_axis(own, "lat"), longitude or find_axis(own, "lon")
                for name in (lat, lon):
                    units = file.variables[name][1].get("units", "degrees")
                    if not str(units).startswith("degree"):
                        raise ValueError(f"{name} has units {units}, not degrees")
                found = [np.asarray(file.values(x)) for x in (lat, lon)]
                yield pa.RecordBatch.from_pydict({
                    "lat": [lat], "lon": [lon], "kinds": [[x.dtype.newbyteorder("=").str for x in found]], "lats": pa.array([found[0].astype(float).tolist()], pa.list_(pa.float64())), "lons": pa.array([found[1].astype(float).tolist()], pa.list_(pa.float64())),
                })

    found = files.mapInArrow(axes, "lat string, lon string, kinds array<string>, lats array<double>, lons array<double>").collect()
    if len(found) != 1:
        raise ValueError(f"{path} is {len(found)} files")
    lat, lon, kinds, lats, lons = found[0]

    def decoded(batches):
        for batch in batches:
            for raw in batch.column(0):
                file = Classic(raw.as_py())
                yield from pixels(plane(file.decoded(variable), file.variables[variable][0], lat, lon, index))

    df: DataFrame = files.mapInArrow(decoded, "row long, col long, value double")
    return Raster.of(df, np.asarray(lats, kinds[0]), np.asarray(lons, kinds[1]))
