"""Files in public array formats, and the command line."""

import json
import struct
import zlib

import numpy as np
import pytest

from terragrid.__main__ import main
from terragrid.sources.netcdf import TYPES, Classic, plane, read_netcdf
from terragrid.sources.zarr import read_zarr

LATS, LONS = np.array([70.0, 69.0, 68.0], "f4"), np.arange(-4.0, 4.0, 1.0)
DATA = np.arange(24, dtype="i2").reshape(3, 8)


def name(x):
    return struct.pack(">i", len(x)) + x.encode() + b"\0" * (-len(x) % 4)


def attrs(own):
    out = b"\0" * 8 if not own else struct.pack(">ii", 12, len(own))
    for k, v in own.items():
        if isinstance(v, str):
            out += name(k) + struct.pack(">i", 2) + name(v)
        else:
            raw = np.asarray(v)
            code = next(c for c, t in TYPES.items() if np.dtype(t) == raw.dtype.newbyteorder(">") and c > 2)
            body = raw.astype(raw.dtype.newbyteorder(">")).tobytes()
            out += name(k) + struct.pack(">ii", code, raw.size) + body + b"\0" * (-len(body) % 4)
    return out


def classic(dims, variables, records=0):
    """A CDF-2 file; ``variables``: name to (dims, attributes, big-endian array); dimension length 0 is the record one."""
    ids = list(dims)

    def header(begins):
        out = b"CDF\x02" + struct.pack(">i", records) + struct.pack(">ii", 10, len(dims)) + b"".join(name(d) + struct.pack(">i", n) for d, n in dims.items()) + attrs({})
        out += struct.pack(">ii", 11, len(variables))
        for (k, (own, a, v)), at in zip(variables.items(), begins, strict=True):
            code = next(c for c, t in TYPES.items() if np.dtype(t) == v.dtype)
            out += name(k) + struct.pack(">i", len(own)) + b"".join(struct.pack(">i", ids.index(d)) for d in own) + attrs(a) + struct.pack(">iiq", code, 0, at)
        return out

    begin, begins, fixed, moving = len(header([0] * len(variables))), {}, b"", []
    for k, (own, _, v) in variables.items():
        if dims[own[0]]:
            begins[k] = begin + len(fixed)
            fixed += v.tobytes() + b"\0" * (-v.nbytes % 4)
        else:
            moving.append(k)
    at = begin + len(fixed)
    for k in moving:
        begins[k] = at
        at += variables[k][2][0].nbytes + -variables[k][2][0].nbytes % 4
    tail = b"".join(variables[k][2][i].tobytes() + b"\0" * (-variables[k][2][i].nbytes % 4) for i in range(records) for k in moving)
    return header([begins[k] for k in variables]) + fixed + tail


@pytest.fixture
def nc(tmp_path):
    made = classic(
        {"lat": 3, "lon": 8},
        {"lat": (("lat",), {"units": "degrees_north"}, LATS.astype(">f4")), "lon": (("lon",), {"standard_name": "longitude"}, LONS.astype(">f8")), "COVER": (("lat", "lon"), {"_FillValue": np.int16(5), "scale_factor": np.float64(2.0)}, DATA.astype(">i2"))},
    )
    (tmp_path / "a.nc").write_bytes(made)
    return str(tmp_path / "a.nc")


def grid_of(raster):
    out = np.full(DATA.shape, -1.0)
    for r in raster.df.collect():
        out[r.row, r.col] = np.nan if r.value is None else r.value
    return out


def test_netcdf_reads_back(spark, nc):
    raster = read_netcdf(spark, nc, "COVER")
    want = DATA * 2.0
    want[0, 5] = np.nan
    np.testing.assert_array_equal(grid_of(raster), want)
    np.testing.assert_allclose(raster.lats, LATS)
    assert raster.df.where("row = 1 and col = 2").select("lat", "lon").first() == (69.0, -2.0)


def test_netcdf_records_and_errors(spark, nc):
    values = np.arange(12, dtype=">f8").reshape(2, 2, 3)
    other = np.arange(2, dtype=">i2").reshape(2, 1)
    file = Classic(classic({"time": 0, "y": 2, "x": 3, "one": 1}, {"v": (("time", "y", "x"), {"note": "abc"}, values), "w": (("time", "one"), {}, other)}, 2))
    assert file.dims["time"] == 2 and file.variables["v"][1] == {"note": "abc"}
    np.testing.assert_array_equal(file.values("v"), values)
    np.testing.assert_array_equal(file.values("w"), other)
    np.testing.assert_array_equal(plane(file.values("v"), ("time", "y", "x"), "x", "y", {"time": 1}), values[1].T)
    for index in ({"time": 2}, {"z": 0}):
        with pytest.raises(ValueError):
            plane(file.values("v"), ("time", "y", "x"), "y", "x", index)
    with pytest.raises(ValueError):
        Classic(b"\x89HDF....")


@pytest.mark.parametrize(("compressor", "order", "dot"), [(None, "C", "."), ({"id": "zlib"}, "F", "/"), ({"id": "zstd"}, "C", ".")])
def test_zarr_reads_back(spark, tmp_path, compressor, order, dot):
    import zstandard

    pack = {None: bytes, "zlib": zlib.compress, "zstd": lambda x: zstandard.ZstdCompressor().compress(x)}[(compressor or {}).get("id")]
    cube = np.stack([DATA, DATA + 100]).astype("<f4")

    def put(at, array, chunks, skip=()):
        (tmp_path / "g.zarr" / at).mkdir(parents=True)
        meta = {"zarr_format": 2, "shape": array.shape, "chunks": chunks, "dtype": array.dtype.str, "compressor": compressor, "fill_value": 103.0, "order": order, "filters": None, "dimension_separator": dot}
        (tmp_path / "g.zarr" / at / ".zarray").write_text(json.dumps(meta))
        for key in np.ndindex(*(-(-n // c) for n, c in zip(array.shape, chunks, strict=True))):
            if key in skip:
                continue
            block = np.zeros(chunks, array.dtype)
            own = array[tuple(slice(k * c, (k + 1) * c) for k, c in zip(key, chunks, strict=True))]
            block[tuple(slice(0, n) for n in own.shape)] = own
            file = tmp_path / "g.zarr" / at / dot.join(map(str, key))
            file.parent.mkdir(parents=True, exist_ok=True)
            file.write_bytes(pack(block.tobytes(order)))

    put("latitude", LATS, (2,))
    put("longitude", LONS, (8,))
    put("v", cube, (1, 2, 5), skip={(1, 1, 1)})
    want = cube[1].astype(float)
    want[want == 103] = np.nan
    want[2:, 5:] = np.nan
    np.testing.assert_array_equal(grid_of(read_zarr(spark, str(tmp_path / "g.zarr"), "v", index={"dim_0": 1})), want)


def test_command_line(spark, nc, tmp_path):
    out = str(tmp_path / "out")
    main(["--source-file", nc, "--source-var", "COVER", "--mode", "mean", "--domain", "metcoop", "--fill-uncovered", "-1", "--output", out])
    got = spark.read.parquet(out)
    assert got.where("mean_data_status = 0").count() > 0 and got.where("mean_data_status = 2 and mean <> -1").isEmpty()
    assert json.loads(spark.read.text(f"{out}_provenance").first()[0])["domain"] == "metcoop"
