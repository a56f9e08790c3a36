"""A small GeoTIFF codec: strips, uncompressed or deflate, one plane, colour map, geo keys, nodata."""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from cairnspark.operators.raster import Affine
from cairnspark.sources.las import crs_of, geokeys

_TYPES = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 11: "f", 12: "d", 16: "Q"}
_KINDS = {(1, 8): "u1", (2, 8): "i1", (1, 16): "u2", (2, 16): "i2", (1, 32): "u4", (2, 32): "i4", (3, 32): "f4", (3, 64): "f8"}


@dataclass
class Raster:
    values: np.ndarray
    affine: Affine
    epsg: int | None
    nodata: float | None = None
    palette: dict[int, tuple[int, int, int]] = field(default_factory=dict)

    @property
    def valid(self) -> np.ndarray:
        ok = np.ones(self.values.shape, bool) if self.nodata is None else self.values != self.nodata
        return ok & np.isfinite(self.values) if self.values.dtype.kind == "f" else ok

    @property
    def kind(self) -> str:
        return "categorical" if self.palette else "continuous"

    def table(self, spark: SparkSession) -> DataFrame:
        """(row, col, value, valid) with value double."""
        r, c = np.indices(self.values.shape)
        import pandas as pd

        return spark.createDataFrame(pd.DataFrame({"row": r.ravel().astype("int32"), "col": c.ravel().astype("int32"), "value": self.values.ravel().astype(float), "valid": self.valid.ravel()}))


def read(raw: bytes, band: int = 1) -> Raster:
    """Decode one band; errors name what is not supported."""
    order = {b"II": "<", b"MM": ">"}.get(raw[:2])
    if order is None or struct.unpack_from(order + "H", raw, 2)[0] != 42:
        raise ValueError("not a classic TIFF file")
    at = struct.unpack_from(order + "I", raw, 4)[0]
    tags = {}
    for i in range(struct.unpack_from(order + "H", raw, at)[0]):
        tag, kind, n = struct.unpack_from(order + "HHI", raw, at + 2 + 12 * i)
        code = _TYPES.get(kind)
        if code is None:
            continue
        size = struct.calcsize("=" + code) * n
        where = at + 10 + 12 * i if size <= 4 else struct.unpack_from(order + "I", raw, at + 10 + 12 * i)[0]
        tags[tag] = raw[where : where + n] if code == "s" else struct.unpack_from(f"{order}{n * len(code)}{code[0]}", raw, where)
    w, h, samples = tags[256][0], tags[257][0], tags.get(277, (1,))[0]
    if not 1 <= band <= samples:
        raise ValueError(f"band {band} not in 1..{samples}")
    if 322 in tags or tags.get(317, (1,))[0] != 1:
        raise ValueError("tiled or predicted TIFF files are not supported")
    if 34264 in tags:
        raise ValueError("rotated rasters are not supported")
    method = tags.get(259, (1,))[0]
    if method not in (1, 8, 32946):
        raise ValueError(f"TIFF compression {method} is not supported")
    dtype = np.dtype(order + _KINDS[tags.get(339, (1,))[0], tags[258][0]])
    strips = [raw[o : o + n] for o, n in zip(tags[273], tags[279], strict=True)]
    data = np.frombuffer(b"".join(zlib.decompress(s) if method != 1 else s for s in strips), dtype)
    if tags.get(284, (1,))[0] == 2:
        values = data.reshape(samples, h, w)[band - 1]
    else:
        values = data.reshape(h, w, samples)[:, :, band - 1]
    sx, sy, _ = tags[33550]
    i, j, _, x, y, _ = tags[33922][:6]
    keys = tags.get(34735)
    epsg = crs_of(34735, struct.pack(f"<{len(keys)}H", *keys)) if keys else None
    nodata = float(tags[42113].split(b"\0")[0]) if 42113 in tags else None
    values = values.astype(dtype.newbyteorder("="))
    palette = {}
    if 320 in tags:
        n = len(tags[320]) // 3
        seen = np.unique(values if nodata is None else values[values != nodata])
        palette = {int(k): tuple(tags[320][c * n + int(k)] >> 8 for c in range(3)) for k in seen if k < n}
    return Raster(values, Affine(sx, x - i * sx, -sy, y + j * sy, w, h), epsg, nodata, palette)


def write(r: Raster, deflate: bool = False) -> bytes:
    a = np.ascontiguousarray(r.values)
    fmt = {"u": 1, "i": 2, "f": 3}[a.dtype.kind]
    body = zlib.compress(a.tobytes()) if deflate else a.tobytes()
    t = r.affine
    tags = [(256, 4, (t.width,)), (257, 4, (t.height,)), (258, 3, (a.dtype.itemsize * 8,)), (259, 3, (8 if deflate else 1,)), (262, 3, (3 if r.palette else 1,)), (273, 4, (8,)), (277, 3, (1,)), (278, 4, (t.height,)), (279, 4, (len(body),))]
    if r.palette:
        tags.append((320, 3, tuple(r.palette.get(k, (0, 0, 0))[c] * 257 for c in range(3) for k in range(256))))
    tags += [(339, 3, (fmt,)), (33550, 12, (t.a, -t.e, 0.0)), (33922, 12, (0.0, 0.0, 0.0, t.c, t.f, 0.0))]
    if r.epsg:
        key = bytearray(geokeys(r.epsg))
        if r.epsg in (4326, 4979):
            struct.pack_into("<H", key, 16, 2048)
        tags.append((34735, 3, struct.unpack("<12H", bytes(key))))
    if r.nodata is not None:
        tags.append((42113, 2, f"{r.nodata:g}".encode() + b"\0"))
    at = 8 + len(body) + len(body) % 2
    extra, entries = b"", b""
    for tag, kind, v in tags:
        data = v if kind == 2 else struct.pack(f"<{len(v)}{_TYPES[kind]}", *v)
        if len(data) > 4:
            where = at + 2 + 12 * len(tags) + 4 + len(extra)
            extra += data + b"\0" * (len(data) % 2)
            data = struct.pack("<I", where)
        entries += struct.pack("<HHI", tag, kind, len(v)) + data.ljust(4, b"\0")
    return struct.pack("<2sHI", b"II", 42, at) + body + b"\0" * (len(body) % 2) + struct.pack("<H", len(tags)) + entries + b"\0" * 4 + extra
