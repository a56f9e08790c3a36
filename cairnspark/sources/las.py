"""LAS 1.2-1.4 point files: header, Spark data source over record ranges, writer, CRS records.

Records have a fixed length, so a file is split into ranges of records and
each task seeks to its own.  Only the columns of the requested schema are
built; give a narrow ``.schema(...)`` to read less.  Compressed (LAZ) files
need a decoder that is not available and raise a clear error.  Paths must be
readable by the executors' file system.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
from datetime import date, timedelta

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

RGB_AT = {2: 20, 3: 28, 5: 28, 7: 30, 8: 30, 10: 30}
RECORD = {0: 20, 1: 28, 2: 26, 3: 34, 6: 30, 7: 36, 8: 38}
SCHEMA = "x double, y double, z double, red int, green int, blue int"


def read_header(path: str) -> dict:
    """Fields of the public header, and the CRS if a VLR declares one."""
    with open(path, "rb") as f:
        raw = f.read(375)
        if raw[:4] != b"LASF":
            raise ValueError(f"{path}: not a LAS file")
        u16, u32 = (lambda at: struct.unpack_from("<H", raw, at)[0]), (lambda at: struct.unpack_from("<I", raw, at)[0])
        h = {"version": f"{raw[24]}.{raw[25]}", "header_size": u16(94), "points_at": u32(96), "n_vlrs": u32(100), "format": raw[104] & 0x3F, "compressed": bool(raw[104] & 0x80), "record": u16(105), "count": u32(107)}
        h["system"], h["software"] = (raw[a : a + 32].split(b"\0")[0].decode("latin-1") for a in (26, 58))
        h["scales"], h["offsets"] = struct.unpack_from("<3d", raw, 131), struct.unpack_from("<3d", raw, 155)
        b = struct.unpack_from("<6d", raw, 179)
        h["maxs"], h["mins"] = b[0::2], b[1::2]
        spans = [(h["header_size"], h["n_vlrs"], 54)]
        if raw[25] >= 4 and raw[24] == 1:
            h["count"] = struct.unpack_from("<Q", raw, 247)[0]
            spans.append((struct.unpack_from("<Q", raw, 235)[0], struct.unpack_from("<I", raw, 243)[0], 60))
        guid = raw[8:24]
        h["uuid"] = str(uuid.UUID(bytes_le=guid)) if any(guid) else None
        day, year = u16(90), u16(92)
        h["created"] = str(date(year, 1, 1) + timedelta(days=day - 1)) if year and 0 < day < 367 else None
        h["dimensions"] = dimensions(h["format"])
        h["vlrs"], h["epsg"], h["wkt"] = [], None, None
        for at, n, size in spans:
            for _ in range(n):
                f.seek(at)
                head = f.read(size)
                user, rid = head[2:18].split(b"\0")[0].decode("latin-1"), struct.unpack_from("<H", head, 18)[0]
                length = struct.unpack_from("<H" if size == 54 else "<Q", head, 20)[0]
                data = f.read(length) if rid in (34735, 2112) else b""
                h["vlrs"].append({"user": user, "id": rid, "length": length})
                h["epsg"] = crs_of(rid, data) or h["epsg"]
                if rid == 2112:
                    h["wkt"] = data.split(b"\0")[0].decode("utf-8", "replace")
                at += size + length
    h["has_rgb"] = h["format"] in RGB_AT
    return h


def dimensions(fmt: int) -> list[str]:
    """Names of a point format's fields."""
    first = ["x", "y", "z", "intensity", "return_number", "number_of_returns"]
    old = ["scan_direction_flag", "edge_of_flight_line", "classification", "synthetic", "key_point", "withheld", "scan_angle_rank", "user_data", "point_source_id"]
    new = ["synthetic", "key_point", "withheld", "overlap", "scanner_channel", "scan_direction_flag", "edge_of_flight_line", "classification", "user_data", "scan_angle", "point_source_id"]
    out = first + (old if fmt < 6 else new)
    out += ["gps_time"] * (fmt in (1, 3, 4, 5) or fmt >= 6)
    out += ["red", "green", "blue"] * (fmt in RGB_AT) + ["nir"] * (fmt in (8, 10))
    waves = ["wavepacket_index", "wavepacket_offset", "wavepacket_size", "return_point_wave_location", "x_t", "y_t", "z_t"]
    return out + waves * (fmt in (4, 5, 9, 10))


def crs_of(record_id: int, data: bytes) -> int | None:
    """EPSG code in a GeoKey directory or a WKT record."""
    if record_id == 34735 and len(data) >= 8:
        keys = np.frombuffer(data[: len(data) // 8 * 8], "<u2").reshape(-1, 4)[1:]
        for want in (3072, 2048):
            for k, where, _, value in keys.tolist():
                if k == want and where == 0 and value not in (0, 32767):
                    return value
    if record_id == 2112:
        codes = re.findall(r'(?:AUTHORITY\["EPSG",\s*"(\d+)"\]|ID\["EPSG",\s*(\d+)\])\s*\]\s*\0*\s*$', data.decode("utf-8", "ignore"))
        if codes:
            return int(codes[-1][0] or codes[-1][1])
    return None


def records(path: str, header: dict, start: int, n: int, columns: list[str]) -> dict[str, np.ndarray]:
    """Columns of ``n`` records from number ``start`` on."""
    with open(path, "rb") as f:
        f.seek(header["points_at"] + start * header["record"])
        raw = np.frombuffer(f.read(n * header["record"]), np.uint8).reshape(-1, header["record"])
    out = {}
    for i, c in enumerate("xyz"):
        if c in columns:
            out[c] = raw[:, 4 * i : 4 * i + 4].copy().view("<i4")[:, 0] * header["scales"][i] + header["offsets"][i]
    for i, c in enumerate(("red", "green", "blue")):
        if c in columns:
            at = RGB_AT.get(header["format"])
            out[c] = raw[:, at + 2 * i : at + 2 * i + 2].copy().view("<u2")[:, 0].astype(np.int32) if at else None
    return out


class LasReader(DataSourceReader):
    def __init__(self, schema, options):
        self.columns = schema.fieldNames()
        self.path = options.get("path")
        self.size = int(options.get("records", 1_000_000))
        if not self.path:
            raise ValueError("give a path")

    def partitions(self):
        files = [self.path] if os.path.isfile(self.path) else sorted(os.path.join(self.path, x) for x in os.listdir(self.path) if x.lower().endswith((".las", ".laz")))
        out, room = [], 0  # a task reads a range of a long file, or several short files
        for path in files:
            h = read_header(path)
            if h["compressed"]:
                raise ValueError(f"{path}: LAZ needs a decoder that is not available; convert it to LAS")
            for start in range(0, h["count"], self.size):
                n = min(self.size, h["count"] - start)
                if n > room:
                    out.append([])
                    room = self.size
                out[-1].append((path, h, start, n))
                room -= n
        return [InputPartition(spans) for spans in out] or [InputPartition([])]

    def read(self, partition):
        kinds = {"red": pa.int32(), "green": pa.int32(), "blue": pa.int32()}
        for path, header, start, total in partition.value:
            for lo in range(0, total, 200_000):
                n = min(200_000, total - lo)
                got = records(path, header, start + lo, n, self.columns)
                yield pa.RecordBatch.from_arrays([pa.nulls(n, kinds[c]) if got[c] is None else pa.array(got[c], kinds.get(c, pa.float64())) for c in self.columns], names=self.columns)


class LasSource(DataSource):
    """``spark.read.format("las").load(path)`` after ``register(spark)``."""

    @classmethod
    def name(cls):
        return "las"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return LasReader(schema, self.options)


def geokeys(epsg: int) -> bytes:
    return struct.pack("<12H", 1, 1, 0, 2, 1024, 0, 1, 1, 3072, 0, 1, epsg)


def write_las(path: str, ints: np.ndarray, rgb: np.ndarray, scales, offsets, epsg: int | None = None, fmt: int = 7) -> None:
    """LAS 1.4 of integer coordinates [n, 3] and 16-bit colours [n, 3]."""
    n = len(ints)
    vlr = struct.pack("<H16sHH32s", 0, b"LASF_Projection", 34735, 24, b"") + geokeys(epsg) if epsg else b""
    at = 375 + len(vlr)
    head = bytearray(375)
    head[:4], head[24:26] = b"LASF", bytes([1, 4])
    struct.pack_into("<HIIBHI", head, 94, 375, at, 1 if epsg else 0, fmt, RECORD[fmt], 0)
    struct.pack_into("<6d", head, 131, *scales, *offsets)
    real = ints * np.array(scales) + np.array(offsets)
    lo, hi = (real.min(axis=0), real.max(axis=0)) if n else (np.zeros(3), np.zeros(3))
    struct.pack_into("<6d", head, 179, *[v for pair in zip(hi, lo, strict=True) for v in pair])
    struct.pack_into("<Q", head, 247, n)
    raw = np.zeros((n, RECORD[fmt]), np.uint8)
    raw[:, :12] = np.ascontiguousarray(ints, dtype="<i4").view(np.uint8).reshape(n, 12)
    if fmt in RGB_AT:
        raw[:, RGB_AT[fmt] : RGB_AT[fmt] + 6] = np.ascontiguousarray(rgb, dtype="<u2").view(np.uint8).reshape(n, 6)
    with open(path, "wb") as f:
        f.write(bytes(head) + vlr + raw.tobytes())


def write_parts(points, folder: str, scales=(0.001,) * 3, offsets=(0.0,) * 3, epsg: int | None = None, rows: int = 1_000_000):
    """Write ``points(x, y, z, red, green, blue)`` as LAS files of at most ``rows`` points, a task at a time; returns (file, n).

    ``folder`` must be visible to all executors; files appear whole, and a
    task that runs again replaces its own.
    """

    def run(batches):
        import pandas as pd
        from pyspark import TaskContext

        task, k, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush(part):
            name = os.path.join(folder, f"part-{task:05d}-{k:05d}.las")
            xyz = np.rint((part[["x", "y", "z"]].to_numpy() - offsets) / scales).astype(np.int64)
            write_las(f"{name}.{os.getpid()}", xyz, part[["red", "green", "blue"]].to_numpy(), scales, offsets, epsg)
            os.replace(f"{name}.{os.getpid()}", name)
            return pd.DataFrame({"file": [name], "n": [len(part)]})

        for b in batches:
            while len(b):  # a file is filled before the next begins
                held.append(b.iloc[: rows - size])
                size, b = size + len(held[-1]), b.iloc[rows - size :]
                if size == rows:
                    yield flush(pd.concat(held))
                    k, held, size = k + 1, [], 0
        if held:
            yield flush(pd.concat(held))

    os.makedirs(folder, exist_ok=True)
    return points.select("x", "y", "z", "red", "green", "blue").mapInPandas(run, "file string, n long")


def describe(path: str) -> dict:
    """Header facts with extent, area and point density (null when the area is 0); no point is read."""
    h = read_header(path)
    w, d, up = (b - a for a, b in zip(h["mins"], h["maxs"], strict=True))
    return h | {"extent": (w, d, up), "area": w * d, "density": h["count"] / (w * d) if w * d > 0 else None}


def sample(path: str, count: int = 2000, stops: int = 40) -> np.ndarray:
    """About ``count`` points [n, 3] by seeking to evenly spaced stops; all points of a file that has no more."""
    h = read_header(path)
    if h["compressed"]:
        raise ValueError(f"{path}: LAZ needs a decoder that is not available; convert it to LAS")
    if h["count"] <= count:
        spans = [(0, h["count"])]
    else:
        each = -(-count // stops)
        spans = [(k * (h["count"] - each) // max(1, stops - 1), each) for k in range(stops)]
    got = [records(path, h, start, n, ["x", "y", "z"]) for start, n in spans if n]
    return np.concatenate([np.column_stack([g[c] for c in "xyz"]) for g in got]) if got else np.zeros((0, 3))


def set_crs(path: str, wkt: str, apply: bool = False, force: bool = False) -> dict:
    """Append a WKT record to a LAS 1.4 file and point its header there; returns what restores it. Dry run by default.

    A file that declares a CRS is refused without ``force``; then the new
    record, the last of its kind, counts.
    """
    h = read_header(path)
    if h["version"] != "1.4":
        raise ValueError("only LAS 1.4 files can take an extended record")
    if h["epsg"] and not force:
        raise ValueError(f"the file declares EPSG:{h['epsg']} already")
    size = os.path.getsize(path)
    with open(path, "rb") as f:
        raw = f.read(375)
        at, n = struct.unpack_from("<QI", raw, 235)
        end = at if n else size
        for _ in range(n):
            f.seek(end + 20)
            end += 60 + struct.unpack("<Q", f.read(8))[0]
    if end != size:
        raise ValueError("the file has data after its extended records")
    undo = {"size": size, "header": raw[6:8] + raw[235:247]}
    body = wkt.encode() + b"\0"
    if apply:
        with open(path, "r+b") as f:
            f.seek(size)
            f.write(struct.pack("<H16sHQ32s", 0, b"LASF_Projection", 2112, len(body), b"WKT") + body)
            f.seek(6)
            f.write(struct.pack("<H", struct.unpack_from("<H", raw, 6)[0] | 16))
            f.seek(235)
            f.write(struct.pack("<QI", at if n else size, n + 1))
    return undo


def restore_crs(path: str, undo: dict) -> None:
    with open(path, "r+b") as f:
        f.seek(6)
        f.write(undo["header"][:2])
        f.seek(235)
        f.write(undo["header"][2:])
        f.truncate(undo["size"])


def register(spark) -> None:
    """Register the ``las`` format; the package goes along, as Spark plans and reads in other Python processes."""
    import shutil
    import tempfile

    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if not getattr(spark, "_cairn_shipped", False):
        spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="cairnspark-"), "cairnspark"), "zip", os.path.dirname(package), os.path.basename(package)))
        spark._cairn_shipped = True
    spark.dataSource.register(LasSource)
