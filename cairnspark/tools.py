"""Tools beside the builder: ``python -m cairnspark.tools guess-crs | set-crs | upload | verify``.

Exit codes: 0 done, 1 run error or failed checks, 2 wrong usage.  ``set-crs``
and ``upload`` only show what they would do unless told to apply it.
"""

from __future__ import annotations

import argparse
import json
import os
import re
import sys

from cairnspark.functions import crs
from cairnspark.sources import las, outdir


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser("cairnspark.tools")
    kinds = p.add_subparsers(dest="tool", required=True)
    g = kinds.add_parser("guess-crs", help="what a file's coordinates may be")
    g.add_argument("file")
    g.add_argument("--near", nargs="+", metavar="LON,LAT", help="where the site is: LON,LAT or LON LAT")
    g.add_argument("--tolerance", type=float, default=60.0, help="kilometres")
    g.add_argument("--samples", type=int, default=2000)
    g.add_argument("--limit", type=int, default=15)
    s = kinds.add_parser("set-crs", help="write a CRS record into a LAS 1.4 file")
    s.add_argument("file")
    s.add_argument("--epsg", type=int)
    s.add_argument("--wkt-flavour", choices=("WKT1_GDAL",), default="WKT1_GDAL")
    s.add_argument("--apply", action="store_true")
    s.add_argument("--restore", action="store_true", help="undo by the backup beside the file")
    s.add_argument("--force", action="store_true", help="even if the file declares a CRS")
    u = kinds.add_parser("upload", help="what publishing a folder would send; transfer is not part of this engine")
    u.add_argument("folder")
    u.add_argument("dest")
    v = kinds.add_parser("verify", help="check a tileset folder")
    v.add_argument("folder")
    v.add_argument("--input", help="the LAS file or folder it was built from")
    return p


def hint(words: list[str]) -> tuple[float, float]:
    """Longitude and latitude from one or two words."""
    parts = [x for x in re.split(r"[,\s]+", " ".join(words)) if x]
    if len(parts) != 2:
        raise ValueError("--near wants a longitude and a latitude")
    lon, lat = map(float, parts)
    if not (-180 <= lon <= 180 and -90 <= lat <= 90):
        raise ValueError("--near is no place on earth")
    return lon, lat


def guess(a) -> list[str]:
    h = las.read_header(a.file)
    lows, highs = h["mins"], h["maxs"]
    lines = [f"declared: {'EPSG:%d' % h['epsg'] if h['epsg'] else 'none'}"]
    if not h["compressed"] and h["count"]:
        points = las.sample(a.file, a.samples)
        lows, highs = points.min(axis=0).tolist(), points.max(axis=0).tolist()
        lines.append(f"{len(points):,} points sampled; all inside the header's bounds: {'yes' if all(x >= y - 1e-6 for x, y in zip(lows, h['mins'], strict=True)) and all(x <= y + 1e-6 for x, y in zip(highs, h['maxs'], strict=True)) else 'no'}")
    lines += crs.family(lows, highs)
    east, north = ((lows[k] + highs[k]) / 2 for k in (0, 1))
    if a.near:
        found = crs.search(east, north, *hint(a.near), a.tolerance)
        lines += [f"{r['km']:9.3f} km  EPSG:{r['epsg']:<6} {r['name']}" for r in found[: a.limit]] or [f"no known system puts the hint within {a.tolerance:g} km; the hint or the units may be wrong"]
    elif "degrees" not in lines:
        found = crs.zones_of(east, north)
        lines += [f"EPSG:{r['epsg']}  {r['lon']:9.4f}  {r['lat']:8.4f}" for r in found[: a.limit]]
        lines.append(f"{len(found)} zones read these numbers as a place inside themselves; --near tells them apart")
    return lines


def backup(path: str) -> str:
    return path + ".crs-backup.json"


def write_crs(a) -> list[str]:
    saved = backup(a.file)
    if a.restore:
        with open(saved) as f:
            undo = json.load(f)
        las.restore_crs(a.file, {"size": undo["size"], "header": bytes.fromhex(undo["header"])})
        os.remove(saved)
        return [f"restored {a.file}"]
    text = crs.wkt(a.epsg)
    undo = las.set_crs(a.file, text, force=a.force)
    if not a.apply:
        return [text, f"would append {len(text) + 61} bytes and change 14 bytes of the header; --apply does it"]
    if os.path.exists(saved):
        raise FileExistsError(f"{saved} exists; --restore first")
    outdir.write_file(saved, json.dumps({"size": undo["size"], "header": undo["header"].hex()}).encode(), False, True)
    las.set_crs(a.file, text, apply=True, force=a.force)
    if las.read_header(a.file)["epsg"] != a.epsg:
        raise ValueError("the record does not read back")
    return [f"EPSG:{a.epsg} written; {saved} restores the file"]


def bounds_of(path: str) -> tuple[list[float], list[float]]:
    """Bounds over the headers of a file or a folder of files."""
    files = [path] if os.path.isfile(path) else sorted(os.path.join(path, n) for n in os.listdir(path) if n.lower().endswith((".las", ".laz")))
    heads = [las.read_header(f) for f in files]
    return [min(h["mins"][k] for h in heads) for k in range(3)], [max(h["maxs"][k] for h in heads) for k in range(3)]


def main(argv: list[str] | None = None, spark=None) -> int:
    p = parser()
    a = p.parse_args([re.sub(r"^(-[0-9.]+)", r" \1", x) for x in (sys.argv[1:] if argv is None else argv)])  # a leading blank keeps -45.1 from being an option
    path = getattr(a, "file", None) or a.folder
    if not os.path.exists(path):
        p.error(f"{path} does not exist")
    try:
        if a.tool == "guess-crs" and a.near:
            hint(a.near)
        if a.tool == "set-crs" and not a.restore:
            if not a.epsg:
                raise ValueError("--epsg is required")
            crs.utm(a.epsg)
    except ValueError as e:
        p.error(str(e))
    try:
        if a.tool == "verify":
            from pyspark.sql import SparkSession
            from pyspark.sql import functions as F

            from cairnspark.plans.verify import verify

            spark = spark or SparkSession.builder.appName("cairnspark").getOrCreate()
            las.register(spark)
            rows = verify(spark, a.folder, bounds_of(a.input) if a.input else None).groupBy("label").agg(F.count("*").alias("n"), F.count_if(~F.col("ok")).alias("bad"), F.min(F.when(~F.col("ok"), F.col("tile"))).alias("first")).orderBy("label").collect()
            for r in rows:
                print(f"{'ok  ' if not r.bad else 'FAIL'} {r.label}: {r.n - r.bad} of {r.n}" + (f", first {r.first}" if r.bad else ""))
            return int(any(r.bad for r in rows))
        if a.tool == "upload":
            lines = [f"{r['file']} -> {a.dest.rstrip('/')}/{r['key']}  {r['type']}  {r['encoding'] or '-'}  {r['cache']}  {r['bytes']}" for r in outdir.upload_plan(a.folder)]
        else:
            lines = guess(a) if a.tool == "guess-crs" else write_crs(a)
        print("\n".join(lines))
        return 0
    except Exception as e:  # one line for the user
        print(f"error: {e}", file=sys.stderr)
    return 1


if __name__ == "__main__":
    sys.exit(main())
