"""Command line: ``python -m cairnspark -i site.las -o out``.  Exit codes: 0 done, 1 run error, 2 wrong usage."""

from __future__ import annotations

import argparse
import json
import os
import sys

from cairnspark import __version__
from cairnspark.functions import crs
from cairnspark.operators.properties import check_names, load_config
from cairnspark.schema import BuildConfig
from cairnspark.sources import geotiff, las, outdir


def parse(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser("cairnspark", description="Point cloud to a pyramid of coloured cubes as 3D Tiles.")
    p.add_argument("--version", action="version", version=__version__)
    p.add_argument("-i", "--input", required=True, help="a LAS file or a folder of LAS files")
    p.add_argument("-o", "--output", help="output folder")
    p.add_argument("--info", action="store_true", help="print header facts and stop")
    p.add_argument("--epsg", type=int, help="CRS of files that declare none")
    p.add_argument("--mode", choices=("baked", "instanced"), default="baked")
    p.add_argument("--color-bits", type=int, default=8)
    p.add_argument("--palette-bits", type=int, default=2)
    p.add_argument("--voxel-size", type=float, default=1.0)
    p.add_argument("--brick", type=int, default=64)
    p.add_argument("--levels", type=int)
    p.add_argument("--property", action="append", default=[], metavar="NAME=PATH")
    p.add_argument("--properties", metavar="JSON", help="property config; paths are relative to it")
    p.add_argument("--gzip", action="store_true")
    p.add_argument("--gzip-only", action="store_true")
    p.add_argument("--overwrite", action="store_true")
    p.add_argument("--draco", action="store_true")
    p.add_argument("-q", "--quiet", action="store_true")
    a = p.parse_args(argv)
    if not os.path.exists(a.input):
        p.error(f"{a.input} does not exist")
    if not a.info and not a.output:
        p.error("--output is required")
    a.specs = []
    try:
        if a.properties:
            with open(a.properties) as f:
                folder = os.path.dirname(os.path.abspath(a.properties))
                a.specs = [s | {"file": os.path.join(folder, s["file"])} for s in load_config(json.load(f))]
        for text in a.property:
            name, eq, path = text.partition("=")
            if not eq or not path:
                raise ValueError(f"--property wants NAME=PATH, not {text!r}")
            a.specs.append({"name": name, "file": path})
        check_names(a.specs)
        for s in a.specs:
            if not os.path.exists(s["file"]):
                raise ValueError(f"{s['name']}: {s['file']} does not exist")
        if a.epsg:
            crs.utm(a.epsg)
        a.config = BuildConfig(a.voxel_size, a.brick, a.levels, a.mode, a.color_bits, a.palette_bits, a.draco, a.epsg, a.gzip, a.gzip_only, a.overwrite, properties=a.specs).check()
    except (ValueError, KeyError, OSError) as e:
        p.error(str(e))
    return a


def crs_text(epsg: int | None) -> str:
    if not epsg:
        return "none declared"
    try:
        return f"EPSG:{epsg} ({crs.utm(epsg)[3]})"
    except ValueError:
        return f"EPSG:{epsg}"


def info_text(h: dict) -> str:
    density = "unknown" if h["density"] is None else f"{h['density']:.3f} points per square unit"
    rows = [
        ("version", h["version"]), ("point format", h["format"]), ("points", f"{h['count']:,}"), ("colours", "yes" if h["has_rgb"] else "no"), ("compressed", "yes" if h["compressed"] else "no"),
        ("dimensions", ", ".join(h["dimensions"])), ("created", h["created"] or "unknown"), ("project id", h["uuid"] or "none"),
        ("CRS", crs_text(h["epsg"])), ("WKT", h["wkt"] or "none"), ("minimum", h["mins"]), ("maximum", h["maxs"]), ("extent", h["extent"]), ("density", density),
        ("scales", h["scales"]), ("offsets", h["offsets"]), ("system", h["system"]), ("software", h["software"]), ("records", ", ".join(f"{v['user']}/{v['id']}" for v in h["vlrs"]) or "none"),
    ]
    return "\n".join(f"{k:>14}: {v}" for k, v in rows)


def main(argv: list[str] | None = None, spark=None) -> int:
    a = parse(sys.argv[1:] if argv is None else argv)
    try:
        first = a.input if os.path.isfile(a.input) else os.path.join(a.input, sorted(os.listdir(a.input))[0])
        if a.info:
            print(info_text(las.describe(first)))
            return 0
        from pyspark.sql import SparkSession

        from cairnspark.plans.build import build

        declared = las.read_header(first)["epsg"]
        if declared:
            if a.epsg and a.epsg != declared and not a.quiet:
                print(f"The file declares EPSG:{declared}; --epsg is ignored.")
            a.config.epsg = declared
        if not outdir.confirm(a.output, a.overwrite, input if sys.stdin and sys.stdin.isatty() else None):
            outdir.clear(a.output, False)  # says why it refuses
        spark = spark or SparkSession.builder.appName("cairnspark").getOrCreate()
        las.register(spark)
        rasters = {}
        for s in a.specs:
            with open(s["file"], "rb") as f:
                rasters[s["name"]] = geotiff.read(f.read(), s.get("band", 1))
        kept = open(a.properties, "rb").read() if a.properties else None  # it may lie in the output folder
        a.config.overwrite = True
        report = build(spark.read.format("las").load(a.input), a.output, a.config, rasters, say=None if a.quiet else print, settings={s["name"]: s for s in a.specs})
        if kept is not None:
            outdir.write_file(os.path.join(a.output, "properties.config.json"), kept, False, True)
        if not a.quiet:
            for x in report["per_level"]:
                print(f"level {x['level']}: cell {x['cell_size']:g}, tiles {x['tiles']}, cubes {x['cubes']:,}, triangles {x['triangles']:,}, bytes {x['bytes']:,}")
        return 0
    except KeyboardInterrupt:
        print("cancelled", file=sys.stderr)
    except Exception as e:  # one line for the user; the traceback is for developers
        print(f"error: {e}", file=sys.stderr)
    return 1


if __name__ == "__main__":
    sys.exit(main())
