"""Building and checking a tileset: points to voxels, levels, features, tiles, documents."""

from __future__ import annotations

import json
import os
import time

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from cairnspark.functions import crs, glb
from cairnspark.operators import properties as P
from cairnspark.operators import tiles as T
from cairnspark.operators import voxel as V
from cairnspark.schema import FACES, BuildConfig, GridSpec, check_key_space, pyramid_depth
from cairnspark.sources import outdir

FLAGS = [f for f, *_ in FACES]
TILE = (
    "level int, tx long, tz long, cell_size double, x0 long, x1 long, z0 long, z1 long, y_min long, y_max long, "
    "cubes long, triangles long, bytes long, content binary, props string"
)


def encode_tiles(ids: DataFrame, grid: GridSpec, depth: int, config: BuildConfig, props=()) -> DataFrame:
    """One row per tile with its tight bounds and binary content; a tile is a group of at most brick x height x brick cells."""
    held = ids.sparkSession.sparkContext.broadcast(list(props))

    def encode(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row_in_tile")
        level = depth - int(pdf["depth"].iloc[0])
        cell = grid.voxel_size * 2.0 ** int(pdf["depth"].iloc[0])
        index = pdf[["gx", "gy", "gz"]].to_numpy()
        centers, rgb = (index + 0.5) * cell, pdf[["r", "g", "b"]].to_numpy().astype(np.uint8)
        notes = {}
        if config.mode == "instanced":
            blob, stats = glb.instanced(centers, rgb, cell, config.palette_bits, config.generator)
        else:
            columns = None
            if held.value:
                columns = [("FeatureID", pdf["feature_id"].to_numpy().astype(np.int32), "INT32")]
                for p in held.value:
                    v, counters = P.sample(p, grid.origin[0] + centers[:, 0], grid.origin[1] - centers[:, 2], cell, config.epsg)
                    columns.append((p.name, v, p.component))
                    codes, n = np.unique(v, return_counts=True)
                    notes[p.name] = counters | {"min": float(v.min()), "max": float(v.max()), "sum": float(v.astype(float).sum()), "classes": dict(zip(map(str, codes.tolist()), n.tolist(), strict=True)) if p.categorical else None}
            blob, stats = glb.baked(centers, rgb, pdf[FLAGS].to_numpy(), cell, config.color_bits, columns, config.generator)
        (x0, y0, z0), (x1, y1, z1) = index.min(axis=0).tolist(), index.max(axis=0).tolist()
        row = (level, int(pdf["tx"].iloc[0]), int(pdf["tz"].iloc[0]), cell, x0, x1 + 1, z0, z1 + 1, y0, y1, stats["cubes"], stats["triangles"], len(blob), blob, json.dumps(notes))
        return pd.DataFrame([row], columns=[c.split()[0] for c in TILE.split(", ")])

    columns = ["depth", "tx", "tz", "gx", "gy", "gz", "r", "g", "b", *FLAGS, "row_in_tile", "feature_id"]
    return ids.select(*columns).groupBy("depth", "tx", "tz").applyInPandas(encode, TILE)


def write_tiles(tiles: DataFrame, out: str, config: BuildConfig) -> DataFrame:
    """Write each tile's content under ``out``/content and return the rows without it."""
    zipped, raw = config.gzip or config.gzip_only, not config.gzip_only

    def run(batches):
        for b in batches:
            for r in b.itertuples():
                outdir.write_file(os.path.join(out, "content", f"L{r.level}_{r.tx}_{r.tz}.glb"), r.content, zipped, raw)
            yield b.drop(columns=["content"])

    return tiles.mapInPandas(run, TILE.replace("content binary, ", ""))


def node_tree(bounds: list, depth: int) -> dict:
    """Nested tileset nodes from tiles with their bounds."""

    def box(t):
        cs = t.cell_size
        e, n, u = (t.x0 * cs, t.x1 * cs), (-t.z1 * cs, -t.z0 * cs), (t.y_min * cs, (t.y_max + 1.0) * cs)
        half = [(b - a) / 2 for a, b in (e, n, u)]
        return [*((a + b) / 2 for a, b in (e, n, u)), half[0], 0.0, 0.0, 0.0, half[1], 0.0, 0.0, 0.0, half[2]]

    by = {(t.level, t.tx, t.tz): t for t in bounds}

    def node(t):
        out = {"boundingVolume": {"box": box(t)}, "geometricError": 0.0 if t.level == depth else t.cell_size, "refine": "REPLACE", "content": {"uri": f"content/L{t.level}_{t.tx}_{t.tz}.glb"}}
        kids = [node(by[k]) for dx in (0, 1) for dz in (0, 1) if (k := (t.level + 1, 2 * t.tx + dx, 2 * t.tz + dz)) in by]
        return out | ({"children": kids} if kids else {})

    top = min(t.level for t in bounds)
    roots = sorted((t for t in bounds if t.level == top), key=lambda t: (t.tx, t.tz))
    if len(roots) == 1:
        return node(roots[0])
    lo = [min(b[i] - b[3 + 4 * i] for b in map(box, roots)) for i in range(3)]
    hi = [max(b[i] + b[3 + 4 * i] for b in map(box, roots)) for i in range(3)]
    c, h = [(a + b) / 2 for a, b in zip(lo, hi, strict=True)], [(b - a) / 2 for a, b in zip(lo, hi, strict=True)]
    return {"boundingVolume": {"box": [*c, h[0], 0, 0, 0, h[1], 0, 0, 0, h[2]]}, "geometricError": roots[0].cell_size * 2, "refine": "REPLACE", "children": [node(t) for t in roots]}


def build(points: DataFrame, out: str, config: BuildConfig | None = None, rasters: dict | None = None, cut=None, say=None, settings: dict | None = None) -> dict:
    """Build a tileset from ``points`` into the folder ``out``; returns the report.

    ``rasters`` maps property names to ``geotiff.Raster``, ``settings`` to
    their kind, labels and colours (a config's entries).  ``cut`` may
    materialise a level and the drawn cells (a checkpoint on a cluster); by
    default they are cached for the build.  Only the tile table, a row per
    tile, comes to the driver, with bounds that the encoding tasks found.
    ``say`` gets a line per milestone; all lines go to ``log/build.log`` too.
    """
    began, lines, held = time.time(), [], []

    def note(text):
        lines.append(f"{time.time() - began:9.2f} s  {text}")
        if say:
            say(text)

    def keep(df):
        held.append(cut(df) if cut else df.persist())
        return held[-1]

    config = (config or BuildConfig()).check()
    if rasters and config.mode == "instanced":
        raise ValueError("properties need baked mode")
    P.check_names([{"name": n} for n in rasters or {}])
    grid = V.grid_spec(points, config.voxel_size)
    check_key_space(grid.dims, config.brick)
    ox, oy, oz = grid.origin
    sides = [n * config.voxel_size for n in grid.dims]
    note(f"grid {' x '.join(map(str, grid.dims))} from {grid.n_points:,} points")
    props = []
    for name, r in (rasters or {}).items():
        props.append(P.prepare(name, r, (settings or {}).get(name)))
        share = P.coverage(props[-1], (ox, oy - sides[2], ox + sides[0], oy), config.epsg)
        if share <= 0:
            raise ValueError(f"{name}: the raster does not overlap the points")
        note(f"{name}: the raster covers {100 * share:.1f} % of the site")
    outdir.clear(out, config.overwrite)
    depth = (config.levels - 1) if config.levels else pyramid_depth(grid.dims, config.brick)
    faces = V.pyramid(points, grid, depth + 1, config.brick, "rgb" if grid.coloured else "height", keep)
    ids = T.feature_ids(keep(faces.where("nf > 0")))
    tiles = write_tiles(encode_tiles(ids, grid, depth, config, props), out, config).collect()
    voxels = held[0].count()
    note(f"{voxels:,} voxels, {len(tiles):,} tiles")
    for df in held if cut is None else []:
        df.unpersist()
    root = node_tree(tiles, depth)
    residual = lonlat = None
    if config.epsg:
        root["transform"], residual = crs.placement(config.epsg, grid.origin, (sides[0], sides[1], sides[2]))
        lonlat = [float(np.ravel(v)[0]) for v in crs.transform(config.epsg, 4979, np.array([ox]), np.array([oy]), np.array([oz]))]
        note(f"placed within {residual['max_horizontal_m']:.3f} m, {residual['max_vertical_m']:.3f} m in height")
    documents = describe(config, grid, depth, tiles, props, voxels, residual, lonlat)
    tileset = {"asset": {"version": "1.1", "tilesetVersion": config.generator, "gltfUpAxis": "Y"}}
    if props:
        tileset["properties"] = {n: {"minimum": p["minimum"], "maximum": p["maximum"]} for n, p in documents["specs.json"]["properties"].items()}
    tileset |= {"geometricError": config.voxel_size * 2 ** (depth + 1), "root": root}
    outdir.write_file(os.path.join(out, "tileset.json"), json.dumps(tileset, indent=2).encode(), config.gzip or config.gzip_only, not config.gzip_only)
    documents["report.json"]["seconds"] = round(time.time() - began, 2)
    note("done")
    for name, body in documents.items():
        outdir.write_file(os.path.join(out, name), json.dumps(body, indent=2).encode(), False, True)
    outdir.write_file(os.path.join(out, outdir.LOG), ("\n".join(lines) + "\n").encode(), False, True)
    return documents["report.json"]


def describe(config: BuildConfig, grid: GridSpec, depth: int, tiles: list, props: list, voxels: int, residual, lonlat) -> dict:
    """``specs.json`` (what the tileset is) and ``report.json`` (what the build counted)."""
    notes = [json.loads(t.props) for t in tiles]
    sizes = [config.voxel_size * 2 ** (depth - k) for k in range(depth + 1)]
    per_level = [
        {"level": k, "cell_size": size, "tiles": len(own), **{c: sum(t[c] for t in own) for c in ("cubes", "triangles", "bytes")}}
        for k, size in enumerate(sizes) for own in [[t for t in tiles if t.level == k]]
    ]
    totals = {c: sum(x[c] for x in per_level) for c in ("tiles", "cubes", "triangles", "bytes")}
    crs_name = crs.utm(config.epsg)[3] if config.epsg else None
    origin = dict(zip(("easting", "northing", "height"), grid.origin, strict=True))
    specs = {
        "generator": config.generator,
        "source": {"points": grid.n_points, "minimum": list(grid.mins), "maximum": list(grid.maxs)},
        "georeference": {
            "horizontal_epsg": config.epsg, "crs_name": crs_name, "grid_origin_world": origin, "origin_lonlat": lonlat, "voxel_size": config.voxel_size, "placement_residual": residual,
            "placement": "root.transform takes metres east, north and up of the origin to EPSG:4978; tile content has y up" if config.epsg else "local metres, no root transform",
        },
        "grid": {"voxel_size": config.voxel_size, "dims": list(grid.dims), "brick": config.brick, "voxel_count": voxels, "levels": [{"level": k, "cell_size": size} for k, size in enumerate(sizes)]},
        "encoding": {"content": "glb", "mode": config.mode, "draco": False, "color": "COLOR_0 FLOAT32 VEC3", "color_bits": config.color_bits, "exact_color": config.color_bits >= 8},
    }
    report = {
        "generator": config.generator, "mode": config.mode, "draco": False, "gzip": "only" if config.gzip_only else config.gzip, "color_bits": config.color_bits, "exact_color": config.color_bits >= 8,
        "voxel_size": config.voxel_size, "brick": config.brick, "levels": depth + 1, "epsg": config.epsg, "crs_name": crs_name, "origin": list(grid.origin), "origin_lonlat": lonlat,
        "placement_residual": residual, "grid_dims": list(grid.dims), "voxel_count": voxels, "points": grid.n_points, "content": "glb", "totals": totals, "per_level": per_level, "properties": {},
    }
    if props:
        specs["encoding"]["feature_id"] = "_FEATURE_ID_0 per vertex, one value a cube, as FLOAT: the cube's row in the tile's property table"
        specs["feature_id"] = {"property": "FeatureID", "component_type": "INT32", "scope": "a number for each cube of each level, without gaps", "min": 0, "max": totals["cubes"] - 1}
        specs["properties"] = {}
        report["feature_ids"] = totals["cubes"]
    for p in props:
        own = [n[p.name] for n in notes]
        classes = {k: sum(n["classes"].get(k, 0) for n in own) for k in sorted({k for n in own for k in n["classes"]}, key=int)} if p.categorical else None
        kind = "categorical" if p.categorical else "continuous"
        legend = {"classes": {k: P.legend(p, int(k)) | {"cells": n} for k, n in classes.items()}} if p.categorical else {}
        specs["properties"][p.name] = {"kind": kind, "component_type": p.component, "minimum": min(n["min"] for n in own), "maximum": max(n["max"] for n in own), "raster_epsg": p.epsg} | legend
        report["properties"][p.name] = {
            "on_filled": sum(n["on_filled"] for n in own), "outside": sum(n["outside"] for n in own), "max_ring": max(n["max_ring"] for n in own), "mean": sum(n["sum"] for n in own) / totals["cubes"], "classes": classes
        }
    return {"specs.json": specs, "report.json": report}
