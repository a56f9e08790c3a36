import hashlib
import importlib.util
import json
import os

import numpy as np
import pytest

from cairnspark.functions import crs, glb
from cairnspark.operators import properties
from cairnspark.operators.raster import Affine
from cairnspark.plans import build, verify
from cairnspark.schema import BuildConfig, GridSpec, check_key_space, level_dims, pyramid_depth
from cairnspark.sources import geotiff, las, outdir

_spec = importlib.util.spec_from_file_location("survey_site", os.path.join(os.path.dirname(__file__), "site.py"))
site = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(site)
BRICK = 32


@pytest.fixture(scope="module")
def cloud(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("las") / "site.las")
    xyz, rgb = site.points()
    las.write_las(path, xyz, rgb, (0.001,) * 3, (site.EAST, site.NORTH, 0.0), site.EPSG)
    las.register(spark)
    return path, spark.read.format("las").option("records", 30_000).load(path)


def landcover():
    i, j = np.indices((55, 60))
    v = np.where((i + j) % 7 == 0, 0, np.where(i % 5 == 0, 1, np.where(j > 30, 3, 4))).astype(np.uint8)
    v[20:30, 40:50] = 255
    return geotiff.Raster(v, Affine(2.0, site.EAST, -2.0, site.NORTH + 110, 60, 55), site.EPSG, 255, {0: (0, 90, 200), 1: (220, 50, 50), 3: (20, 120, 40), 4: (150, 200, 90)})


def test_baked_tileset(spark, cloud, tmp_path):
    out = str(tmp_path / "t")
    r = build.build(cloud[1], out, BuildConfig(epsg=las.read_header(cloud[0])["epsg"], brick=BRICK))
    dims, voxels, levels = site.count(BRICK)
    assert r["points"] == len(site.points()[0]) and r["grid_dims"] == list(dims) and r["voxel_count"] == voxels
    assert [(x["tiles"], x["cubes"], x["triangles"]) for x in r["per_level"]] == [(t, c, 2 * f) for t, c, f in levels]
    assert len(levels) > 2 and levels[-1][1] < voxels  # the deck has cells inside
    assert r["placement_residual"]["max_horizontal_m"] < 0.01 and r["placement_residual"]["max_vertical_m"] < 0.01
    assert r["origin_lonlat"][0] == pytest.approx(-44.999999027, abs=1e-8) and -22.606 < r["origin_lonlat"][1] < -22.604
    assert [row.ok for row in verify.verify(spark, out).select("ok").distinct().collect()] == [True]
    with pytest.raises(FileExistsError):
        build.build(cloud[1], out)
    tileset = json.load(open(os.path.join(out, "tileset.json")))
    tileset["root"]["children"][0]["boundingVolume"]["box"][3] -= 0.01
    json.dump(tileset, open(os.path.join(out, "tileset.json"), "w"))
    assert verify.verify(spark, out).where("not ok").count() > 0


def test_instanced_gzip_and_properties(spark, cloud, tmp_path):
    r = build.build(cloud[1], str(tmp_path / "i"), BuildConfig(mode="instanced", gzip_only=True, brick=BRICK))
    cubes = sum(c for _, c, _ in site.count(BRICK)[2])
    assert r["totals"]["cubes"] == cubes and r["totals"]["triangles"] == 12 * cubes
    assert all(n.endswith(".gz") for n in os.listdir(tmp_path / "i" / "content"))
    assert verify.verify(spark, str(tmp_path / "i")).where("not ok").count() == 0
    p = build.build(cloud[1], str(tmp_path / "p"), BuildConfig(epsg=site.EPSG, brick=BRICK), {"Cover": landcover()}, settings={"Cover": {"labels": {"1": "roof"}, "colors": {"4": "#88cc44"}}})
    assert sum(p["properties"]["Cover"]["classes"].values()) == cubes and p["properties"]["Cover"]["outside"] > 0
    blob = (tmp_path / "p" / "content" / "L0_0_0.glb").read_bytes()
    assert verify.verify(spark, str(tmp_path / "p")).where("not ok").count() == 0
    tables = [glb.metadata_checks((tmp_path / "p" / "content" / n).read_bytes(), p["voxel_size"] * 2 ** (p["levels"] - 1 - int(n[1])), {}) for n in os.listdir(tmp_path / "p" / "content")]
    assert sorted(np.concatenate([ids for _, ids in tables]).tolist()) == list(range(cubes)) and all(ok for found, _ in tables for _, ok in found)
    assert not all(ok for _, ok in glb.metadata_checks(blob, p["voxel_size"], {})[0])  # the wrong cell size mixes cubes up
    assert not all(ok for _, ok in glb.metadata_checks(blob, p["voxel_size"] * 2 ** (p["levels"] - 1), {"Cover": {"minimum": 1, "maximum": 1}})[0])
    legend = json.load(open(tmp_path / "p" / "specs.json"))["properties"]["Cover"]["classes"]
    assert legend["1"]["label"] == "roof" and legend["4"]["color"] == "#88cc44" and legend["0"]["color"] == "#005ac8" and sum(c["cells"] for c in legend.values()) == cubes
    assert all(ok for _, ok in glb.checks(blob))
    assert glb.unpack(blob)[0]["extensionsUsed"] == ["EXT_mesh_features", "EXT_structural_metadata"]


def test_las_header_crs_and_restore(cloud, tmp_path):
    h = las.describe(cloud[0])
    assert h["count"] == len(site.points()[0]) and h["epsg"] == 31983 and h["mins"][0] == 500000.1 and h["density"] > 1
    path = str(tmp_path / "a.las")
    xyz, rgb = site.points()
    las.write_las(path, xyz[:10], rgb[:10], (0.001,) * 3, (0.0,) * 3)
    before = hashlib.sha256(open(path, "rb").read()).hexdigest()
    assert las.read_header(path)["epsg"] is None
    undo = las.set_crs(path, 'PROJCS["x",AUTHORITY["EPSG","31983"]]')
    assert hashlib.sha256(open(path, "rb").read()).hexdigest() == before
    las.set_crs(path, 'PROJCS["x",AUTHORITY["EPSG","31983"]]', apply=True)
    assert las.read_header(path)["epsg"] == 31983 and las.read_header(path)["count"] == 10 and las.read_header(path)["wkt"].startswith("PROJCS")
    assert las.read_header(path)["dimensions"][-4:] == ["gps_time", "red", "green", "blue"] and las.read_header(path)["uuid"] is None
    las.restore_crs(path, undo)
    assert hashlib.sha256(open(path, "rb").read()).hexdigest() == before


def test_narrow_schema_reads_only_it(spark, cloud):
    assert spark.read.format("las").schema("x double").load(cloud[0]).columns == ["x"]


def test_geotiff_round_trip():
    for r in (landcover(), geotiff.Raster(np.arange(12, dtype=np.float32).reshape(3, 4), Affine(5e-5, -45.0, -5e-5, -22.0, 4, 3), 4326, -9999.0)):
        for deflate in (False, True):
            back = geotiff.read(geotiff.write(r, deflate))
            assert (back.values == r.values).all() and back.affine == r.affine and back.epsg == r.epsg and back.nodata == r.nodata and back.palette == r.palette and back.kind == r.kind
    with pytest.raises(ValueError):
        geotiff.read(geotiff.write(landcover()), 2)


def test_fill_and_sampling():
    v = np.array([[1, 9, 9], [9, 9, 9], [9, 9, 4]], np.uint8)
    filled, ring = properties.fill(v, v != 9, True)
    assert filled.tolist() == [[1, 1, 4], [1, 4, 4], [4, 4, 4]] and ring.max() == 2
    p = properties.prepare("c", landcover())
    got, counters = properties.sample(p, np.array([site.EAST + 1.0, site.EAST + 1e6]), np.array([site.NORTH + 109.0, 0.0]), 8.0, site.EPSG)
    assert got[0] in (0, 1, 3, 4) and counters["outside"] == 1
    with pytest.raises(ValueError):
        properties.load_config({"properties": [{"name": "a", "what": 1}]})
    for bad in ("FeatureID", "2x", ""):
        with pytest.raises(ValueError):
            properties.check_names([{"name": bad}])


def test_property_rules_and_rounding():
    bad = [{"name": "a"}, {"name": "a"}, {"name": "b", "kind": "odd"}, {"name": "c", "nodata": "zero"}, {"name": "9x"}]
    with pytest.raises(ValueError) as e:
        properties.check_names(bad)
    assert all(part in str(e.value) for part in ("same name", "kind is unknown", "nearest", "no digit"))
    r = geotiff.Raster(np.array([[0, 255], [255, 255]], np.uint8), Affine(1.0, 0.0, -1.0, 2.0, 2, 2), site.EPSG)
    p = properties.prepare("v", r, {"kind": "continuous"})
    p.filled = np.array([[-3.0, 300.0], [254.6, 1.2]])  # outside the stored type's range
    got, _ = properties.sample(p, np.array([0.5, 1.5, 0.5, 1.5]), np.array([1.5, 1.5, 0.5, 0.5]), 0.1, site.EPSG)
    assert got.dtype == np.uint8 and got.tolist() == [0, 255, 255, 1]


def test_tile_bytes_are_laid_out_by_rule():
    centers, rgb = np.array([[0.5, 0.5, 0.5], [2.5, 0.5, 0.5], [2.5, 0.5, 4.5]]), np.array([[10, 20, 30], [200, 100, 50], [205, 110, 60]], np.uint8)
    blob, stats = glb.baked(centers, rgb, np.ones((3, 6), bool), 1.0, properties=[("FeatureID", np.arange(3, dtype=np.int32), "INT32"), ("Kind", np.array([1, 2, 3], np.uint8), "UINT8")])
    doc, binary = glb.unpack(blob)
    assert stats == {"cubes": 3, "triangles": 36} and all(ok for _, ok in glb.checks(blob))
    end = 0
    for v, align in zip(doc["bufferViews"], (4, 4, 4, 4, 4, 8, 8), strict=True):
        assert v["byteOffset"] == -(-end // align) * align
        end = v["byteOffset"] + v["byteLength"]
    assert doc["buffers"] == [{"byteLength": end}] and len(binary) == -(-end // 4) * 4
    ids = doc["bufferViews"][5]
    assert np.frombuffer(binary, "<i4", 3, ids["byteOffset"]).tolist() == [0, 1, 2] and binary[doc["bufferViews"][6]["byteOffset"] :][:3] == b"\1\2\3"
    blob, stats = glb.instanced(centers, rgb, 1.0)
    doc, binary = glb.unpack(blob)
    assert stats["palette_entries"] == 2 and len(doc["nodes"]) == 2 and all(ok for _, ok in glb.checks(blob))
    assert sorted(doc["accessors"][n["extensions"]["EXT_mesh_gpu_instancing"]["attributes"]["TRANSLATION"]]["count"] for n in doc["nodes"]) == [1, 2]
    assert glb.bounds(blob) == ([0.0, 0.0, 0.0], [3.0, 1.0, 5.0])


def test_coordinates():
    e, n = np.array([500100.5, 650000.0]), np.array([7500280.1, 7000000.0])
    x, y, z = crs.transform(31983, 4978, e, n, np.array([762.55, 0.0]))
    back = crs.transform(4978, 31983, x, y, z)
    assert np.allclose(back[0], e, atol=1e-6) and np.allclose(back[1], n, atol=1e-6) and np.allclose(back[2], [762.55, 0], atol=1e-6)
    assert crs.zones_near(500150.0, 7500140.0, -45.0, -22.6)[0]["epsg"] == 32723
    with pytest.raises(ValueError, match="not supported"):
        crs.utm(2154)


def test_settings_and_limits():
    g = GridSpec(1.0, (0.1, 0.1, 0.0), (9.9, 4.0, 2.0))
    assert g.dims == (10, 3, 4) and g.origin == (0.1, 4.1, 0.0)
    assert pyramid_depth((300, 38, 280), 64) == 3 and level_dims((300, 38, 280), 3) == (38, 5, 35)
    with pytest.raises(ValueError):
        check_key_space((1 << 30, 1 << 12, 1 << 30), 64)
    for wrong in ({"voxel_size": 0}, {"brick": 1}, {"levels": 0}, {"mode": "x"}, {"draco": True}):
        with pytest.raises(ValueError):
            BuildConfig(**wrong).check()


def test_output_folder_safety(tmp_path):
    (tmp_path / "mine.txt").write_text("keep")
    assert outdir.inspect(str(tmp_path))["kind"] == "foreign"
    with pytest.raises(FileExistsError):
        outdir.clear(str(tmp_path), True)
    assert [p.name for p in tmp_path.iterdir()] == ["mine.txt"]
    out = tmp_path / "new"
    outdir.clear(str(out), False)
    outdir.write_file(str(out / "content" / "L0_0_0.glb"), b"x", True, True)
    (out / "notes.txt").write_text("keep")
    found = outdir.inspect(str(out))
    assert found["kind"] == "own" and "notes.txt" in found["keep"] and "content/L0_0_0.glb.gz" in found["delete"]
    outdir.clear(str(out), True)
    assert (out / "notes.txt").exists() and not (out / "content" / "L0_0_0.glb").exists()


def test_streamed_sums_equal_batch(spark, tmp_path):
    from cairnspark.operators.voxel import cell_sums, grid_spec
    from cairnspark.plans.cloud import points
    from cairnspark.streaming.voxels import start

    p = points(spark, "/root/testdata/sf0.001")
    p.repartition(3).write.parquet(str(tmp_path / "p"))
    grid = grid_spec(p)
    q = start(spark.readStream.schema(p.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "p")), grid, "cells")
    q.processAllAvailable()
    q.stop()
    assert sorted(spark.table("cells").collect()) == sorted(cell_sums(p, grid).collect())
