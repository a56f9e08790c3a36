import json

import numpy as np
import pytest

from cairnspark.__main__ import main
from cairnspark.operators.raster import Affine
from cairnspark.sources import geotiff, las, outdir
from cairnspark.tools import main as tool


@pytest.fixture
def small(tmp_path):
    path = str(tmp_path / "a.las")
    xyz = np.column_stack([np.arange(50) * 700, np.arange(50) * 900, np.arange(50) * 40])
    las.write_las(path, xyz, np.full((50, 3), 25600), (0.001,) * 3, (500000.0, 7500000.0, 0.0), 31983)
    return path


@pytest.mark.parametrize("extra", [[], ["-o", "x", "--voxel-size", "0"], ["-o", "x", "--brick", "1"], ["-o", "x", "--levels", "0"], ["-o", "x", "--epsg", "2154"], ["-o", "x", "--property", "a"], ["-o", "x", "--property", "FeatureID=a.tif"], ["-o", "x", "--draco"], ["-o", "x", "--mode", "round"]])
def test_wrong_usage(small, extra):
    with pytest.raises(SystemExit) as e:
        main(["-i", small, *extra])
    assert e.value.code == 2


def test_missing_input_and_version(tmp_path):
    for argv, code in ((["-i", str(tmp_path / "none.las"), "-o", "x"], 2), (["--version"], 0)):
        with pytest.raises(SystemExit) as e:
            main(argv)
        assert e.value.code == code


def test_info(small, capsys):
    assert main(["-i", small, "--info"]) == 0
    assert "EPSG:31983" in capsys.readouterr().out


def test_build_and_run_errors(spark, small, tmp_path, capsys):
    r = geotiff.Raster(np.arange(1600, dtype=np.float32).reshape(40, 40), Affine(1.0, 500000.0, -1.0, 7500045.0, 40, 40), 31983)
    (tmp_path / "h.tif").write_bytes(geotiff.write(r))
    (tmp_path / "p.json").write_text(json.dumps({"defaults": {"kind": "continuous"}, "properties": [{"name": "Height", "file": "h.tif"}]}))
    out = str(tmp_path / "out")
    assert main(["-i", small, "-o", out, "--properties", str(tmp_path / "p.json"), "--brick", "16"], spark) == 0
    assert json.load(open(f"{out}/tileset.json"))["properties"]["Height"]["maximum"] > 0
    assert open(f"{out}/properties.config.json").read() == (tmp_path / "p.json").read_text()
    assert open(f"{out}/log/build.log").read().rstrip().endswith("done")
    specs, report = (json.load(open(f"{out}/{n}.json")) for n in ("specs", "report"))
    assert specs["feature_id"] == {"property": "FeatureID", "component_type": "INT32", "scope": specs["feature_id"]["scope"], "min": 0, "max": report["feature_ids"] - 1}
    assert specs["grid"]["dims"] == report["grid_dims"] and specs["properties"]["Height"]["kind"] == "continuous" and "per_level" not in specs
    assert tool(["verify", out, "--input", small], spark) == 0
    specs["georeference"]["grid_origin_world"]["northing"] += 1
    (tmp_path / "out" / "specs.json").write_text(json.dumps(specs))
    capsys.readouterr()
    assert tool(["verify", out, "--input", small], spark) == 1
    told = capsys.readouterr().out
    assert "FAIL origin at the northern edge" in told and "FAIL placed within half a voxel" in told and "ok   FeatureID is unique" in told
    far = geotiff.Raster(np.ones((4, 4), np.uint8), Affine(1.0, 700000.0, -1.0, 7500045.0, 4, 4), 31983)
    (tmp_path / "far.tif").write_bytes(geotiff.write(far))
    assert main(["-i", small, "-o", str(tmp_path / "o3"), "--property", f"A={tmp_path / 'far.tif'}"], spark) == 1
    assert "does not overlap" in capsys.readouterr().err and not (tmp_path / "o3" / "tileset.json").exists()
    assert main(["-i", small, "-o", out], spark) == 1
    assert "overwrite" in capsys.readouterr().err
    assert main(["-i", small, "-o", out, "--overwrite", "-q"], spark) == 0
    broken = tmp_path / "b.las"
    broken.write_bytes(b"nope")
    assert main(["-i", str(broken), "-o", str(tmp_path / "o2")], spark) == 1


def test_confirmation(tmp_path):
    out = tmp_path / "o"
    asked = []

    def ask(answer):
        return lambda text: asked.append(text) or answer

    assert outdir.confirm(str(out), False)
    outdir.clear(str(out), False)
    (out / "mine.txt").write_text("x")
    assert not outdir.confirm(str(out), False) and outdir.confirm(str(out), True)
    assert [outdir.confirm(str(out), False, ask(x)) for x in ("y", " YES ", "", "n", "yep")] == [True, True, False, False, False]
    assert len(asked) == 5 and "keeping 1" in asked[0]
    (out / outdir.MARKER).unlink()
    assert not outdir.confirm(str(out), True, ask("y")) and len(asked) == 5


def test_upload_plan(tmp_path, capsys):
    for n in ("tileset.json.gz", "specs.json", "content/L0_0_0.glb", "content/L0_0_0.glb.gz", "content/L1_0_0.glb", ".htaccess", ".hidden.json", "notes.txt"):
        (tmp_path / n).parent.mkdir(exist_ok=True)
        (tmp_path / n).write_bytes(b"abc")
    got = [(r["key"], r["encoding"], r["type"]) for r in outdir.upload_plan(str(tmp_path))]
    assert got == [("content/L0_0_0.glb", "gzip", "model/gltf-binary"), ("content/L1_0_0.glb", None, "model/gltf-binary"), ("specs.json", None, "application/json"), ("tileset.json", "gzip", "application/json")]
    assert tool(["upload", str(tmp_path), "s3://b/x/"]) == 0
    assert "s3://b/x/tileset.json  application/json  gzip  public, max-age=300" in capsys.readouterr().out


def test_guess_and_set_crs(small, tmp_path, capsys):
    assert tool(["guess-crs", small, "--near", "-45.0", "-22.6"]) == 0
    told = capsys.readouterr().out
    assert "declared: EPSG:31983" in told and "SIRGAS 2000 / UTM zone 23S" in told and "EPSG:32723" in told and "utm northing" in told
    assert tool(["guess-crs", small]) == 0
    assert "120 zones" in capsys.readouterr().out
    for bad in (["guess-crs", small, "--near", "7"], ["set-crs", small], ["set-crs", small, "--epsg", "2154"], ["upload", str(tmp_path / "none"), "x"]):
        with pytest.raises(SystemExit) as e:
            tool(bad)
        assert e.value.code == 2
    raw = open(small, "rb").read()
    assert tool(["set-crs", small, "--epsg", "32723", "--apply"]) == 1 and open(small, "rb").read() == raw
    assert tool(["set-crs", small, "--epsg", "32723", "--force"]) == 0 and open(small, "rb").read() == raw
    assert tool(["set-crs", small, "--epsg", "32723", "--force", "--apply"]) == 0
    assert las.read_header(small)["epsg"] == 32723 and open(small, "rb").read() != raw
    assert tool(["set-crs", small, "--restore"]) == 0 and open(small, "rb").read() == raw


def test_sample_stops(tmp_path):
    path = str(tmp_path / "s.las")
    xyz = np.column_stack([np.arange(1000)] * 3)
    las.write_las(path, xyz, np.zeros((1000, 3)), (1.0,) * 3, (0.0,) * 3)
    assert len(las.sample(path)) == 1000
    got = las.sample(path, 100, 10)[:, 0]
    assert len(got) == 100 and got[0] == 0 and got[-1] == 999 and (np.diff(got) > 0).all()


def test_parts_are_filled_and_short_files_share_a_task(spark, tmp_path):
    rows = spark.range(25_000, numPartitions=1).selectExpr("id * 0.5D as x", "1.0D as y", "2.0D as z", "1 as red", "2 as green", "3 as blue")
    files = las.write_parts(rows, str(tmp_path / "l"), rows=12_000).orderBy("file").collect()
    assert [f.n for f in files] == [12_000, 12_000, 1_000]
    las.register(spark)
    back = spark.read.format("las").option("records", 13_000).load(str(tmp_path / "l"))
    assert back.rdd.getNumPartitions() == 2 and back.count() == 25_000
    assert back.selectExpr("sum(x)", "max(x)", "sum(blue)").first() == rows.selectExpr("sum(x)", "max(x)", "sum(blue)").first()
