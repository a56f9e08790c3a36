"""Output folders: what is in them, what may be deleted, markers, and file writing."""

from __future__ import annotations

import gzip
import os
import re
import tempfile
import uuid
from pathlib import Path

from cairnspark.functions.scalar import TILE_NAME

MARKER = ".cairnspark"
LOG = "log/build.log"
DOCUMENTS = {"tileset.json", "tileset.json.gz", "specs.json", "report.json", "properties.config.json", LOG, MARKER}
# Content types and cache headers of published files.
SERVED = {
    ".glb": ("model/gltf-binary", "public, max-age=31536000, immutable"),
    ".json": ("application/json", "public, max-age=300, must-revalidate"),
}


def work_folder(spark, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir`` that plain file calls reach on all executors; a temporary one where that is unset (tests)."""
    top = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="cairnspark-")
    path = re.sub("^file:/*", "/", top)
    if "://" in path:
        raise ValueError(f"{top} is no mounted folder")
    return os.path.join(path, f"{name}-{uuid.uuid4().hex}")


def inspect(out: str) -> dict:
    """Kind (empty, own, foreign), the files a rebuild would delete, and those it keeps."""
    root = Path(out)
    if root.exists() and not root.is_dir():
        return {"kind": "foreign", "delete": [], "keep": [root.name]}
    names = sorted(p.relative_to(root).as_posix() for p in root.rglob("*") if p.is_file()) if root.exists() else []
    own = [n for n in names if n in DOCUMENTS or (n.startswith("content/") and re.match(TILE_NAME.replace("^", "", 1), n[8:]) and "/" not in n[8:])]
    keep = sorted(set(names) - set(own))
    kind = "empty" if not names else "own" if MARKER in names else "foreign"
    return {"kind": kind, "delete": own if kind == "own" else [], "keep": keep if kind != "empty" else []}


def confirm(out: str, overwrite: bool, ask=None) -> bool:
    """Whether a build may replace what is in ``out``.  Foreign folders never, empty ones always; an own one by ``overwrite`` or by a yes to ``ask`` (None: nobody to ask)."""
    found = inspect(out)
    if found["kind"] != "own" or overwrite:
        return found["kind"] != "foreign"
    if ask is None:
        return False
    kept = f", keeping {len(found['keep'])}" if found["keep"] else ""
    return ask(f"{out} holds an earlier build. Delete its {len(found['delete'])} files{kept}? [y/N] ").strip().lower() in {"y", "yes"}


def upload_plan(folder: str) -> list[dict]:
    """What publishing a folder sends: file, key (without .gz), type, encoding, cache header and size; documents after the tiles they name.

    Where a file has a compressed twin, the twin is sent.
    """
    root, plan = Path(folder), []
    for path in sorted(p for p in root.rglob("*") if p.is_file()):
        name = path.relative_to(root).as_posix()
        key = name.removesuffix(".gz")
        served = SERVED.get(Path(key).suffix)
        twin = key == name and path.with_name(path.name + ".gz").exists()
        if served and not twin and not path.name.startswith("."):
            plan.append({"file": str(path), "key": key, "type": served[0], "encoding": "gzip" if key != name else None, "cache": served[1], "bytes": path.stat().st_size})
    return sorted(plan, key=lambda r: r["key"].endswith(".json"))


def clear(out: str, overwrite: bool) -> None:
    """Make room for a build: refuses foreign folders, needs ``overwrite`` for own ones, deletes listed names only."""
    found = inspect(out)
    if found["kind"] == "foreign":
        shown = ", ".join(found["keep"][:5]) + (f" and {len(found['keep']) - 5} more" if len(found["keep"]) > 5 else "")
        raise FileExistsError(f"{out} holds files that no build here wrote: {shown}")
    if found["kind"] == "own":
        if not overwrite:
            raise FileExistsError(f"{out} holds an earlier build; pass overwrite to replace it")
        for n in found["delete"]:
            os.remove(Path(out) / n)
        for d in ("content", "log"):
            if (p := Path(out) / d).is_dir() and not any(p.iterdir()):
                p.rmdir()
    for d in ("content", "log"):
        Path(out, d).mkdir(parents=True, exist_ok=True)
    Path(out, MARKER).write_text("cairnspark output\n")


def write_file(path: str, data: bytes, zipped: bool, raw: bool) -> int:
    """Write a file, its gzip twin, or only that; each appears whole by a rename.  Returns the size before compression."""
    for name, body in ([(path, data)] if raw else []) + ([(path + ".gz", gzip.compress(data, 6, mtime=0))] if zipped else []):
        part = f"{name}.{os.getpid()}.part"
        with open(part, "wb") as f:
            f.write(body)
        os.replace(part, name)
    return len(data)
