"""Grid, georeference and build settings, and the column layouts that operators agree on."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

POINTS = "x double, y double, z double, red int, green int, blue int"
CELLS = ["gx", "gy", "gz", "r", "g", "b", "w"]
INDEX = ["gx", "gy", "gz"]
# Face columns, in the order in which meshes list faces, with the neighbour each looks at.
FACES = [("px", 1, 0, 0), ("mx", -1, 0, 0), ("py", 0, 1, 0), ("my", 0, -1, 0), ("pz", 0, 0, 1), ("mz", 0, 0, -1)]


@dataclass(frozen=True)
class GridSpec:
    """Grid x runs east, y up and z south; the origin is the north-west corner at the lowest height."""

    voxel_size: float
    mins: tuple[float, float, float]
    maxs: tuple[float, float, float]
    n_points: int = 0
    denom: int = 1
    coloured: bool = True

    @property
    def dims(self) -> tuple[int, int, int]:
        east, north, up = (max(1, math.floor((b - a) / self.voxel_size) + 1) for a, b in zip(self.mins, self.maxs, strict=True))
        return east, up, north

    @property
    def origin(self) -> tuple[float, float, float]:
        return self.mins[0], self.mins[1] + self.dims[2] * self.voxel_size, self.mins[2]


def level_dims(dims: tuple[int, int, int], depth: int) -> tuple[int, int, int]:
    """Grid size after ``depth`` halvings, each rounded up."""
    for _ in range(depth):
        dims = tuple(max(1, (d + 1) // 2) for d in dims)
    return dims


def pyramid_depth(dims: tuple[int, int, int], brick: int) -> int:
    """Fewest halvings after which one brick covers the footprint."""
    depth = 0
    while brick << depth < max(dims[0], dims[2]):
        depth += 1
    return depth


def check_key_space(dims: tuple[int, int, int], brick: int) -> int:
    """Largest brick key of a grid; an error if it doesn't fit 63 bits."""
    tiles = -(-dims[0] // brick) * -(-dims[2] // brick)
    top = tiles * (brick + 2) * dims[1] * (brick + 2) - 1
    if top >= 1 << 63:
        raise ValueError(f"a grid of {dims} with brick {brick} needs keys up to {top}; use a larger voxel size")
    return top


@dataclass
class BuildConfig:
    """Options of a tileset build, checked together."""

    voxel_size: float = 1.0
    brick: int = 64
    levels: int | None = None
    mode: str = "baked"
    color_bits: int = 8
    palette_bits: int = 2
    draco: bool = False
    epsg: int | None = None
    gzip: bool = False
    gzip_only: bool = False
    overwrite: bool = False
    generator: str = "cairnspark"
    properties: list = field(default_factory=list)

    def check(self) -> BuildConfig:
        for wrong, what in (
            (not self.voxel_size > 0, "voxel_size must be above 0"),
            (self.brick < 2, "brick must be at least 2"),
            (self.levels is not None and self.levels < 1, "levels must be at least 1"),
            (self.mode not in ("baked", "instanced"), "mode must be baked or instanced"),
            (self.draco and self.mode == "instanced", "draco needs baked mode"),
            (bool(self.properties) and self.mode == "instanced", "properties need baked mode"),
            (self.draco, "no Draco encoder is available"),
        ):
            if wrong:
                raise ValueError(what)
        return self
