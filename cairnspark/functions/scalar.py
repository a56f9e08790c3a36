"""Column expressions of the voxel engine; all run inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cairnspark.schema import GridSpec


def clamp(c: Column, lo, hi) -> Column:
    return F.least(F.greatest(c, F.lit(lo)), F.lit(hi))


def bin_columns(grid: GridSpec, x="x", y="y", z="z") -> dict[str, Column]:
    """gx, gy, gz of a point: floor, clipped to the grid, north turned to south."""
    nx, ny, nz = grid.dims

    def cell(c, low, n):
        return clamp(F.floor((F.col(c) - F.lit(low)) / F.lit(grid.voxel_size)), 0, n - 1).cast("long")

    return {"gx": cell(x, grid.mins[0], nx), "gy": cell(z, grid.mins[2], ny), "gz": F.lit(nz - 1).cast("long") - cell(y, grid.mins[1], nz)}


def tile_of(brick: int) -> dict[str, Column]:
    return {"tx": F.expr(f"gx div {brick}"), "tz": F.expr(f"gz div {brick}")}


def brick_key(dims: tuple[int, int, int], brick: int) -> Column:
    """Tile-major key with a margin of one cell on each side of a tile."""
    w, ny, ntz = brick + 2, dims[1], -(-dims[2] // brick)
    return F.expr(f"((((gx div {brick}) * {ntz} + gz div {brick}) * {w} + gx % {brick} + 1) * {ny} + gy) * {w} + gz % {brick} + 1")


def brick_unkey(key: str, dims: tuple[int, int, int], brick: int) -> dict[str, Column]:
    w, ny, ntz = brick + 2, dims[1], -(-dims[2] // brick)
    tile = f"({key} div {w * ny * w})"
    return {
        "kx": F.expr(f"({tile} div {ntz}) * {brick} + ({key} div {ny * w}) % {w} - 1"),
        "ky": F.expr(f"({key} div {w}) % {ny}"),
        "kz": F.expr(f"({tile} % {ntz}) * {brick} + {key} % {w} - 1"),
    }


def mean_colour(total: Column, weight: Column) -> Column:
    """Mean rounded half to even, as a byte value."""
    return clamp(F.rint(total / weight), 0.0, 255.0).cast("int")


def height_ramp(z: Column, low: float, span: float) -> list[Column]:
    """Fixed-point (2^24) red, green, blue numerators of a height ramp."""
    t = clamp((z - F.lit(low)) / F.lit(max(span, 1e-9)), 0.0, 1.0)
    parts = (F.lit(1.5) * t, F.lit(1.0) - F.abs(t - F.lit(0.5)) * F.lit(2.0), F.lit(1.5) * (F.lit(1.0) - t))
    return [F.rint(clamp(p, 0.0, 1.0) * F.lit(255.0) * F.lit(16777216.0)).cast("long") for p in parts]


def quantized(c: Column, bits: int) -> Column:
    """0..1 colour as float on an endpoint-preserving grid of 2^bits levels."""
    if bits <= 0 or bits >= 8:
        return c.cast("float") / F.lit(255.0).cast("float")
    top = float((1 << bits) - 1)
    return (F.rint(c / F.lit(255.0) * F.lit(top)) / F.lit(top)).cast("float")


def palette_key(bits: int, r="r", g="g", b="b") -> Column:
    s = 8 - bits
    return F.shiftleft(F.shiftright(r, s), 2 * bits).bitwiseOR(F.shiftleft(F.shiftright(g, s), bits)).bitwiseOR(F.shiftright(b, s))


def world(grid: GridSpec, cell: float) -> dict[str, Column]:
    """Easting and northing of a cell's centre."""
    ox, oy, _ = grid.origin
    return {"east": F.lit(ox) + (F.col("gx") + 0.5) * cell, "north": F.lit(oy) - (F.col("gz") + 0.5) * cell}


def size_text(c: Column) -> Column:
    """Bytes as text with a unit, rounded from the exact value of the double as in C (``format_string`` would turn 1.005 into 1.01)."""
    two = lambda x: F.call_function("format_number", x, F.lit("0.00"))
    return (
        F.when(c >= 1e9, F.concat(two(c / 1e9), F.lit(" GB"))).when(c >= 1e6, F.concat(two(c / 1e6), F.lit(" MB")))
        .when(c >= 1e3, F.concat(two(c / 1e3), F.lit(" KB"))).otherwise(F.format_string("%d bytes", c.cast("long")))
    )


def range_of(c: Column, bounds: list) -> Column:
    """How many of the sorted ``bounds`` are below ``c``, by halving; a null counts as above all."""

    def halve(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(c <= bounds[mid], halve(lo, mid)).otherwise(halve(mid + 1, hi))

    return halve(0, len(bounds))


def hex_colour(r: Column, g: Column, b: Column) -> Column:
    return F.concat(F.lit("#"), *[F.lower(F.lpad(F.hex(c), 2, "0")) for c in (r, g, b)])


def from_hex(c: Column) -> list[Column]:
    return [F.conv(F.substring(c, i, 2), 16, 10).cast("int") for i in (2, 4, 6)]


TILE_NAME = r"^L\d+_\d+_\d+\.glb(\.gz)?$"


def is_tile_name(c: Column) -> Column:
    return c.rlike(TILE_NAME)


def coordinate_family(x0, y0, x1, y1, z0, z1) -> Column:
    """Notes on which kind of coordinates a bounding box may hold, in a fixed order."""
    degrees = (x0 >= -180) & (x1 <= 180) & (y0 >= -90) & (y1 <= 90)
    mercator = (F.abs(x0) <= 20_037_509) & (F.abs(y0) <= 20_048_967) & (F.greatest(F.abs(x1), F.abs(y1)) > 1_000_000)
    notes = F.array_compact(
        F.array(
            F.when(mercator, "web mercator"),
            F.when((x0 >= 100_000) & (x1 <= 1_000_000), "transverse mercator easting"),
            F.when((y0 >= 0) & (y1 <= 10_000_000), "utm northing"),
            F.when(z1 - z0 < 9000, "metres").otherwise("check units"),
        )
    )
    return F.when(degrees, F.array(F.lit("degrees"))).otherwise(notes)
