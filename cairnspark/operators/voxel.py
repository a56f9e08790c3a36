"""Grid, voxel aggregation, neighbour tests and the level pyramid."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairnspark.functions import scalar as S
from cairnspark.schema import FACES, INDEX, GridSpec


def grid_spec(points: DataFrame, voxel_size: float = 1.0) -> GridSpec:
    """Bounds, count and colour scale in one aggregate (one row to the driver, like a file header)."""
    rgb = {"red", "green", "blue"} <= set(points.columns)
    aggs = [f(c).alias(f"{n}_{c}") for c in "xyz" for n, f in (("lo", F.min), ("hi", F.max))]
    peak = F.max(F.greatest("red", "green", "blue")) if rgb else F.lit(0)
    row = points.agg(*aggs, F.count("*").alias("n"), peak.alias("peak")).first()
    if not row.n:
        raise ValueError("no points")
    return GridSpec(voxel_size, tuple(float(row[f"lo_{c}"]) for c in "xyz"), tuple(float(row[f"hi_{c}"]) for c in "xyz"), row.n, 257 if (row.peak or 0) > 255 else 1, rgb and row.peak is not None)


def bin_points(points: DataFrame, grid: GridSpec) -> DataFrame:
    return points.withColumns(S.bin_columns(grid))


def cell_sums(points: DataFrame, grid: GridSpec, colour: str = "rgb") -> DataFrame:
    """(gx, gy, gz, sr, sg, sb, cnt): exact integer sums, so any partitioning gives the same; one shuffle of partial sums."""
    binned = bin_points(points, grid)
    if colour == "rgb":
        parts = [F.col(c).cast("long") if grid.denom == 257 else S.clamp(F.col(c), 0, 255).cast("long") for c in ("red", "green", "blue")]
    else:
        parts = S.height_ramp(F.col("z"), grid.mins[2], grid.maxs[2] - grid.mins[2])
    return binned.select(*INDEX, *[p.alias(n) for p, n in zip(parts, ("sr", "sg", "sb"), strict=True)]).groupBy(*INDEX).agg(
        F.sum("sr").alias("sr"), F.sum("sg").alias("sg"), F.sum("sb").alias("sb"), F.count("*").alias("cnt")
    )


def voxelize(points: DataFrame, grid: GridSpec, colour: str = "rgb") -> DataFrame:
    """Level-0 cells (gx, gy, gz, r, g, b, w) with mean colours; each has weight 1."""
    scale = F.lit(float(grid.denom if colour == "rgb" else 1 << 24))
    cells = cell_sums(points, grid, colour)
    return cells.select(*INDEX, *[S.mean_colour(F.col(s), F.col("cnt") * scale).alias(c) for s, c in (("sr", "r"), ("sg", "g"), ("sb", "b"))], F.lit(1).cast("long").alias("w"))


def downsample(cells: DataFrame) -> DataFrame:
    """Next coarser level: halved indices, colours weighted by the level-0 cells below (of the colours as rounded)."""
    half = cells.select(*[F.shiftright(c, 1).alias(c) for c in INDEX], *[(F.col(c) * F.col("w")).alias(c) for c in "rgb"], "w")
    out = half.groupBy(*INDEX).agg(*[F.sum(c).alias(f"s{c}") for c in "rgb"], F.sum("w").alias("w"))
    return out.select(*INDEX, *[S.mean_colour(F.col(f"s{c}"), F.col("w")).alias(c) for c in "rgb"], "w")


def apron(cells: DataFrame, brick: int) -> DataFrame:
    """(tx, tz, own, gx, gy, gz and the other columns): each cell in its tile, and copies in the tiles whose border it touches; one branch of the plan."""
    t = S.tile_of(brick)
    rest = [c for c in cells.columns if c not in INDEX]
    here = cells.withColumns({"tx": t["tx"], "tz": t["tz"]})
    side = [("gx", 0, -1, 0), ("gx", brick - 1, 1, 0), ("gz", 0, 0, -1), ("gz", brick - 1, 0, 1)]
    spots = F.array_compact(
        F.array(
            F.struct(F.col("tx"), F.col("tz"), F.lit(True).alias("own")),
            *[F.when(F.col(c) % brick == at, F.struct((F.col("tx") + dx).alias("tx"), (F.col("tz") + dz).alias("tz"), F.lit(False).alias("own"))) for c, at, dx, dz in side],
        )
    )
    return here.select(*INDEX, *rest, F.explode(spots).alias("s")).select("s.tx", "s.tz", "s.own", *INDEX, *rest).where("tx >= 0 and tz >= 0")


def exposed_faces(cells: DataFrame, brick: int = 64) -> DataFrame:
    """``cells`` with tx, tz, six face flags and their number nf.

    A face is exposed if no cell stands next to it (none stands outside the
    grid).  Cells and their apron are partitioned by tile once; the three
    windows (rows of cells along x, y and z inside a tile) all run on that
    partitioning, so the test costs one shuffle, and tile-wise consumers can
    reuse it.  ``cells`` is planned once, as the apron comes from the same
    rows; borders are a few percent of a tile, so they carry their colours.
    """
    both = apron(cells, brick).repartition("tx", "tz")
    out = both
    for axis, names in (("gx", ("px", "mx")), ("gy", ("py", "my")), ("gz", ("pz", "mz"))):
        others = [c for c in INDEX if c != axis]
        line = Window.partitionBy("tx", "tz", *others).orderBy(axis)
        out = out.withColumn(names[0], ~F.coalesce(F.lead(axis).over(line) == F.col(axis) + 1, F.lit(False)))
        out = out.withColumn(names[1], ~F.coalesce(F.lag(axis).over(line) == F.col(axis) - 1, F.lit(False)))
    nf = reduce(lambda a, b: a + b, [F.col(f).cast("int") for f, *_ in FACES])
    return out.where("own").drop("own").withColumn("nf", nf)


def surface(faces: DataFrame) -> DataFrame:
    return faces.where("nf > 0")


def pyramid(points: DataFrame, grid: GridSpec, levels: int, brick: int = 64, colour: str = "rgb", cut=None) -> DataFrame:
    """Faces of all levels, ``depth`` 0 the finest.

    Levels chain (each averages the rounded colours below), so each is built
    from the one before; ``cut`` may materialise a level (cells shrink about
    fourfold per level), else each level is planned in full.
    """
    cells, out = voxelize(points, grid, colour), []
    for depth in range(levels):
        if depth:
            cells = downsample(cells)
        if cut is not None:
            cells = cut(cells)
        out.append(exposed_faces(cells, brick).withColumn("depth", F.lit(depth)))
    return reduce(DataFrame.unionByName, out)


def level_stats(faces: DataFrame) -> DataFrame:
    """Cells, drawn cells and their share, tiles and triangles per level, with a total (depth null)."""
    seen = F.when(F.col("nf") > 0, 1)
    return faces.groupBy("depth", "tx", "tz").agg(F.count("*").alias("cells"), F.count(seen).alias("drawn"), F.sum("nf").alias("quads")).rollup("depth").agg(
        F.sum("cells").alias("cells"),
        F.sum("drawn").alias("drawn"),
        F.count(F.when(F.col("drawn") > 0, 1)).alias("tiles"),
        (F.sum("quads") * 2).alias("triangles"),
        F.round(F.sum("drawn") * 100.0 / F.sum("cells"), 6).alias("drawn_pct"),
    )
