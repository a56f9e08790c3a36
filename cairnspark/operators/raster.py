"""Rasters as tables (row, col, value, valid): filling, lookups, footprints, class counts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairnspark.functions.scalar import clamp

# Neighbours in the order in which a categorical fill looks at them.
AROUND = [(1, 1), (1, 0), (1, -1), (0, 1), (0, -1), (-1, 1), (-1, 0), (-1, -1)]


@dataclass(frozen=True)
class Affine:
    """Pixel (row, col) has its corner at x = c + a * col, y = f + e * row."""

    a: float
    c: float
    e: float
    f: float
    width: int
    height: int


def fill_pass(raster: DataFrame, step: int, categorical: bool = True) -> DataFrame:
    """One ring: invalid pixels with known neighbours take the first (classes) or the mean of them; ``dist`` is the pass."""
    known = raster.where("valid")
    offers = known.select(F.explode(F.array(*[F.struct((F.col("row") - dr).alias("row"), (F.col("col") - dc).alias("col"), F.lit(i).alias("ord"), "value") for i, (dr, dc) in enumerate(AROUND)])).alias("o"))
    given = offers.select("o.*").groupBy("row", "col").agg((F.min_by("value", "ord") if categorical else F.avg("value")).alias("given"))
    both = raster.join(given, ["row", "col"], "left")
    grown = ~F.col("valid") & F.col("given").isNotNull()
    return both.select(
        "row", "col", F.when(grown, F.col("given")).otherwise(F.col("value")).alias("value"), (F.col("valid") | grown).alias("valid"),
        F.when(grown, F.lit(step)).otherwise(F.col("dist")).alias("dist"),
    )


def fill_nearest(raster: DataFrame, passes: int, categorical: bool = True) -> DataFrame:
    out = raster.withColumn("dist", F.lit(0))
    for step in range(1, passes + 1):
        out = fill_pass(out, step, categorical)
    return out


def pixel_index(points: DataFrame, t: Affine) -> DataFrame:
    """Adds fractional pixel coordinates, the edge-clamped pixel and whether the point lies outside."""
    out = points.withColumn("colf", (F.col("east") - t.c) / t.a).withColumn("rowf", (F.col("north") - t.f) / t.e)
    ci, ri = F.floor("colf"), F.floor("rowf")
    outside = (ci < 0) | (ci >= t.width) | (ri < 0) | (ri >= t.height)
    return out.withColumn("outside", outside).withColumn("col", clamp(ci, 0, t.width - 1).cast("int")).withColumn("row", clamp(ri, 0, t.height - 1).cast("int"))


def centre_lookup(points: DataFrame, filled: DataFrame, t: Affine) -> DataFrame:
    """Value under each point; the raster is the small side and Spark broadcasts it by its size."""
    return pixel_index(points, t).join(filled.select("row", "col", "value", "dist"), ["row", "col"], "left")


def footprint(points: DataFrame, t: Affine, cell: float) -> DataFrame:
    """Adds the ranges [c0, c1) x [r0, r1) of pixels whose centres lie under a cell, and whether it is a pixel wide."""
    hc, hr = cell / 2 / abs(t.a), cell / 2 / abs(t.e)
    out = pixel_index(points, t)
    for name, f, h, n in (("c", "colf", hc, t.width), ("r", "rowf", hr, t.height)):
        lo = clamp(F.ceil(F.col(f) - h - 0.5), 0, n).cast("int")
        out = out.withColumn(f"{name}0", lo).withColumn(f"{name}1", F.greatest(clamp(F.ceil(F.col(f) + h - 0.5), 0, n).cast("int"), lo))
    return out.withColumn("wide", F.lit(2 * hc >= 1 and 2 * hr >= 1))


def under(cells: DataFrame, raster: DataFrame, keys: list[str]) -> DataFrame:
    """Valid pixels of each footprint by an equality join: ranges are exploded to pixels, so no range join is needed."""
    at = cells.where("wide and r1 > r0 and c1 > c0").select(*keys, F.explode(F.sequence("r0", F.col("r1") - 1)).alias("row"), "c0", "c1")
    at = at.select(*keys, "row", F.explode(F.sequence("c0", F.col("c1") - 1)).alias("col"))
    return at.join(raster.where("valid").select("row", "col", "value"), ["row", "col"])


def majority(cells: DataFrame, raster: DataFrame, keys: list[str]) -> DataFrame:
    """Most frequent class of each footprint, ties to the lowest code."""
    counts = under(cells, raster, keys).groupBy(*keys, "value").agg(F.count("*").alias("n"))
    best = counts.groupBy(*keys).agg(F.max(F.struct("n", (-F.col("value")).alias("neg"))).alias("m"))
    return best.select(*keys, (-F.col("m.neg")).alias("code"), F.col("m.n").alias("pixels"))


def sat(raster: DataFrame) -> DataFrame:
    """Summed-area table of value and validity: running sums along rows, then along columns."""
    v = raster.withColumn("v", F.when(F.col("valid"), F.col("value")).otherwise(0)).withColumn("k", F.col("valid").cast("long"))
    across = Window.partitionBy("row").orderBy("col").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy("col").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    v = v.withColumn("v", F.sum("v").over(across)).withColumn("k", F.sum("k").over(across))
    return v.select("row", "col", F.sum("v").over(down).alias("total"), F.sum("k").over(down).alias("n"))


def rect_sums(cells: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Sum and number of valid pixels of each footprint from four corners of the summed-area table."""
    corners = cells.where("wide").select(
        *keys,
        F.explode(F.array(*[F.struct((F.col(r) - 1).alias("row"), (F.col(c) - 1).alias("col"), F.lit(s).alias("sign")) for r, c, s in (("r1", "c1", 1), ("r0", "c1", -1), ("r1", "c0", -1), ("r0", "c0", 1))])).alias("k"),
    ).select(*keys, "k.*")
    got = corners.join(table, ["row", "col"], "left")
    return got.groupBy(*keys).agg(F.coalesce(F.sum(F.col("sign") * F.col("total")), F.lit(0)).alias("total"), F.coalesce(F.sum(F.col("sign") * F.col("n")), F.lit(0)).alias("n"))


def coverage(x0, y0, x1, y1, t: Affine):
    """Share of a box that the raster covers."""
    rx, ry = sorted((t.c, t.c + t.a * t.width)), sorted((t.f, t.f + t.e * t.height))
    w = F.greatest(F.lit(0.0), F.least(x1, F.lit(rx[1])) - F.greatest(x0, F.lit(rx[0])))
    h = F.greatest(F.lit(0.0), F.least(y1, F.lit(ry[1])) - F.greatest(y0, F.lit(ry[0])))
    return w * h / F.greatest((x1 - x0) * (y1 - y0), F.lit(1e-12))
