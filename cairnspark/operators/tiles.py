"""Tiles, quadtree, feature numbers, face geometry and palettes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairnspark.functions import scalar as S
from cairnspark.schema import FACES

# Normal, tangent and bitangent of each face (tangent x bitangent = normal), and the corner order.
FRAMES = [
    ((1, 0, 0), (0, 1, 0), (0, 0, 1)),
    ((-1, 0, 0), (0, 0, 1), (0, 1, 0)),
    ((0, 1, 0), (0, 0, 1), (1, 0, 0)),
    ((0, -1, 0), (1, 0, 0), (0, 0, 1)),
    ((0, 0, 1), (1, 0, 0), (0, 1, 0)),
    ((0, 0, -1), (0, 1, 0), (1, 0, 0)),
]
CORNERS = ((-1, -1), (1, -1), (1, 1), (-1, 1))


def tile_bounds(faces: DataFrame, depth: int, voxel_size: float = 1.0) -> DataFrame:
    """One row per tile with drawn cells: level (0 the coarsest of ``depth`` + 1), tight bounds, cubes, triangles."""
    seen = faces.where("nf > 0")
    return seen.groupBy((F.lit(depth) - F.col("depth")).alias("level"), "tx", "tz").agg(
        F.min("gx").alias("x0"), (F.max("gx") + 1).alias("x1"), F.min("gz").alias("z0"), (F.max("gz") + 1).alias("z1"),
        F.min("gy").alias("y_min"), F.max("gy").alias("y_max"), F.count("*").alias("cubes"), (F.sum("nf") * 2).alias("triangles"),
    ).withColumn("cell_size", F.lit(voxel_size) * F.pow(F.lit(2.0), F.lit(depth) - F.col("level")))


def boxes(tiles: DataFrame) -> DataFrame:
    """Centre and half sizes (east, north, up) of each tile's box."""
    cs = F.col("cell_size")
    e0, e1, n0, n1 = F.col("x0") * cs, F.col("x1") * cs, -F.col("z1") * cs, -F.col("z0") * cs
    u0, u1 = F.col("y_min") * cs, (F.col("y_max") + 1) * cs
    return tiles.select(
        "level", "tx", "tz",
        ((e0 + e1) / 2).alias("ce"), ((n0 + n1) / 2).alias("cn"), ((u0 + u1) / 2).alias("cu"),
        ((e1 - e0) / 2).alias("he"), ((n1 - n0) / 2).alias("hn"), ((u1 - u0) / 2).alias("hu"),
    )


def children(tiles: DataFrame) -> DataFrame:
    """Each tile with the names of its children, in (dx, dz) order; the tile table is small."""
    t = tiles.select("level", "tx", "tz")
    kids = t.select(
        (F.col("level") - 1).alias("level"), F.shiftright("tx", 1).alias("tx"), F.shiftright("tz", 1).alias("tz"),
        F.struct(F.col("tx").alias("cx"), F.col("tz").alias("cz"), F.format_string("L%d_%d_%d", "level", "tx", "tz").alias("name")).alias("kid"),
    )
    kids = kids.groupBy("level", "tx", "tz").agg(F.array_sort(F.collect_list("kid")).alias("kids"))
    return t.join(kids, ["level", "tx", "tz"], "left").select("level", "tx", "tz", F.coalesce(F.array_join("kids.name", ","), F.lit("")).alias("children"))


def tree_checks(tiles: DataFrame, depth: int) -> DataFrame:
    """Per tile with a parent: box inside the parent's (one parent cell of slack), error smaller than the parent's."""
    b = boxes(tiles).join(tiles.select("level", "tx", "tz", "cell_size"), ["level", "tx", "tz"])
    b = b.withColumn("error", F.when(F.col("level") == depth, 0.0).otherwise(F.col("cell_size")))
    p = b.select(*[F.col(c).alias(f"p_{c}") for c in b.columns])
    j = b.join(p, (F.col("p_level") == F.col("level") - 1) & (F.col("p_tx") == F.shiftright("tx", 1)) & (F.col("p_tz") == F.shiftright("tz", 1)))
    inside = F.lit(True)
    for c, h in (("ce", "he"), ("cn", "hn"), ("cu", "hu")):
        inside = inside & (F.abs(F.col(c) - F.col(f"p_{c}")) + F.col(h) <= F.col(f"p_{h}") + F.col("p_cell_size"))
    return j.select("level", "tx", "tz", inside.alias("inside"), (F.col("error") < F.col("p_error")).alias("error_falls"))


def feature_ids(faces: DataFrame) -> DataFrame:
    """Drawn cells with row_in_tile and feature_id, dense from 0: finest level first, tiles by (tx, tz), cells by (x, y, z).

    Rows are numbered inside tiles; only the tile table (a count each) is
    summed in one ordered window, then joined back.
    """
    seen = faces.where("nf > 0")
    inside = Window.partitionBy("depth", "tx", "tz").orderBy("gx", "gy", "gz")
    rows = seen.withColumn("row_in_tile", F.row_number().over(inside).cast("long") - 1)
    counts = seen.groupBy("depth", "tx", "tz").agg(F.count("*").alias("n"))
    before = Window.orderBy("depth", "tx", "tz").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("depth", "tx", "tz", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return rows.join(base, ["depth", "tx", "tz"]).withColumn("feature_id", F.col("base") + F.col("row_in_tile")).drop("base")


def feature_check(ids: DataFrame) -> DataFrame:
    return ids.agg(F.count("*").alias("n"), F.countDistinct("feature_id").alias("distinct_ids"), F.min("feature_id").alias("lo"), F.max("feature_id").alias("hi"))


def quads(faces: DataFrame) -> DataFrame:
    """One row per exposed face (0..5) of each drawn cell."""
    flags = F.array(*[F.when(F.col(f), F.lit(i)) for i, (f, *_) in enumerate(FACES)])
    return faces.where("nf > 0").select("depth", "tx", "tz", "gx", "gy", "gz", "r", "g", "b", F.explode(F.array_compact(flags)).alias("face"))


def vertices(quads_: DataFrame) -> DataFrame:
    """Four corners per face in half cells, with normals, in winding order."""

    def corner(face, k):
        n, t, b = FRAMES[face]
        st, sb = CORNERS[k]
        return F.struct(F.lit(k).alias("corner"), *[F.lit(n[a] + st * t[a] + sb * b[a]).alias(f"d{a}") for a in range(3)], *[F.lit(n[a]).alias(f"n{a}") for a in range(3)])

    table = F.array(*[F.array(*[corner(f, k) for k in range(4)]) for f in range(6)])
    v = quads_.select("*", F.explode(F.get(table, F.col("face"))).alias("c"))
    return v.select(
        "depth", "gx", "gy", "gz", "face", "c.corner",
        *[(2 * F.col(g) + 1 + F.col(f"c.d{a}")).alias(f"h{g[1]}") for a, g in enumerate(("gx", "gy", "gz"))], "c.n0", "c.n1", "c.n2",
    )


def palette(cells: DataFrame, bits: int = 2) -> DataFrame:
    """Mean colour of each bucket of 2^bits levels per channel."""
    return cells.groupBy(S.palette_key(bits).alias("bucket")).agg(
        *[F.rint(F.avg(c)).cast("int").alias(c) for c in "rgb"], F.count("*").alias("cells")
    )
