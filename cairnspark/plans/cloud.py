"""A deterministic point cloud and rasters derived from the star-schema tables by integer arithmetic, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnspark.operators.raster import Affine

VOXEL, BRICK, LEVELS = 1.0, 32, 3
RASTER = Affine(2.0, 8.0, -2.0, 86.0, 60, 45)


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates in millimetres turned to metres: x east, y north, z up; 16-bit colours."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    q = F.floor("l_quantity").cast("long")
    mm = li.select(
        ((F.col("l_orderkey") * 7919 + F.col("l_linenumber").cast("long") * 104729 + F.col("l_suppkey") * 613) % 120000).alias("xm"),
        ((F.col("l_partkey") * 1299709 + F.col("l_suppkey") * 15485863) % 90000).alias("ym"),
        q.alias("q"), (F.col("l_partkey") % 256 * 256).cast("int").alias("red"), (F.col("l_suppkey") * 3 % 256 * 256).cast("int").alias("green"),
    )
    z = F.expr("20000 + xm div 20 + ym div 30 + q * 100")
    return mm.select((F.col("xm") * F.lit(0.001)).alias("x"), (F.col("ym") * F.lit(0.001)).alias("y"), (z * F.lit(0.001)).alias("z"), "red", "green", (F.col("q") * 1280).cast("int").alias("blue"))


def dense_points(spark: SparkSession, sf_dir: str, copies: int = 16, side: int = 357_000) -> DataFrame:
    """A denser site for timing whole builds: ``copies`` points for each row of ``lineitem``, on slopes over a square of ``side`` millimetres."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    many = li.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("k"))
    mm = many.select(
        F.expr(f"pmod(l_orderkey * 7919 + l_linenumber * 104729 + l_suppkey * 613 + k * 15485863, {side})").alias("xm"),
        F.expr(f"pmod(l_partkey * 1299709 + l_suppkey * 86028121 + k * 32452843, {side})").alias("ym"),
        "k", (F.col("l_partkey") % 256 * 256).cast("int").alias("red"), (F.col("l_suppkey") % 256 * 256).cast("int").alias("green"),
    )
    z = F.expr("xm div 10 + ym div 15 + k * 120")
    return mm.select((F.col("xm") * F.lit(0.001)).alias("x"), (F.col("ym") * F.lit(0.001)).alias("y"), (z * F.lit(0.001)).alias("z"), "red", "green", (F.col("k") * 4096).cast("int").alias("blue"))


def raster(spark: SparkSession, kind: str = "class") -> DataFrame:
    """Five classes, or a slope, with nodata pixels on diagonals."""
    r = spark.range(RASTER.height * RASTER.width).select(F.expr(f"cast(id div {RASTER.width} as int)").alias("row"), F.expr(f"cast(id % {RASTER.width} as int)").alias("col"))
    value = F.expr("(row * 7 + col * 3) % 5") if kind == "class" else F.expr("cast(100 + 0.5 * col + 0.25 * row as double)")
    return r.select("row", "col", value.alias("value"), ((F.col("row") + F.col("col")) % 17 > 2).alias("valid"))


POINTS_SQL = """
pm AS (SELECT (l_orderkey * 7919 + l_linenumber::BIGINT * 104729 + l_suppkey * 613) % 120000 AS xm,
  (l_partkey * 1299709 + l_suppkey * 15485863) % 90000 AS ym, floor(l_quantity)::BIGINT AS q,
  (l_partkey % 256 * 256)::INT AS red, (l_suppkey * 3 % 256 * 256)::INT AS green FROM lineitem),
p AS (SELECT xm * 0.001::DOUBLE AS x, ym * 0.001::DOUBLE AS y, (20000 + xm // 20 + ym // 30 + q * 100) * 0.001::DOUBLE AS z, red, green, (q * 1280)::INT AS blue FROM pm)"""

GRID_SQL = f"""
gr AS (SELECT *, greatest(1, floor((x1 - x0) / {VOXEL}) + 1)::BIGINT AS nx, greatest(1, floor((z1 - z0) / {VOXEL}) + 1)::BIGINT AS ny, greatest(1, floor((y1 - y0) / {VOXEL}) + 1)::BIGINT AS nz
  FROM (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, min(z) AS z0, max(z) AS z1, count(*) AS n, CASE WHEN max(greatest(red, green, blue)) > 255 THEN 257 ELSE 1 END AS denom FROM p)),
bp AS (SELECT p.*, gr.denom, gr.z0, gr.z1, least(greatest(floor((x - x0) / {VOXEL}), 0), nx - 1)::BIGINT AS gx, least(greatest(floor((z - z0) / {VOXEL}), 0), ny - 1)::BIGINT AS gy,
  (nz - 1 - least(greatest(floor((y - y0) / {VOXEL}), 0), nz - 1))::BIGINT AS gz FROM p, gr)"""

CELLS_SQL = """
c0 AS (SELECT gx, gy, gz, least(greatest(round_even(sum(red)::DOUBLE / (count(*) * any_value(denom)), 0), 0), 255)::INT AS r,
  least(greatest(round_even(sum(green)::DOUBLE / (count(*) * any_value(denom)), 0), 0), 255)::INT AS g,
  least(greatest(round_even(sum(blue)::DOUBLE / (count(*) * any_value(denom)), 0), 0), 255)::INT AS b, 1::BIGINT AS w FROM bp GROUP BY gx, gy, gz)"""


def _down(k: int) -> str:
    means = ", ".join(f"least(greatest(round_even(sum({c} * w)::DOUBLE / sum(w)::DOUBLE, 0), 0), 255)::INT AS {c}" for c in "rgb")
    return f"c{k + 1} AS (SELECT gx >> 1 AS gx, gy >> 1 AS gy, gz >> 1 AS gz, {means}, sum(w)::BIGINT AS w FROM c{k} GROUP BY 1, 2, 3)"


def _faces(k: int) -> str:
    steps = [("px", 1, 0, 0), ("mx", -1, 0, 0), ("py", 0, 1, 0), ("my", 0, -1, 0), ("pz", 0, 0, 1), ("mz", 0, 0, -1)]
    joins = " ".join(f"LEFT JOIN c{k} {n} ON {n}.gx = a.gx + {x} AND {n}.gy = a.gy + {y} AND {n}.gz = a.gz + {z}" for n, x, y, z in steps)
    flags = ", ".join(f"({n}.gx IS NULL) AS {n}" for n, *_ in steps)
    total = " + ".join(f"({n}.gx IS NULL)::INT" for n, *_ in steps)
    return f"f{k} AS (SELECT a.*, {k} AS depth, a.gx // {BRICK} AS tx, a.gz // {BRICK} AS tz, {flags}, {total} AS nf FROM c{k} a {joins})"


LEVEL_SQL = [POINTS_SQL, GRID_SQL, CELLS_SQL, *[_down(k) for k in range(LEVELS - 1)]]
FACES_SQL = [*LEVEL_SQL, *[_faces(k) for k in range(LEVELS)], "fa AS (" + " UNION ALL ".join(f"SELECT * FROM f{k}" for k in range(LEVELS)) + ")"]
TILES_SQL = [
    *FACES_SQL,
    f"""ti AS (SELECT {LEVELS - 1} - depth AS level, tx, tz, min(gx) AS x0, max(gx) + 1 AS x1, min(gz) AS z0, max(gz) + 1 AS z1, min(gy) AS y_min, max(gy) AS y_max,
  count(*) AS cubes, (sum(nf) * 2)::BIGINT AS triangles, {VOXEL} * pow(2.0, any_value(depth)) AS cell_size FROM fa WHERE nf > 0 GROUP BY depth, tx, tz)""",
]
RASTER_SQL = f"""
rc AS (SELECT (i // {RASTER.width})::INT AS row, (i % {RASTER.width})::INT AS col FROM range({RASTER.height * RASTER.width}) t(i)),
ra AS (SELECT row, col, ((row * 7 + col * 3) % 5)::INT AS value, (row + col) % 17 > 2 AS valid FROM rc),
rv AS (SELECT row, col, (100 + 0.5 * col + 0.25 * row)::DOUBLE AS value, (row + col) % 17 > 2 AS valid FROM rc)"""


def sql(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(x.strip() for x in ctes) + "\n" + select
