"""Registered queries of the voxel engine over the table-derived cloud, and equivalent SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairnspark.functions import scalar as S
from cairnspark.operators import raster as R
from cairnspark.operators import tiles as T
from cairnspark.operators import voxel as V
from cairnspark.plans import cloud as C
from cairnspark.schema import INDEX

QUERIES, ORACLES = {}, {}
DEPTH = C.LEVELS - 1
FLAGS = ["px", "mx", "py", "my", "pz", "mz"]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _base(spark, sf_dir):
    p = C.points(spark, sf_dir)
    return p, V.grid_spec(p, C.VOXEL)


def _cells(spark, sf_dir, depth=0):
    p, grid = _base(spark, sf_dir)
    cells = V.voxelize(p, grid)
    for _ in range(depth):
        cells = V.downsample(cells)
    return cells, grid


def _pyramid(spark, sf_dir):
    p, grid = _base(spark, sf_dir)
    return V.pyramid(p, grid, C.LEVELS, C.BRICK), grid


@query(C.sql([C.POINTS_SQL, C.GRID_SQL], "SELECT nx, ny, nz, n AS n_points, denom::INT AS denom, x0, x1, y0, y1, z0, z1, y0 + nz AS origin_north FROM gr"))
def grid_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds, dimensions, origin."""
    _, g = _base(spark, sf_dir)
    row = (*g.dims, g.n_points, g.denom, g.mins[0], g.maxs[0], g.mins[1], g.maxs[1], g.mins[2], g.maxs[2], g.origin[1])
    return spark.createDataFrame([row], "nx long, ny long, nz long, n_points long, denom int, x0 double, x1 double, y0 double, y1 double, z0 double, z1 double, origin_north double")


@query(C.sql([C.POINTS_SQL, C.GRID_SQL], "SELECT gx, gy, gz, count(*) AS n FROM bp GROUP BY gx, gy, gz"))
def bin_points(spark, sf_dir):
    """Points per cell."""
    p, grid = _base(spark, sf_dir)
    return V.bin_points(p, grid).groupBy(*INDEX).agg(F.count("*").alias("n"))


_W = C.BRICK + 2


@query(C.sql([C.POINTS_SQL, C.GRID_SQL], f"""SELECT gx, gy, gz, ((((gx // {C.BRICK}) * ((nz + {C.BRICK - 1}) // {C.BRICK}) + gz // {C.BRICK}) * {_W} + gx % {C.BRICK} + 1) * ny + gy) * {_W} + gz % {C.BRICK} + 1 AS key,
  (gx * ny + gy) * nz + gz AS stride_key, true AS same FROM (SELECT DISTINCT gx, gy, gz FROM bp), gr"""))
def brick_key_roundtrip(spark, sf_dir):
    """Brick keys, stride keys, and unpacking."""
    p, grid = _base(spark, sf_dir)
    _, ny, nz = grid.dims
    k = V.bin_points(p, grid).select(*INDEX).distinct().withColumn("key", S.brick_key(grid.dims, C.BRICK)).withColumns(S.brick_unkey("key", grid.dims, C.BRICK))
    same = (F.col("kx") == F.col("gx")) & (F.col("ky") == F.col("gy")) & (F.col("kz") == F.col("gz"))
    return k.select(*INDEX, "key", ((F.col("gx") * ny + F.col("gy")) * nz + F.col("gz")).alias("stride_key"), same.alias("same"))


@query(C.sql([C.POINTS_SQL, C.GRID_SQL, C.CELLS_SQL], "SELECT * FROM c0"))
def voxelize_rgb(spark, sf_dir):
    """Level-0 cells."""
    return _cells(spark, sf_dir)[0]


_RAMP = ["1.5::DOUBLE * t", "1.0::DOUBLE - abs(t - 0.5::DOUBLE) * 2.0::DOUBLE", "1.5::DOUBLE * (1.0::DOUBLE - t)"]


@query(C.sql([C.POINTS_SQL, C.GRID_SQL, "t AS (SELECT gx, gy, gz, least(greatest((z - z0) / greatest(z1 - z0, 1e-9), 0), 1) AS t FROM bp)"],
  "SELECT gx, gy, gz, " + ", ".join(f"least(greatest(round_even(sum(round_even(least(greatest({e}, 0), 1) * 255.0::DOUBLE * 16777216.0::DOUBLE, 0)::BIGINT)::DOUBLE / (count(*) * 16777216.0::DOUBLE), 0), 0), 255)::INT AS {c}" for e, c in zip(_RAMP, "rgb", strict=True))
  + ", 1::BIGINT AS w FROM t GROUP BY gx, gy, gz"))
def voxelize_height_ramp(spark, sf_dir):
    """Colours from height where a cloud has none."""
    p, grid = _base(spark, sf_dir)
    return V.voxelize(p, grid, "height")


@query(C.sql(C.LEVEL_SQL, "SELECT * FROM c1"))
def downsample_l1(spark, sf_dir):
    """P10, G2."""
    return _cells(spark, sf_dir, 1)[0]


@query(C.sql(C.LEVEL_SQL, "SELECT * FROM c2"))
def downsample_l2(spark, sf_dir):
    """P10, G2, chained."""
    return _cells(spark, sf_dir, 2)[0]


@query(C.sql(C.FACES_SQL, f"SELECT gx, gy, gz, {', '.join(FLAGS)}, nf FROM f0"))
def exposed_faces(spark, sf_dir):
    """Neighbour tests."""
    return V.exposed_faces(_cells(spark, sf_dir)[0], C.BRICK).select(*INDEX, *FLAGS, "nf")


@query(C.sql(C.FACES_SQL, "SELECT gx, gy, gz, r, g, b, nf FROM f1 WHERE nf > 0"))
def surface_cells(spark, sf_dir):
    """Drawn cells of level 1."""
    return V.surface(V.exposed_faces(_cells(spark, sf_dir, 1)[0], C.BRICK)).select(*INDEX, "r", "g", "b", "nf")


@query(C.sql([*C.LEVEL_SQL, f"t AS (SELECT gx, gy, gz, gx // {C.BRICK} AS tx, gz // {C.BRICK} AS tz FROM c0)"], f"""
SELECT tx, tz, true AS own, gx, gy, gz FROM t
UNION ALL SELECT tx - 1, tz, false, gx, gy, gz FROM t WHERE gx % {C.BRICK} = 0 AND tx > 0
UNION ALL SELECT tx + 1, tz, false, gx, gy, gz FROM t WHERE gx % {C.BRICK} = {C.BRICK - 1}
UNION ALL SELECT tx, tz - 1, false, gx, gy, gz FROM t WHERE gz % {C.BRICK} = 0 AND tz > 0
UNION ALL SELECT tx, tz + 1, false, gx, gy, gz FROM t WHERE gz % {C.BRICK} = {C.BRICK - 1}"""))
def apron_cells(spark, sf_dir):
    """Own and bordering cells of each tile."""
    return V.apron(_cells(spark, sf_dir)[0], C.BRICK).select("tx", "tz", "own", *INDEX)


_STATS = "count(*) AS cells, sum((nf > 0)::INT)::BIGINT AS drawn, count(DISTINCT CASE WHEN nf > 0 THEN depth * 1000000 + tx * 1000 + tz END) AS tiles, (sum(nf) * 2)::BIGINT AS triangles, round(sum((nf > 0)::INT) * 100.0::DOUBLE / count(*), 6) AS drawn_pct"


@query(C.sql(C.FACES_SQL, f"SELECT depth, {_STATS} FROM fa GROUP BY depth"))
def level_stats(spark, sf_dir):
    """Per level."""
    return V.level_stats(_pyramid(spark, sf_dir)[0]).where("depth is not null")


@query(C.sql(C.FACES_SQL, f"SELECT depth, {_STATS} FROM fa GROUP BY ROLLUP (depth)"))
def level_rollup(spark, sf_dir):
    """Per level and in total."""
    return V.level_stats(_pyramid(spark, sf_dir)[0])


def _tiles(spark, sf_dir):
    return T.tile_bounds(_pyramid(spark, sf_dir)[0], DEPTH, C.VOXEL)


@query(C.sql(C.TILES_SQL, "SELECT * FROM ti"))
def tile_bounds(spark, sf_dir):
    """Tight bounds of drawn cells."""
    return _tiles(spark, sf_dir)


_BOX = """level, tx, tz, (x0 * cell_size + x1 * cell_size) / 2 AS ce, (-z1 * cell_size - z0 * cell_size) / 2 AS cn, (y_min * cell_size + (y_max + 1) * cell_size) / 2 AS cu,
  (x1 * cell_size - x0 * cell_size) / 2 AS he, (-z0 * cell_size + z1 * cell_size) / 2 AS hn, ((y_max + 1) * cell_size - y_min * cell_size) / 2 AS hu"""


@query(C.sql(C.TILES_SQL, f"SELECT {_BOX} FROM ti"))
def tile_boxes(spark, sf_dir):
    """P20: boxes of tiles."""
    return T.boxes(_tiles(spark, sf_dir))


@query(C.sql([*C.TILES_SQL, f"bx AS (SELECT {_BOX} FROM ti)"], """SELECT level, (min(ce - he) + max(ce + he)) / 2 AS ce, (min(cn - hn) + max(cn + hn)) / 2 AS cn, (min(cu - hu) + max(cu + hu)) / 2 AS cu,
  (max(ce + he) - min(ce - he)) / 2 AS he, (max(cn + hn) - min(cn - hn)) / 2 AS hn, (max(cu + hu) - min(cu - hu)) / 2 AS hu FROM bx GROUP BY level"""))
def union_box(spark, sf_dir):
    """Union of boxes."""
    b = T.boxes(_tiles(spark, sf_dir))
    lo = {a: F.min(F.col(f"c{a}") - F.col(f"h{a}")) for a in "enu"}
    hi = {a: F.max(F.col(f"c{a}") + F.col(f"h{a}")) for a in "enu"}
    return b.groupBy("level").agg(*[((lo[a] + hi[a]) / 2).alias(f"c{a}") for a in "enu"], *[((hi[a] - lo[a]) / 2).alias(f"h{a}") for a in "enu"])


@query(C.sql([*C.TILES_SQL, """ro AS (SELECT max(cell_size) AS cs, min(x0) * max(cell_size) AS e0, max(x1) * max(cell_size) AS e1, -max(z1) * max(cell_size) AS n0, -min(z0) * max(cell_size) AS n1,
  min(y_min) * max(cell_size) AS u0, (max(y_max) + 1) * max(cell_size) AS u1 FROM ti WHERE level = 0)""",
  f"po AS (SELECT 0.0::DOUBLE AS e0, x1 - x0 AS e1, -nz * {C.VOXEL}::DOUBLE AS n0, y1 - y0 - nz * {C.VOXEL} AS n1, 0.0::DOUBLE AS u0, z1 - z0 AS u1 FROM gr)"],
  "SELECT axis, round(below, 6) AS below, round(above, 6) AS above, below > -1e-6 AND above > -1e-6 AS holds, greatest(below, 0) + greatest(above, 0) <= cs + 1e-6 AS tight FROM ("
  + " UNION ALL ".join(f"SELECT '{a}' AS axis, cs, po.{a}0 - ro.{a}0 AS below, ro.{a}1 - po.{a}1 AS above FROM ro, po" for a in "enu") + ")"))
def root_extent(spark, sf_dir):
    """How far the coarsest tiles' boxes reach beyond the points (east, north, up of the origin)."""
    faces, g = _pyramid(spark, sf_dir)
    b = T.boxes(T.tile_bounds(faces, DEPTH, C.VOXEL)).where("level = 0")
    box = b.agg(*[f.alias(f"{a}{k}") for a in "enu" for k, f in ((0, F.min(F.col(f"c{a}") - F.col(f"h{a}"))), (1, F.max(F.col(f"c{a}") + F.col(f"h{a}"))))])
    north = g.dims[2] * g.voxel_size
    points = {"e": (0.0, g.maxs[0] - g.mins[0]), "n": (-north, g.maxs[1] - g.mins[1] - north), "u": (0.0, g.maxs[2] - g.mins[2])}
    rows = box.select(F.explode(F.array(*[F.struct(F.lit(a).alias("axis"), (F.lit(lo) - F.col(f"{a}0")).alias("below"), (F.col(f"{a}1") - F.lit(hi)).alias("above")) for a, (lo, hi) in points.items()])).alias("r")).select("r.*")
    slack, cell = F.lit(1e-6), C.VOXEL * 2**DEPTH
    return rows.select(
        "axis", F.round("below", 6).alias("below"), F.round("above", 6).alias("above"), ((F.col("below") > -slack) & (F.col("above") > -slack)).alias("holds"),
        (F.greatest(F.col("below"), F.lit(0.0)) + F.greatest(F.col("above"), F.lit(0.0)) <= F.lit(cell) + slack).alias("tight"),
    )


@query(C.sql([*C.TILES_SQL, "k AS (SELECT level - 1 AS level, tx >> 1 AS px, tz >> 1 AS pz, string_agg('L' || level || '_' || tx || '_' || tz, ',' ORDER BY tx, tz) AS children FROM ti GROUP BY 1, 2, 3)"],
  "SELECT ti.level, tx, tz, coalesce(children, '') AS children FROM ti LEFT JOIN k ON k.level = ti.level AND k.px = tx AND k.pz = tz"))
def quadtree_children(spark, sf_dir):
    """Children of each tile."""
    return T.children(_tiles(spark, sf_dir))


@query(C.sql([*C.TILES_SQL, f"bx AS (SELECT cell_size, CASE WHEN level = {DEPTH} THEN 0 ELSE cell_size END AS err, {_BOX} FROM ti)"], """SELECT c.level, c.tx, c.tz,
  abs(c.ce - p.ce) + c.he <= p.he + p.cell_size AND abs(c.cn - p.cn) + c.hn <= p.hn + p.cell_size AND abs(c.cu - p.cu) + c.hu <= p.hu + p.cell_size AS inside, c.err < p.err AS error_falls
  FROM bx c JOIN bx p ON p.level = c.level - 1 AND p.tx = c.tx >> 1 AND p.tz = c.tz >> 1"""))
def quadtree_check(spark, sf_dir):
    """Boxes and errors against the parent's."""
    return T.tree_checks(_tiles(spark, sf_dir), DEPTH)


@query(C.sql([*C.TILES_SQL], f"""SELECT level, tx, tz, CASE WHEN level = {DEPTH} THEN 0 ELSE cell_size END AS geometric_error, 'FLOAT' AS id_type,
  'content/L' || level || '_' || tx || '_' || tz || '.glb' AS uri FROM ti"""))
def tile_nodes(spark, sf_dir):
    """Errors, feature id types (float in all files that are not compressed) and content names."""
    t = _tiles(spark, sf_dir)
    return t.select("level", "tx", "tz", F.when(F.col("level") == DEPTH, 0.0).otherwise(F.col("cell_size")).alias("geometric_error"),
                    F.lit("FLOAT").alias("id_type"), F.format_string("content/L%d_%d_%d.glb", "level", "tx", "tz").alias("uri"))


_IDS = "fi AS (SELECT depth, tx, tz, gx, gy, gz, row_number() OVER (PARTITION BY depth, tx, tz ORDER BY gx, gy, gz) - 1 AS row_in_tile, row_number() OVER (ORDER BY depth, tx, tz, gx, gy, gz) - 1 AS feature_id FROM fa WHERE nf > 0)"


@query(C.sql([*C.FACES_SQL, _IDS], "SELECT * FROM fi"))
def feature_ids(spark, sf_dir):
    """Feature numbers and rows in tiles."""
    return T.feature_ids(_pyramid(spark, sf_dir)[0]).select("depth", "tx", "tz", *INDEX, "row_in_tile", "feature_id")


@query(C.sql([*C.FACES_SQL, _IDS], "SELECT depth, tx, tz, max(row_in_tile) AS last_row, min(feature_id) AS first_id, max(feature_id) AS last_id FROM fi GROUP BY depth, tx, tz"))
def tile_row_ids(spark, sf_dir):
    """First and last ids of tiles."""
    f = T.feature_ids(_pyramid(spark, sf_dir)[0])
    return f.groupBy("depth", "tx", "tz").agg(F.max("row_in_tile").alias("last_row"), F.min("feature_id").alias("first_id"), F.max("feature_id").alias("last_id"))


@query(C.sql([*C.FACES_SQL, _IDS], "SELECT count(*) AS n, count(DISTINCT feature_id) AS distinct_ids, min(feature_id) AS lo, max(feature_id) AS hi FROM fi"))
def feature_id_check(spark, sf_dir):
    """No gaps, no repeats."""
    return T.feature_check(T.feature_ids(_pyramid(spark, sf_dir)[0]))


_QUADS = "qu AS (" + " UNION ALL ".join(f"SELECT depth, gx, gy, gz, r, g, b, {i} AS face FROM fa WHERE {c}" for i, c in enumerate(FLAGS)) + ")"


@query(C.sql([*C.FACES_SQL, _QUADS], "SELECT * FROM qu"))
def face_quads(spark, sf_dir):
    """Exposed faces with their cell's columns."""
    return T.quads(_pyramid(spark, sf_dir)[0]).drop("tx", "tz")


_CORNERS = ", ".join(
    f"({f}, {k}, " + ", ".join(str(n[a] + st * t[a] + sb * b[a]) for a in range(3)) + ", " + ", ".join(str(n[a]) for a in range(3)) + ")"
    for f, (n, t, b) in enumerate(T.FRAMES) for k, (st, sb) in enumerate(T.CORNERS)
)


@query(C.sql([*C.FACES_SQL, _QUADS, f"co(face, corner, d0, d1, d2, n0, n1, n2) AS (VALUES {_CORNERS})"],
  "SELECT depth, gx, gy, gz, face, corner, 2 * gx + 1 + d0 AS hx, 2 * gy + 1 + d1 AS hy, 2 * gz + 1 + d2 AS hz, n0, n1, n2 FROM qu JOIN co USING (face)"))
def quad_vertices(spark, sf_dir):
    """Corners of all faces in half cells."""
    return T.vertices(T.quads(_pyramid(spark, sf_dir)[0]))


_KEY = "((r >> 6) << 4) | ((g >> 6) << 2) | (b >> 6)"


@query(C.sql(C.LEVEL_SQL, f"SELECT {_KEY} AS bucket, round_even(avg(r), 0)::INT AS r, round_even(avg(g), 0)::INT AS g, round_even(avg(b), 0)::INT AS b, count(*) AS cells FROM c0 GROUP BY 1"))
def palette_buckets(spark, sf_dir):
    """Palette."""
    return T.palette(_cells(spark, sf_dir)[0], 2)


@query(C.sql(C.LEVEL_SQL, "SELECT gx, gy, gz, " + ", ".join(f"round(round_even({c} / 255.0::DOUBLE * 31, 0) / 31, 6) AS {c}" for c in "rgb") + " FROM c1"))
def color_quantize(spark, sf_dir):
    """Five-bit colours."""
    c = _cells(spark, sf_dir, 1)[0]
    return c.select(*INDEX, *[F.round(S.quantized(F.col(x), 5).cast("double"), 6).alias(x) for x in "rgb"])


@query(C.sql([*C.LEVEL_SQL], "SELECT DISTINCT '#' || lpad(lower(to_hex(r)), 2, '0') || lpad(lower(to_hex(g)), 2, '0') || lpad(lower(to_hex(b)), 2, '0') AS hex, r, g, b FROM c2"))
def hex_colours(spark, sf_dir):
    """Colours to hex and back."""
    h = _cells(spark, sf_dir, 2)[0].select(S.hex_colour(F.col("r"), F.col("g"), F.col("b")).alias("hex")).distinct()
    return h.select("hex", *[c.alias(n) for c, n in zip(S.from_hex(F.col("hex")), "rgb", strict=True)])


def _placed(spark, sf_dir, depth):
    cells, grid = _cells(spark, sf_dir, depth)
    size = C.VOXEL * 2**depth
    return V.surface(V.exposed_faces(cells, C.BRICK)).select(*INDEX).withColumns(S.world(grid, size)), size


def _placed_sql(depth):
    size, r = C.VOXEL * 2**depth, C.RASTER
    h = size / 2 / abs(r.a)
    lim = lambda e, n: f"least(greatest({e}, 0), {n})::INT"
    return [
        *C.FACES_SQL, C.RASTER_SQL,
        f"en AS (SELECT gx, gy, gz, x0 + (gx + 0.5::DOUBLE) * {size} AS east, (y0 + nz * {C.VOXEL}) - (gz + 0.5::DOUBLE) * {size} AS north FROM f{depth}, gr WHERE nf > 0)",
        f"px AS (SELECT *, (east - {r.c}) / {r.a} AS colf, (north - {r.f}) / ({r.e}) AS rowf FROM en)",
        f"pc AS (SELECT *, floor(colf) < 0 OR floor(colf) >= {r.width} OR floor(rowf) < 0 OR floor(rowf) >= {r.height} AS outside, {lim('floor(colf)', r.width - 1)} AS col, {lim('floor(rowf)', r.height - 1)} AS row FROM px)",
        f"fp AS (SELECT *, {lim(f'ceil(colf - {h} - 0.5)', r.width)} AS c0, {lim(f'ceil(colf + {h} - 0.5)', r.width)} AS c1, {lim(f'ceil(rowf - {h} - 0.5)', r.height)} AS r0, {lim(f'ceil(rowf + {h} - 0.5)', r.height)} AS r1 FROM pc)",
    ]


@query(C.sql(_placed_sql(0), "SELECT gx, gy, gz, pc.row, pc.col, outside, value FROM pc JOIN ra ON ra.row = pc.row AND ra.col = pc.col"))
def raster_center(spark, sf_dir):
    """Value under each drawn cell, clamped to the raster's edge."""
    at, _ = _placed(spark, sf_dir, 0)
    r = C.raster(spark).withColumn("dist", F.lit(0))
    return R.centre_lookup(at, r, C.RASTER).select(*INDEX, "row", "col", "outside", F.col("value").cast("int").alias("value"))


@query(C.sql(_placed_sql(0), "SELECT row, col, count(*) AS cells FROM pc WHERE outside GROUP BY row, col"))
def raster_edge_clamp(spark, sf_dir):
    """Edge pixels that stand for cells outside."""
    at, _ = _placed(spark, sf_dir, 0)
    return R.pixel_index(at, C.RASTER).where("outside").groupBy("row", "col").agg(F.count("*").alias("cells"))


_UNDER = "un AS (SELECT gx, gy, gz, value FROM fp JOIN ra ON ra.row >= r0 AND ra.row < r1 AND ra.col >= c0 AND ra.col < c1 WHERE ra.valid)"


@query(C.sql([*_placed_sql(2), _UNDER, "n AS (SELECT gx, gy, gz, value, count(*) AS n FROM un GROUP BY ALL)", "k AS (SELECT *, row_number() OVER (PARTITION BY gx, gy, gz ORDER BY n DESC, value) AS k FROM n)"],
  "SELECT gx, gy, gz, value AS code, n AS pixels FROM k WHERE k = 1"))
def raster_majority(spark, sf_dir):
    """Majority class under coarse cells."""
    at, size = _placed(spark, sf_dir, 2)
    m = R.majority(R.footprint(at, C.RASTER, size), C.raster(spark), INDEX)
    return m.select(*INDEX, F.col("code").cast("int").alias("code"), "pixels")


@query(C.sql([*_placed_sql(2), _UNDER.replace("ra", "rv")], "SELECT gx, gy, gz, round(avg(value), 6) AS mean, count(*) AS pixels FROM un GROUP BY ALL"))
def raster_mean(spark, sf_dir):
    """Mean under coarse cells, by explode and equality join."""
    at, size = _placed(spark, sf_dir, 2)
    u = R.under(R.footprint(at, C.RASTER, size), C.raster(spark, "slope"), INDEX)
    return u.groupBy(*INDEX).agg(F.round(F.avg("value"), 6).alias("mean"), F.count("*").alias("pixels"))


@query(C.sql([*_placed_sql(2), _UNDER], "SELECT fp.gx, fp.gy, fp.gz, coalesce(sum(value), 0)::BIGINT AS total, count(value) AS n FROM fp LEFT JOIN un USING (gx, gy, gz) GROUP BY ALL"))
def raster_rect_sum(spark, sf_dir):
    """Footprint sums from a summed-area table."""
    at, size = _placed(spark, sf_dir, 2)
    s = R.rect_sums(R.footprint(at, C.RASTER, size), R.sat(C.raster(spark)), INDEX)
    return s.select(*INDEX, F.col("total").cast("long").alias("total"), F.col("n").cast("long").alias("n"))


@query(C.sql([C.RASTER_SQL, "a AS (SELECT row, col, sum(CASE WHEN valid THEN value ELSE 0 END) OVER (PARTITION BY row ORDER BY col) AS v, sum(valid::INT) OVER (PARTITION BY row ORDER BY col) AS k FROM ra)"],
  "SELECT row, col, (sum(v) OVER (PARTITION BY col ORDER BY row))::BIGINT AS total, (sum(k) OVER (PARTITION BY col ORDER BY row))::BIGINT AS n FROM a"))
def raster_sat(spark, sf_dir):
    """Summed-area table by two windows."""
    return R.sat(C.raster(spark)).select("row", "col", F.col("total").cast("long").alias("total"), F.col("n").cast("long").alias("n"))


_AROUND = ", ".join(f"({i}, {dr}, {dc})" for i, (dr, dc) in enumerate(R.AROUND))


def _fill_ctes(src: str, pick: str, passes: int) -> list[str]:
    ctes = [f"o(ord, dr, dc) AS (VALUES {_AROUND})", f"s0 AS (SELECT row, col, value, valid, 0 AS dist FROM {src})"]
    for k in range(1, passes + 1):
        ctes.append(f"n{k} AS (SELECT a.row, a.col, {pick} AS given FROM s{k - 1} a, o JOIN s{k - 1} b ON b.row = a.row + dr AND b.col = a.col + dc WHERE NOT a.valid AND b.valid GROUP BY ALL)")
        ctes.append(f"s{k} AS (SELECT a.row, a.col, CASE WHEN NOT valid AND given IS NOT NULL THEN given ELSE value END AS value, valid OR given IS NOT NULL AS valid, CASE WHEN NOT valid AND given IS NOT NULL THEN {k} ELSE dist END AS dist FROM s{k - 1} a LEFT JOIN n{k} n ON n.row = a.row AND n.col = a.col)")
    return ctes


def _fill_sql(src: str, pick: str, passes: int, out: str) -> str:
    return C.sql([C.RASTER_SQL, *_fill_ctes(src, pick, passes)], f"SELECT row, col, {out} AS value, valid, dist FROM s{passes}")


@query(_fill_sql("ra", "min_by(b.value, ord)", 2, "value::INT"))
def raster_fill_pass(spark, sf_dir):
    """Two rings of nodata filling, classes."""
    f = R.fill_nearest(C.raster(spark), 2)
    return f.select("row", "col", F.col("value").cast("int").alias("value"), "valid", "dist")


@query(_fill_sql("rv", "avg(b.value)", 2, "round(value, 6)"))
def raster_fill_mean(spark, sf_dir):
    """Two rings of nodata filling, means."""
    f = R.fill_nearest(C.raster(spark, "slope"), 2, categorical=False)
    return f.select("row", "col", F.round("value", 6).alias("value"), "valid", "dist")


def _histogram(spark, sf_dir, passes=0):
    r = R.fill_nearest(C.raster(spark), passes)
    out = None
    for depth in range(C.LEVELS):
        at, _ = _placed(spark, sf_dir, depth)
        one = R.centre_lookup(at, r, C.RASTER).withColumn("depth", F.lit(depth))
        out = one if out is None else out.unionByName(one)
    return out


def _histogram_sql(select: str, src: str = "ra", ctes=()) -> str:
    r = C.RASTER
    every = " UNION ALL ".join(
        f"SELECT {d} AS depth, gx, gy, gz, least(greatest(floor((x0 + (gx + 0.5::DOUBLE) * {C.VOXEL * 2**d} - {r.c}) / {r.a}), 0), {r.width - 1})::INT AS col, "
        f"least(greatest(floor(((y0 + nz * {C.VOXEL}) - (gz + 0.5::DOUBLE) * {C.VOXEL * 2**d} - {r.f}) / ({r.e})), 0), {r.height - 1})::INT AS row, "
        f"floor((x0 + (gx + 0.5::DOUBLE) * {C.VOXEL * 2**d} - {r.c}) / {r.a}) NOT BETWEEN 0 AND {r.width - 1} OR floor(((y0 + nz * {C.VOXEL}) - (gz + 0.5::DOUBLE) * {C.VOXEL * 2**d} - {r.f}) / ({r.e})) NOT BETWEEN 0 AND {r.height - 1} AS outside FROM f{d}, gr WHERE nf > 0"
        for d in range(C.LEVELS)
    )
    return C.sql([*C.FACES_SQL, C.RASTER_SQL, *ctes, f"al AS ({every})", f"h AS (SELECT depth, outside, r.* FROM al JOIN {src} r ON r.row = al.row AND r.col = al.col)"], select)


@query(_histogram_sql("SELECT depth, value::INT AS value, count(*) AS cells FROM h GROUP BY ROLLUP (depth, value)"))
def class_histogram(spark, sf_dir):
    """Classes per level with totals."""
    return _histogram(spark, sf_dir).rollup("depth", F.col("value").cast("int").alias("value")).agg(F.count("*").alias("cells"))


@query(_histogram_sql("SELECT min(value)::INT AS lo, max(value)::INT AS hi, round(avg(value), 6) AS mean, count(*) AS n FROM h"))
def property_range(spark, sf_dir):
    """Range and mean of a property over all drawn cells."""
    h = _histogram(spark, sf_dir)
    return h.agg(F.min("value").cast("int").alias("lo"), F.max("value").cast("int").alias("hi"), F.round(F.avg("value"), 6).alias("mean"), F.count("*").alias("n"))


@query(_histogram_sql("SELECT depth, sum((outside OR dist > 0)::INT)::BIGINT AS on_filled, sum(outside::INT)::BIGINT AS outside, max(dist) AS max_ring FROM h GROUP BY depth", "s2", _fill_ctes("ra", "min_by(b.value, ord)", 2)))
def fill_counters(spark, sf_dir):
    """Cells on filled pixels and outside, and the farthest ring that a cell's value comes from."""
    h = _histogram(spark, sf_dir, 2)
    return h.groupBy("depth").agg(F.count_if(F.col("outside") | (F.col("dist") > 0)).alias("on_filled"), F.count_if("outside").alias("outside"), F.max("dist").alias("max_ring"))


_R = C.RASTER
_RX, _RY = sorted((_R.c, _R.c + _R.a * _R.width)), sorted((_R.f, _R.f + _R.e * _R.height))


@query(C.sql([C.POINTS_SQL, C.GRID_SQL], f"""SELECT round(greatest(0, least(x1, {_RX[1]}) - greatest(x0, {_RX[0]})) * greatest(0, least(y1, {_RY[1]}) - greatest(y0, {_RY[0]})) / greatest((x1 - x0) * (y1 - y0), 1e-12), 6) AS coverage FROM gr"""))
def raster_coverage(spark, sf_dir):
    """P25: share of the cloud's box that the raster covers."""
    _, g = _base(spark, sf_dir)
    return spark.range(1).select(F.round(R.coverage(F.lit(g.mins[0]), F.lit(g.mins[1]), F.lit(g.maxs[0]), F.lit(g.maxs[1]), _R), 6).alias("coverage"))


@query(C.sql([C.RASTER_SQL], "SELECT round(avg(valid::INT), 6) AS valid_fraction, count(DISTINCT CASE WHEN valid THEN value END) AS codes FROM ra"))
def valid_fraction(spark, sf_dir):
    """Valid share and number of classes."""
    return C.raster(spark).agg(F.round(F.avg(F.col("valid").cast("int")), 6).alias("valid_fraction"), F.countDistinct(F.when(F.col("valid"), F.col("value"))).alias("codes"))


@query(C.sql([C.POINTS_SQL, C.GRID_SQL], "SELECT x1 - x0 AS width, y1 - y0 AS height, round(n / nullif((x1 - x0) * (y1 - y0), 0), 6) AS density FROM gr"))
def density(spark, sf_dir):
    """Extent and points per square unit."""
    p = C.points(spark, sf_dir).agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"), F.count("*").alias("n"))
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    return p.select(w.alias("width"), h.alias("height"), F.round(F.try_divide("n", F.nullif(w * h, F.lit(0.0))), 6).alias("density"))


@query("SELECT o_orderkey, o_custkey FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS k, (SELECT count(*) FROM orders) AS n FROM orders) WHERE k % greatest(1, n // 2000) = 0")
def stride_sample(spark, sf_dir):
    """Every k-th row of an ordered source (numbers within ranges of fixed bounds, no single-task window); equal keys by customer."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    n = o.count()
    ranges = max(1, min(200, n // 100_000 + 1))
    # the bounds are constants: a range partitioning samples anew in each job, and its borders move between them
    bounds = o.agg(F.percentile_approx("o_orderkey", [i / ranges for i in range(1, ranges)]).alias("b")).first().b or [] if ranges > 1 else []
    o = o.withColumn("part", S.range_of(F.col("o_orderkey"), sorted(set(bounds))))
    base, start = [0] * (len(bounds) + 1), 0
    for part, size in sorted((r.part, r.n) for r in o.groupBy("part").agg(F.count("*").alias("n")).collect()):
        base[part], start = start, start + size
    at = F.row_number().over(Window.partitionBy("part").orderBy(F.asc_nulls_last("o_orderkey"), F.asc_nulls_last("o_custkey"))) - 1
    first = F.get(F.lit(base).cast("array<long>"), F.col("part"))
    return o.withColumn("at", at).where((first + F.col("at")) % max(1, n // 2000) == 0).select("o_orderkey", "o_custkey")


_BOXES = [(-60.0, -30.0, -50.0, -20.0, 0.0, 10.0), (500000.0, 7500000.0, 500300.0, 7500280.0, 760.0, 800.0), (-6e6, -2e6, -5.9e6, -1.9e6, 0.0, 100.0), (0.0, 0.0, 50.0, 60.0, 0.0, 9500.0)]


@query("WITH b(x0, y0, x1, y1, z0, z1) AS (VALUES " + ", ".join(str(tuple(f"{v}" for v in b)).replace("'", "") for b in _BOXES) + """),
d AS (SELECT x0::DOUBLE AS x0, y0::DOUBLE AS y0, x1::DOUBLE AS x1, y1::DOUBLE AS y1, z0::DOUBLE AS z0, z1::DOUBLE AS z1 FROM b)
SELECT x0, y0, CASE WHEN x0 >= -180 AND x1 <= 180 AND y0 >= -90 AND y1 <= 90 THEN 'degrees' ELSE concat_ws('; ',
  CASE WHEN abs(x0) <= 20037509 AND abs(y0) <= 20048967 AND greatest(abs(x1), abs(y1)) > 1000000 THEN 'web mercator' END,
  CASE WHEN x0 >= 100000 AND x1 <= 1000000 THEN 'transverse mercator easting' END, CASE WHEN y0 >= 0 AND y1 <= 10000000 THEN 'utm northing' END,
  CASE WHEN z1 - z0 < 9000 THEN 'metres' ELSE 'check units' END) END AS family FROM d""")
def coordinate_family(spark, sf_dir):
    """Kinds of coordinates that bounds may hold."""
    b = spark.createDataFrame(_BOXES, "x0 double, y0 double, x1 double, y1 double, z0 double, z1 double")
    return b.select("x0", "y0", F.array_join(S.coordinate_family(*[F.col(c) for c in ("x0", "y0", "x1", "y1", "z0", "z1")]), "; ").alias("family"))


_NAMES = "f AS (SELECT 'content/L' || level || '_' || tx || '_' || tz || '.glb.gz' AS name, cubes * 1500 AS bytes FROM ti UNION ALL SELECT 'tileset.json', 2000 UNION ALL SELECT '.htaccess', 10 UNION ALL SELECT 'notes.txt', 5)"


@query(C.sql([*C.TILES_SQL, _NAMES, "g AS (SELECT name, regexp_replace(name, '\\.gz$', '') AS key, bytes FROM f)"], """SELECT key, CASE WHEN key LIKE '%.glb' THEN 'model/gltf-binary' ELSE 'application/json' END AS content_type,
  CASE WHEN key LIKE '%.json' THEN 1 ELSE 0 END AS turn, regexp_matches(split_part(name, '/', -1), '^L\\d+_\\d+_\\d+\\.glb(\\.gz)?$') AS is_tile,
  CASE WHEN bytes >= 1e9 THEN printf('%.2f GB', bytes / 1e9) WHEN bytes >= 1e6 THEN printf('%.2f MB', bytes / 1e6) WHEN bytes >= 1e3 THEN printf('%.2f KB', bytes / 1e3) ELSE bytes || ' bytes' END AS size FROM g WHERE key LIKE '%.glb' OR key LIKE '%.json'"""))
def publish_plan(spark, sf_dir):
    """Keys, types and order of an upload (tileset last), sizes as text."""
    t = _tiles(spark, sf_dir).select(F.format_string("content/L%d_%d_%d.glb.gz", "level", "tx", "tz").alias("name"), (F.col("cubes") * 1500).alias("bytes"))
    f = t.union(spark.createDataFrame([("tileset.json", 2000), (".htaccess", 10), ("notes.txt", 5)], "name string, bytes long"))
    key = F.regexp_replace("name", r"\.gz$", "")
    f = f.withColumn("key", key).where(F.col("key").endswith(".glb") | F.col("key").endswith(".json"))
    return f.select(
        "key", F.when(F.col("key").endswith(".glb"), "model/gltf-binary").otherwise("application/json").alias("content_type"),
        F.col("key").endswith(".json").cast("int").alias("turn"), S.is_tile_name(F.element_at(F.split("name", "/"), -1)).alias("is_tile"), S.size_text(F.col("bytes")).alias("size"),
    )


@query(C.sql([*C.TILES_SQL, "e AS (SELECT 'L' || level || '_' || tx || '_' || tz AS k, cubes::DOUBLE AS v FROM ti)", "a AS (SELECT k, v + CASE WHEN v % 7 = 0 THEN 1 WHEN v % 5 = 0 THEN 1e-12 ELSE 0 END AS v FROM e WHERE v % 11 <> 0 UNION ALL SELECT 'extra', 1)"],
  "SELECT coalesce(e.k, a.k) AS k, CASE WHEN a.k IS NULL THEN 'missing' WHEN e.k IS NULL THEN 'unexpected' ELSE 'differs' END AS what FROM e FULL JOIN a ON e.k = a.k WHERE a.k IS NULL OR e.k IS NULL OR abs(e.v - a.v) > 1e-9 * greatest(1, abs(e.v))"))
def manifest_diff(spark, sf_dir):
    """Differences of two manifests beyond a tolerance."""
    e = _tiles(spark, sf_dir).select(F.format_string("L%d_%d_%d", "level", "tx", "tz").alias("k"), F.col("cubes").cast("double").alias("v"))
    a = e.where("v % 11 <> 0").select(F.col("k").alias("k2"), (F.col("v") + F.when(F.col("v") % 7 == 0, 1.0).when(F.col("v") % 5 == 0, 1e-12).otherwise(0.0)).alias("v2"))
    a = a.union(spark.createDataFrame([("extra", 1.0)], "k string, v double"))
    j = e.join(a, F.col("k") == F.col("k2"), "full_outer")
    j = j.where(F.col("k").isNull() | F.col("k2").isNull() | (F.abs(F.col("v") - F.col("v2")) > F.lit(1e-9) * F.greatest(F.lit(1.0), F.abs("v"))))
    return j.select(F.coalesce("k", "k2").alias("k"), F.when(F.col("k2").isNull(), "missing").when(F.col("k").isNull(), "unexpected").otherwise("differs").alias("what"))


@query(C.sql(C.TILES_SQL, """SELECT tx, tz, 'both' AS side FROM (SELECT tx, tz FROM ti WHERE level = 2 INTERSECT SELECT tx, tz FROM ti WHERE level = 1)
UNION ALL SELECT tx, tz, 'fine only' FROM (SELECT tx, tz FROM ti WHERE level = 2 EXCEPT SELECT tx, tz FROM ti WHERE level = 1)"""))
def name_set_ops(spark, sf_dir):
    """Intersection and difference of tile names."""
    t = _tiles(spark, sf_dir)
    fine, coarse = t.where("level = 2").select("tx", "tz"), t.where("level = 1").select("tx", "tz")
    return fine.intersect(coarse).withColumn("side", F.lit("both")).union(fine.subtract(coarse).withColumn("side", F.lit("fine only")))


@query("SELECT message, min(k) AS first_at FROM (SELECT event_type AS message, event_id AS k FROM events) GROUP BY message")
def message_dedupe(spark, sf_dir):
    """Distinct messages at their first place."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").groupBy(F.col("event_type").alias("message")).agg(F.min("event_id").alias("first_at"))


@query("SELECT u * 10 AS u, v * 10 - 80 AS v, w AS w FROM range(9) a(u), range(9) b(v), range(3) c(w)")
def lattice(spark, sf_dir):
    """Sample lattice of the placement fit."""
    one = spark.range(1).select(F.explode(F.sequence(F.lit(0), F.lit(8))).alias("u")).select("u", F.explode(F.sequence(F.lit(0), F.lit(8))).alias("v"))
    one = one.select("u", "v", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("w"))
    return one.select((F.col("u") * 10).cast("long").alias("u"), (F.col("v") * 10 - 80).cast("long").alias("v"), F.col("w").cast("long").alias("w"))


@query(C.sql([*C.TILES_SQL], f"SELECT level, tx, tz, tx >> level AS root_x, tz >> level AS root_z, level AS steps FROM ti"))
def tree_walk(spark, sf_dir):
    """Root and depth of each tile, by a walk over parent rows: a level of the tree for each join."""
    t = _tiles(spark, sf_dir).select("level", "tx", "tz")
    up = t.select("*", F.col("level").alias("at"), F.col("tx").alias("root_x"), F.col("tz").alias("root_z"), F.lit(0).alias("steps"))
    parent = t.select(F.col("level").alias("pl"), F.col("tx").alias("px"), F.col("tz").alias("pz"))
    for _ in range(DEPTH):
        on = (F.col("pl") == F.col("at") - 1) & (F.col("px") == F.shiftright("root_x", 1)) & (F.col("pz") == F.shiftright("root_z", 1))
        up = up.join(parent, on, "left").select(
            "level", "tx", "tz", F.coalesce("pl", "at").alias("at"), F.coalesce("px", "root_x").alias("root_x"), F.coalesce("pz", "root_z").alias("root_z"), (F.col("steps") + F.col("pl").isNotNull().cast("int")).alias("steps")
        )
    return up.drop("at")


def _encoded(spark, sf_dir, mode):
    from cairnspark.plans.build import encode_tiles
    from cairnspark.schema import BuildConfig

    faces, grid = _pyramid(spark, sf_dir)
    tiles = encode_tiles(T.feature_ids(faces), grid, DEPTH, BuildConfig(C.VOXEL, C.BRICK, mode=mode))
    return tiles.select("level", "tx", "tz", "cubes", "triangles", "bytes", F.sha2("content", 256).alias("sha256"))


@query()
def glb_tiles(spark, sf_dir):
    """Baked tiles and their hashes."""
    return _encoded(spark, sf_dir, "baked")


@query()
def glb_instanced(spark, sf_dir):
    """K3: instanced tiles and their hashes."""
    return _encoded(spark, sf_dir, "instanced")


@query()
def utm_to_ecef(spark, sf_dir):
    """Projected coordinates to earth-centred metres and back."""
    import numpy as np
    import pandas as pd

    from cairnspark.functions import crs

    def convert(batches):
        for b in batches:
            e, n = 500000.0 + b["x"].to_numpy(), 7500000.0 + b["y"].to_numpy()
            ex, ey, ez = crs.transform(31983, 4978, e, n, b["z"].to_numpy())
            be, bn, bh = crs.transform(4978, 31983, ex, ey, ez)
            yield pd.DataFrame({"ex": ex.round(6), "ey": ey.round(6), "ez": ez.round(6), "off_m": np.hypot(be - e, bn - n).round(6), "off_h": np.abs(bh - b["z"].to_numpy()).round(6)})

    return C.points(spark, sf_dir).select("x", "y", "z").mapInPandas(convert, "ex double, ey double, ez double, off_m double, off_h double")


@query()
def affine_fit(spark, sf_dir):
    """Placement matrix of the cloud's grid, with its worst errors."""
    from cairnspark.functions import crs

    _, g = _base(spark, sf_dir)
    nx, ny, nz = (float(n) for n in g.dims)
    m, worst = crs.placement(31983, (500000.0 + g.origin[0], 7500000.0 + g.origin[1], g.origin[2]), (nx, ny, nz))
    rows = [(i // 4, i % 4, round(v, 6)) for i, v in enumerate(m)] + [(4, 0, round(worst["max_horizontal_m"], 6)), (4, 1, round(worst["max_vertical_m"], 6))]
    return spark.createDataFrame(rows, "col int, row int, value double")


@query()
def utm_zones(spark, sf_dir):
    """Zones whose reading of a coordinate lies near a hint."""
    from cairnspark.functions import crs

    found = crs.zones_near(500150.0, 7500140.0, -45.0, -22.6, 700.0)
    return spark.createDataFrame([(r["epsg"], round(r["lon"], 6), round(r["lat"], 6), round(r["km"], 3)) for r in found], "epsg int, lon double, lat double, km double")


@query(C.sql([C.POINTS_SQL], "SELECT floor(x)::BIGINT % 10 AS strip, count(*) AS n, round(sum(z), 3) AS z, sum(red)::BIGINT AS red, (SELECT count(*) FROM p) AS declared FROM p GROUP BY 1"))
def las_round_trip(spark, sf_dir):
    """The whole cloud written as LAS files by tasks, and read by record ranges."""
    from cairnspark.sources.las import register, write_parts
    from cairnspark.sources.outdir import work_folder

    folder = work_folder(spark, "las")
    declared = write_parts(C.points(spark, sf_dir), folder, epsg=31983).agg(F.sum("n")).first()[0]
    register(spark)
    back = spark.read.format("las").option("records", 20_000).load(folder)
    return back.groupBy((F.floor("x") % 10).alias("strip")).agg(F.count("*").alias("n"), F.round(F.sum("z"), 3).alias("z"), F.sum("red").alias("red")).withColumn("declared", F.lit(declared))
