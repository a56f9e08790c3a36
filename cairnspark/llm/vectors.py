"""Embedding near-dedup by spherical-cap filters from structured random product codes.

A filter direction is the concatenation of one code word per block of the
vector; a vector is list-decoded to all directions whose inner product
exceeds a threshold (block sums are combined and pruned, so the q^4 directions
are never visited one by one).  Vectors of a label that share a filter are
compared in double precision.  The code grows with the number of vectors, so
a filter keeps a few vectors whatever the size of the table.

Equal vectors of a label are one class from the start.  A filter's vectors are
compared in blocks, by matrix products; no pair rows are made: a task emits
link counts and a spanning set of edges.  A pair in several filters counts in
the smallest.  Filters with more than ``block`` vectors are cut into blocks,
and pairs of blocks are separate groups.

Edge cases: vectors that are null, zero or hold null or non-finite components,
and null labels, link with nothing; vectors of different length are not
compared; fewer dimensions than blocks use fewer blocks; repeated ids are rows
of their own, one class only if their vectors and labels are equal; null ids
are rows as well and never the smallest id; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnspark.llm.shared import Scratch, components, cut

COSINE = 0.98
LIST = 24
LEAST = 16
BLOCK = 2048


def codebooks(dim: int, q: int, seed: int) -> list[np.ndarray]:
    """Four random code books (fewer below four dimensions) of q unit words each."""
    rng = np.random.default_rng([seed, dim, q])
    out = []
    for part in np.array_split(np.arange(dim), min(4, dim)):
        c = rng.standard_normal((q, len(part)))
        out.append(c / np.linalg.norm(c, axis=1, keepdims=True))
    while len(out) < 4:
        out.append(np.zeros((1, 0)))
    return out


def decode(x: np.ndarray, q: int, seed: int, size: int = LIST, least: int = LEAST) -> list[np.ndarray]:
    """Filter numbers of each unit vector of ``x``: all that exceed the threshold, the ``least`` largest at least.

    The threshold lets about ``size`` of the directions pass for a vector that
    has equal weight in all blocks.
    """
    n, dim = x.shape
    books = codebooks(dim, q, seed)
    parts = np.array_split(np.arange(dim), min(4, dim)) + [np.arange(0)] * (4 - min(4, dim))
    s = [x[:, p] @ c.T if len(p) else np.zeros((n, 1)) for p, c in zip(parts, books, strict=True)]
    ab = (s[0][:, :, None] + s[1][:, None, :]).reshape(n, -1)
    cd = (s[2][:, :, None] + s[3][:, None, :]).reshape(n, -1)
    total = ab.shape[1] * cd.shape[1]
    limit = NormalDist().inv_cdf(1 - min(0.5, size / total)) / np.sqrt(dim) * np.sqrt(min(4, dim))
    ia, ic = np.argsort(-ab, axis=1), np.argsort(-cd, axis=1)
    out = []
    for i in range(n):
        a, c = ab[i, ia[i]], cd[i, ic[i]]
        bar = limit
        k = min(least, total)
        top = np.sort((a[:k, None] + c[None, :k]).reshape(-1))  # the k best sums lie in the k x k corner
        bar = min(bar, top[-k])
        m = int(np.searchsorted(-a, -(bar - c[0]), side="right"))
        take = np.searchsorted(-c, -(bar - a[:m]), side="right")
        f = np.repeat(ia[i, :m] * cd.shape[1], take)
        run = np.arange(len(f)) - np.repeat(np.cumsum(take) - take, take)
        out.append(np.sort(f + ic[i, run]))
    return out


def _decode_batches(q: int, seed: int):
    def run(batches):
        for batch in batches:
            vec = batch.column("vec")
            dims = np.diff(vec.offsets.to_numpy())
            flat = vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            base = np.concatenate([[0], np.cumsum(dims)])
            lists: list = [None] * len(dims)
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                for lo in range(0, len(rows), 256):
                    part = rows[lo : lo + 256]
                    x = flat[base[part][:, None] + np.arange(dim)]
                    x = x / np.abs(x).max(axis=1, keepdims=True)
                    x /= np.linalg.norm(x, axis=1, keepdims=True)
                    for r, f in zip(part, decode(x, q, seed), strict=True):
                        lists[r] = f
            offs = pa.array(np.concatenate([[0], np.cumsum([len(f) for f in lists])]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.ListArray.from_arrays(offs, pa.array(np.concatenate(lists).astype(np.int64)))], names=["rep", "filters"])

    return run


def _compare(rep, weight, x, filters, here, side, own, cosine):
    """Link counts and edges within one filter: of all pairs in a block's ``own`` group, else of those across the two sides."""
    n = len(rep)
    counts = np.zeros(n, np.int64)
    found = []
    for lo in range(0, n, 512):
        c = x[lo : lo + 512] @ x.T
        i, j = np.nonzero(c >= cosine)
        i += lo
        ok = i < j if own else (side[i] != side[j]) & (i < j)
        found.append(np.column_stack([i[ok], j[ok]]))
    p = np.concatenate(found)
    if not len(p):
        return counts, p
    # a pair belongs to its smallest common filter: drop those that share one below this
    flat = np.concatenate(filters)
    owner = np.repeat(np.arange(n), [len(f) for f in filters])
    small = flat < here
    keep = np.ones(len(p), bool)
    if small.any():
        cols, at = np.unique(flat[small], return_inverse=True)
        for lo in range(0, len(cols), 4096):
            part = (at >= lo) & (at < lo + 4096)
            has = np.zeros((n, min(4096, len(cols) - lo)), np.float32)
            has[owner[small][part], at[part] - lo] = 1
            if len(p) < n:
                keep &= ~((has[p[:, 0]] * has[p[:, 1]]).any(axis=1))
            else:
                for r in range(0, n, 512):
                    mine = (p[:, 0] >= r) & (p[:, 0] < r + 512)
                    keep[mine] &= (has[r : r + 512] @ has.T)[p[mine, 0] - r, p[mine, 1]] == 0
    own = p[keep]
    np.add.at(counts, own[:, 0], weight[own[:, 1]])
    np.add.at(counts, own[:, 1], weight[own[:, 0]])
    label = np.arange(n)  # smallest node reached, by rounds over the links: a star per component is enough
    while True:
        low = np.minimum(label[p[:, 0]], label[p[:, 1]])
        nxt = label.copy()
        np.minimum.at(nxt, p[:, 0], low)
        np.minimum.at(nxt, p[:, 1], low)
        nxt = nxt[nxt]
        if (nxt == label).all():
            break
        label = nxt
    far = np.flatnonzero(label != np.arange(n))
    return counts, np.column_stack([far, label[far]])


def _links(cosine: float):
    names = ["rep", "other", "n"]

    def group(rows: dict, lo: int, hi: int):
        x = rows["x"][lo:hi]
        f = rows["filters"][lo:hi]
        rep = rows["rep"][lo:hi]
        counts, edges = _compare(rep, rows["m"][lo:hi], np.stack(x), f, rows["filter"][lo], rows["side"][lo:hi], rows["own"][lo], cosine)
        hit = np.flatnonzero(counts)
        return rep[hit], counts[hit], rep[edges[:, 0]], rep[edges[:, 1]]

    def emit(parts):
        if parts:
            r, c, a, b = (np.concatenate([p[i] for p in parts]) for i in range(4))
            ids, at = np.unique(r, return_inverse=True)
            n = np.bincount(at, c, len(ids)).astype(np.int64) if len(ids) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([ids, a])), pa.array([None] * len(ids) + b.tolist(), pa.int64()), pa.array(np.concatenate([n, np.zeros(len(a), np.int64)]))], names=names
            )

    def run(batches):
        held = None
        for batch in batches:
            vec, filters = batch.column("vec"), batch.column("filters")
            flat, offs = vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64), vec.offsets.to_numpy() - vec.offsets[0].as_py()
            x = []
            for a, b in zip(offs[:-1], offs[1:], strict=True):
                v = flat[a:b]
                v = v / np.abs(v).max()
                x.append(v / np.sqrt(np.dot(v, v)))
            ff, fo = filters.flatten().to_numpy(), filters.offsets.to_numpy() - filters.offsets[0].as_py()
            rows = {k: batch.column(k).to_numpy() for k in ("key", "rep", "m", "filter", "side", "own")}
            rows |= {"x": x, "filters": [ff[a:b] for a, b in zip(fo[:-1], fo[1:], strict=True)]}
            if held:
                rows = {k: np.concatenate([held[k], v]) if isinstance(v, np.ndarray) else held[k] + v for k, v in rows.items()}
            cuts = np.flatnonzero(np.diff(rows["key"])) + 1
            cuts = np.concatenate([[0], cuts])
            yield from emit([group(rows, int(a), int(b)) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b - a > 1])
            held = {k: v[cuts[-1] :] for k, v in rows.items()}
        if held and len(held["rep"]) > 1:
            yield from emit([group(held, 0, len(held["rep"]))])

    return run


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, seed: int = 11, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of ``vectors(vec_id, label, embedding)``."""
    e = F.col("embedding")
    fine = F.col("label").isNotNull() & e.isNotNull() & F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(e, lambda v: v != 0)
    work = Scratch()
    v = vectors.select("vec_id", "label", "embedding", F.coalesce(fine, F.lit(False)).alias("ok"))
    v = v.withColumn("h1", F.xxhash64("label", "embedding")).withColumn("h2", F.xxhash64("embedding", F.lit(31), "label"))
    classes = v.where("ok").groupBy("label", "h1", "h2").agg(F.min("vec_id").alias("first"), F.count("*").alias("m"), F.first("embedding").alias("vec"))
    # classes have numbers of their own, since ids may repeat; written, so that a number stays with its class
    classes = work.cut(classes, "classes").withColumn("rep", F.monotonically_increasing_id())
    classes = work.cut(classes, "numbered")
    reps = classes.select("rep", "m", "label", "vec")
    n = reps.count()
    q = max(8, int(np.ceil((32 * max(1, n)) ** 0.25)))
    lists = work.cut(reps.select("rep", "vec").mapInArrow(_decode_batches(q, seed), "rep long, filters array<bigint>"), "filters")
    full = reps.join(lists, "rep")
    cells = full.select("rep", "label", F.size("vec").alias("dim"), F.explode("filters").alias("filter"))
    sizes = cells.groupBy("label", "dim", "filter").agg(F.count("*").alias("c")).where("c > 1")
    shared = work.cut(cells.join(sizes, ["label", "dim", "filter"]).select("rep", "label", "dim", "filter", F.ceil(F.col("c") / block).alias("blocks")), "shared")
    mine = F.pmod(F.xxhash64("rep", "filter"), F.col("blocks"))
    # a block meets itself and each later block: (i, j) with i <= j, one group each
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    dealt = shared.select("*", mine.alias("mine")).select("rep", "label", "dim", "filter", "mine", other)
    key = F.xxhash64("label", "dim", "filter", F.least("mine", "other"), F.greatest("mine", "other"))
    dealt = dealt.select("rep", "filter", key.alias("key"), (F.col("mine") > F.col("other")).cast("long").alias("side"), (F.col("mine") == F.col("other")).alias("own"))
    ready = dealt.join(full.select("rep", "m", "vec", "filters"), "rep").select("key", "rep", "m", "filter", "side", F.col("own").cast("long").alias("own"), "vec", "filters")
    found = work.cut(ready.repartition("key").sortWithinPartitions("key").mapInArrow(_links(cosine), "rep long, other long, n long"), "links")
    counts = found.where("other is null").groupBy("rep").agg(F.sum("n").alias("n"))
    comp = work.cut(components(found.where("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b"))), "comp")
    named = classes.join(counts, "rep", "left").join(comp, F.col("rep") == F.col("node"), "left")
    named = work.cut(named.select("label", "h1", "h2", "first", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("links"), F.coalesce("root", "rep").alias("root")), "named")
    smallest = named.groupBy(F.col("root").alias("r")).agg(F.min("first").alias("component"))
    named = named.join(smallest, F.col("root") == F.col("r")).drop("root", "r", "first")
    out = v.select("vec_id", "ok", "label", "h1", "h2").join(named, ["label", "h1", "h2"], "left")
    component = F.when(F.col("ok"), F.col("component")).otherwise(F.col("vec_id"))
    out = out.select("vec_id", F.when(F.col("ok"), F.col("links")).otherwise(0).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
    out = cut(out, "vectors")
    work.clear()
    return out


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


#: All pairs of a label, then everything that links reach.
OP8_SQL = f"""
WITH RECURSIVE v AS (SELECT row_number() OVER () AS rid, vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
p AS (SELECT a.rid AS a, b.rid AS b FROM ok a JOIN ok b ON a.label = b.label AND len(a.e) = len(b.e) AND a.rid < b.rid AND list_cosine_similarity(a.e, b.e) >= {COSINE}),
u AS (SELECT a, b FROM p UNION SELECT b, a FROM p),
r AS (SELECT rid AS a, rid AS b FROM v UNION SELECT r.a, u.b FROM r JOIN u ON r.b = u.a),
c AS (SELECT r.a AS rid, min(v.vec_id) AS component_id FROM r JOIN v ON v.rid = r.b GROUP BY r.a),
n AS (SELECT a AS rid, count(*) AS n FROM u GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN c USING (rid) LEFT JOIN n USING (rid)
"""
