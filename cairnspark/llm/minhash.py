"""MinHash near-dedup: SuperMinHash signatures, banding, verification, union-find grouping.

Each shingle ranks the signature's slots by a permutation of its own; round j
offers slot p_j the value j + r_j, and a document is done as soon as all its
slots hold values below the next round's (early stopping), so long documents
need one or two rounds.  Documents whose bands agree are candidates; links
are confirmed on full shingle sets and grouped.

Equal sets are one class from the start (grouped by a 128-bit fingerprint),
so copies are never paired.  Each class is first compared with the smallest
ids of its band buckets.  Classes at least half similar to those form
clusters; where links have not joined a whole cluster, all its pairs are
compared inside tasks, in blocks of bounded rows and shingles, which emit
spanning edges and no pairs.
Buckets that clusters share are compared as well: those of up to ``few``
classes by pairs, unless the triangle inequality rules a pair out, larger ones
inside tasks, in blocks, like clusters.  No cap on buckets or partners.

Edge cases: a null or empty text, or one without words, has no shingles and
links with nothing; fewer words than a shingle count as one whole sequence;
repeated ids are rows of their own, one class only if their sets are equal;
ties go to the smallest id, and a null id is never the smallest; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairnspark.llm.shared import Scratch, components, cut
from cairnspark.llm.textnum import GOLDEN, as_bytes, blocks, mix, rows, shingle_sets

SLOTS, BANDS = 160, 32
SHINGLE, SIMILAR = 5, 80
GROUP = 1 << 16
BLOCK, BLOCK_SHINGLES = 1000, 2_000_000
FEW = 32
_U = np.uint64


def superminhash(sets: list[np.ndarray], slots: int = SLOTS, seed: int = 1) -> np.ndarray:
    """Signatures [sets, slots] of arrays of distinct 64-bit hashes; those of empty sets are infinite."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    sig = np.full((len(sets), slots), np.inf)
    lo = 0
    while lo < len(sets):
        hi = max(lo + 1, int(np.searchsorted(np.cumsum(sizes[lo:]), GROUP, side="right")) + lo)
        _rounds(sets[lo:hi], sizes[lo:hi], sig[lo:hi], slots, seed)
        lo = hi
    return sig


def _rounds(sets, sizes, sig, slots, seed):
    if not sizes.sum():
        return
    element = np.concatenate(sets)
    doc = np.repeat(np.arange(len(sets)), sizes)
    flat = sig.reshape(-1)
    rank = None
    with np.errstate(over="ignore"):
        for j in range(slots):
            h = mix(element + _U(2 * j + 1 + 1024 * seed) * GOLDEN)
            k = j + (((h >> _U(40)) * _U(slots - j)) >> _U(24)).astype(np.int64)
            r = (h & _U((1 << 40) - 1)).astype(np.float64) / (1 << 40)
            if rank is None:
                p = k
            else:
                e = np.arange(len(element))
                p = rank[e, k].astype(np.int64)
                rank[e, k] = rank[:, j]
            np.minimum.at(flat, doc * slots + p, r + j)
            if j + 1 == slots:
                return
            left = np.ones(len(sizes), bool)
            left[sizes == 0] = False
            left[sizes > 0] = sig[sizes > 0].max(axis=1) >= j + 1
            if not left.any():
                return
            keep = left[doc]
            if rank is None:
                k = k[keep]
                rank = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint16), (int(keep.sum()), 1))
                rank[np.arange(len(k)), k] = 0
                element, doc = element[keep], doc[keep]
            elif not keep.all() and keep.mean() < 0.9:
                element, doc, rank = element[keep], doc[keep], rank[keep]


def _sign(k: int, slots: int, bands: int, seed: int):
    per = slots // bands

    def run(batches):
        for batch in batches:
            for lo, hi, data, offs in rows(batch, "text"):
                sets = shingle_sets(data, offs, k)
                n = np.array([len(s) for s in sets], dtype=np.int64)
                f1, f2 = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
                with np.errstate(over="ignore"):
                    for i, s in enumerate(sets):
                        if len(s):
                            m = mix(s + _U(0x5851F42D4C957F2D))
                            f1[i], f2[i] = m.sum(), np.bitwise_xor.reduce(mix(m * GOLDEN)) + _U(len(s))
                    sig = superminhash(sets, slots, seed).view(np.uint64)
                    key = np.empty((len(sets), bands), np.uint64)
                    for b in range(bands):
                        v = np.full(len(sets), b + 1, np.uint64)
                        for c in range(b * per, b * per + per):
                            v = mix(v * GOLDEN + sig[:, c])
                        key[:, b] = v
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "id", "tag")],
                        pa.array(n),
                        pa.array(f1.view(np.int64)),
                        pa.array(f2.view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * bands), pa.array(key.reshape(-1).view(np.int64))),
                    ],
                    names=["doc_id", "id", "tag", "n_shingles", "f1", "f2", "bands"],
                )

    return run


def _similarity(k: int):
    """(a, b, both, either): sizes of intersection and union of the full shingle sets of each pair."""

    def run(batches):
        for batch in batches:
            a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            distinct, at = np.unique(np.concatenate([a, b]), return_index=True)
            data, offs = as_bytes(pa.concat_arrays([batch.column("ta"), batch.column("tb")]).take(pa.array(at)))
            sets: list[np.ndarray] = []
            for lo, hi in blocks(offs):
                sets += shingle_sets(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo], k)
            both, either = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
            for i, (x, y) in enumerate(zip(np.searchsorted(distinct, a), np.searchsorted(distinct, b), strict=True)):
                merged = np.concatenate([sets[x], sets[y]])
                merged.sort()
                both[i] = np.count_nonzero(merged[1:] == merged[:-1])
                either[i] = len(merged) - both[i]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(both), pa.array(either)], names=["a", "b", "both", "either"])

    return run


def linked_within(sets: list[np.ndarray], similar: int) -> np.ndarray:
    """For each set, the smallest index reachable by links among ``sets``; all pairs are compared.

    With p the elements of most sets, the intersection of x and y is
    |p| - |p - x| - |p - y| + |(x ^ p) & (y ^ p)|, and the symmetric differences
    are short for copies of one text, so only they are counted pairwise.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    values, at = np.unique(flat, return_inverse=True)
    owner = np.repeat(np.arange(n), sizes)
    center = np.bincount(at, minlength=len(values)) * 2 > n
    lost = int(center.sum()) - np.bincount(owner[center[at]], minlength=n)
    # symmetric differences: elements outside the center, and center elements that a set lacks
    has = np.zeros((n, int(center.sum())), bool)
    rank = np.cumsum(center) - 1
    inside = center[at]
    has[owner[inside], rank[at[inside]]] = True
    row, col = np.nonzero(~has)
    who = np.concatenate([owner[~inside], row])
    what = np.concatenate([at[~inside], col + len(values)])
    order = np.argsort(what, kind="stable")
    who, what = who[order], what[order]
    cut_ = np.flatnonzero(np.concatenate([[True], what[1:] != what[:-1], [True]]))
    shared = np.zeros((n, n), np.int32)
    for lo, hi in zip(cut_[:-1][np.diff(cut_) > 1], cut_[1:][np.diff(cut_) > 1], strict=True):
        rows_ = who[lo:hi]
        shared[rows_[:, None], rows_] += 1
    both = shared
    both += np.int32(center.sum())
    both -= lost[:, None].astype(np.int32)
    both -= lost[None, :].astype(np.int32)
    link = (100 + similar) * both >= similar * (sizes[:, None] + sizes[None, :]).astype(np.int32)
    link &= (sizes > 0)[:, None] & (sizes > 0)[None, :]
    label = np.arange(n)
    while True:
        low = np.where(link, label[None, :], n).min(axis=1)
        nxt = np.minimum(label, low)
        nxt = nxt[nxt]
        if (nxt == label).all():
            return label
        label = nxt


def _link_groups(k: int, similar: int):
    def solve(ids, texts):
        data, offs = as_bytes(texts)
        sets: list[np.ndarray] = []
        for lo, hi in blocks(offs):
            sets += shingle_sets(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo], k)
        label = linked_within(sets, similar)
        far = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays([pa.array(ids[far]), pa.array(ids[label[far]])], names=["a", "b"])

    def run(batches):
        held: list = []
        last = None
        for batch in batches:
            key = batch.column("key").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if held and key[lo] != last:
                    yield solve(np.concatenate([h[0] for h in held]), pa.concat_arrays([h[1] for h in held]))
                    held = []
                last = key[lo]
                held.append((batch.column("rep").to_numpy()[lo:hi], batch.column("text").slice(lo, hi - lo)))
        if held:
            yield solve(np.concatenate([h[0] for h in held]), pa.concat_arrays([h[1] for h in held]))

    return run


def near_duplicates(docs: DataFrame, k: int = SHINGLE, similar: int = SIMILAR, slots: int = SLOTS, bands: int = BANDS, seed: int = 1, block: int = BLOCK, few: int = FEW) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of ``docs(doc_id, text)``.

    Links are pairs with 100 * intersection >= ``similar`` * union of their
    ``k``-word shingle sets.  With 32 bands of 5 a pair at 0.8 is missed with
    probability 3e-6, less above.
    """
    work = Scratch()
    # a row's key is its id and a hash of its text, since ids may repeat; classes have numbers of their own
    texts = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), F.xxhash64("text").alias("tag"), "text")
    sig = work.cut(texts.mapInArrow(_sign(k, slots, bands, seed), "doc_id long, id long, tag long, n_shingles long, f1 long, f2 long, bands array<bigint>"), "sig")
    firsts = [F.first(c).alias(c) for c in ("id", "tag", "n_shingles", "bands")]
    classes = work.cut(sig.where("n_shingles > 0").groupBy("f1", "f2").agg(F.min("doc_id").alias("smallest"), *firsts), "classes")
    classes = work.cut(classes.withColumn("rep", F.monotonically_increasing_id()), "numbered")
    reps = classes.select("rep", F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    shared = reps.groupBy("key").agg(F.min("rep").alias("lead"), F.max("rep").alias("top")).where("lead < top").select("key", "lead")
    buckets = work.cut(reps.join(shared, "key").distinct(), "buckets")
    wanted = classes.select("rep", "id", "tag").join(buckets.select("rep").distinct(), "rep")
    cand = work.cut(texts.select("id", "tag", "text").join(wanted, ["id", "tag"]).groupBy(F.col("rep").alias("doc_id")).agg(F.first("text").alias("text")), "cand")

    def measured(p: DataFrame) -> DataFrame:
        with_a = p.join(cand.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a")
        both = with_a.join(cand.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b")
        return both.select("a", "b", "ta", "tb").mapInArrow(_similarity(k), "a long, b long, both long, either long")

    link = (F.col("either") > 0) & (100 * F.col("both") >= similar * F.col("either"))
    # 1. each class against the smallest ids of its buckets: the one it meets most often, and all it meets twice
    met = buckets.where("rep <> lead").groupBy(F.col("lead").alias("a"), F.col("rep").alias("b")).agg(F.count("*").alias("c"))
    best = Window.partitionBy("b").orderBy(F.col("c").desc(), "a")
    pairs = work.cut(met.withColumn("k", F.row_number().over(best)).where("k = 1 or c > 1").select("a", "b"), "pairs")
    sim = work.cut(measured(pairs), "sim")
    # 2. half-similar classes form clusters; in those that links have not joined, all pairs are compared, in blocks
    comp = work.cut(components(sim.where(link).select("a", "b")), "comp")
    cluster = work.cut(components(sim.where("either > 0 and 2 * both >= either").select("a", "b")).toDF("node", "cluster"), "cluster")
    at = cluster.join(comp, "node", "left").select("node", "cluster", F.coalesce("root", "node").alias("comp"))
    at = at.union(cluster.select(F.col("cluster").alias("node"), "cluster").distinct().join(comp, "node", "left").select("node", "cluster", F.coalesce("root", "node")))
    at = work.cut(at, "members")
    sized = at.join(classes.select(F.col("rep").alias("node"), F.col("n_shingles").alias("n")), "node")
    torn = sized.groupBy("cluster").agg(F.count("*").alias("size"), F.sum("n").alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")

    def inside(members: DataFrame, sizes: DataFrame) -> DataFrame:
        """Edges that span the links within each group of ``members(node, cluster)``, in blocks: each meets itself and each other one of its group."""
        dealt = members.join(sizes.select("cluster", F.ceil(F.greatest(F.col("size") / block, F.col("n") / BLOCK_SHINGLES)).alias("blocks")), "cluster")
        dealt = dealt.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks"))).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
        dealt = dealt.select(F.col("node").alias("rep"), F.xxhash64("cluster", F.least("mine", "other"), F.greatest("mine", "other")).alias("key"))
        groups = dealt.join(cand, F.col("doc_id") == F.col("rep")).select("key", "rep", "text").repartition("key").sortWithinPartitions("key")
        return groups.mapInArrow(_link_groups(k, similar), "a long, b long")

    inner = work.cut(inside(at.select("node", "cluster"), torn), "inner")
    # 3. pairs of a bucket across clusters; Jaccard distance is a metric, so the distances to the bucket's lead rule most out
    of = at.select(F.col("node").alias("rep"), "cluster")
    known = sim.select(F.col("a").alias("lead"), F.col("b").alias("rep"), (1 - F.col("both") / F.col("either")).alias("far"))
    spread = buckets.join(of, "rep", "left").withColumn("cluster", F.coalesce("cluster", "rep"))
    mixed = spread.groupBy("key").agg(F.min("cluster").alias("lo"), F.max("cluster").alias("hi")).where("lo <> hi").select("key")
    rest = spread.join(mixed, "key", "left_semi").join(known, ["lead", "rep"], "left").select("key", "rep", "n", "cluster", F.when(F.col("rep") == F.col("lead"), 0.0).otherwise(F.col("far")).alias("far"))
    rest = work.cut(rest, "rest")
    crowds = work.cut(rest.groupBy("key").agg(F.count("*").alias("size"), F.sum("n").alias("n")).where(F.col("size") > few).withColumnRenamed("key", "cluster"), "crowds")
    crowded = work.cut(inside(rest.select(F.col("rep").alias("node"), F.col("key").alias("cluster")), crowds), "crowded")
    x = rest.join(crowds.select(F.col("cluster").alias("key")), "key", "left_anti")
    y = x.toDF("key", "rep2", "n2", "cluster2", "far2")
    apart = x.join(y, "key").where("rep < rep2 and cluster <> cluster2").where(100 * F.least("n", "n2") >= similar * F.greatest("n", "n2"))
    apart = apart.where(F.coalesce(F.abs(F.col("far") - F.col("far2")) <= F.lit((100 - similar) / 100 + 1e-9), F.lit(True)))
    fresh = work.cut(apart.select(F.col("rep").alias("a"), F.col("rep2").alias("b")).distinct().join(pairs, ["a", "b"], "left_anti"), "fresh")
    outer = measured(fresh).where(link).select("a", "b")
    comp = work.cut(components(sim.where(link).select("a", "b").union(inner).union(crowded).union(outer)), "comp")
    named = work.cut(classes.join(comp, F.col("rep") == F.col("node"), "left").select("f1", "f2", "smallest", F.coalesce("root", "rep").alias("root")), "named")
    least = named.groupBy(F.col("root").alias("r")).agg(F.min("smallest").alias("component"))
    named = named.join(least, F.col("root") == F.col("r")).select("f1", "f2", "component")
    out = sig.select("doc_id", "n_shingles", "f1", "f2").join(named, ["f1", "f2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    out = cut(out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")), "groups")
    work.clear()
    return out


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), k=2)


#: All pairs of documents that share a shingle, then everything that links reach.
OP6_SQL = f"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT rid, doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM w),
e AS (SELECT rid, len(s) AS n, unnest(s) AS x FROM s),
p AS (SELECT a.rid AS a, b.rid AS b FROM e a JOIN e b ON a.x = b.x AND a.rid < b.rid AND 100 * least(a.n, b.n) >= {SIMILAR} * greatest(a.n, b.n)
  GROUP BY a.rid, b.rid, a.n, b.n HAVING 100 * count(*) >= {SIMILAR} * (a.n + b.n - count(*))),
u AS (SELECT a, b FROM p UNION SELECT b, a FROM p),
r AS (SELECT rid AS a, rid AS b FROM s UNION SELECT r.a, u.b FROM r JOIN u ON r.b = u.a),
c AS (SELECT r.a AS rid, min(s.doc_id) AS component_id FROM r JOIN s ON s.rid = r.b GROUP BY r.a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN c USING (rid)
"""
