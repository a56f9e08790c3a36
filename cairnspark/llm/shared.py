"""Lineage cuts in the cluster's shared folder, and connected components."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; in local mode, where all is one machine, the warehouse if that is unset."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = f"{spark.conf.get('spark.sql.warehouse.dir')}/cairnspark"
    return at.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: no lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cairn_path = path
    return out


def drop(df: DataFrame) -> None:
    """Delete a table that ``cut`` wrote and nothing reads any more."""
    path = getattr(df, "_cairn_path", None)
    if path:
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


class Scratch:
    """Tables that one operator cuts; ``clear`` deletes them once its result is written."""

    def __init__(self) -> None:
        self.held: list[DataFrame] = []

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        self.held.append(cut(df, name))
        return self.held[-1]

    def clear(self) -> None:
        while self.held:
            drop(self.held.pop())


BROADCAST_BYTES = 32 << 20


def within(df: DataFrame, column: str, limit: int) -> bool:
    """Whether the strings of ``column``, 16 bytes more for each row, take at most ``limit`` bytes."""
    return (df.agg(F.sum(F.octet_length(column).cast("long") + 16).alias("b")).first().b or 0) <= limit


def constant_set(keys: DataFrame) -> Callable[[Column], Column]:
    """Membership in the strings ``key`` of a table of checked size, as an expression.

    The strings are dealt to as many hash buckets as there are strings, and
    the buckets are a constant of the plan, so a test reads one short bucket
    wherever it stands, in a lambda too, and no row carries the table.
    """
    n = max(1, keys.count())
    at = F.pmod(F.xxhash64("key"), F.lit(n)).cast("int")
    buckets: list[list[str]] = [[] for _ in range(n)]
    for r in keys.select(at.alias("at"), "key").toLocalIterator():
        buckets[r["at"]].append(r["key"])
    table = F.from_json(F.lit(json.dumps(buckets)), "array<array<string>>")
    # the lambda makes x once
    return lambda x: F.exists(F.array(x), lambda k: F.array_contains(F.get(table, F.pmod(F.xxhash64(k), F.lit(n)).cast("int")), k))


def without(docs: DataFrame, ids: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` without the rows whose doc_id is in ``ids``; those are broadcast up to ``broadcast_bytes`` of them, else joined by a shuffle."""
    gone = cut(ids.select(F.col("doc_id").alias("_cairn_id")).distinct(), "gone")
    few = gone.count() * 16 <= broadcast_bytes
    return docs.join(F.broadcast(gone) if few else gone, docs["doc_id"] == F.col("_cairn_id"), "left_anti")


def _union_find(batches):
    """Contract the edges of one partition to a forest: (node, smallest node reachable here)."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ra, rb = find(a), find(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
    out = [(x, r) for x in list(parent) if (r := find(x)) != x]
    if out:
        a = np.array(out, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], names=["u", "v"])


LOCAL_EDGES = 1 << 17


def components(edges: DataFrame, name: str = "components", max_rounds: int = 60, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """Connected components of undirected ``edges(a long, b long)``: (node, root), root the smallest node.

    Union-find contracts each partition's edges first.  What that leaves is
    finished by one more union-find in one task if it is ``local_edges`` edges
    of 16 bytes at most, counted; beyond that, large-star and small-star rounds
    (minimum by aggregation, then a join, so no node's neighbours are gathered
    in one task) finish across partitions.  A round is about seven shuffles,
    whose plans and threads the driver holds.  Each round is cut into the
    shared folder.  Both give the same rows.  A component's smallest node and
    nodes without edges are absent.
    """
    pairs = edges.select(F.col("a").cast("long").alias("u"), F.col("b").cast("long").alias("v")).where("u != v")
    e = cut(pairs.mapInArrow(_union_find, "u long, v long"), name)
    seen = None
    for _ in range(max_rounds):
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if now.n <= local_edges:
            return e.coalesce(1).mapInArrow(_union_find, "u long, v long").toDF("node", "root")
        if seen == (now.n, now.s) or not now.n:
            break
        seen = (now.n, now.s)
        both = e.union(e.select("v", "u").toDF("u", "v"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low2, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").union(low2.select("u", F.col("m").alias("v"))).distinct()
        )
        nxt = cut(small.select("u", "v"), name)
        drop(e)
        e = nxt
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    # the one table of edges that is left is the result
    return e.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
