"""Mixing sources to target weights by cube-method balanced sampling.

Each source gets a target number of words by its weight; a document's
inclusion is target / source size, its whole part taken as sure repeats and
its fraction rounded by the cube method: a flight through the null space of
the balancing constraints (words and documents of the source) fixes one unit
at a time while both totals hold, block by block, then over what the blocks
left, until a landing problem of two units per source remains.  First each of
a block's largest units is carried to a bound, the others sharing what
balances it (of a source of many blocks, before they are dealt, against all
its documents); then units come in by falling size, three at a time.  So what is
left to land is small documents, and the source's words stay near the target.
Every step is as likely up as down by its lengths, so each document keeps its
inclusion probability; landing keeps it too (the words hold while two units
are left, then the last one is tossed for).  One case is set aside before: a
document of more words than its source's fractions stand for in all can't be
taken near the target, so the others take over its fraction if they can.

Edge cases: a null or empty text has size 0 and is never sampled by words
(its fraction is still balanced by count); a null source is a source of its
own, last in order; a source of size 0 has target 0 and takes nothing;
repeated ids are rows of their own, told apart by text, and equal rows are
interchangeable; an empty table gives an empty result; extra columns are
ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairnspark.llm.shared import Scratch, cut

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3
BLOCK_ROWS = 4096
LARGE_UNITS = 48


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def targets(totals: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, cap: float = MAX_REPEATS) -> DataFrame:
    """Target words of each source of ``totals(source, source_size)``.

    Weights repeat over the sources in code point order, null last.  With
    level t, a source gets min(cap * size, t * weight); the level is where the
    targets sum to ``share`` of all words.  Sources sorted by size / weight
    fill up in that order, so the level comes from running sums (one row per
    source, by window functions): no loop on the driver.
    """
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    k = F.row_number().over(order) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (k % len(weights) + 1).cast("int"))
    t = totals.withColumn("w", w).withColumn("full", F.col("source_size") * F.lit(float(cap)))
    rank = Window.orderBy(F.col("full") / F.col("w"), F.col("source").isNull(), F.encode("source", "UTF-8"))
    before = rank.rowsBetween(Window.unboundedPreceding, -1)
    after = rank.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    t = t.withColumn("goal", F.sum("source_size").over(whole) * F.lit(float(share)))
    t = t.withColumn("level", (F.col("goal") - F.coalesce(F.sum("full").over(before), F.lit(0.0))) / F.sum("w").over(after))
    # the first source in this order that the level doesn't fill sets the level of all that follow
    t = t.withColumn("open", F.min(F.when(F.col("level") * F.col("w") < F.col("full"), F.struct(F.col("full") / F.col("w"), F.col("level")))).over(whole))
    level = F.col("open.level")
    return t.select(
        "source",
        "source_size",
        F.when(level.isNull(), F.col("full")).otherwise(F.least("full", level * F.col("w"))).cast("double").alias("target"),
    )


def _span(pi: np.ndarray, u: np.ndarray) -> tuple[float, float]:
    """How far ``pi`` can go along ``u`` and against it before a unit is at 0 or 1."""
    with np.errstate(divide="ignore", invalid="ignore"):
        up = np.where(u > 1e-15, (1 - pi) / u, np.where(u < -1e-15, -pi / u, np.inf))
        down = np.where(u > 1e-15, pi / u, np.where(u < -1e-15, -(1 - pi) / u, np.inf))
    return float(up.min()), float(down.min())


def carry(pi: np.ndarray, x: np.ndarray, rng: np.random.Generator, units: np.ndarray | None = None, both: bool = True) -> np.ndarray:
    """First part of the flight: each of ``units``, the largest ones unless given, is carried to 0 or 1 in turn.

    All other units in play share what balances it, each by its room to the
    nearer bound, so that they come to their bounds late and together.  Both
    totals hold as long as that moves the unit on; where the number of
    documents stands in the way (a document of very many words takes the place
    of many), only the words do.  A step goes to the bound on one side or the
    other, with the probabilities that keep the expectation.
    """
    eps = 1e-9
    pi = pi.astype(float).copy()
    live = (pi > eps) & (pi < 1 - eps)
    if units is None:
        units = np.flatnonzero(live)[np.argsort(-x[live], kind="stable")][:LARGE_UNITS]
    for j in units:
        steps = 0 if both else 4
        while live[j]:
            at = np.flatnonzero(live)
            if len(at) < 2 + both:
                return pi
            p, me = pi[at], at == j
            room = np.where(me, 0.0, np.minimum(p, 1 - p))
            columns = [x[at] / max(1.0, x[at].max()), np.ones(len(at))][: 2 if steps < 4 else 1]
            a = np.column_stack(columns)
            goal = a[me][0]
            try:
                u = -room * (a @ np.linalg.solve(a.T @ (a * room[:, None]), goal)) if len(columns) == 2 else -room * goal[0] / (room @ a[:, 0])
            except np.linalg.LinAlgError:
                u = np.full(len(at), np.nan)
            u[me] = 1.0
            if not np.isfinite(u).all() or np.abs(a.T @ u).max() > 1e-7:
                if len(columns) == 1:
                    break
                steps = 4
                continue
            up, down = _span(p, u)
            pi[at] += u * (up if rng.random() * (up + down) < down else -down)
            pi[pi < eps], pi[pi > 1 - eps] = 0.0, 1.0
            live = (pi > 0) & (pi < 1)
            steps += 1
    return pi


def flight(pi: np.ndarray, x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Flight for two constraints: units are visited in order, three at a time stay in play.

    Each step moves the three along the null vector of their constraint
    matrix to the bound on one side or the other, with the probabilities that
    keep the expectation; at least one becomes 0 or 1 and the next unit comes
    in.  Returns pi with at most two entries strictly between 0 and 1.
    """
    eps = 1e-9
    pi = pi.astype(float).tolist()
    a = np.column_stack([x, np.ones(len(x))]).tolist()
    todo = [i for i, p in enumerate(pi) if eps < p < 1 - eps]
    toss = rng.random(len(todo) + 3).tolist()
    play: list[int] = []
    at = step = 0
    while True:
        while len(play) < 3 and at < len(todo):
            play.append(todo[at])
            at += 1
        if len(play) < 3:
            break
        i, j, k = play
        (a1, a2), (b1, b2), (c1, c2) = a[i], a[j], a[k]
        u = (b1 * c2 - b2 * c1, c1 * a2 - c2 * a1, a1 * b2 - a2 * b1)
        if max(map(abs, u)) < 1e-12:  # equal sizes: exchange two of them
            u = (1.0, -1.0, 0.0)
        up = down = float("inf")
        for i_, v in zip(play, u, strict=True):
            p = pi[i_]
            if v > 0:
                up, down = min(up, (1 - p) / v), min(down, p / v)
            elif v < 0:
                up, down = min(up, -p / v), min(down, -(1 - p) / v)
        by = up if toss[step % len(toss)] * (up + down) < down else -down
        step += 1
        if step == len(toss):
            toss, step = rng.random(len(toss)).tolist(), 0
        stay = []
        for i_, v in zip(play, u, strict=True):
            p = pi[i_] + by * v
            pi[i_] = 0.0 if p < eps else 1.0 if p > 1 - eps else p
            if 0.0 < pi[i_] < 1.0:
                stay.append(i_)
        play = stay
    return np.array(pi)


def landing(pi: np.ndarray, x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Round what the flight left, two units at most: their words hold until one is settled, then the other is tossed for."""
    out = pi.copy()
    free = np.flatnonzero((out > 0) & (out < 1))
    if len(free) == 2:
        i, j = free
        u = np.array([x[j], -x[i]]) / max(x[i], x[j]) if x[i] or x[j] else np.array([1.0, -1.0])
        up, down = _span(out[free], u)
        out[free] += u * (up if rng.random() * (up + down) < down else -down)
        out[free] = np.where(out[free] < 1e-9, 0.0, np.where(out[free] > 1 - 1e-9, 1.0, out[free]))
    for i in np.flatnonzero((out > 0) & (out < 1)):
        out[i] = float(rng.random() < out[i])
    return out


def _fly(last: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "doc_id", "row"], ascending=False, kind="stable", na_position="last").reset_index(drop=True)
        rng = np.random.default_rng([int(pdf["seed"].iloc[0]) & 0x7FFFFFFF, len(pdf)])
        x, pi = pdf["size"].to_numpy(dtype=float), pdf["pi"].to_numpy(dtype=float)
        out = flight(carry(pi, x, rng), x, rng)
        return pdf.assign(pi=landing(out, x, rng) if last else out)

    return run


def _settle(pdf: pd.DataFrame) -> pd.DataFrame:
    """The largest documents of a source to 0 or 1, one by one; those left and all others, whose fraction is one number, share what balances the words."""
    pdf = pdf.sort_values("rank")
    rng = np.random.default_rng(int(pdf["seed"].iloc[0]) & 0x7FFFFFFF)
    x, pi = pdf["size"].to_numpy(dtype=float), pdf["pi"].to_numpy(dtype=float)
    others = max(0.0, float(pdf["words"].iloc[0]) - x.sum())
    out = carry(np.append(pi, pi[0]), np.append(x, others), rng, np.arange(len(x)), both=False)
    return pdf.assign(settled=out[:-1], rest=out[-1])[["uid", "source", "settled", "rest"]]


def mix_sources(
    spark: SparkSession,
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = 1.0,
    cap: float = MAX_REPEATS,
    block_rows: int = BLOCK_ROWS,
    seed: int = 17,
) -> DataFrame:
    """(doc_id, source, row, size, source_size, target, copies): one row per document, ``copies`` in 0 .. cap, ``row`` a hash of id and text.

    A source's documents are dealt to blocks of about ``block_rows`` by a hash
    of the id, so a source with a third of all rows is many tasks; what the
    blocks leave open (two units each) meets in blocks again until each source
    has one.  Only ids and sizes are shuffled; texts stay with their row if
    the caller joins back on ``doc_id``.
    """
    work = Scratch()
    d = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("doc_id", "text").alias("row"))
    d = work.cut(d.withColumn("uid", F.monotonically_increasing_id()), "sizes")  # words are counted once, and a row keeps its number
    totals = d.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    goal = targets(totals.select("source", "source_size"), weights, share, cap)
    stats = goal.join(totals.select(F.col("source").alias("s2"), "n"), F.col("source").eqNullSafe(F.col("s2"))).select(
        F.col("source").alias("s"), "source_size", "target", F.greatest(F.lit(1), F.ceil(F.col("n") / block_rows)).alias("blocks")
    )
    stats = stats.withColumn("want", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
    stats = stats.withColumn("sure", F.floor(F.col("want") + F.lit(1e-9))).withColumn("pi", F.greatest(F.lit(0.0), F.col("want") - F.col("sure")))
    part = F.col("pi") * F.col("source_size")  # words that the fractions stand for
    known = d.join(stats, F.col("source").eqNullSafe(F.col("s"))).withColumn("over", F.col("size") > part)
    over = known.groupBy("source").agg(F.sum(F.when(F.col("over"), F.col("size")).otherwise(0)).alias("big")).select(F.col("source").alias("s3"), "big")
    others = part / (F.col("source_size") - F.col("big"))
    pi = F.when((F.col("big") > 0) & (F.col("big") < F.col("source_size")) & (others <= 1), F.when(F.col("over"), 0.0).otherwise(others)).otherwise(F.col("pi"))
    key = F.xxhash64(F.lit(seed), "doc_id", "size", "row")
    known = known.join(over, F.col("source").eqNullSafe(F.col("s3"))).withColumn("pi", pi)
    open_ = (F.col("pi") > 0) & (F.col("pi") < 1)
    # the largest documents of a source of many blocks are settled against all others of the source
    rank = Window.partitionBy("source").orderBy(F.col("size").desc(), "doc_id", "row", "uid")
    top = known.where(open_ & (F.col("blocks") > 1) & (F.col("size") * 100 * F.col("blocks") > F.col("source_size"))).withColumn("rank", F.row_number().over(rank))
    top = top.where(F.col("rank") <= LARGE_UNITS).select("uid", "source", "size", "rank", "pi", (F.col("source_size") - F.when(F.col("pi") == F.col("want") - F.col("sure"), 0).otherwise(F.col("big"))).alias("words"), F.xxhash64(F.lit(seed + 1), "source").alias("seed"))
    settled = work.cut(top.groupBy("source").applyInPandas(_settle, "uid long, source string, settled double, rest double"), "settled")
    rest = settled.groupBy(F.col("source").alias("s4")).agg(F.first("rest").alias("rest"))
    known = known.join(settled.select(F.col("uid").alias("u2"), "settled"), F.col("uid") == F.col("u2"), "left").join(rest, F.col("source").eqNullSafe(F.col("s4")), "left")
    full = (
        known.withColumn("pi", F.when(open_, F.coalesce("settled", "rest", "pi")).otherwise(F.col("pi")))
        .withColumn("block", F.pmod(key, F.col("blocks")))
        .withColumn("seed", F.xxhash64(F.lit(seed), "source", "block"))
        .select("doc_id", "source", "size", "row", "source_size", "target", "sure", "pi", "blocks", "block", "seed")
    )
    schema = full.schema
    out, is_open = None, (F.col("pi") > 0) & (F.col("pi") < 1)
    done = full.groupBy("source", "block", "blocks").applyInPandas(_fly(False), schema)
    level = work.cut(done, "mix")
    while True:
        out = level.where(~is_open) if out is None else out.unionByName(level.where(~is_open))
        left = level.where(is_open)
        top = left.agg(F.max("blocks").alias("b")).first().b
        if top is None:
            break
        last = top <= block_rows
        left = left.withColumn("blocks", F.when(F.lit(last), F.lit(1)).otherwise(F.ceil(F.col("blocks") / block_rows)))
        left = left.withColumn("block", F.pmod(F.col("block"), F.col("blocks"))).withColumn("seed", F.xxhash64(F.lit(seed), "source", "block", "blocks"))
        level = work.cut(left.select(*schema.names).groupBy("source", "block").applyInPandas(_fly(last), schema), "mix")
    out = out.select("doc_id", "source", "row", "size", "source_size", "target", (F.col("sure") + F.col("pi")).cast("long").alias("copies"))
    out = cut(out, "mixed")
    work.clear()
    return out


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    m = mix_sources(spark, docs)
    return m.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")
