"""Suffix-array dedup: bytes covered by a ``span``-byte string that starts more than once anywhere.

Every window of ``span`` bytes belongs to one anchor, the smallest of the
hashed ``gram``-byte substrings in it (leftmost on ties), so equal windows
have equal anchors at equal offsets.  The windows of one anchor occurrence are
a run, its bytes a piece of under 2 * span bytes.

1. Anchors are counted over the corpus; pieces of single anchors are done.
2. Equal pieces (128-bit hashes) are counted; all windows of a piece that
   occurs twice are repeated.
3. Pieces that share an anchor but are not equal (the borders of passages) get
   suffix arrays, a few anchors at a time: suffixes smaller than their
   successors are sorted directly, all others induced by bucket scans, then
   common prefixes of neighbours of at least ``span`` bytes mark windows.
   An anchor with more than ``most`` distinct pieces would gather unbounded
   text in a task.  Its pieces are split by longer anchors and take steps 2 and
   3 again, with grams that fall short of ``span`` by a quarter of what the
   last did.  Each round settles what is inside a passage and drops what is
   outside, so the few windows on its borders are all that reach the last, where
   a gram is a window and every piece of an anchor is equal.

Counts are partial aggregates and joins can be split, so a passage found in a
third of all documents makes no hot task.  Every size takes the same path:
scans read the texts, narrow rows are joined, and texts with pieces to sort or
spans to remove meet them in a shuffle on the row's key.  Blocks bound a
worker's memory inside a document too: a long text is read in segments that
overlap by a span.

Edge cases: a null text is empty (0 bytes); texts shorter than ``span`` lose
nothing; equal rows remove each other; repeated ids are rows of their own (a
row's key is its id and a hash of its text; equal rows have equal results); a
null id is a row as well; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnspark.llm.shared import Scratch, cut
from cairnspark.llm.textnum import GOLDEN, mix, rows

SPAN, GRAM = 200, 64
MOST = 512
BUFFER = 1 << 18
SEGMENT = 1 << 20

_U = np.uint64
_BASES = (_U(0x9E6C63D0876A9A35), _U(0xC2B2AE3D27D4EB4F))


def _inverse(odd: int) -> np.uint64:
    x = odd
    for _ in range(6):
        x = x * (2 - odd * x) % (1 << 64)
    return _U(x)


_INVERSES = tuple(_inverse(int(b)) for b in _BASES)
with np.errstate(over="ignore"):
    _VALUE = mix(np.arange(1, 257, dtype=np.uint64) * GOLDEN)
_POWERS: dict[tuple[int, bool], np.ndarray] = {}


def _powers(which: int, inverse: bool, n: int) -> np.ndarray:
    got = _POWERS.get((which, inverse))
    if got is None or len(got) < n:
        base = (_INVERSES if inverse else _BASES)[which]
        with np.errstate(over="ignore"):
            got = np.cumprod(np.concatenate([[_U(1)], np.full(n, base)]), dtype=np.uint64)
        if n <= 1 << 21:
            _POWERS[which, inverse] = got
    return got


class Rolling:
    """Polynomial hashes of substrings of a block, from running sums."""

    def __init__(self, data: np.ndarray, which: int):
        n = len(data)
        self.which, self.n = which, n
        with np.errstate(over="ignore"):
            self.sums = np.zeros(n + 1, np.uint64)
            np.cumsum(_VALUE[data] * _powers(which, False, n)[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[end] - self.sums[start]) * _powers(self.which, True, self.n)[start]


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each run of ``w`` values, by running minima of blocks from both ends."""
    n = len(x)
    if n < w:
        return x[:0]
    pad = -n % w
    y = np.concatenate([x, np.full(pad, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, w)
    left = np.minimum.accumulate(y, axis=1).reshape(-1)
    right = np.minimum.accumulate(y[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(right[: n - w + 1], left[w - 1 : n])


def pieces(data: np.ndarray, offs: np.ndarray, span: int = SPAN, gram: int = GRAM, full: bool = True):
    """(document, first window, windows, anchor hash, two piece hashes) of a block."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < span:
        return none, none, none, *(np.zeros(0, _U),) * 3
    r0 = Rolling(data, 0)
    at = np.arange(n - gram + 1)
    h = mix(r0.of(at, at + gram))
    bits = _U(max(1, int(n).bit_length()))
    low = (_U(1) << bits) - _U(1)
    key = sliding_min((h & ~low) | at.astype(_U), span - gram + 1)
    anchor = (key & low).astype(np.int64)
    valid = np.zeros(n + 1, np.int32)
    long = np.flatnonzero(np.diff(offs) >= span)
    if not len(long):
        return none, none, none, *(np.zeros(0, _U),) * 3
    valid[offs[long]] += 1
    np.add.at(valid, offs[long + 1] - span + 1, -1)
    ok = np.cumsum(valid)[: len(anchor)] > 0
    new = ok.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~ok[:-1]
    new[offs[long]] = True
    first = np.flatnonzero(new)
    stop = ok.copy()
    stop[:-1] &= (anchor[1:] != anchor[:-1]) | ~ok[1:]
    nxt = offs[long + 1] - span
    stop[nxt] = True
    last = np.flatnonzero(stop)
    doc = np.searchsorted(offs, first, side="right") - 1
    a = h[anchor[first]]
    if not full:
        return doc, first - offs[doc], last - first + 1, a, a, a
    end = last + span
    r1 = Rolling(data, 1)
    with np.errstate(over="ignore"):
        shape = (anchor[first] - first).astype(_U) * _U(1 << 20) + (end - first).astype(_U)
        f1 = mix(r0.of(first, end) + shape * GOLDEN)
        f2 = mix(r1.of(first, end) ^ (shape * _BASES[0]))
    return doc, first - offs[doc], last - first + 1, a, f1, f2


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def segments(batch: pa.RecordBatch, span: int, size: int = SEGMENT):
    """Blocks of a batch: first row, bytes, row offsets and the first byte's place in its text; a long text comes in parts that overlap by a span."""
    for lo, _, data, offs in rows(batch, "text"):
        if len(offs) == 2 and len(data) > 2 * size:
            for at in range(0, len(data) - span + 1, size):  # the windows that start in [at, at + size)
                part = data[at : at + size + span - 1]
                yield lo, part, np.array([0, len(part)]), at
        else:
            yield lo, data, offs, 0


def _anchors(span: int, gram: int):
    def run(batches):
        for batch in batches:
            got = [pieces(d, o, span, gram, False)[3] for _, d, o, _ in segments(batch, span)]
            if got:
                h, n = np.unique(np.concatenate(got), return_counts=True)
                yield pa.RecordBatch.from_arrays([_long(h), pa.array(n)], names=["h", "n"])

    return run


def _pieces(span: int, gram: int):
    def run(batches):
        for batch in batches:
            for lo, data, offs, base in segments(batch, span):
                doc, at, n, h, f1, f2 = pieces(data, offs, span, gram)
                key = [batch.column(c).take(pa.array(doc + lo)) for c in ("id", "tag")]
                yield pa.RecordBatch.from_arrays([_long(h), _long(f1), _long(f2), *key, pa.array(at + base), pa.array(n)], names=["h", "f1", "f2", "id", "tag", "at", "n"])

    return run


def suffix_array(text: bytes, depth: int) -> np.ndarray:
    """Suffixes of ``text`` in the order of their first ``depth`` bytes at least, by two-stage sorting."""
    t = np.frombuffer(text, np.uint8)
    n = len(t)
    # a suffix is smaller than its successor if the next different byte is larger
    diff = np.flatnonzero(t[1:] != t[:-1])
    nxt = np.searchsorted(diff, np.arange(n))
    rises = np.zeros(n, bool)
    inside = nxt < len(diff)
    at = diff[nxt[inside]]
    rises[inside] = t[at] < t[at + 1]
    direct = np.flatnonzero(rises)
    keys = [text[i : i + depth] for i in direct.tolist()]
    direct = direct[np.array(sorted(range(len(keys)), key=keys.__getitem__), dtype=np.int64)] if len(keys) else direct
    by = np.searchsorted(t[direct], np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    induced[t[n - 1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        turn = np.concatenate(induced[c]) if induced[c] else np.zeros(0, np.int64)
        seen = [turn]
        while len(turn):  # runs of one byte: each turn induces the next from this bucket itself
            prev = turn[turn > 0] - 1
            turn = prev[(t[prev] == c) & ~rises[prev]]
            seen.append(turn)
        bucket = np.concatenate([*seen, direct[by[c] : by[c + 1]]])
        if not len(bucket):
            continue
        out.append(bucket)
        prev = bucket[bucket > 0] - 1
        prev = prev[(t[prev] > c) & ~rises[prev]]
        if len(prev):
            first = t[prev]
            order = np.argsort(first, kind="stable")
            prev, first = prev[order], first[order]
            edge = np.flatnonzero(np.diff(first)) + 1
            for part in np.split(prev, edge):
                induced[t[part[0]]].append(part)
    return np.concatenate(out)


def common_prefixes(text: bytes, order: np.ndarray, limit: int) -> np.ndarray:
    """Common prefix of each suffix with the one before it in ``order``, up to ``limit`` bytes, in steps of eight."""
    t = np.concatenate([np.frombuffer(text, np.uint8), np.zeros(limit + 8, np.uint8)]).astype(np.uint64)
    word = np.zeros(len(t) - 7, np.uint64)
    for j in range(8):
        word = (word << _U(8)) | t[j : len(t) - 7 + j]
    lcp = np.zeros(len(order), np.int64)
    live = np.arange(1, len(order))
    for step in range(0, limit, 8):
        live = live[word[order[live] + step] == word[order[live - 1] + step]]
        lcp[live] = step + 8
    return lcp


def repeated_windows(texts: list[bytes], span: int) -> list[np.ndarray]:
    """For each text, whether each of its windows of ``span`` bytes starts more than once in the texts."""
    whole = b"".join(texts)
    sizes = np.array([len(x) for x in texts])
    base = np.cumsum(sizes) - sizes
    order = suffix_array(whole, span + 8)
    room = np.repeat(base + sizes, sizes) - np.arange(len(whole))
    order = order[room[order] >= span]
    lcp = common_prefixes(whole, order, span)
    same = np.zeros(len(whole), bool)
    eq = np.flatnonzero(lcp >= span)
    same[order[eq]] = True
    same[order[eq - 1]] = True
    return [same[b : b + max(0, s - span + 1)] for b, s in zip(base, sizes, strict=True)]


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edge[::2], edge[1::2] - edge[::2]


def _sort_suffixes(span: int):
    names = ["id", "tag", "at", "n"]

    def flush(held):
        flags = repeated_windows([x[0] for x in held], span)
        out = [[] for _ in names]
        for (_, i, t, a, c), f in zip(held, flags, strict=True):
            if c == 1:
                s, k = runs(f)
                for col, v in zip(out, ([i] * len(s), [t] * len(s), (s + a).tolist(), k.tolist()), strict=True):
                    col += v
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=names)

    def run(batches):
        held, size, last = [], 0, None
        for batch in batches:
            cols = [batch.column(k).to_pylist() for k in ("h", "bytes", "id", "tag", "at", "c")]
            for h, text, i, t, a, c in zip(*cols, strict=True):
                if h != last and size >= BUFFER:
                    yield flush(held)
                    held, size = [], 0
                last = h
                held.append((text, i, t, a, c))
                size += len(text)
        if held:
            yield flush(held)

    return run


def _split(span: int, gram: int):
    """Pieces of pieces, by anchors of ``gram`` bytes."""

    def run(batches):
        for batch in batches:
            for lo, _, data, offs in rows(batch, "bytes", BUFFER):
                doc, at, n, h, f1, f2 = pieces(data, offs, span, gram)
                parent = batch.take(pa.array(doc + lo))
                start = offs[doc] + at
                text = [data[i:j].tobytes() for i, j in zip(start.tolist(), (start + n + span - 1).tolist(), strict=True)]
                at = pa.array(parent.column("at").to_numpy() + at)
                yield pa.RecordBatch.from_arrays(
                    [_long(h), _long(f1), _long(f2), parent.column("id"), parent.column("tag"), at, pa.array(n), parent.column("c"), pa.array(text, pa.binary())], names=["h", "f1", "f2", "id", "tag", "at", "n", "c", "bytes"]
                )

    return run


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the row's key: ``id`` (0 for a null) and ``tag``, a hash of the text."""
    return docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), F.xxhash64("text").alias("tag"), "text")


def _twice(p: DataFrame, q: DataFrame) -> DataFrame:
    """Windows of the pieces ``p`` that occur more than once among the distinct ones ``q``."""
    return p.join(q.where("c > 1").select("h", "f1", "f2"), ["h", "f1", "f2"], "left_semi").select("id", "tag", "at", "n")


def _mixed(q: DataFrame) -> DataFrame:
    """Distinct pieces of the anchors that have several, of which one at least occurs once; ``k`` is their number."""
    mixed = q.groupBy("h").agg(F.count("*").alias("k"), F.min("c").alias("least")).where("k > 1 and least = 1").select("h", "k")
    return q.join(mixed, "h").drop("f1", "f2")


def repeats(docs: DataFrame, span: int = SPAN, gram: int = GRAM, most: int = MOST) -> DataFrame:
    """(id, tag, at, n): ``n`` windows from byte ``at`` on start more than once in ``docs(doc_id, text)``."""
    work = Scratch()
    texts = keyed(docs).drop("doc_id").where(F.octet_length("text") >= span)
    key = ["id", "tag"]
    # written first, so that the join has a shuffle of its own on both sides, whose large partitions Spark can split
    again = work.cut(texts.select("text").mapInArrow(_anchors(span, gram), "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h"), "anchors")
    p = texts.mapInArrow(_pieces(span, gram), "h long, f1 long, f2 long, id long, tag long, at long, n long").join(again, "h", "left_semi")
    p = work.cut(p, "pieces")
    q = work.cut(p.groupBy("h", "f1", "f2").agg(F.count("*").alias("c"), *[F.first(c).alias(c) for c in (*key, "at", "n")]), "distinct")
    found, todo = [_twice(p, q)], _mixed(q)
    per = todo.groupBy(*key).agg(F.collect_list(F.struct("h", "k", "c", "at", "n")).alias("w"))
    got = texts.join(per, key).select(*key, F.col("text").cast("binary").alias("raw"), F.explode("w").alias("w"))
    got = got.select("w.h", "w.k", "w.c", *key, "w.at", F.expr(f"substring(raw, cast(w.at + 1 as int), cast(w.n + {span - 1} as int))").alias("bytes"))
    got = work.cut(got, "texts")
    while True:
        wide = got.where((F.col("k") > most) & F.lit(gram < span))
        few = got.where((F.col("k") <= most) | F.lit(gram >= span))
        found.append(few.repartition("h").sortWithinPartitions("h").select("h", "bytes", *key, "at", "c").mapInArrow(_sort_suffixes(span), "id long, tag long, at long, n long"))
        if wide.isEmpty():
            break
        gram = span - (span - gram) // 4
        p = wide.select("bytes", *key, "at", "c").mapInArrow(_split(span, gram), "h long, f1 long, f2 long, id long, tag long, at long, n long, c long, bytes binary")
        p = work.cut(p, "parts")
        q = work.cut(p.groupBy("h", "f1", "f2").agg(F.sum("c").alias("c"), *[F.first(c).alias(c) for c in (*key, "at", "n", "bytes")]), "parts-distinct")
        found.append(_twice(p.where("c = 1"), q))  # the others' windows are known
        got = work.cut(_mixed(q), "parts-mixed")
    out = cut(reduce(DataFrame.union, found), "repeats")
    work.clear()
    return out


def _strip(span: int):
    def run(batches):
        for batch in batches:
            spans = batch.column("w").to_pylist()
            size, removed, n, sha = [], [], [], []
            k = 0
            for lo, hi, data, offs in rows(batch, "text"):
                for i in range(hi - lo):
                    x = data[offs[i] : offs[i + 1]]
                    w = spans[lo + i]
                    if w:
                        mark = np.zeros(len(x) + 1, np.int32)
                        np.add.at(mark, [s["at"] for s in w], 1)
                        np.add.at(mark, [s["at"] + s["n"] + span - 1 for s in w], -1)
                        gone = np.cumsum(mark[:-1]) > 0
                        k = len(runs(gone)[0])
                        rest = x[~gone]
                    else:
                        k, rest = 0, x
                    size.append(len(x))
                    removed.append(len(x) - len(rest))
                    n.append(k)
                    sha.append(hashlib.sha256(rest.tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(n, pa.int64()), pa.array(sha, pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return run


def dedup(docs: DataFrame, span: int = SPAN, **options) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256): one row per document."""
    hits = repeats(docs, span, **options)
    per = hits.groupBy("id", "tag").agg(F.collect_set(F.struct("at", "n")).alias("w"))
    both = keyed(docs).join(per, ["id", "tag"], "left").select("doc_id", "text", "w")
    return both.mapInArrow(_strip(span), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: Every window of every text as hexadecimal digits, counted; then runs of covered bytes.
OP2_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT rid, i, substr(h, 2 * i + 1, {2 * SPAN}) AS s FROM (SELECT rid, h, unnest(range(length(h) // 2 - {SPAN - 1})) AS i FROM d WHERE length(h) >= {2 * SPAN})),
t AS (SELECT s FROM w GROUP BY s HAVING count(*) > 1),
x AS (SELECT rid, i FROM w SEMI JOIN t USING (s)),
g AS (SELECT rid, i, sum(fresh) OVER (PARTITION BY rid ORDER BY i) AS g FROM (SELECT rid, i, CASE WHEN i <= lag(i) OVER (PARTITION BY rid ORDER BY i) + {SPAN} THEN 0 ELSE 1 END AS fresh FROM x)),
r AS (SELECT rid, min(i) AS a, max(i) + {SPAN} AS b FROM g GROUP BY rid, g),
k AS (SELECT rid, a, b, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS z FROM r),
y AS (SELECT rid, sum(b - a) AS gone, count(*) AS spans, max(b) AS z, string_agg(substr(h, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) AS kept FROM k JOIN d USING (rid) GROUP BY rid)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
  sha256(unhex(CASE WHEN gone IS NULL THEN h ELSE kept || substr(h, 2 * z + 1) END)) AS kept_sha256 FROM d LEFT JOIN y USING (rid)
"""
