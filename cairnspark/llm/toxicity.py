"""Toxicity: a logistic classifier with a counterfactual penalty.

Features are the presence of lower-cased words and of their first four and
five bytes.  Training takes about ``max_toxic`` and ``max_clean`` labelled
texts (chosen by a hash, equal texts once), selects features that are
significantly more common in toxic texts, and fits weights by full-batch
gradient steps on the driver; the sample bounds all it gathers.

Counterfactuals: every sentence of a training text that names a group, and
each term as a sentence by itself, is copied with the terms swapped for others
of the same language and kind (people or adjective; letters' case kept), and
the features of the copy are made anew.  The squared change of the logit
between a sentence and its copy is penalised, so that naming a group does not
raise a score.  ``gap`` measures what is left of it.

Edge cases: null and empty texts get the score of no features; rows without a
label are scored all the same; of several labels of an id, or of equal texts
with several labels, toxic counts; repeated ids share their label; without
positive or negative labels every score is 0; equal rows get equal scores;
extra columns are ignored, whatever their names; long texts are read whole,
block by block; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnspark.llm.shared import cut, drop
from cairnspark.llm.textnum import _LOWER, Words, mix, rows

MAX_TOXIC, MAX_CLEAN = 2500, 5000
MIN_Z = 4.0
THRESHOLD = 0.7
L2, COUNTERFACTUAL, STEPS = 1e-4, 1.0, 400
COPIES = 2

# Terms that name groups of people, by language and kind.
IDENTITY_TERMS = [
    """women woman men man girls boys muslims christians jews immigrant immigrants refugee refugees lesbian""".split(),
    """muslim christian jewish hindu buddhist catholic atheist black white asian african european american mexican arab gay trans queer
    disabled blind deaf elderly young old""".split(),
    """frauen männer muslime christen juden schwarze ausländer flüchtlinge homosexuelle""".split(),
    """femmes hommes musulmans chrétiens juifs noirs étrangers réfugiés homosexuels""".split(),
    """mujeres hombres musulmanes cristianos judíos negros extranjeros refugiados homosexuales""".split(),
]
_GROUP = {t: g for g in IDENTITY_TERMS for t in g}
_WORD = re.compile("[A-Za-z\u0080-\U0010ffff]+")
_SENTENCE = re.compile("[.!?;\\n]+")

_U = np.uint64


def word_features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, 64-bit feature) of the words and their prefixes, with repeats."""
    mask = (((data | 32) >= 0x61) & ((data | 32) <= 0x7A)) | (data >= 0x80)
    w = Words(data, offs, mask)
    if not len(w):
        return np.zeros(0, np.int64), np.zeros(0, _U)
    low = _LOWER[data]
    size = w.end - w.start
    parts, docs = [w.hashes()], [w.doc]
    four = np.zeros(len(w), _U)
    for j in range(5):
        ok = size > j
        byte = np.where(ok, low[np.minimum(w.start + j, len(low) - 1)], 0).astype(_U)
        four = (four << _U(8)) | byte
        if j >= 3:
            long = size > j + 1
            parts.append(mix(four[long] * _U(16) + _U(j)))
            docs.append(w.doc[long])
    return np.concatenate(docs), np.concatenate(parts)


def text_features(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return np.unique(word_features(raw, np.array([0, len(raw)]))[1])


def ascii_lower(text: str) -> str:
    return text.translate({c: c + 32 for c in range(0x41, 0x5B)})


def swapped(sentence: str, turn: int) -> str:
    """The sentence with each identity term replaced by another of its group, ``turn`` places on; the case of the first letter stays."""

    def other(m):
        word = m.group()
        group = _GROUP.get(ascii_lower(word))
        if group is None:
            return word
        new = group[(group.index(ascii_lower(word)) + 1 + turn % (len(group) - 1)) % len(group)]
        return new[0].upper() + new[1:] if word[0].isupper() else new

    return _WORD.sub(other, sentence)


def naming(text: str) -> list[str]:
    """The sentences of a text that name a group."""
    return [s for s in _SENTENCE.split(text) if any(w in _GROUP for w in _WORD.findall(ascii_lower(s)))]


def counterfactuals(text: str, copies: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(features lost, features won) of each swapped copy of a sentence of the text that names a group."""
    out = []
    for sentence in naming(text):
        f = text_features(sentence)
        for c in range(copies):
            g = text_features(swapped(sentence, len(sentence) * copies + 7 * c))
            out.append((np.setdiff1d(f, g), np.setdiff1d(g, f)))
    return out


def distinct(doc: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((feature, doc))
    doc, feature = doc[order], feature[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (feature[1:] != feature[:-1])
    return doc[new], feature[new]


def _tally(batches):
    for batch in batches:
        toxic = np.array(batch.column("toxic").to_pylist(), dtype=np.int64)
        for lo, hi, data, offs in rows(batch, "text"):
            doc, f = distinct(*word_features(data, offs))
            if len(f):
                keys, at = np.unique(f, return_inverse=True)
                y = toxic[lo:hi][doc]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(np.bincount(at, y, len(keys)).astype(np.int64)), pa.array(np.bincount(at, minlength=len(keys)).astype(np.int64))],
                    names=["f", "toxic", "n"],
                )


def _select(known, copies: int):
    """(toxic, feature numbers of the text; of its swapped sentences the lost and the won feature numbers)."""

    def numbers(keys, f):
        at = np.minimum(np.searchsorted(keys, f), len(keys) - 1)
        return at[keys[at] == f].tolist()

    def run(batches):
        keys = known.value
        for batch in batches:
            for lo, hi, data, offs in rows(batch, "text"):
                doc, f = word_features(data, offs)
                at = np.minimum(np.searchsorted(keys, f), len(keys) - 1)
                hit = keys[at] == f
                doc, at = distinct(doc[hit], at[hit].astype(np.uint64))
                cut_ = np.searchsorted(doc, np.arange(hi - lo + 1)).astype(np.int32)
                lost, won = [], []
                for text in batch.column("text").slice(lo, hi - lo).to_pylist():
                    pairs = counterfactuals(text or "", copies)
                    lost.append([numbers(keys, a) for a, _ in pairs])
                    won.append([numbers(keys, b) for _, b in pairs])
                nested = pa.list_(pa.list_(pa.int64()))
                columns = [batch.column("toxic").slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(cut_), pa.array(at.astype(np.int64))), pa.array(lost, nested), pa.array(won, nested)]
                yield pa.RecordBatch.from_arrays(columns, names=["toxic", "at", "lost", "won"])

    return run


def _fit(x_rows: list[np.ndarray], y: np.ndarray, n: int, swaps: list[tuple[np.ndarray, np.ndarray]], l2: float, cf: float, steps: int):
    """Weights and bias by Adam on the balanced logistic loss, L2 and the counterfactual penalty."""
    row = np.repeat(np.arange(len(x_rows)), [len(r) for r in x_rows])
    col = np.concatenate(x_rows) if x_rows else np.zeros(0, np.int64)
    srow = np.concatenate([np.full(len(a) + len(b), i) for i, (a, b) in enumerate(swaps)]) if swaps else np.zeros(0, np.int64)
    scol = np.concatenate([np.concatenate(ab) for ab in swaps]) if swaps else np.zeros(0, np.int64)
    sval = np.concatenate([np.concatenate([np.ones(len(a)), -np.ones(len(b))]) for a, b in swaps]) if swaps else np.zeros(0)
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    w, b = np.zeros(n), -2.0
    m, v, mb, vb = np.zeros(n), np.zeros(n), 0.0, 0.0
    for t in range(1, steps + 1):
        z = np.bincount(row, w[col], len(x_rows)) + b
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight
        gw = np.bincount(col, g[row], n) + l2 * w
        if len(swaps):
            change = np.bincount(srow, w[scol] * sval, len(swaps))
            gw += cf * 2 / len(swaps) * np.bincount(scol, change[srow] * sval, n)
        gb = g.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * gw, 0.999 * v + 0.001 * gw * gw, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        fix = np.sqrt(1 - 0.999**t) / (1 - 0.9**t)
        w -= 0.05 * fix * m / (np.sqrt(v) + 1e-8)
        b -= 0.05 * fix * mb / (np.sqrt(vb) + 1e-8)
    return w, b


def train(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN, cf: float = COUNTERFACTUAL):
    """(sorted feature hashes, weights, bias) from ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``; None without both classes."""
    spark = docs.sparkSession
    known = labels.where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    size = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not size.get(1) or not size.get(0):
        return None
    million = 1_000_000
    share = F.when(F.col("toxic") == 1, min(million, max_toxic * million // size[1])).otherwise(min(million, max_clean * million // size[0]))
    chosen = known.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(million)) < share)
    text = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id")  # bounded by max_toxic + max_clean
    sample = cut(text.groupBy("text").agg(F.max("toxic").alias("toxic")), "toxic")
    n = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        return None
    seen = sample.mapInArrow(_tally, "f long, toxic long, n long").groupBy("f").agg(F.sum("toxic").alias("a"), F.sum("n").alias("n")).where("a >= 3")
    p1, p0, p = F.col("a") / n1, (F.col("n") - F.col("a")) / n0, F.col("n") / (n1 + n0)
    z = (p1 - p0) / F.sqrt(F.greatest(F.lit(1e-12), p * (1 - p)) * (1 / n1 + 1 / n0))
    top = seen.where(z >= MIN_Z).select("f").toArrow()["f"].to_numpy()
    alone = [t for g in IDENTITY_TERMS for t in g]
    keys = np.unique(np.concatenate([top.astype(np.int64).view(np.uint64), *[text_features(t) for t in alone]]))
    got = sample.mapInArrow(_select(spark.sparkContext.broadcast(keys), COPIES), "toxic int, at array<bigint>, lost array<array<bigint>>, won array<array<bigint>>").toArrow()
    y = got["toxic"].to_numpy().astype(float)
    x = [np.asarray(r, dtype=np.int64) for r in got["at"].to_pylist()]
    swaps = [tuple(np.searchsorted(keys, f) for f in pair) for t in alone for pair in counterfactuals(t, COPIES)]
    for a, b in zip(got["lost"].to_pylist(), got["won"].to_pylist(), strict=True):
        swaps += [(np.asarray(u, dtype=np.int64), np.asarray(v, dtype=np.int64)) for u, v in zip(a, b, strict=True)]
    drop(sample)
    w, b = _fit(x, y, len(keys), swaps, L2, cf, STEPS)
    return keys, w, float(b)


def score_text(text: str, model) -> float:
    """The score of one text, on the driver."""
    keys, w, b = model
    f = text_features(text)
    at = np.minimum(np.searchsorted(keys, f), len(keys) - 1)
    return float(1 / (1 + np.exp(-(w[at[keys[at] == f]].sum() + b))))


def gap(sentences: list[str], model) -> tuple[float, float]:
    """Mean and largest change of the score of neutral sentences when their terms are swapped for each other one of the group."""
    change = []
    for s in sentences:
        longest = max(len(_GROUP[w]) for w in _WORD.findall(ascii_lower(s)) if w in _GROUP)
        change += [abs(score_text(s, model) - score_text(swapped(s, t), model)) for t in range(longest - 1)]
    return float(np.mean(change)), float(np.max(change))


def _score(model):
    def run(batches):
        got = model.value
        for batch in batches:
            for lo, hi, data, offs in rows(batch, "text"):
                n = hi - lo
                z = np.full(n, -50.0)
                if got is not None:
                    keys, w, b = got
                    doc, f = word_features(data, offs)
                    at = np.minimum(np.searchsorted(keys, f), len(keys) - 1)
                    hit = keys[at] == f
                    doc, at = distinct(doc[hit], at[hit].astype(np.uint64))
                    z = np.bincount(doc, w[at.astype(np.int64)], n) + b
                score = 1 / (1 + np.exp(-np.clip(z, -50, 50))) if got is not None else np.zeros(n)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, n), pa.array(score)], names=["doc_id", "score"])

    return run


def score(docs: DataFrame, model) -> DataFrame:
    """(doc_id, score) of ``docs(doc_id, text)``."""
    return docs.select("doc_id", "text").mapInArrow(_score(docs.sparkSession.sparkContext.broadcast(model)), "doc_id long, score double")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = train(docs, labels.where(~held))
    return score(docs, model).select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
