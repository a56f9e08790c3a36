"""Benchmark decontamination by template windows.

Texts become template tokens: numbers, units and names (capitalised words not
at a sentence start; a run of them is one) turn into typed placeholders, other
words are lower-cased.  Windows of ``window`` template tokens of documents and
benchmark items meet in a hash join; a document is contaminated by an item if
enough of the item's windows are found in it and the slot values map
consistently (one value of the document for each value of the item), which
catches re-parameterised questions.  Both are judged for each occurrence of
the item by itself, so differently filled versions in one document don't hide
each other; matches scattered over a document count if they are consistent
together.

Items shorter than a window count as one window of their length.  Windows with
fewer than three literal tokens are too general for placeholders: their words
are matched as they are, numbers, units and names included.  Items of one or
two words must stand alone, from a sentence or line start to an end.  Scripts
written without spaces (Chinese, Japanese, Thai, ...) have a token for each
character.  The item windows are broadcast while there are at most
``broadcast_windows``; beyond that the same join runs as a shuffle.

Edge cases: null or empty texts have no windows and are clean; repeated items
and rows are reported by their ids; an empty benchmark or table gives clean or
no rows; extra columns are ignored; long texts are read whole, block by block.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnspark.llm.shared import Scratch, cut
from cairnspark.llm.textnum import Words, mix, rows

WINDOW = 8
MIN_LITERALS = 3
MIN_COVERAGE = 0.25
MIN_CONSISTENT = 0.5
BROADCAST_BYTES = 64 << 20
SET_BITS = 24

# Words that stand for numbers, and unit words.
NUMBER_WORDS = """zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen
seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion""".split()
UNIT_WORDS = """mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons pound
pounds ounce ounces ml l litre litres liter liters gallon gallons second seconds minute minutes hour hours day days week weeks
month months year years dollar dollars euro euros cent cents percent degree degrees watt watts volt volts meter meters metre
metres kilometer kilometers kilometre kilometres""".split()

_U = np.uint64
_NUM, _UNIT, _NAME = _U(0x1111111111111111), _U(0x2222222222222222), _U(0x3333333333333333)


def _list_hashes(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), dtype=np.uint8)
    return np.sort(Words(data, np.array([0, len(data)])).hashes())


def _isin(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


#: Code points of scripts written without spaces, and of the punctuation and spaces of East Asian texts.
UNSPACED = [(0xE00, 0xFFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3040, 0x312F), (0x31A0, 0x9FFF), (0xA000, 0xA4CF),
            (0xA980, 0xA9DF), (0xA9E0, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1B000, 0x1B16F), (0x20000, 0x3FFFF)]
STOPS = [(0x3000, 0x3004), (0x3008, 0x303F), (0xFF01, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65)]


def _unspaced(data: np.ndarray):
    """(byte positions before and after each character of unspaced scripts, byte positions of East Asian punctuation)."""
    at = np.flatnonzero(data >= 0xE0)
    long = data[at] >= 0xF0
    d = np.concatenate([data, np.zeros(3, np.uint8)])
    b = [d[at + j].astype(np.int64) & 63 for j in range(4)]
    code = np.where(long, ((b[0] & 7) << 18) | (b[1] << 12) | (b[2] << 6) | b[3], ((b[0] & 15) << 12) | (b[1] << 6) | b[2])

    def among(ranges):
        return np.logical_or.reduce([(code >= lo) & (code <= hi) for lo, hi in ranges])

    char, stop = among(UNSPACED), at[among(STOPS)]
    return np.concatenate([at[char], at[char] + np.where(long[char], 4, 3)]), (stop[:, None] + np.arange(3)).ravel()


class Raw(NamedTuple):
    """The words of a block as they are: hash, is slot, document, index of the template token, starts and ends a sentence or line."""

    value: np.ndarray
    slot: np.ndarray
    doc: np.ndarray
    token: np.ndarray
    opens: np.ndarray
    closes: np.ndarray


def template_tokens(data: np.ndarray, offs: np.ndarray):
    """(canonical hash, value hash, is slot, document) of the template tokens of a block, and its words."""
    digit = (data >= 0x30) & (data <= 0x39)
    mask = digit | (((data | 32) >= 0x61) & ((data | 32) <= 0x7A)) | (data >= 0x80)
    point = (data == 0x2E) | (data == 0x2C)
    if len(data) > 2:
        mask[1:-1] |= point[1:-1] & digit[:-2] & digit[2:]
    breaks, stops = _unspaced(data)
    mask[stops] = False
    w = Words(data, offs, mask, breaks)
    if not len(w):
        none, no = np.zeros(0, np.int64), np.zeros(0, bool)
        return np.zeros(0, _U), np.zeros(0, _U), no, none, Raw(np.zeros(0, _U), no, none, none, no, no)
    value = w.hashes()
    number = np.logical_or.reduceat(digit, w.start)
    number |= _isin(value, _list_hashes(NUMBER_WORDS))
    unit = _isin(value, _list_hashes(UNIT_WORDS)) & ~number
    head = data[w.start]
    second = data[np.minimum(w.start + 1, len(data) - 1)]
    capital = ((head >= 0x41) & (head <= 0x5A)) | ((head == 0xC3) & (second >= 0x80) & (second <= 0x9E))
    end = np.isin(data, np.frombuffer(b".!?:;\n\r|", np.uint8)) & ~mask
    end[stops] = True
    ends = np.concatenate([[0], np.cumsum(end)])
    opens = np.ones(len(w), bool)
    opens[1:] = (ends[w.start[1:]] > ends[w.end[:-1]]) | (w.doc[1:] != w.doc[:-1])
    name = capital & ~opens & ~number & ~unit & (w.end - w.start > 1)
    canon = np.where(number, _NUM, np.where(unit, _UNIT, np.where(name, _NAME, value)))
    follows = np.zeros(len(w), bool)
    follows[1:] = name[1:] & name[:-1] & (w.doc[1:] == w.doc[:-1])
    raw = Raw(value, number | unit | name, w.doc, np.cumsum(~follows) - 1, opens, np.append(opens[1:], True))
    if follows.any():  # a run of names is one slot; its value mixes them all
        lead = np.flatnonzero(~follows)
        with np.errstate(over="ignore"):
            value = np.add.reduceat(value * np.where(follows, _U(3), _U(1)), lead)
        canon, number, unit, name, doc = canon[lead], number[lead], unit[lead], name[lead], w.doc[lead]
    else:
        doc = w.doc
    return canon, value, number | unit | name, doc, raw


def windows_of(canon: np.ndarray, slot: np.ndarray, doc: np.ndarray, k: int):
    """(hash, first token) of the windows of ``k`` tokens that have enough literals."""
    n = len(canon)
    if n < k:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    literals = np.concatenate([[0], np.cumsum(~slot)])
    at = np.flatnonzero((doc[: n - k + 1] == doc[k - 1 :]) & (literals[k:] - literals[: n - k + 1] >= min(MIN_LITERALS, k)))
    with np.errstate(over="ignore"):
        h = np.full(len(at), k, _U)
        for j in range(k):
            h = h * _U(0x9FB21C651E98DF25) + canon[at + j]
        return mix(h), at


def exact_windows(raw: Raw, k: int):
    """(hash, first word) of the windows of ``k`` words as they are; of one or two words, those that stand alone."""
    n = len(raw.value)
    if n < k:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    ok = raw.doc[: n - k + 1] == raw.doc[k - 1 :]
    if k < MIN_LITERALS:
        ok &= raw.opens[: n - k + 1] & raw.closes[k - 1 :]
    at = np.flatnonzero(ok)
    with np.errstate(over="ignore"):
        h = np.full(len(at), ~_U(k), _U)
        for j in range(k):
            h = h * _U(0x9FB21C651E98DF25) + raw.value[at + j]
        return mix(h), at


def _emit_exact(ids, h, at, raw, names):
    first = np.searchsorted(raw.doc, raw.doc[at])
    slots = pa.ListArray.from_arrays(pa.array(np.zeros(len(at) + 1, np.int32)), pa.array(np.zeros(0, np.int64)))
    return pa.RecordBatch.from_arrays([ids.take(pa.array(raw.doc[at])), pa.array(raw.token[at] - raw.token[first]), pa.array(h.view(np.int64)), slots], names=names)


def _emit(ids, k, h, at, value, slot, doc, names):
    lists, cut = [], [0]
    for i in at:
        s = value[i : i + k][slot[i : i + k]]
        lists.append(s)
        cut.append(cut[-1] + len(s))
    flat = np.concatenate(lists) if lists else np.zeros(0, _U)
    slots = pa.ListArray.from_arrays(pa.array(np.array(cut, np.int32)), pa.array(flat.view(np.int64)))
    first = np.searchsorted(doc, doc[at])
    return pa.RecordBatch.from_arrays([ids.take(pa.array(doc[at])), pa.array(at - first), pa.array(h.view(np.int64)), slots], names=names)


def _item_windows(window: int):
    def run(batches):
        for batch in batches:
            for lo, hi, data, offs in rows(batch, "text"):
                canon, value, slot, doc, raw = template_tokens(data, offs)
                ids = batch.column("item_id").slice(lo, hi - lo)
                names = ["item_id", "item_pos", "h", "item_slots"]
                counts = np.bincount(doc, minlength=hi - lo)
                for k in range(3, window + 1):
                    use = (counts >= window) if k == window else (counts == k)
                    if use.any():
                        h, at = windows_of(canon, slot, doc, k)
                        keep = use[doc[at]]
                        out = _emit(ids, k, h[keep], at[keep], value, slot, doc, names)
                        yield out.append_column("k", pa.array(np.full(len(out), k, np.int64)))
                counts = np.bincount(raw.doc, minlength=hi - lo)
                literals = np.concatenate([[0], np.cumsum(~raw.slot)])
                for k in range(1, window + 1):  # windows that are too general, as they are
                    use = (counts >= window) if k == window else (counts == k)
                    if use.any():
                        h, at = exact_windows(raw, k)
                        keep = use[raw.doc[at]] & (literals[at + k] - literals[at] < MIN_LITERALS)
                        out = _emit_exact(ids, h[keep], at[keep], raw, names)
                        yield out.append_column("k", pa.array(np.full(len(out), -k, np.int64)))

    return run


def _bits(size: int):
    """The bit set of a partition's hashes: bit h mod 2^size of each."""

    def run(batches):
        found = np.zeros(1 << size >> 3, np.uint8)
        for batch in batches:
            bit = batch.column("h").to_numpy().view(np.uint64) & _U((1 << size) - 1)
            np.bitwise_or.at(found, (bit >> _U(3)).astype(np.int64), np.uint8(128) >> (bit & _U(7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array([found.tobytes()], pa.binary())], names=["bits"])

    return run


def bit_set(windows: DataFrame, size: int) -> np.ndarray:
    """2^size bits as bytes: the union of the partitions' sets, taken in one at a time."""
    out = np.zeros(1 << size >> 3, np.uint8)
    for r in windows.select("h").coalesce(8).mapInArrow(_bits(size), "bits binary").toLocalIterator():
        out |= np.frombuffer(r.bits, np.uint8)
    return out


def _doc_windows(lengths: list[int], wanted, size: int):
    """Windows of the documents, of lengths below 0 as they are; only those in the broadcast bit set."""

    def run(batches):
        known, low = wanted.value, _U((1 << size) - 1)
        for batch in batches:
            for lo, hi, data, offs in rows(batch, "text"):
                canon, value, slot, doc, raw = template_tokens(data, offs)
                ids = batch.column("doc_id").slice(lo, hi - lo)
                names = ["doc_id", "doc_pos", "h", "doc_slots"]
                for k in lengths:
                    h, at = windows_of(canon, slot, doc, k) if k > 0 else exact_windows(raw, -k)
                    bit = h & low
                    hit = (known[(bit >> _U(3)).astype(np.int64)] >> (_U(7) - (bit & _U(7))).astype(np.uint8)) & 1 > 0
                    h, at = h[hit], at[hit]
                    if len(at):
                        yield _emit(ids, k, h, at, value, slot, doc, names) if k > 0 else _emit_exact(ids, h, at, raw, names)

    return run


def _occurrences(hits: list[dict], window: int):
    """Groups of a pair's matches that are judged by themselves.

    Matches of equal ``doc_pos - item_pos`` are one copy of the item.  Such
    runs are also chained, where one goes on behind another with at most
    ``window`` tokens put in or left out, which is a copy with edits.  All
    matches together come last.
    """
    runs: dict[int, list[dict]] = {}
    for m in sorted(hits, key=lambda m: (m["doc_pos"], m["item_pos"])):
        runs.setdefault(m["doc_pos"] - m["item_pos"], []).append(m)
    yield from runs.values()
    if len(runs) > 1:
        reach = max(m["item_pos"] for m in hits) + window
        chains, live = [], []
        for shift, run in runs.items():  # by first document position
            at, item = run[0]["doc_pos"], run[0]["item_pos"]
            live = [c for c in live if c[-1][-1]["doc_pos"] + reach >= at]
            fits = [c for c in live if c[-1][-1]["doc_pos"] < at and c[-1][-1]["item_pos"] < item and abs(_shift(c) - shift) <= window]
            if fits:
                min(fits, key=lambda c: abs(_shift(c) - shift)).append(run)
            else:
                chains.append([run])
                live.append(chains[-1])
        for c in chains:
            if len(c) > 1:
                yield [m for run in c for m in run]
        yield hits


def _shift(chain: list[list[dict]]) -> int:
    return chain[-1][0]["doc_pos"] - chain[-1][0]["item_pos"]


def _coverage(hits: list[dict], total: int, general: int) -> float:
    """The share of the item's windows found, of all or of those with placeholders, whichever is more."""
    share = len({m["h"] for m in hits}) / total
    return max(share, len({m["h"] for m in hits if m["g"]}) / general) if general else share


def _judge(window: int, min_coverage: float, min_consistent: float):
    """The pairs of which one occurrence, or all matches together, are covered and consistent."""

    def run(batches):
        for batch in batches:
            out = []
            for doc_id, item_id, total, general, hits in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "item_id", "total", "general", "hits")), strict=True):
                best = None
                for part in _occurrences(hits, window):
                    if _coverage(part, total, general) < min_coverage:
                        continue
                    maps = {x for m in part for x in zip(m["item_slots"], m["doc_slots"], strict=True)}
                    consistent = len({i for i, _ in maps}) / len(maps) if maps else 1.0
                    if consistent >= min_consistent:
                        best = max(best or (False, 0.0), (all(i == d for i, d in maps), consistent))
                if best:
                    out.append((doc_id, item_id, _coverage(hits, total, general), best[1], best[0]))
            cols = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["doc_id", "item_id", "coverage", "consistent", "exact"])

    return run


def matches(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    min_coverage: float = MIN_COVERAGE,
    min_consistent: float = MIN_CONSISTENT,
    broadcast_bytes: int = BROADCAST_BYTES,
    set_bits: int = SET_BITS,
) -> DataFrame:
    """(doc_id, item_id, coverage, consistent, exact) of the contaminated pairs.

    ``coverage`` is the share of the item's windows found (of all, or of those
    with placeholders, whichever is more), ``consistent`` the
    share of slot values with one counterpart (1 without slots) in the best
    occurrence, ``exact`` whether all slots of an occurrence kept their values.
    """
    work = Scratch()
    spark = docs.sparkSession
    iw = work.cut(items.select("item_id", "text").mapInArrow(_item_windows(window), "item_id long, item_pos long, h long, item_slots array<bigint>, k long"), "items")
    lengths = sorted(r.k for r in iw.select("k").distinct().collect())
    size = iw.agg(F.sum(64 + 8 * F.size("item_slots").cast("long")).alias("b")).first().b or 0
    wanted = spark.sparkContext.broadcast(bit_set(iw, set_bits))
    dw = docs.select("doc_id", "text").mapInArrow(_doc_windows(lengths, wanted, set_bits), "doc_id long, doc_pos long, h long, doc_slots array<bigint>")
    total = iw.groupBy("item_id").agg(F.countDistinct("h").alias("total"), F.countDistinct(F.when(F.col("k") > 0, F.col("h"))).alias("general"))
    side = iw.select("*", (F.col("k") > 0).alias("g")).drop("k").join(total, "item_id")
    pairs = dw.join(F.broadcast(side) if size <= broadcast_bytes else side, "h")
    hit = F.struct("doc_pos", "item_pos", "h", "g", "item_slots", "doc_slots")
    found = pairs.groupBy("doc_id", "item_id", "total", "general").agg(F.collect_set(hit).alias("hits"))
    # of all windows, or of those with placeholders: a question filled anew has none of the others
    everything = F.size(F.array_distinct(F.transform("hits", lambda m: m["h"]))) >= min_coverage * F.col("total")
    general = F.size(F.array_distinct(F.transform(F.filter("hits", lambda m: m["g"]), lambda m: m["h"]))) >= min_coverage * F.col("general")
    found = found.where(everything | ((F.col("general") > 0) & general))
    found = cut(found.mapInArrow(_judge(window, min_coverage, min_consistent), "doc_id long, item_id long, coverage double, consistent double, exact boolean"), "contaminated")
    work.clear()
    return found


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """(doc_id, contaminated, item_ids, coverage, exact): one row per document."""
    m = matches(docs, items, **options)
    per = m.groupBy(F.col("doc_id").alias("hit")).agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.max("coverage").alias("coverage"), F.max("exact").alias("exact"))
    return docs.select("doc_id").join(per, F.col("doc_id") == F.col("hit"), "left").select(
        "doc_id",
        F.col("hit").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"),
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
        F.coalesce("exact", F.lit(False)).alias("exact"),
    )


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
