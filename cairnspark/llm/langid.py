"""Language identification of whole texts, with spans of mixed-language text.

A word's script narrows the candidate languages to those learned with it; its
score per language is the sum of log-probabilities of its byte trigrams; a
Viterbi pass with a switching penalty labels each word, among all languages
that a word of its block may have, and a document's language is the one of
most of its words.  Scripts are those of Unicode: a letter's or mark's script
is the first word of its character name.

Training counts trigrams of about ``train_docs`` documents of each language,
chosen by a hash of the id (the documented bound of the sample); counts are
aggregated on the executors and the model has a fixed size per language.

Edge cases: a null text, or one without letters, is ``und`` with score 0 and
no spans; words without letters follow their neighbours; words of a script
that no learned language has give no language their vote but count among the
words, so a text of such words alone gets the first language with score 0;
ties go to the first language in code point order; with nothing to learn from,
all is ``und``; very long texts cost linear time and are read in parts, cut
between words, each labelled by itself with its votes added up; repeated rows
and ids are rows of their own; ``identify`` returns the columns that it names
and ignores others, ``keep_identified`` passes all columns through, whatever
their names; an empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnspark.llm.textnum import Words, rows

BUCKETS = 1 << 16
TRAIN_DOCS = 2000
SWITCH = 12.0
PIECE = 32
MIN_SCORE = 0.3
PART = 1 << 19


@lru_cache(maxsize=1)
def script_table() -> tuple[list[str], np.ndarray]:
    """Script names, and the number of the script of each code point: 0 for what is neither letter nor mark, or has no script of its own.

    Latin is 1; names that Unicode gives to letters of another script's forms
    (full width, modifiers, mathematical letters) are scripts here as well.
    """
    names = ["none", "LATIN"]
    number = {"LATIN": 1}
    of = np.zeros(0x110000, np.int16)
    for start, end in ((0x41, 0xAC00), (0xD7B0, 0xD800), (0xF900, 0x20000), (0x2F800, 0x2FA20)):
        for cp in range(start, end):
            c = chr(cp)
            if unicodedata.category(c)[0] in "LM":
                script = unicodedata.name(c, "").split(" ")[0]
                if script not in ("", "COMBINING", "VARIATION", "MODIFIER"):
                    if script not in number:
                        number[script] = len(names)
                        names.append(script)
                    of[cp] = number[script]
    of[0xAC00:0xD7B0] = number["HANGUL"]
    of[0x20000:0x2F800] = of[0x30000:0x33480] = number["CJK"]
    return names, of


def fold(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z and the capitals of U+00C0..U+00DE in lower case."""
    out = data.copy()
    out[(data >= 0x41) & (data <= 0x5A)] += 32
    cap = np.zeros(len(data), dtype=bool)
    if len(data) > 1:
        cap[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    out[cap] += 32
    return out


def scripts(data: np.ndarray) -> np.ndarray:
    """Script number at the first byte of each letter, 0 elsewhere."""
    table = script_table()[1]
    out = np.zeros(len(data), dtype=np.int16)
    out[((data | 32) >= 0x61) & ((data | 32) <= 0x7A)] = 1
    for lo, hi, n in ((0xC2, 0xE0, 2), (0xE0, 0xF0, 3), (0xF0, 0xF5, 4)):
        at = np.flatnonzero((data >= lo) & (data < hi))
        at = at[at + n <= len(data)]
        if len(at):
            cp = (data[at] & (0x7F >> n)).astype(np.int64)
            for j in range(1, n):
                cp = (cp << 6) | (data[at + j] & 0x3F)
            out[at] = table[np.minimum(cp, 0x10FFFF)]
    return out


def trigrams(words: Words) -> np.ndarray:
    """Bucket of the byte trigram around each byte; the space stands for a word's ends."""
    low = fold(words.data)
    low[~words.word] = 0x20
    edge = words.offs[1:-1]
    prev = np.empty_like(low)
    prev[0:1], prev[1:] = 0x20, low[:-1]
    nxt = np.empty_like(low)
    nxt[-1:], nxt[:-1] = 0x20, low[1:]
    edge = edge[edge < len(low)]
    prev[edge] = 0x20
    nxt[edge[edge > 0] - 1] = 0x20
    code = (prev.astype(np.uint32) << 16) | (low.astype(np.uint32) << 8) | nxt
    code *= np.uint32(0x9E3779B1)
    return code >> np.uint32(16)


def per_word(values: np.ndarray, words: Words, op=np.add) -> np.ndarray:
    """``op`` over the bytes of each word; bytes between words must be neutral."""
    if not len(words):
        return values[:0]
    return op.reduceat(values, words.start, axis=0)


def _count(langs: list[str]):
    index = {x: i for i, x in enumerate(langs)}

    def run(batches):
        grams = np.zeros((len(langs), BUCKETS), np.int64)
        seen = np.zeros((len(langs), len(script_table()[0])), np.int64)
        for batch in batches:
            lang = np.array([index[x] for x in batch.column("lang").to_pylist()], dtype=np.int64)
            for lo, hi, data, offs in rows(batch, "text"):
                w = Words(data, offs)
                if not len(w):
                    continue
                kind = per_word(scripts(data), w, np.maximum)
                of = lang[lo:hi][w.doc]
                np.add.at(seen, (of, kind), 1)
                owner = np.repeat(np.where(kind > 0, of, -1), np.diff(np.append(w.start, len(data))))
                at = w.word[w.start[0] :] & (owner >= 0)
                cells = owner[at] * BUCKETS + trigrams(w)[w.start[0] :][at]
                grams += np.bincount(cells, minlength=grams.size).reshape(grams.shape)
        for table, base in ((grams, 0), (seen, BUCKETS)):
            a, b = np.nonzero(table)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b + base), pa.array(table[a, b])], names=["lang", "cell", "n"])

    return run


def model_of(langs: list[str], grams: np.ndarray, seen: np.ndarray) -> SimpleNamespace:
    """``logp`` [BUCKETS, languages] of the trigrams and ``may`` [scripts, languages], the candidates of each script.

    A plain namespace, so that executors can read the broadcast without this package installed.
    """
    p = (grams + 0.5) / (grams.sum(axis=1, keepdims=True) + 0.5 * BUCKETS)
    share = seen[:, 1:].T / np.maximum(1, seen[:, 1:].sum(axis=1))
    may = np.vstack([np.ones((1, len(langs)), bool), share >= 0.01])
    known = may.any(axis=1)
    may[~known] = True
    return SimpleNamespace(langs=langs, logp=np.ascontiguousarray(np.log(p).T.astype(np.float32)), may=may, known=known)


def train(docs: DataFrame, learn, train_docs: int = TRAIN_DOCS) -> SimpleNamespace:
    """Model from the rows of ``docs(doc_id, text, lang)`` where ``learn`` holds."""
    known = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(counts, key=lambda x: x.encode())
    if not langs:
        return model_of([], np.zeros((0, BUCKETS)), np.zeros((0, len(script_table()[0]))))
    share = F.lit(0)
    for x in langs:
        share = F.when(F.col("lang") == x, F.lit(min(1_000_000, -(-train_docs * 1_000_000 // counts[x])))).otherwise(share)
    sample = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share).select("lang", "text")
    cells = sample.mapInArrow(_count(langs), "lang long, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros((len(langs), BUCKETS + len(script_table()[0])), np.int64)
    table[cells["lang"].to_numpy(), cells["cell"].to_numpy()] = cells["n"].to_numpy()
    return model_of(langs, table[:, :BUCKETS], table[:, BUCKETS:])


def viterbi(scores: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of each word when each change of label within a document costs ``penalty``.

    ``scores`` is [words, labels], ``first`` the first word of each document
    (length documents + 1).  Pieces of 32 words are solved for every start
    label at once (max-plus products), chained per document, then traced back.
    """
    n, k = scores.shape
    lens = np.diff(first)
    pieces = -(-lens // PIECE)
    if not n:
        return np.zeros(0, np.int64)
    base = np.concatenate([[0], np.cumsum(pieces)])
    total = int(base[-1])
    doc = np.repeat(np.arange(len(lens)), lens)
    within = np.arange(n) - first[:-1][doc]
    slot = (base[:-1][doc] + within // PIECE, within % PIECE)
    g = np.zeros((total, PIECE, k), np.float32)
    g[slot] = scores
    m = np.full((total, k, k), -1e30, np.float32)
    m[:, np.arange(k), np.arange(k)] = 0
    for t in range(PIECE):
        m = np.maximum(m, m.max(axis=2, keepdims=True) - penalty) + g[:, t, None, :]
    order = np.argsort(-pieces, kind="stable")
    active = [int(x) for x in np.searchsorted(-pieces[order], -np.arange(1, int(pieces.max()) + 1), side="right")]
    v0 = np.zeros((total, k), np.float32)
    cur = np.zeros((len(lens), k), np.float32)
    for c, a in enumerate(active):
        d = order[:a]
        p = base[d] + c
        v0[p] = cur[d]
        nxt = (cur[d][:, :, None] + m[p]).max(axis=1)
        cur[d] = nxt - nxt.max(axis=1, keepdims=True)
    v, back = v0, np.empty((PIECE, total, k), np.int16)
    stay = np.arange(k, dtype=np.int16)
    for t in range(PIECE):
        top = v.argmax(axis=1)
        best = v[np.arange(total), top][:, None] - penalty
        back[t] = np.where(v >= best, stay, top[:, None].astype(np.int16))
        v = np.maximum(v, best) + g[:, t]
    start = np.broadcast_to(stay, (total, k)).copy()
    for t in range(PIECE):
        start = np.take_along_axis(start, back[t].astype(np.int64), axis=1)
    last = np.zeros(total, np.int64)
    end = np.zeros(len(lens), np.int64)
    for c in range(len(active) - 1, -1, -1):
        d = order[: active[c]]
        p = base[d] + c
        fresh = pieces[d] == c + 1
        end[d[fresh]] = v[p[fresh]].argmax(axis=1)
        last[p] = end[d]
        end[d] = start[p, end[d]]
    labels = np.empty((total, PIECE), np.int64)
    for t in range(PIECE - 1, -1, -1):
        labels[:, t] = last
        last = back[t][np.arange(total), last].astype(np.int64)
    return labels[slot]


def label(data: np.ndarray, offs: np.ndarray, model: SimpleNamespace, penalty: float = SWITCH):
    """Words, the language index of each word, which words have letters, and which have letters of a learned script."""
    w = Words(data, offs)
    if not len(w):
        return w, np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, bool)
    kind = per_word(scripts(data), w, np.maximum)
    lettered = kind > 0
    can = np.flatnonzero(model.may[np.unique(kind[lettered])].any(axis=0)) if lettered.any() else np.arange(1)  # languages that a word of the block may have
    grams = trigrams(w)
    logp = model.logp[:, can][grams] if len(can) < len(model.langs) else model.logp[grams]
    logp[~w.word] = 0
    s = per_word(logp, w)
    s = np.where(model.may[kind][:, can], s, s.min(axis=1, keepdims=True, initial=0) - 30)
    s[~lettered | ~model.known[kind]] = 0
    return w, can[viterbi(s, w.first, penalty)], lettered, lettered & model.known[kind]


def parts(data: np.ndarray, offs: np.ndarray, size: int):
    """Blocks (first row, bytes, offsets) of a block's rows; a row of over ``size`` bytes in parts, each ending behind a word where there is one."""
    if len(offs) > 2 or len(data) <= size:
        yield data, offs
        return
    at = 0
    while at < len(data):
        end = min(len(data), at + size)
        if end < len(data):
            gap = np.flatnonzero(np.isin(data[at:end], np.frombuffer(b"\x20\t\n\x0b\x0c\r", np.uint8)))
            if len(gap):
                end = at + int(gap[-1]) + 1
            else:  # no word ends here: not inside a character
                while end > at + 1 and data[end] & 0xC0 == 0x80:
                    end -= 1
        yield data[at:end], np.array([0, end - at])
        at = end


def _predict(model, penalty: float):
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("span_lang", pa.list_(pa.string())), ("span_start", pa.list_(pa.int64()))])

    def run(batches):
        got = model.value
        k = len(got.langs)
        names = np.array([*got.langs, "und"], dtype=object)
        size = max(1 << 14, (1 << 21) // max(4, k))
        for batch in batches:
            for lo, hi, data, offs in rows(batch, "text", size):
                n = hi - lo
                ids = batch.column("doc_id").slice(lo, n)
                if not k:
                    empty = pa.array([[]] * n, schema.field(3).type), pa.array([[]] * n, schema.field(4).type)
                    yield pa.RecordBatch.from_arrays([ids, pa.array(["und"] * n), pa.array([0.0] * n), *empty], schema=schema)
                    continue
                votes, words, done, last = np.zeros((n, k), np.int64), np.zeros(n, np.int64), 0, -1
                runs: list[tuple[np.ndarray, ...]] = []  # document, language and first word of each span
                inside = False
                for d, o in parts(data, offs, max(size, PART)):
                    w, lab, lettered, voting = label(d, o, got, penalty)
                    done -= inside and bool(len(d)) and bool(w.word[0])  # goes on with the word that the last part ended in
                    inside = bool(len(d)) and bool(w.word[-1])
                    votes += np.bincount(w.doc[voting] * k + lab[voting], minlength=n * k).reshape(n, -1)
                    words += np.bincount(w.doc[lettered], minlength=n)
                    change = np.ones(len(w), bool)
                    change[1:] = (lab[1:] != lab[:-1]) | (w.doc[1:] != w.doc[:-1])
                    if done and len(w):
                        change[0] = lab[0] != last
                    at = np.flatnonzero(change)
                    runs.append((w.doc[at], lab[at], at - w.first[w.doc[at]] + done))
                    done, last = done + len(w), lab[-1] if len(w) else last  # only a row in parts has more than one turn
                doc, lab, start = (np.concatenate(c) for c in zip(*runs, strict=True)) if runs else (np.zeros(0, np.int64),) * 3
                some = words > 0
                lang = np.where(some, votes.argmax(axis=1), k)
                score = np.where(some, votes.max(axis=1) / np.maximum(1, words), 0.0)
                doc, lab, start = (c[some[doc]] for c in (doc, lab, start))
                cut = pa.array(np.searchsorted(doc, np.arange(n + 1)), pa.int32())
                spans = [pa.ListArray.from_arrays(cut, pa.array(names[lab], pa.string())), pa.ListArray.from_arrays(cut, pa.array(start, pa.int64()))]
                yield pa.RecordBatch.from_arrays([ids, pa.array(names[lang], pa.string()), pa.array(score, pa.float64()), *spans], schema=schema)

    return run


def identify(docs: DataFrame, model: SimpleNamespace, penalty: float = SWITCH) -> DataFrame:
    """(doc_id, lang_pred, score, span_lang, span_start): spans start at word numbers, counted from 0."""
    spark = docs.sparkSession
    return docs.select("doc_id", "text").mapInArrow(
        _predict(spark.sparkContext.broadcast(model), penalty),
        "doc_id long, lang_pred string, score double, span_lang array<string>, span_start array<bigint>",
    )


def _keep(model, penalty: float, min_score: float):
    predict = _predict(model, penalty)

    def run(batches):
        for batch in batches:
            slim = pa.RecordBatch.from_arrays([pa.array(np.zeros(len(batch), np.int64)), batch.column(batch.schema.names.index("text"))], names=["doc_id", "text"])
            got = pa.Table.from_batches(list(predict([slim])))
            ok = (got["lang_pred"].to_numpy() != "und") & (got["score"].to_numpy() >= min_score)
            yield batch.filter(pa.array(ok))

    return run


def keep_identified(docs: DataFrame, model: SimpleNamespace, penalty: float = SWITCH, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` with a language that has at least ``min_score`` of the words; all columns stay, no row moves."""
    return docs.mapInArrow(_keep(docs.sparkSession.sparkContext.broadcast(model), penalty, min_score), docs.schema)


def fold_of(doc_id: str, mod: int):
    return F.crc32(F.col(doc_id).cast("string")) % mod


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.select("doc_id", "text", "lang"), fold_of("doc_id", 5) != 0)
    out = identify(docs, model)
    return out.select("doc_id", (fold_of("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score", F.size("span_lang").alias("n_spans"))
