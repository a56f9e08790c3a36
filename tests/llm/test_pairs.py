"""MinHash, suffix arrays and embeddings against brute force, with edge rows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from cairnspark.llm import minhash, shared, suffixes, textnum, vectors


def groups(ids, links):
    parent = {i: i for i in ids}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text, k):
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode()))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def texts(rnd):
    vocab = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 7))) for _ in range(500)]
    out = [None, "", "  \n\t ", "one", "One", "two words", "TWO   words", "x" * 5000, "ÀÉ àé"]
    for _ in range(40):
        out.append(" ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 60))))
    base = [rnd.choice(vocab) for _ in range(150)]
    for _ in range(60):  # copies with few to many edits, so that links chain
        w = list(base)
        for _ in range(rnd.randint(0, 14)):
            w[rnd.randrange(len(w))] = rnd.choice(vocab)
        out.append(" ".join(w))
    return out + [" ".join(base)] * 7


@pytest.mark.parametrize("k", [2, 5])
def test_minhash_equals_brute_force(spark, k):
    rows = list(enumerate(texts(random.Random(k))))
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, key string, cluster int")
    sets = {i: shingles(t, k) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = groups(list(sets), links)
    for block, few in ((1500, 32), (10, 2)):
        got = {r.doc_id: r for r in minhash.near_duplicates(df, k=k, block=block, few=few).collect()}
        assert {i: r.component_id for i, r in got.items()} == want
        assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
        assert all(r.kept == (i == r.component_id) for i, r in got.items())


def test_minhash_with_repeated_and_null_ids(spark):
    rnd = random.Random(11)
    text = lambda: " ".join("".join(rnd.choice("abcdefg") for _ in range(5)) for _ in range(200))
    a, b, c = text(), text(), text()
    near = lambda t: t.rsplit(" ", 4)[0] + " x y z"
    rows = [(5, a), (5, b), (5, a), (6, near(a)), (7, near(b)), (8, c), (None, c), (None, near(c)), (None, None), (9, ""), (9, " \n"), (10, "solo"), (11, "SOLO"), (12, "z " * 300_000), (13, "z " * 300_001)]
    got = [tuple(r) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=2).collect()]
    want = [(5, 5, True), (5, 5, True), (5, 5, True), (6, 5, False), (7, 5, False), (8, 8, True), (None, 8, False), (None, 8, False), (None, None, True), (9, 9, True), (9, 9, True), (10, 10, True), (11, 10, False), (12, 12, True), (13, 12, False)]
    assert sorted(((i, m, k) for i, _, m, k in got), key=str) == sorted(want, key=str)


def test_minhash_of_an_empty_table(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_few_edges_are_finished_in_one_task(spark):
    rnd = random.Random(5)
    links = [(1, i) for i in range(2, 200)] + [(1000 + i, 1001 + i) for i in range(300)] + [(7, 7), (7, None), (None, None)]
    links += [(rnd.randint(5000, 5400), rnd.randint(5000, 5400)) for _ in range(250)] + [(-3, 9000), (9000, 1 << 40)] * 2
    rnd.shuffle(links)
    want = groups({x for a, b in links for x in (a, b) if None not in (a, b)}, [x for x in links if None not in x])
    edges = spark.createDataFrame(links, "a long, b long").repartition(6)
    sc, jobs = spark.sparkContext, {}
    for most in (shared.LOCAL_EDGES, 0):
        sc.setJobGroup(f"components-{most}", "")
        rows = shared.components(edges, local_edges=most).collect()
        jobs[most] = len(sc.statusTracker().getJobIdsForGroup(f"components-{most}"))
        sc.setLocalProperty("spark.jobGroup.id", None)
        assert {r.node: r.root for r in rows} == {x: r for x, r in want.items() if x != r} and len(rows) == len({r.node for r in rows})
    assert jobs[shared.LOCAL_EDGES] <= 6 < jobs[0], jobs
    assert shared.components(edges.limit(0)).collect() == []


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 900, dtype=np.uint64)
    a, b = np.unique(pool[:600]), np.unique(pool[300:])
    sig = minhash.superminhash([a, b, np.zeros(0, np.uint64), a[:3]], 160)
    assert abs((sig[0] == sig[1]).mean() - 1 / 3) < 0.12
    assert np.isinf(sig[2]).all() and np.isfinite(sig[3]).all()
    assert (np.floor(sig[0]) < 5).all()  # early stopping leaves only small ranks


def test_links_within_a_group():
    rnd = random.Random(5)
    sets = [np.unique(np.array([rnd.randrange(60) for _ in range(rnd.randint(0, 50))], dtype=np.uint64)) for _ in range(80)]
    links = [(i, j) for i in range(80) for j in range(i) if len(sets[i]) and len(sets[j]) and 10 * len(np.intersect1d(sets[i], sets[j])) >= 5 * len(np.union1d(sets[i], sets[j]))]
    want = groups(range(80), links)
    assert minhash.linked_within(sets, 50).tolist() == [want[i] for i in range(80)]


def test_word_hashes_and_blocks():
    import pyarrow as pa

    col = pa.array([None, "", "Aa bB", "aa bb", "é" * 9000, "x y z"])
    data, offs = textnum.as_bytes(col)
    w = textnum.Words(data, offs)
    h = w.hashes()
    assert np.diff(w.first).tolist() == [0, 0, 2, 2, 1, 2]
    assert h[0] == h[2] and h[1] == h[3] and h[0] != h[1]
    assert list(textnum.blocks(offs, 10)) == [(0, 4), (4, 5), (5, 6)]
    assert textnum.as_bytes(col.slice(2, 2))[1].tolist() == [0, 5, 10]


def brute_repeats(rows, span):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[i : i + span] for _, b in raw for i in range(len(b) - span + 1))
    out = []
    for d, b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - span + 1):
            if seen[b[i : i + span]] > 1:
                gone[i : i + span] = True
        out.append((d, len(b), int(gone.sum()), len(suffixes.runs(gone)[0]), hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out, key=str)


def test_suffix_array_is_sorted():
    rnd = random.Random(3)
    for _ in range(200):
        t = bytes(rnd.choice(b"ab\xc3\xff\x00") for _ in range(rnd.randint(1, 70)))
        assert suffixes.suffix_array(t, len(t) + 1).tolist() == sorted(range(len(t)), key=lambda i: t[i:])


@pytest.mark.parametrize("most", [512, 4])
def test_suffix_dedup_equals_brute_force(spark, most):
    rnd = random.Random(2)
    text = lambda n: "".join(rnd.choice("abcdefgh ijklé") for _ in range(n))
    passage = text(260)
    rows = [(i, text(rnd.randint(0, 150)) + passage + text(rnd.randint(0, 150))) for i in range(30)]
    rows += [(50, None), (51, ""), (52, "a" * 700), (53, "ab" * 400), (54, text(199)), (55, passage[:200]), (56, "b" + "a" * 300), (57, text(900)), (58, rows[3][1])]
    rows += [(60 + i, text(90) + passage[i : i + 205] + text(50)) for i in range(20)]
    rows += [(57, text(700)), (57, text(40) + passage + text(30)), (58, rows[3][1]), (58, text(300)), (None, text(260)), (None, text(20) + passage)]  # repeated and null ids
    df = spark.createDataFrame([(i, t, 5, "x") for i, t in rows], "doc_id long, text string, h int, tag string")
    got = sorted((tuple(r) for r in suffixes.dedup(df, most=most).collect()), key=str)
    assert got == brute_repeats(rows, 200)
    assert suffixes.dedup(df.limit(0)).count() == 0


@pytest.mark.parametrize("most", [512, 3])
def test_suffix_dedup_of_a_passage_in_many_texts(spark, monkeypatch, most):
    kind = type(spark.range(1))
    made, plain = [], kind.mapInArrow

    def counted(df, func, schema, *more, **options):
        n = spark.sparkContext.accumulator(0)
        made.append(n)

        def run(batches):
            for b in func(batches):
                n.add(b.num_rows)
                yield b

        return plain(df, run, schema, *more, **options)

    monkeypatch.setattr(kind, "mapInArrow", counted)
    rnd = random.Random(9)
    text = lambda n: "".join(rnd.choice("abcdefgh ijklé") for _ in range(n))
    passage, other = text(260), text(230)
    rows = [(i, text(150) + passage + (other if i % 50 == 0 else "") + text(150)) for i in range(700)]
    rows += [(800, passage), (801, "x" + passage[:200]), (802, passage[60:] + "y"), (803, text(30) + other + "z" * 450), (804, rows[4][1]), (805, rows[4][1][100:430])]
    got = sorted((tuple(r) for r in suffixes.dedup(spark.createDataFrame(rows, "doc_id long, text string"), most=most).collect()), key=str)
    assert got == brute_repeats(rows, 200)
    assert max(n.value for n in made) < 20 * len(rows)  # rows for pieces, not for each of their hundred windows


def test_suffix_dedup_settles_when_every_anchor_is_split(spark):
    rnd = random.Random(12)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(215))
    rows = [(i, passage[: 180 + i % 36] + chr(97 + i % 7) * (i % 40) + passage[i % 15 :]) for i in range(120)] + [(200 + i, "ab" * (90 + i)) for i in range(25)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for gram in (8, 64, 199, 200):
        assert sorted((tuple(r) for r in suffixes.dedup(df, most=1, gram=gram).collect()), key=str) == brute_repeats(rows, 200)


def test_suffix_dedup_reads_long_texts_in_segments(spark):
    rng = np.random.default_rng(8)
    long = bytes(rng.integers(97, 123, 2_600_000, dtype=np.uint8)).decode()
    cut = suffixes.SEGMENT  # passages across and beside the segments' borders
    rows = [(1, long), (2, "x" * 50 + long[cut - 300 : cut + 300] + "y" * 50), (3, long[2 * cut - 200 : 2 * cut]), (4, long[2 * cut : 2 * cut + 200]), (5, long[-200:] + long[:200]), (6, long[1000:1199])]
    got = {r.doc_id: r for r in suffixes.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    gone = [(0, 200), (cut - 300, cut + 300), (2 * cut - 200, 2 * cut + 200), (len(long) - 200, len(long))]
    assert (got[1].n_removed, got[1].n_spans) == (sum(b - a for a, b in gone), 4)
    kept = "".join(long[a:b] for a, b in zip([0] + [b for _, b in gone], [a for a, _ in gone] + [len(long)], strict=True))
    assert got[1].kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()
    assert [got[i].n_removed for i in range(2, 7)] == [600, 200, 200, 400, 0]


def test_embeddings_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(900, 1, None), (901, 1, [0.0] * 64), (902, 1, [float("nan")] * 64), (903, None, [1.0] * 64), (904, 1, [1.0, None] * 32), (905, 1, [float("inf")] * 64), (906, 1, [2.0, 1.0]), (907, 1, [4.0, 2.0])]
    centers = rng.standard_normal((6, 64))
    for i in range(300):
        v = rng.standard_normal(64) if i % 3 else centers[i % 6] + rng.standard_normal(64) * rng.choice([0.05, 0.12, 0.2])
        rows.append((i, int(i % 2), v.astype(np.float32).tolist()))
    rows += [(1000 + i, 0, rows[20][2]) for i in range(9)] + [(1100, 0, [2 * x for x in rows[20][2]]), (1101, 1, rows[20][2])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, label int, embedding array<float>, key string")
    ok = {i: (lab, np.array(v, np.float64)) for i, lab, v in rows if lab is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)}
    links = [(a, b) for a in ok for b in ok if a < b and ok[a][0] == ok[b][0] and len(ok[a][1]) == len(ok[b][1]) and ok[a][1] @ ok[b][1] / np.linalg.norm(ok[a][1]) / np.linalg.norm(ok[b][1]) >= 0.98]
    want = groups([r[0] for r in rows], links)
    n = Counter(x for link in links for x in link)
    for block in (2048, 7):
        got = {r.vec_id: r for r in vectors.near_duplicates(df, block=block).collect()}
        assert {i: r.component_id for i, r in got.items()} == want
        assert {i: r.n_links for i, r in got.items()} == {i: n[i] for i in want}
    assert vectors.near_duplicates(df.limit(0)).count() == 0


def test_embeddings_with_repeated_and_null_ids(spark):
    rng = np.random.default_rng(6)
    a, b, c = (rng.standard_normal(16) for _ in range(3))
    near = lambda v: (v + rng.standard_normal(16) * 0.01).astype(np.float32).tolist()
    rows = [(1, 1, near(a)), (1, 1, near(b)), (2, 1, near(a)), (3, 1, near(b)), (4, 2, near(a)), (5, 1, near(c)), (None, 1, near(c)), (None, None, near(c)), (6, 1, None)]
    rows += [(7, 1, rows[0][2]), (1, 1, rows[0][2])]  # a copy of the first, and that row again
    got = [tuple(r) for r in vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")).collect()]
    want = [(1, 3, 1, True), (1, 1, 1, True), (2, 3, 1, False), (3, 1, 1, False), (4, 0, 4, True), (5, 1, 5, True), (None, 1, 5, False), (None, 0, None, True), (6, 0, 6, True), (7, 3, 1, False), (1, 3, 1, True)]
    assert sorted(got, key=str) == sorted(want, key=str)
