"""Language ID, line dedup, licences, decontamination, toxicity, mixing, WARC and the pipeline."""

import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cairnspark.llm import decontam, langid, licenses, line_dedup, mixing, toxicity, warc
from cairnspark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def same_as_sql(df, sql, **tables):
    con = duckdb.connect()
    for name, rows in tables.items():
        con.register(f"_{name}", rows.toPandas() if not isinstance(rows, str) else duckdb.read_parquet(rows).df())
        con.execute(f"create view {name} as select * from _{name}")
    a, b = df.toPandas(), con.execute(sql).df()
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    a, b = (x[cols].sort_values(cols).reset_index(drop=True) for x in (a, b))
    assert len(a) == len(b)
    for c in cols:
        assert ((a[c] == b[c]) | (a[c].isna() & b[c].isna())).all(), c


TEXTS = "doc_id long, text string, leaf string, gone string, w int"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    table = "pages" if "warc" in name else "embeddings" if "embedding" in name else "documents"
    same_as_sql(QUERIES[name](spark, SF), ORACLES[name], **{table: f"{SF}/{table}.parquet"})


def edge_lines():
    rows = [(0, None), (1, ""), (2, "\n\n"), (3, "a b"), (4, "lone line of four words\r\nx")]
    for i in range(30):
        rows.append((10 + i, f"head number{i} unique-{i} wordswords{i}\nPosted by user{i} on day {i * 7} under news\nshared footer of all\nshared footer of all\nbody{i} {'z' * i} longlongword{i}"))
    rows += [(100 + i, "copied document withlongwords here\nanother copied line of it") for i in range(40)]
    return rows + [(10, "x\nshared footer of all"), (10, "repeated id\nshared footer of all"), (200, "w " * 60_000 + "\nshared footer of all\n\tend")]


@pytest.mark.parametrize("small", [False, True])
def test_line_dedup_edges_and_sql(spark, small):
    df = spark.createDataFrame([(i, t, "l", "g", 1, 7, "k") for i, t in edge_lines()], TEXTS + ", n_lines int, kept string")
    found = line_dedup.recurring(df, **(dict(broadcast_bytes=0, lookup_bytes=0) if small else {}))
    lookup = 0 if small else line_dedup.LOOKUP_BYTES
    every = line_dedup.drop_lines(df, found, lookup).collect()
    out = {r.doc_id: r for r in every if r.doc_id != 10}
    assert len(every) == len(edge_lines())
    assert out[0].text is None and out[0].kept is None and out[0].n_lines == 0
    assert out[1].n_lines == 1 and out[2].kept == "\n\n"
    assert out[15].n_lines == 5 and "footer" not in out[15].kept and "Posted" not in out[15].kept and out[15].kept.startswith("head")
    assert out[110].kept == out[110].text  # copies of one document are no recurrence
    assert out[200].kept == "w " * 60_000 + "\n\tend"
    assert {r.kept for r in every if r.doc_id == 10} >= {"x", "repeated id"}
    assert {r.gone for r in every} == {"g"}
    got = line_dedup.drop_lines(df, found, lookup).select("doc_id", "n_lines", "n_lines_kept", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))
    same_as_sql(got, line_dedup.OP9_SQL, documents=df.select("doc_id", "text"))
    none = line_dedup.recurring(df.limit(0))
    assert line_dedup.hits(none).count() == 0 and line_dedup.drop_lines(df.limit(0), none, lookup).count() == 0
    assert line_dedup.drop_lines(df, none, lookup).where("n_lines <> n_lines_kept").count() == 0


def test_line_dedup_drops_a_long_footer_of_short_documents(spark):
    footer = "Copyright notice: " + " ".join(f"boilerplate{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(40))
    menu = "\n".join(["home news sport weather travel", "about contact imprint privacy terms", "follow us on all channels"])
    rnd = random.Random(3)
    body = lambda: " ".join("".join(rnd.choice("aeioustrnl") for _ in range(5)) for _ in range(6))
    rows = [(i, f"{body()}\n{footer}") for i in range(300)] + [(1000 + i, f"{menu}\n{body()}\n{footer}") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = line_dedup.drop_lines(df, line_dedup.recurring(df))
    got = {r.doc_id: r.kept for r in out.collect()}
    assert all(got[i] == t.split("\n")[-2] for i, t in rows)


def test_licenses_edges_and_sql(spark):
    import textwrap

    full = {i: t for i, _, t in licenses.TEMPLATES}
    wrapped = textwrap.wrap(full[17], 72)
    code = [f"int value_{i} = compute({i}) + the_result;" for i in range(60)]
    rows = [(0, None), (1, ""), (2, "x"), (3, "Licensed under the Apache License, Version 2.0.\nhello"), (4, "ALL RIGHTS RESERVED!"), (5, "licensed under CC BY-NC 4.0\nlicensed under CC BY-NC 4.0"), (6, "word " * 9000)]
    rows += [(7, full[5]), (8, "Licensed under the Apache Software License, Version 2.0 today")]
    rows += [(9, "\n".join(["/* header", *[" * " + x for x in wrapped], " */", *code]))]  # above 60 lines of code
    rows += [(10, "\n".join([*code, "", *["# " + x for x in textwrap.wrap(full[20], 60)], *code, "All rights reserved.", *textwrap.wrap(full[22], 90)]))]
    rows += [(3, "no licence"), (3, "All rights reserved."), (3, "All rights reserved."), (None, "Released under the MIT License."), (11, "\n".join(code * 40 + wrapped + ["of the software"] * 500)), (12, full[18].replace(" ", "\n"))]
    df = spark.createDataFrame([(*r, "l", "g", 1) for r in rows], "doc_id long, text string, license string, first_line string, dice int")
    got = licenses.scan(df)
    found = sorted(((r.doc_id, r.first_line, r.last_line, r.license) for r in got.collect()), key=str)
    last = len(rows[10][1].split("\n")) - 1
    n20, n22 = len(textwrap.wrap(full[20], 60)), len(textwrap.wrap(full[22], 90))
    want = [(3, 0, 0, "Apache-2.0"), (4, 0, 0, "proprietary"), (5, 0, 0, "CC-BY-NC-4.0"), (5, 1, 1, "CC-BY-NC-4.0"), (7, 0, 0, "MIT"), (9, 1, len(wrapped), "MIT")]
    want += [(10, 61, 60 + n20, "BSD-3-Clause"), (10, last - n22, last - n22, "proprietary"), (10, last - n22 + 1, last, "GPL-3.0"), (3, 0, 0, "proprietary"), (3, 0, 0, "proprietary"), (None, 0, 0, "MIT")]
    want += [(11, 2400, 2399 + len(wrapped), "MIT"), (12, 0, len(full[18].split()) - 2, "ISC")]  # its last bigram is a repeated one
    assert found == sorted(want, key=str)
    same_as_sql(got, licenses.OP3_SQL, documents=df.select("doc_id", "text"))
    assert licenses.scan(df.limit(0)).count() == 0 and licenses.scan(df, []).count() == 0


def brute_viterbi(s, penalty):
    v, back = np.zeros(s.shape[1]), []
    for row in s:
        options = v[:, None] - penalty * (1 - np.eye(len(v)))
        back.append(options.argmax(axis=0))
        v = options.max(axis=0) + row
    path = [int(v.argmax())]
    for b in back[:0:-1]:
        path.append(int(b[path[-1]]))
    return v.max(), path[::-1]


def test_viterbi_finds_a_best_path():
    rng = np.random.default_rng(0)
    lens = [0, 1, 31, 32, 33, 200, 0, 5]
    first = np.concatenate([[0], np.cumsum(lens)])
    s = rng.normal(0, 3, (first[-1], 3)).astype(np.float32)
    got = langid.viterbi(s, first, 4.0)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b > a:
            best, _ = brute_viterbi(s[a:b].astype(float), 4.0)
            lab = got[a:b]
            score = s[np.arange(a, b), lab].sum() - 4.0 * (np.diff(lab) != 0).sum()
            assert score == pytest.approx(best, abs=1e-3)


def test_language_id(spark):
    out = {r.doc_id: r for r in QUERIES["op4_language_id"](spark, SF).collect()}
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert set(out) == set(docs)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in out.items())
    held = [i for i, r in out.items() if r.held_out]
    assert np.mean([out[i].lang_pred == docs[i] for i in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in out.values())


def test_language_id_edges(spark):
    rnd = random.Random(1)
    en, ru = ["the", "and", "house", "river", "of"], ["дом", "река", "и", "это", "не"]
    rows = [(i, " ".join(rnd.choice(en if i % 2 else ru) for _ in range(30)), "en" if i % 2 else "ru", 3) for i in range(40)]
    learn = spark.createDataFrame(rows, "doc_id long, text string, lang string, k int")
    model = langid.train(learn, F.lit(True))
    mixed = "the house and the river of the house дом и река это не дом река"
    ask = spark.createDataFrame([(0, None), (1, ""), (2, "123 !!"), (3, mixed), (4, "дом река"), (5, "the and " * 20000), (6, "漢字 漢")], "doc_id long, text string")
    got = {r.doc_id: r for r in langid.identify(ask, model).collect()}
    assert [got[i].lang_pred for i in range(6)] == ["und", "und", "und", "en", "ru", "en"]
    assert got[3].span_lang == ["en", "ru"] and got[3].span_start == [0, 8]
    assert got[6].lang_pred != "und" and got[0].score == 0
    assert {r.doc_id for r in langid.keep_identified(ask, model).collect()} >= {3, 4, 5}
    empty = langid.train(learn.limit(0), F.lit(True))
    assert {r.lang_pred for r in langid.identify(ask, empty).collect()} == {"und"}
    assert langid.identify(ask.limit(0), model).count() == 0


def test_language_id_labels_many_languages_and_scripts(spark):
    rnd = random.Random(4)
    vocab = {f"l{j:02d}": ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(25)] for j in range(20)}
    vocab |= {"te": ["తెలుగు", "భాష", "నది", "ఇల్లు"], "am": ["አማርኛ", "ወንዝ", "ቤት"], "km": ["ភាសា", "ខ្មែរ", "ទន្លេ"], "got": ["𐌲𐌿𐍄𐌹𐍃𐌺", "𐍂𐌰𐌶𐌳𐌰", "𐌰𐍈𐌰"], "zh": ["汉字", "河流", "房子"]}
    text = lambda lang, n: " ".join(rnd.choice(vocab[lang]) for _ in range(n))
    rows = [(100 * j + i, text(lang, 25), lang, "x") for j, lang in enumerate(vocab) for i in range(30)]
    learn = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    model = langid.train(learn, F.lit(True))
    langs = list(vocab)
    rnd.shuffle(langs)
    ask = [(i, text(lang, 20)) for i, lang in enumerate(langs)] + [(50, " ".join(text(x, 30) for x in langs)), (51, "ગુજરાતી ભાષા"), (51, None), (52, text("te", 9) + " ગુજરાતી ગુજરાતી"), (53, " ".join(["ab" * 400_000, text("l03", 200_000), text("zh", 150_000)]))]
    out = langid.identify(spark.createDataFrame(ask, "doc_id long, text string"), model).collect()
    got = {r.doc_id: r for r in out}
    assert len(out) == len(ask)
    assert [got[i].lang_pred for i in range(len(langs))] == langs
    assert got[50].span_lang == langs and got[50].span_start == [30 * i for i in range(len(langs))]  # 25 languages in one text
    assert sorted((r.lang_pred, r.score) for r in out if r.doc_id == 51) == [("am", 0.0), ("und", 0.0)]
    assert got[52].lang_pred == "te" and got[52].score == pytest.approx(9 / 11)
    assert got[53].lang_pred == "l03" and got[53].span_lang[-2:] == ["l03", "zh"] and got[53].span_start[-1] == 200_001
    kept = langid.keep_identified(learn.limit(40).unionByName(learn.limit(1).withColumn("text", F.lit("ગુજરાતી"))), model)
    assert kept.columns == learn.columns and kept.count() == 40


def test_decontamination_catches_reparameterised_questions(spark):
    item = "A train leaves the old station at 10 km per hour and then Alice Smith counts 25 red wagons before the bridge."
    swap = "Some intro. A train leaves the old station at 90 km per hour and then Bob Jones counts 77 red wagons before the bridge. End."
    mangled = "A train leaves the new harbour at 10 km each day while Alice counts blue boats."
    items = spark.createDataFrame([(1, item, 0), (2, "short odd item", 0), (3, None, 0), (4, "", 0)], "item_id long, text string, h int")
    rows = [(0, None), (1, ""), (2, item), (3, swap), (4, mangled), (5, "here is a short odd item inside"), (6, "w " * 50000 + item), (7, item + " " + item)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, h int")
    for bound in ({}, {"broadcast_bytes": 0}, {"set_bits": 3}):  # broadcast, the shuffled join, and a bit set that lets all pass
        got = {r.doc_id: r for r in decontam.decontaminate(docs, items, **bound).collect()}
        assert {i for i, r in got.items() if r.contaminated} == {2, 3, 5, 6, 7}
        assert got[2].exact and not got[3].exact and got[3].item_ids == [1] and got[5].item_ids == [2]
    assert not any(r.contaminated for r in decontam.decontaminate(docs, items.limit(0)).collect())
    assert decontam.decontaminate(docs.limit(0), items).count() == 0


def test_decontamination_judges_each_occurrence(spark):
    ask = "A train leaves the old station at {} km per hour and then {} counts {} red wagons before the bridge."
    fills = [(10 * i + 7, name, 100 + i) for i, name in enumerate(["Alice Smith", "Bob Jones", "Carol", "Dan", "Eve Adams", "Frank"])]
    sheet = "\n".join(ask.format(*f) for f in fills)
    edited = "\n".join(ask.format(*f).replace("and then", "and then quite suddenly") for f in fills[1:])
    scattered = "\n".join(f"The train leaves the old station at {i} km per hour and then stops." for i in range(40))
    items = spark.createDataFrame([(i, ask.format(*f)) for i, f in enumerate(fills[:3])], "item_id long, text string")
    docs = spark.createDataFrame([(0, sheet), (1, "\n".join(sheet.split("\n")[1:])), (2, edited), (3, sheet + "\n" + scattered)], "doc_id long, text string")
    for bound in (1 << 20, 0):
        got = {(r.doc_id, r.item_id): r for r in decontam.matches(docs, items, broadcast_bytes=bound).collect()}
        assert set(got) == {(d, i) for d in range(4) for i in range(3)}
        assert {k for k, r in got.items() if r.exact} >= {(0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (3, 0)} and not got[1, 0].exact


def test_decontamination_of_variants_repeated_rows_and_items(spark):
    ask = "In the village of {} a miller sold {} sacks of flour for {} dollars each and kept {} for the winter months."
    fill = lambda i: ask.format(["Ashford", "Bexley", "Corby", "Dover", "Epsom", "Frome"][i], 11 * i + 3, 7 * i + 2, 5 * i + 9)
    plain = "Nobody in the valley could say when the old bridge had been built, and few of them cared to ask."
    rows = [(n, "\n".join(["Worksheet.", *[fill(i) for i in range(1, n + 1)], plain])) for n in range(1, 6)]
    rows += [(10, plain), (10, plain), (11, fill(0)), (11, fill(0)), (12, plain), (12, fill(2)), (None, fill(0)), (13, plain * 3000 + fill(0) + plain * 3000)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, h int, item_id string")
    items = spark.createDataFrame([(1, fill(0)), (1, fill(0)), (2, fill(0))], "item_id long, text string")
    out = decontam.decontaminate(docs, items).collect()
    assert len(out) == len(rows)
    assert {r.doc_id for r in out if r.contaminated} == {1, 2, 3, 4, 5, 11, 12, 13}
    assert all(r.item_ids == [1, 2] for r in out if r.contaminated)
    assert {r.doc_id for r in out if r.exact} == {11, 13}


def brute_tokens(text, merge=True):
    """Template tokens by regular expressions, for ASCII texts."""
    numbers, units = set(decontam.NUMBER_WORDS), set(decontam.UNIT_WORDS)
    out, last = [], 0
    for m in re.finditer(r"[A-Za-z0-9](?:[A-Za-z0-9]|(?<=[0-9])[.,](?=[0-9]))*", text):
        w, opens = m.group(), not out or re.search(r"[.!?:;\n\r|]", text[last : m.start()])
        last = m.end()
        low = w.lower()
        if re.search("[0-9]", w) or low in numbers:
            kind = "NUM"
        elif low in units:
            kind = "UNIT"
        elif w[0].isupper() and not opens and len(w) > 1:
            kind = "NAME"
        else:
            kind = low
        if merge and kind == "NAME" and out and out[-1][0] == "NAME":
            out[-1] = ("NAME", out[-1][1] + " " + low)
        else:
            out.append((kind, low))
    return out


def test_decontamination_equals_brute_force_on_windows(spark):
    rnd = random.Random(12)
    words = ["river", "stone", "counts", "before", "Alice", "Bob Jones", "12", "7.5", "three", "km", "the", "old", "wagon.", "and", "So"]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    items = [(i, text(rnd.randint(12, 30))) for i in range(25)]
    docs = [(i, text(30) + " " + (" ".join(items[i % 25][1].split(" ")[: 8 + i % 20]) if i % 3 else "") + " " + text(10)) for i in range(120)]
    kinds = {"NUM", "UNIT", "NAME"}

    def windows(text):
        toks = brute_tokens(text)
        out = {}
        for i in range(len(toks) - 7):
            w = toks[i : i + 8]
            if sum(k not in kinds for k, _ in w) >= 3:
                out.setdefault(tuple(k for k, _ in w), []).append((i, [v for k, v in w if k in kinds]))
        return out, len(toks)

    got = {(r.doc_id, r.item_id): r for r in decontam.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    every = [(i, *windows(t)) for i, t in items]
    seen = 0
    for d, t in docs:
        dw, _ = windows(t)
        for i, iw, n in every:
            if n < 8 or not iw:
                continue
            hits = [{"doc_pos": p, "item_pos": q, "h": h, "g": True, "item_slots": a, "doc_slots": b} for h in iw for q, a in iw[h] for p, b in dw.get(h, [])]
            best = max((len({m["h"] for m in hits if m["doc_pos"] - m["item_pos"] == s}) / len(iw) for s in {m["doc_pos"] - m["item_pos"] for m in hits}), default=0)
            same = any(
                len({m["h"] for m in run}) >= 0.25 * len(iw) and all(m["item_slots"] == m["doc_slots"] for m in run)
                for run in ([m for m in hits if m["doc_pos"] - m["item_pos"] == s] for s in {m["doc_pos"] - m["item_pos"] for m in hits})
            )
            if same and best >= 0.25:  # a copy of a quarter of the item's windows, slots and all
                seen += 1
                assert got[d, i].exact
            if len({m["h"] for m in hits}) < 0.25 * len(iw):
                few = got.get((d, i))
                assert few is None or any(sum(k not in kinds for k, _ in w) < 3 for w in zip(*[brute_tokens(items[i][1], False)[j:] for j in range(8)]))
    assert seen > 30


def test_decontamination_finds_items_without_literals_and_spaces(spark):
    texts = ["What is 15 + 27?", "7 km 12 kg 9 ml 14 mm 3 days 18 hours 21 km 4 weeks 16 tons", "2 + 2", "小明有十五个苹果，他又买了二十七个苹果，现在一共有多少个苹果？", "รถไฟออกจากสถานีเก่าตอนเช้า", "Alice Smith and Bob Jones"]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    rows = [f"Here is one more for you. {t} And that is the end of it." for t in texts] + ["What is 15 + 28? 2 + 2 = 4, as 7 km 12 kg.", "小红有三本书。", "ALICE SMITH and Bob met.", "the question what is 15 + 27 was asked", "小学老师说：" + texts[3] + "请回答。", ""]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    docs = docs.where("doc_id <> 2").union(spark.createDataFrame([(2, "Solve this:\n2 + 2\nThen go on.")], docs.schema))
    for bound in (1 << 20, 0):
        got = {(r.doc_id, r.item_id): r for r in decontam.matches(docs, items, broadcast_bytes=bound).collect()}
        assert set(got) == {(i, i) for i in range(6)} | {(9, 0), (10, 3)}
        assert all(r.exact for r in got.values())


def test_toxicity_learns_and_ignores_identity_terms(spark):
    rnd = random.Random(7)
    words = ["tree", "river", "stone", "music", "cloud", "paper"]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        w = [rnd.choice(words) for _ in range(12)] + (["idiot" if i % 8 else "moronic"] if toxic else [])
        if rnd.random() < (0.6 if toxic else 0.1):  # a biased sample: groups are named more often in toxic texts
            w.append("muslims")
        rnd.shuffle(w)
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    ask = spark.createDataFrame([(0, None), (1, ""), (2, "river muslims stone"), (3, "river idiot stone"), (4, "tree women music")], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(ask, toxicity.train(docs, lab)).collect()}
    assert got[3] >= 0.7 and max(got[i] for i in (0, 1, 2, 4)) < 0.5
    plain = {r.doc_id: r.score for r in toxicity.score(ask, toxicity.train(docs, lab, cf=0.0)).collect()}
    assert abs(got[2] - got[4]) < 0.25 * abs(plain[2] - plain[4])
    neutral = ["We met some Muslims at the river", "The women read the paper", "young people like music"]
    fair, biased = (toxicity.gap(neutral, toxicity.train(docs, lab, cf=cf)) for cf in (1.0, 0.0))
    assert fair[0] < 0.02 and fair[1] < 0.1 and biased[1] > 2 * fair[1]
    none = {r.score for r in toxicity.score(ask, toxicity.train(docs, lab.where("toxic = 0"))).collect()}
    assert none == {0.0}


def test_toxicity_swaps_terms_in_sentences():
    assert toxicity.naming("Old trees. The women sang!\nNothing here") == ["Old trees", " The women sang"]
    for turn in range(40):
        new = toxicity.swapped("The Women met muslim friends, überall", turn)
        a, b = new.split()[1], new.split()[3]
        assert a != "Women" and a[0].isupper() and a.lower() in toxicity.IDENTITY_TERMS[0]
        assert b != "muslim" and b in toxicity.IDENTITY_TERMS[1] and new.endswith("friends, überall")
    pairs = toxicity.counterfactuals("x. Muslims are muslims. y", 2)
    assert len(pairs) == 2
    for lost, won in pairs:  # features of a copy are those of its own words
        assert set(lost) <= set(toxicity.text_features("muslims")) and len(lost) and len(won)


def test_toxicity_edges(spark):
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice(["tree", "river", "stone"]) for _ in range(9)) + (" moron idiot" if i % 3 == 0 else ""), "s") for i in range(300)]
    labels = [(i, int(i % 3 == 0), 1) for i in range(300)] + [(7, None, 1), (0, 0, 1), (1, 0, 1), (500, 1, 0)]  # ties of an id: toxic counts
    docs = spark.createDataFrame(rows + [(1, "a second text of id one", "s")], "doc_id long, text string, score string")
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int, text int"))
    ask = [(0, None), (0, ""), (1, "tree moron idiot"), (1, "tree moron idiot"), (2, "tree " * 100_000), (3, "tree " * 100_000 + "moron idiot"), (None, "river")]
    out = toxicity.score(spark.createDataFrame([(*r, 0.5) for r in ask], "doc_id long, text string, score double"), model).collect()
    got = sorted(((r.doc_id, r.score >= 0.7) for r in out), key=str)
    assert got == sorted([(0, False), (0, False), (1, True), (1, True), (2, False), (3, True), (None, False)], key=str)
    assert all(0 <= r.score <= 1 for r in out)
    assert len({r.score for r in out if r.doc_id == 0}) == 1 and len({r.score for r in out if r.doc_id == 1}) == 1
    assert sorted(r.score for r in out) == pytest.approx(sorted(toxicity.score_text(t or "", model) for _, t in ask))
    assert toxicity.score(docs.limit(0), model).count() == 0
    assert toxicity.train(docs.limit(0), spark.createDataFrame(labels, "doc_id long, toxic int, text int")) is None


def test_toxicity_query_on_held_out_labels(spark):
    out = {r.doc_id: r for r in QUERIES["op5_toxicity"](spark, "/root/testdata/sf0.1").collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    held = [i for i in labels if out[i].held_out and labels[i] is not None]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) for i, r in out.items())
    toxic, clean = [i for i in held if labels[i]], [i for i in held if not labels[i]]
    assert np.mean([out[i].predicted for i in toxic]) > 0.85 and np.mean([out[i].predicted for i in clean]) < 0.02


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, free = {}, float(sum(sizes.values())), set(names)
    while free:
        level = left / sum(w[s] for s in free)
        over = [s for s in free if level * w[s] >= cap * sizes[s]]
        if not over:
            return target | {s: level * w[s] for s in free}
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
            free.remove(s)
    return target


def test_mixing_meets_targets(spark):
    rnd = random.Random(9)
    rows = [(i, rnd.choice(["a", "a", "a", "b", "c", None, "é"]), " ".join(["w"] * int(rnd.paretovariate(1.1) * 5))) for i in range(1500)]
    rows += [(2000, "zero", None), (2001, "zero", ""), (2002, "big", "w " * 40), (2003, "a", None)]
    df = spark.createDataFrame([(*r, 1.0, 2) for r in rows], "doc_id long, source string, text string, target double, size int")
    for block in (4096, 100):
        out = mixing.mix_sources(spark, df, block_rows=block).collect()
        assert sorted(r.doc_id for r in out) == sorted(r[0] for r in rows)
        sizes = {}
        for i, s, t in rows:
            sizes[s] = sizes.get(s, 0) + len((t or "").split())
        want = brute_targets(sizes)
        by_id = {r[0]: r[1] for r in rows}
        taken = dict.fromkeys(sizes, 0)
        for r in out:
            assert 0 <= r.copies <= 3 and r.target == pytest.approx(want[by_id[r.doc_id]])
            taken[by_id[r.doc_id]] += r.copies * r.size
        assert all(math.isclose(taken[s], want[s], rel_tol=0.02, abs_tol=2) for s in sizes)
    again = mixing.mix_sources(spark, df.repartition(7), block_rows=100).collect()
    assert {(r.doc_id, r.copies) for r in again} == {(r.doc_id, r.copies) for r in out}
    assert mixing.mix_sources(spark, df.limit(0)).count() == 0


def test_flight_keeps_totals_and_expectations():
    rng = np.random.default_rng(3)
    x = rng.integers(1, 50, 40).astype(float)
    pi = rng.uniform(0.1, 0.9, 40)
    for fly in (mixing.flight, lambda p, x, r: mixing.flight(mixing.carry(p, x, r, np.arange(10)), x, r)):
        runs = [fly(pi, x, np.random.default_rng(i)) for i in range(1500)]
        for r in runs[:50]:
            assert ((r > 0) & (r < 1)).sum() <= 2
            assert r @ x == pytest.approx(pi @ x) and r.sum() == pytest.approx(pi.sum())
        assert np.abs(np.mean(runs, axis=0) - pi).max() < 0.07


def test_every_document_keeps_its_probability():
    import pandas as pd

    rng = np.random.default_rng(5)
    size = np.sort(np.concatenate([rng.integers(20, 400, 395), [0, 0, 3000, 6000, 20000]]))[::-1]
    runs, seeds = [], 400
    for seed in range(seeds):
        pdf = pd.DataFrame({"doc_id": np.arange(400), "size": size, "row": np.arange(400), "pi": 0.377, "seed": seed})
        out = mixing._fly(True)(pdf)
        assert set(out["pi"]) <= {0.0, 1.0}
        assert abs(out["pi"] @ out["size"] - 0.377 * size.sum()) < 0.02 * size.sum()
        runs.append(out.sort_values("doc_id")["pi"].to_numpy())
    mean = np.mean(runs, axis=0)
    error = np.sqrt(0.377 * 0.623 / seeds)
    assert np.abs(mean - 0.377).max() < 4.5 * error  # 400 documents, 400 seeds
    assert 0.8 < np.std(mean) / error < 1.2


def test_mixing_repeated_ids(spark):
    rows = [(1, "a", "one two"), (1, "a", "three"), (1, "b", "four five six"), (2, "b", None), (2, "b", "x " * 50)] * 3
    out = mixing.mix_sources(spark, spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    assert len(out) == len(rows)
    assert sorted((r.doc_id, r.source, r.size) for r in out) == sorted((i, s, len((t or "").split())) for i, s, t in rows)


def test_warc_round_trip_with_magic_in_payloads(spark):
    fake = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    big = "x" * 300 + "é"
    htmls = [None, "", big, big, "ab" + fake + "cd" * 20, fake + fake, "WARC/1.1\r\n", big, "WARC/1.1\r\n" * 300, "y" * 99, "y" * 99, "tail WARC/1.1\r\n", "\r\n\r\n" * 30 + fake]
    htmls += ["pad %d " % i * 60 for i in range(30)] + ["q" + fake * 3] * 3
    rows = [(i, None if i % 7 == 0 else f"http://a/\r\nb{i}", h, "p", 1) for i, h in enumerate(htmls)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, path string, blk int")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for split, few in (("128m", 1 << 20), ("3k", 0)):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            path = warc.new_path(spark, "t")
            warc.write(df.coalesce(2), path, broadcast_bytes=few)
            got = {r.page_id: r for r in warc.read(spark, path).collect()}
            assert set(got) == set(range(len(rows)))
            assert got[3].record_type == "revisit" and got[3].refers_to == 2 and got[10].record_type == "response"
            assert got[5].payload_bytes == 2 * len(fake) and got[8].payload_bytes == 3000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    path = warc.new_path(spark, "t")
    warc.write(df.limit(0), path)
    assert warc.read(spark, path).count() == 0


def test_warc_keeps_pages_with_very_long_urls(spark):
    body = "same payload " * 20
    rows = [(0, "http://a/0", "first"), (1, "data:text/html," + "x" * 100_000, body), (2, "http://a/2", body), (3, "http://a/3?" + "q" * 70_000, "third"), (4, "http://a/4", "last")]
    path = warc.new_path(spark, "t")
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), path)
    got = {r.page_id: r for r in warc.read(spark, path).collect()}
    assert set(got) == {0, 1, 2, 3, 4}
    assert got[1].payload_bytes == len(body) and got[2].record_type == "revisit" and got[2].refers_to == 1


def test_warc_query_has_a_row_per_page(spark, tmp_path):
    body, other = "equal payload " * 20, "another payload " * 20
    rows = [(1, "a", body), (1, "b", body), (5, "c", body), (1, "d", other), (6, "e", other), (7, None, "z" * 2_000_000), (8, "f", "z" * 2_000_000), (9, "g", None)]
    spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, record_type string").write.parquet(f"{tmp_path}/pages.parquet")
    same_as_sql(QUERIES["op7_warc"](spark, str(tmp_path)), ORACLES["op7_warc"], pages=f"{tmp_path}/pages.parquet/*.parquet")


def test_pipeline_decisions(spark, tmp_path):
    import corpus_pipeline

    bench = spark.read.parquet(f"{SF}/benchmark.parquet").limit(3).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    base = docs.where("lang = 'en' and n_chars between 400 and 2000").orderBy("doc_id").limit(1).first()
    extra = [(9001, base.text, "en", "src1", 1), (9002, None, "en", "src1", 0), (9003, "12 34", "en", "src1", 5), (9004, bench[0].text, "en", "src2", 1)]
    path = str(tmp_path)
    docs.union(spark.createDataFrame(extra, docs.schema)).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{path}/benchmark.parquet")
    now = spark.read.parquet(f"{path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontaminate", "mix_sources"]
    ids = [{r.doc_id for r in now.select("doc_id").collect()}]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        now = stage(spark, now, path)
        now.write.parquet(f"{path}/{name}")
        now = spark.read.parquet(f"{path}/{name}")
        ids.append({r.doc_id for r in now.select("doc_id").collect()})
        assert ids[-1] <= ids[-2]
        if i < 4:
            assert now.columns == docs.columns
    assert {9002, 9003} == ids[0] - ids[1]
    assert 9001 not in ids[3] and base.doc_id in ids[3]
    assert 9004 in ids[3] and 9004 not in ids[4]


def brute_line_dedup(texts):
    """Kept texts, by dictionaries over all lines."""
    split = {t: [[w for w in re.split("[ \\t\\r]+", x) if w] for x in t.split("\n")] for t in set(texts) - {None}}
    mask = lambda w: "<*>" if re.search("[0-9]", w) else w
    leaf = lambda ws: (len(ws), *map(mask, ws[: line_dedup.DEPTH]))
    holders, tokens, shapes = {}, {}, {}
    for t, lines in split.items():
        for ws in lines:
            if len(ws) >= line_dedup.MIN_TOKENS:
                holders.setdefault(leaf(ws), set()).add(t)
    for lines in split.values():
        for ws in lines:
            for i, w in enumerate(ws):
                tokens[leaf(ws), i, mask(w)] = tokens.get((leaf(ws), i, mask(w)), 0) + 1

    def shape(ws):
        if len(ws) < line_dedup.MIN_TOKENS or len(holders[leaf(ws)]) < line_dedup.MIN_SUPPORT:
            return None
        out = tuple(mask(w) if i < line_dedup.DEPTH or tokens[leaf(ws), i, mask(w)] >= line_dedup.MIN_SUPPORT else "<*>" for i, w in enumerate(ws))
        return out if sum(w != "<*>" for w in out) >= line_dedup.MIN_FIXED * len(out) else None

    for t, lines in split.items():
        for ws in lines:
            if shape(ws):
                shapes.setdefault(shape(ws), set()).add(t)
    gone = {x for x, ts in shapes.items() if len(ts) >= line_dedup.MIN_SUPPORT}
    return {t: "\n".join(x for x, ws in zip(t.split("\n"), lines, strict=True) if shape(ws) not in gone) for t, lines in split.items()} | {None: None}


def test_pipeline_stages_equal_plain_versions(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sources = docs.select("source").distinct().count()
    footer = "This footer stands below every page of ours"
    rnd = random.Random(21)
    words = [w for r in docs.where("lang = 'en'").limit(20).collect() for w in r.text.split()]
    body = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    base = body(120)
    more = [(8000 + i, f"{body(30)}\n{footer}", "en", "src1", 1) for i in range(15)] + [(8100 + i, base.replace(" ", "  ", i) if i < 5 else base + f" tail{i}", "en", "src2", 1) for i in range(12)]
    more += [(8200, None, None, None, None), (8201, "", "en", "src1", 0), (8201, body(9), "en", "src1", 0), (8202, footer, "en", "src3", 1), (8203, body(60_000), "en", None, 1)]
    path = str(tmp_path)
    extra = "1 AS kept", "2 AS n_lines", "'s' AS size", "'x' AS line", "3L AS component_id"
    docs.union(spark.createDataFrame(more, docs.schema)).selectExpr("*", *extra).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{path}/benchmark.parquet")
    tables = [spark.read.parquet(f"{path}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, tables[-1], path).write.parquet(f"{path}/{name}")
        tables.append(spark.read.parquet(f"{path}/{name}"))
        if name != "mix_sources":
            assert tables[-1].columns == tables[0].columns
    start, lang, line, near, clean, mixed = [t.collect() for t in tables]
    texts = lambda rows: sorted((str(r.doc_id), r.text) for r in rows)
    model = langid.train(tables[0].select("doc_id", "text", "lang"), F.lit(True))
    verdict = langid.identify(tables[0], model).where("lang_pred <> 'und'").where(F.col("score") >= langid.MIN_SCORE)
    assert sorted(str(r.doc_id) for r in verdict.collect()) == sorted(str(r.doc_id) for r in lang)
    want = brute_line_dedup([r.text for r in lang])
    assert texts(line) == sorted((str(r.doc_id), want[r.text]) for r in lang if want[r.text].strip() or want[r.text] == r.text)
    assert not any(r.text.endswith(footer) for r in line) and len(start) - len(lang) >= 2
    sets = {}
    for r in line:
        w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), r.text.encode()))
        sets.setdefault(r.doc_id, []).append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)})
    keep = set(sets)
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and any(100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
                keep.discard(b)  # links of this fixture chain to no smaller id than their own
    assert {r.doc_id for r in near} == keep
    flagged = {r.doc_id for r in decontam.matches(tables[3], spark.read.parquet(f"{path}/benchmark.parquet")).collect()}
    assert texts(clean) == texts(r for r in near if r.doc_id not in flagged)
    sizes = {}
    for r in clean:
        sizes[r.source] = sizes.get(r.source, 0) + len(r.text.split())
    goal = brute_targets(sizes)
    assert sources and all(r.target == pytest.approx(goal[r.source]) and r.taken == r.copies * r.size and 0 < r.copies <= 3 for r in mixed)
    assert sum(r.taken for r in mixed) == pytest.approx(sum(sizes.values()), rel=0.1)


def test_pipeline_of_an_empty_table(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, now, SF).write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        assert now.count() == 0
