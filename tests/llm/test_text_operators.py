"""Small fixtures for the text operators: nulls, empty texts, ties, repeated
rows, empty tables, clashing column names, and brute-force results."""

import random
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from dichot.llm import decontam, html, langid, licenses, near_dup, packing, quality, rollups, substring, tokens, toxicity

PATH, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id long, text string, lang string, source string, score string, batch string, key string, n string"


def words(seed, n):
    r = random.Random(seed)
    return [f"w{r.randrange(5000)}" for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, "x", "x", "x", "x") for i, t, lang, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    base = words(1, 120)
    rows = [(1, " ".join(base), "en", "a"), (2, " ".join(base), "en", "a"), (3, " ".join(base[:60] + ["x"] + base[61:]), "en", None),
            (4, None, None, "a"), (5, "", "en", "a"), (6, "one", "en", "b"), (7, "one", "de", "b"), (8, "y " * 200, "en", "b"),
            (9, " ".join(words(2, 3000)), "en", "a"), (9, " ".join(words(2, 3000)), "en", "a"),
            (10, "a  b\n\n c\t<|endoftext|>  d ", "de", "a"), (None, " ".join(words(3, 40)), "en", "a"),
            (11, " ".join(words(4, 30) + base[20:90] + words(5, 30)), "fr", "a")]
    return frame(spark, rows)


def brute_strip(rows):
    first = {}
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    cut = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in cut:
        for p in range(len(w) - 19):
            k = tuple(w[p:p + 20])
            here = (i if i is not None else -1, p)
            first[k] = min(first.get(k, here), here)
    out = []
    for i, w in cut:
        gone = set()
        for p in range(len(w) - 19):
            if first[tuple(w[p:p + 20])] < (i if i is not None else -1, p):
                gone.update(range(p, p + 20))
        out.append((i, len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode()))
    return out


def test_substring(docs):
    got = sorted(map(tuple, substring.strip_repeats(docs).collect()), key=repr)
    assert got == sorted(brute_strip([(r["doc_id"], r["text"]) for r in docs.collect()]), key=repr)
    assert substring.strip_repeats(docs.limit(0)).count() == 0
    small = sorted(map(tuple, substring.strip_repeats(docs, batch_bytes=3000, range_bytes=10).collect()), key=repr)
    assert small == got
    spaced = {r["doc_id"]: r["kept_text"] for r in substring.strip_repeats(docs, spaced=True).collect()}
    whole = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert spaced[10] == whole[10].rstrip(" ") and "\n\n" in spaced[10] and spaced[4] == "" and spaced[7] == "one"


def test_near_duplicates(docs):
    got = {r["doc_id"]: r for r in near_dup.near_duplicates(docs, n=2).collect()}
    assert [got[i]["component_id"] for i in (1, 2, 3, 4, 5, 6, 7, 8, 9)] == [1, 1, 1, 4, 5, 6, 6, 8, 9]
    assert not got[2]["kept"] and not got[3]["kept"] and got[4]["kept"] and got[None]["kept"]
    assert got[4]["n_shingles"] == 0 and got[6]["n_shingles"] == 1 and got[8]["n_shingles"] == 1
    assert near_dup.near_duplicates(docs.limit(0), n=2).count() == 0


def test_near_duplicates_equal_brute_force(spark):
    """Repeated ids with other texts, ties, exact and near copies, a group with a hub, and short texts."""
    r = random.Random(11)
    rows = [(7, "a b c d e"), (7, "p q r s t u"), (3, "a b c d e"), (9, "p q r s t u"), (None, "a b c d e"), (20, ""), (21, None), (22, "one")]
    for i in range(12):
        base = words(200 + i, r.randrange(5, 80))
        for j in range(r.randrange(1, 9)):
            copy = list(base)
            for _ in range(r.randrange(0, 5)):
                copy[r.randrange(len(copy))] = f"z{r.randrange(50)}"
            rows.append((100 + 10 * i + j, " ".join(copy)))
    rows += [(400 + i, "same text in many rows here") for i in range(1200)]
    table = frame(spark, [(i, t, "en", "a") for i, t in rows])

    def grams(t):
        w = (t or "").lower().split()
        return frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset(map(tuple, [w] if w else []))
    sets = {}
    for i, t in rows:
        if i is not None and grams(t):
            sets.setdefault(grams(t), set()).add(i)
    root = {i: i for ids in sets.values() for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    def join(a, b):
        a, b = sorted((find(a), find(b)))
        root[b] = a
    for x, ids in sets.items():
        for i in ids:
            join(min(ids), i)
        for y, others in sets.items():
            if 100 * len(x & y) >= 80 * len(x | y):
                join(min(ids), min(others))
    want = sorted(((i, len(grams(t)), find(i) if i in root else i) for i, t in rows), key=repr)
    got = near_dup.near_duplicates(table, n=2).collect()
    assert sorted(((x["doc_id"], x["n_shingles"], x["component_id"]) for x in got), key=repr) == want
    assert all(x["kept"] == (x["doc_id"] == x["component_id"]) for x in got)
    with pytest.raises(ValueError):
        near_dup.near_duplicates(table, n=2, percent=79)


def test_decontamination(spark, docs):
    base = words(1, 120)
    items = spark.createDataFrame([(1, " ".join(base[30:60])), (2, None), (3, ""), (4, "too short"), (6, "One?"), (7, "... !"), (8, f"{base[3]}, {base[4]} {base[5]}"), (None, " ".join(base)),
                                   (5, " ".join(words(99, 20)))], "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"], r["shared"]) for r in decontam.contaminated(docs, items).collect())
    assert got == [(1, 1, 26), (1, 8, 1), (2, 1, 26), (2, 8, 1), (3, 1, 26), (3, 8, 1), (6, 6, 1), (7, 6, 1), (11, 1, 26)]
    small_blocks = decontam.contaminated(docs, items, block=1)
    assert sorted((r["doc_id"], r["item_id"], r["shared"]) for r in small_blocks.collect()) == got
    assert decontam.contaminated(docs.limit(0), items).count() == 0
    assert decontam.contaminated(docs, items.limit(0)).count() == 0


def test_quality(docs):
    rows = {r["doc_id"]: r for r in quality.judge(docs, min_docs=3).collect()}
    assert (rows[4]["n_words"], rows[4]["base_failed"], rows[4]["kept"]) == (0, True, False)
    assert (rows[8]["n_repeat_words"], rows[8]["base_failed"]) == (200, True)
    assert rows[1]["kept"] and rows[1]["word_chars"] == sum(map(len, words(1, 120)))
    assert rows[10]["n_symbols"] == 4
    assert quality.judge(docs.limit(0)).count() == 0


def test_packing(docs):
    tk = Tokenizer.from_file(PATH)
    rows = packing.pack(docs, PATH, RANKS, capacity=64).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for d in docs.collect():
        ids = tk.encode(d["text"] or "", add_special_tokens=False).ids + [0]
        mine = sorted(by_doc[d["doc_id"]], key=lambda r: r["piece"])
        assert sum(r["length"] for r in mine) == len(ids) * (2 if d["doc_id"] == 9 else 1)
        for r in mine:
            assert r["ids_crc32"] == crc32(np.array(ids[r["start"]:r["start"] + r["length"]], dtype="<u4").tobytes())
    seqs = {}
    for r in rows:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(docs.limit(0), PATH, RANKS).count() == 0


def test_plan_uses_every_rank_once():
    counts = {7: 1000, 5: 3, 3: 77, 1: 10, 10: 4}
    seen = {k: 0 for k in counts}
    for length, lo, hi, each, first, offset in packing.plan(counts, 10):
        assert lo == seen[length] and offset + each * length <= 10
        seen[length] = hi
    assert seen == counts


def test_token_ids_equal_the_tokenizer():
    import pyarrow as pa
    texts = ["a  b", "a \n b", "\n\nx y", "x  y", "<|endoftext|> a", "", " lead", "trail ", "don't we'll", None, "d　　e 12.5"]
    tk = Tokenizer.from_file(PATH)
    for ranks in (RANKS, None):
        got = [x.tolist() for x in tokens.token_ids(PATH, ranks).ids(pa.array(texts))]
        assert got == [tk.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_language(spark, docs):
    rows = [(i, "the house is and the", "en", "a") for i in range(3)] + [(i, "das haus ist und das", "de", "a") for i in range(3, 6)]
    model = langid.train(frame(spark, [*rows, (7, "null", None, "a"), (8, None, "en", "a")]))
    told = frame(spark, [(1, "THE house", None, None), (2, "haus das", None, None), (3, None, None, None), (4, "12 !", None, None),
                         (5, "hausen", None, None)])
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(told, model).collect()}
    assert [got[i][0] for i in range(1, 6)] == ["en", "de", "und", "und", "de"]
    assert all(0 <= s <= 1 for _, s in got.values())
    assert {r["lang_pred"] for r in langid.identify(docs, langid.train(docs.limit(0))).collect()} == {"und"}


def test_language_keeps_every_word(spark):
    """Words beyond the cache count in full, and little text does not raise unseen words."""
    big = [(i, " ".join(words(i, 300)), "en", "a") for i in range(40)] + [(40, "solitaire", "en", "a")]
    small = [(50, "sjelden ord her", "no", "a"), (51, "noe annet sjelden", "no", "a")]
    told = frame(spark, [(1, "sjelden", None, None), (2, "annet annet noe", None, None), (3, "solitaire", None, None), (4, "ordsj", None, None),
                         (5, "w17 w18 sjelden", None, None), (6, None, None, None)])
    table = frame(spark, big + small)
    got = [{r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(told, langid.train(table, *size)).collect()}
           for size in ((100_000, 50_000), (1, 1))]
    assert got[0] == got[1]
    assert [got[0][i][0] for i in (1, 2, 3, 4, 6)] == ["no", "no", "en", "no", "und"]


def test_html(spark):
    page = ("<html><head><title>t</title></head><body><nav><a href=x>Menu</a></nav><div class='ad'>Buy</div><article><h1>Head &amp; more</h1>"
            "<p>One  two<br>three<script>var t='</p>';</script> <b>four</b><p>Five<!-- no --></article><div id=comments>me too</div>"
            "<footer>Foot</footer>")
    pages = spark.createDataFrame([(1, "http://h.org/1", page, "x"), (1, "http://h.org/1", page, "x"), (2, None, None, "x"),
                                   (3, "http://h.org/2", "", "x"), (4, "http://h.org/3", "plain text", "x")],
                                  "page_id long, url string, html string, path string")
    got = {r["page_id"]: r for r in html.extract(pages).collect()}
    assert got[1]["text"] == "Head & more\nOne two three four\nFive"
    assert (got[2]["text"], got[3]["n_chars"], got[4]["text"]) == ("", 0, "plain text")
    assert html.extract(pages).count() == 5 and html.extract(pages.limit(0)).count() == 0


def test_html_keeps_all_article_text(spark):
    lists = "<datalist id=l><option value=a><option value=b></datalist>"
    body = "x" * 6000
    told = {1: f"<body>{lists}<p>After the list</p></body>",
            2: "<body><form><select><option>A<optgroup><option>B</select></form><p>After the form</p></body>",
            3: "<body><p>Where <math><msup><mi>x</mi><mn>2</mn></msup><annotation>x^2</annotation></math> is a square</p></body>",
            4: f"<body><article><h1>Head</h1><div class=body>{body}</div><p>Last words</p></article></body>",
            5: "<body><article><div class=body>all the text is here</div></article><div><a href=x>a link</a></div></body>"}
    pages = spark.createDataFrame([(i, f"http://h{i}.org/", x) for i, x in told.items()], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html.extract(pages).collect()}
    assert got == {1: "After the list", 2: "After the form", 3: "Where x2 is a square", 4: f"Head\n{body}\nLast words",
                   5: "all the text is here"}


def test_html_hosts_vote_unknown_boilerplate_out(spark):
    """A strap of no telling name on all pages, a stray strip on one, an article's own header, and copies of one page."""
    def article(i, more=""):
        return f"<article><header class=entry-header><h1>Head {i}</h1></header><p>{' '.join(words(i, 30))}</p>{more}</article>"
    strap = "<div class=line>Quality since 1920</div>"
    pages = [(i, "http://a.org/x", f"<body>{strap}{article(i)}</body>") for i in range(10)]
    pages += [(20 + i, "http://b.org/x", f"<body>{'<div class=strip>Today only</div>' if i == 3 else ''}{article(i)}</body>") for i in range(11)]
    pages += [(40 + i, "http://c.org/x", f"<body>{article(7)}</body>") for i in range(5)]
    pages += [(50, "http://d.org/x", f"<body>{strap}{article(1)}</body>")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html.extract(table).collect()}

    def text(i):
        return f"Head {i}\n{' '.join(words(i, 30))}"
    assert all(got[i] == text(i) for i in range(10)) and all(got[20 + i] == text(i) for i in range(11))
    assert all(got[40 + i] == text(7) for i in range(5))
    # one page alone cannot tell its strap from its text
    assert got[50] == "Quality since 1920\n" + text(1)


def test_rollups(spark, docs, tmp_path):
    tk = Tokenizer.from_file(PATH)
    rows = [(1, "one two", "en", "a"), (2, "three", None, "a"), (3, None, "en", "a"), (None, "no id", "en", "a")]
    up = frame(spark, rows).selectExpr("*", "'upsert' op")
    store = rollups.TokenRollup(spark, str(tmp_path))
    assert store.totals().count() == 0
    assert store.commit("a", up, "v", PATH, RANKS) and not store.commit("a", up, "v", PATH, RANKS)
    n = {t: len(tk.encode(t, add_special_tokens=False).ids) for t in ("one two", "three", "one two four")}

    def totals():
        return sorted(((r["source"], r["lang"], r["n_docs"], r["n_tokens"]) for r in store.totals().collect()), key=repr)
    assert totals() == sorted([("a", "en", 2, n["one two"]), ("a", None, 1, n["three"])], key=repr)
    more = frame(spark, [(1, "one two four", "en", "b")]).selectExpr("*", "'upsert' op").union(
        frame(spark, [(2, None, None, None), (77, None, None, None)]).selectExpr("*", "'delete' op"))
    assert store.commit("b", more, "v", PATH, RANKS)
    assert totals() == [("a", "en", 1, 0), ("b", "en", 1, n["one two four"])]
    assert store.commit("c", up.limit(0), "v", PATH) and totals() == [("a", "en", 1, 0), ("b", "en", 1, n["one two four"])]


def test_licences(spark, docs):
    texts = ["Intro.\nLicensed under the Apache License, Version 2.0.\nplain words here", "Released under the MIT License.", None, "",
             "nothing to see", "This work is licensed under the GNU General Public License, version 3."]
    table = frame(spark, [(i, t, "en", "a") for i, t in enumerate(texts)] + [(100 + i, " ".join(words(i, 30)), "en", "a") for i in range(30)])
    model = licenses.train(table)
    got = sorted((r["doc_id"], r["paragraph"], r["family"]) for r in licenses.scan(table, model).collect())
    assert got == [(0, 1, "Apache-2.0"), (1, 0, "MIT"), (5, 0, "GPL")]
    assert licenses.scan(table.limit(0), model).count() == 0


def test_toxicity_gradients_and_edges(spark, docs):
    rng = np.random.default_rng(0)
    layer = toxicity.Layer(rng, 5, 4)
    layer.p = {k: v.astype(np.float64) for k, v in layer.p.items()}
    table, at, size = rng.standard_normal((7, 5)), rng.integers(0, 7, (6, 9)), np.array([9, 3, 1, 5, 9, 2])
    out = rng.standard_normal((6, 8))
    _, kept = layer.pool(layer.project(table), at, size, True)
    grads, _ = layer.back(out, kept, table)
    for name, value in layer.p.items():
        spot = tuple(rng.integers(0, d) for d in value.shape)
        old, ends = value[spot], []
        for step in (1e-3, -1e-3):
            value[spot] = old + step
            ends.append((layer.pool(layer.project(table), at, size, True)[0] * out).sum())
        value[spot] = old
        assert abs((ends[0] - ends[1]) / 2e-3 - grads[name][spot]) < 1e-2
    assert [list(toxicity.windows(n)) for n in (1, 32, 33, 57)] == [[0], [0], [0, 16], [0, 16, 32]]
    r = random.Random(5)
    rows = [(i, " ".join(words(i, 40) + (["vile", "vilest"] if i % 2 else []) + words(-i, r.randrange(1, 60))), "en", "a") for i in range(120)]
    told = frame(spark, rows).selectExpr("*", "int(doc_id % 2) toxic")
    net = toxicity.train(told)
    got = {x["doc_id"]: x["score"] for x in toxicity.score(frame(spark, [*rows, (500, None, "en", "a"), (501, "", "en", "a")]), net).collect()}
    assert got[500] == got[501] == 0
    assert np.mean([(got[i] >= 0.5) == bool(i % 2) for i in range(120)]) > 0.8
    assert set(x["score"] for x in toxicity.score(docs, toxicity.train(told.limit(0))).collect()) == {0.0}


def test_pipeline_keeps_columns_and_clean_documents(spark, tmp_path):
    import corpus_pipeline
    base = words(1, 200)
    rows = [(1, " ".join(base), "en", "a"), (2, " ".join(base), "en", "a"), (3, "short", "en", "a"), (4, "y " * 100, "en", "a")]
    rows += [(10 + i, " ".join(words(100 + i, 80)), "en", "a") for i in range(20)]
    rows += [(40, " ".join(words(7, 40) + base[50:90] + words(8, 40)), "en", "a"), (41, " ".join(words(9, 40) + words(70, 20)), "en", "a")]
    frame(spark, rows).selectExpr("*", "length(text) n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, " ".join(words(70, 20)))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        docs = spark.createDataFrame(out.collect(), out.schema)
        seen.append({r["doc_id"] for r in docs.collect()})
    clean = {1, 40, *range(10, 30)}
    assert seen == [clean | {2, 41}, clean | {41}, clean | {41}, clean]
    assert [len(r["text"].split()) for r in docs.where("doc_id = 40").collect()] == [80]


def test_pipeline_decides_row_by_row(spark, tmp_path):
    """Null and repeated ids, a clashing key column, and line breaks beside a passage that goes."""
    import corpus_pipeline
    clean = [" ".join(words(500 + i, 60)) for i in range(6)]
    item, passage = words(77, 12), " ".join(words(78, 30))
    rows = [(None, clean[0]), (None, clean[0]), (None, "short"), (5, clean[1]), (5, "bad"), (6, clean[1]), (7, f"{clean[2]}\n\n{' '.join(item)}"),
            (7, clean[3]), (8, f"{clean[4]}\n\n{passage}"), (9, f"{clean[5]}\n\nnew line\n{passage}\nlast words"), (None, None), (None, "")]
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(i, t, "en", "a", len(t or ""), "x") for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, row_key string")
    stages = dict(corpus_pipeline.STAGES)

    def after(name, df):
        out = stages[name](spark, df, str(tmp_path))
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        kept = out.collect()
        return spark.createDataFrame(kept, out.schema), sorted(((r["doc_id"], r["text"]) for r in kept), key=repr)
    docs1, got = after("quality rules", docs)
    assert got == sorted([r for r in rows if r[1] not in ("short", "bad", "", None)], key=repr)
    docs2, got = after("minhash near-dedup", docs1)
    assert got == sorted([r for r in rows if r[1] not in ("short", "bad", "", None) and r[0] != 6][1:], key=repr)
    docs3, got = after("substring dedup", docs2)
    assert dict(got)[9] == f"{clean[5]}\n\nnew line\nlast words" and dict(got)[8] == rows[8][1]
    _, got = after("benchmark decontamination", docs3)
    assert (7, clean[3]) in got and len(got) == 5
    assert all(after(name, docs.limit(0))[1] == [] for name in list(stages)[:-1])


def test_parity_bitmaps_never_exceed_the_difference():
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(words, n)) for n in (1, 2, 30, 200, 900)]
    texts += [t.replace("w7", "other") for t in texts] + ["", None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    out = pa.Table.from_batches(list(near_dup._signatures(2)([batch]))).to_pandas()
    value, first = near_dup._sets(pa.array(texts), 2)
    sets = [set(value[first[i]:first[i + 1]].tolist()) for i in range(len(texts))]
    bits = out[near_dup._BITMAP].to_numpy()
    for i in range(len(texts)):
        for j in range(len(texts)):
            apart = sum(int(x).bit_count() for x in (bits[i] ^ bits[j]).view(np.uint64))
            assert apart <= len(sets[i] ^ sets[j]) and (apart - len(sets[i] ^ sets[j])) % 2 == 0


def test_toxicity_sample_is_bounded_and_chosen_by_id(spark):
    docs = spark.createDataFrame([(i, f"text {i}" if i % 5 else None, "x") for i in range(60)] + [(7, "again", "x"), (None, "no id", "x")],
                                 "doc_id long, text string, toxic string").drop("toxic")
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)] + [(3, 1), (51, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.labelled_sample(docs, labels).collect()
    assert sorted((r["doc_id"], r["text"], r["toxic"]) for r in got) == sorted(
        [(i, f"text {i}", i % 2) for i in range(50) if i % 5] + [(7, "again", 1)])
    few = {(r["doc_id"], r["toxic"]) for r in toxicity.labelled_sample(docs.repartition(7), labels, 4).collect()}
    assert few == {(r["doc_id"], r["toxic"]) for r in toxicity.labelled_sample(docs, labels, 4).collect()} and len(few) == 8
    assert toxicity.labelled_sample(docs.limit(0), labels).count() == 0


def test_packed_steps_take_no_more_than_the_values():
    from dichot.llm.text import pack_deltas, unpack_deltas
    r = np.random.default_rng(5)
    for values in ([], [0], [65535], [(1 << 32) - 1], [0, (1 << 24) - 1, (1 << 32) - 1], *(
            np.unique(r.integers(0, 1 << 32, n)) for n in (3, 200, 30_000, 300_000))):
        values = np.array(values, dtype=np.uint32)
        data = pack_deltas(values)
        assert (unpack_deltas(data) == values).all()
        assert len(data) <= 4 * len(values) + 5                                # 200 values took 131 KB of empty steps


def test_texts_are_handed_over_in_small_batches(spark, monkeypatch):
    from dichot.llm import spark as helpers
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, out = spark.conf.get(key), {}
    told = helpers.written

    def largest(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"])

    rows = spark.range(0, 3000, 1, 1).mapInArrow(largest, "n long")
    assert max(r["n"] for r in told(rows, "batches", 100).collect()) == 100 and spark.conf.get(key) == before
    monkeypatch.setattr(near_dup, "written", lambda df, name, batch_rows=None: out.update({name: batch_rows}) or told(df, name, batch_rows))
    monkeypatch.setattr(quality, "written", near_dup.written)
    docs = spark.createDataFrame([(i, f"one two three four five six {i // 2}", "en", "s") for i in range(4)],
                                 "doc_id long, text string, lang string, source string")
    assert near_dup.near_duplicates(docs, 2).count() == quality.judge(docs).count() == 4
    assert out["near-signatures"] == out["quality-measures"] == helpers.TEXT_ROWS


def test_carried_text_travels_once(docs):
    out = substring.strip_repeats(docs, carry=["lang", "text"], spaced=True)
    dealt = out._jdf.queryExecution().analyzed().toString()
    assert "AS carry_0" in dealt and "AS carry_1" not in dealt                  # the text itself, no second copy beside it
    plain = {r["doc_id"]: r["kept_text"] for r in substring.strip_repeats(docs, spaced=True).collect()}
    whole = {r["doc_id"]: (r["lang"], r["text"]) for r in docs.collect()}
    got = out.collect()
    assert {r["doc_id"]: (r["carry_0"], r["carry_1"]) for r in got} == whole
    assert {r["doc_id"]: r["kept_text"] for r in got} == plain


def test_worker_reads_the_tokenizer_only_for_texts_that_need_it():
    ids = tokens.TokenIds(PATH, RANKS)
    ids.ids(pa.array(["plain words", "two  spaces", None]))
    assert "tokenizer" not in vars(ids)
    assert ids.ids(pa.array(["<|endoftext|>"]))[0].tolist() == ids.tokenizer.encode("<|endoftext|>", add_special_tokens=False).ids


def test_substring_batch_needs_few_bytes_a_word():
    import tracemalloc
    n = 400_000
    table = pa.table({"doc_id": pa.array(range(400), pa.int64()), "text": [" ".join(f"w{i % 997}x{j}" for j in range(n // 400)) for i in range(400)]})
    substring._Batch(table.slice(0, 4), 20, 8, blocks=False, full=True)            # powers and imports
    tracemalloc.start()
    substring._Batch(table, 20, 8, blocks=False, full=True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50 * n
