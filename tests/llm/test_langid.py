import zlib

import numpy as np
from pyspark.sql import functions as F
from rxcover.llm import langid


def test_held_out_accuracy_and_contract(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.identify(docs).collect()
    lang = {r.doc_id: (r.lang, r.text) for r in docs.collect()}
    assert len(rows) == len(lang)
    good = []
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        if r.held_out and r.lang_pred != "und":
            good.append(r.lang_pred == lang[r.doc_id][0])
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in lang[r.doc_id][1] or ""))
    assert np.mean(good) > 0.97
    assert langid.keep_identified(docs).count() >= 0.99 * len(rows)


def brute_subwords(text):
    data = b" " + text.lower().encode().translate(langid._ASCII_GAPS) + b" "
    out = []
    for n in (3, 4):
        for i in range(len(data) - n + 1):
            g = data[i:i + n]
            if b" " not in g[1:-1]:
                out.append(g)
    return out


def test_subwords_match_brute_force():
    for text in ("Hallo  Welt!", "a", "", "é1ü", "x" * 30 + " . " + "yz"):
        got = np.concatenate([langid.subwords(p) for p in langid.pieces(text)])
        assert len(got) == len(brute_subwords(text))


def test_edges(spark, make_docs):
    words = {"en": "the house and the garden ", "de": "das haus und der garten "}
    rows = [(i, words[k] * 5, k) for i, k in enumerate(["en", "de"] * 30)]
    rows += [(100, None, "en"), (101, "123 !!", "de"), (102, "", None), (None, "the garden", None), (103, "das haus " * 40000, None),
             (0, words["en"] * 5, "en")]
    got = langid.identify(make_docs(rows, extra=("score", "p", "lang_pred"))).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    assert [by[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and by[100].score == 0 and by[101].rejected
    assert by[None].lang_pred == "en" and not by[None].held_out and by[103].lang_pred == "de"
    none = langid.identify(make_docs([(1, "hello", None)])).collect()
    assert none[0].lang_pred == "und"
    assert langid.identify(make_docs([])).count() == 0
    kept = langid.keep_identified(make_docs(rows, extra=("__x",)))
    assert kept.columns[-1] == "__x" and kept.where(F.col("doc_id").isin(100, 101, 102)).count() == 0


def test_rare_labels_are_learned(spark, make_docs):
    """Labels that the rows of least hash lack are learned and not rejected."""
    rows = [(i, ("the house and the garden ", "das haus und der garten ")[i % 2] * 3, ("en", "de")[i % 2]) for i in range(12000)]
    rows += [(20000 + i, "το σπίτι και ο κήπος " * 3, "el") for i in range(12)]
    rows += [(30000 + i, "дом и большой сад " * 3, "ru") for i in range(12)]
    docs = make_docs(rows)
    model = langid.train(docs, F.lit(True), rows=40)
    assert model.languages == ["de", "el", "en", "ru"]
    for text, lang in {r[1]: r[2] for r in rows}.items():
        pred, _, rejected = model.predict(text)
        assert pred == lang and not rejected
    assert {r["lang"] for r in langid.sample(docs, F.lit(True), 40, 0)} == {"en", "de"}
    got = langid.sample(docs, F.lit(True), 40, 5)
    assert len(got) == 50 and [r["h"] for r in got] == sorted(r["h"] for r in got)


def test_label_of_one_row_is_not_held_back():
    rows = [{"lang": "ru" if i == 4 else "en", "bag": langid.bag("дом сад" if i == 4 else "the house")} for i in range(20)]
    model = langid.fit(rows)
    assert model.seen[langid.opened(rows[4]["bag"])[0]].all()


def test_bags_hold_every_subword_of_the_text():
    long = "das haus und der garten ünd 12 " * 90000 + "nur am ende: xyzzy"       # several pieces
    for text in ("", "a", "Hallo  Welt!", long):
        ids, counts = langid.opened(langid.bag(text))
        assert counts.sum() == len(brute_subwords(text)) and (np.diff(ids.astype(int)) > 0).all()
    end = langid.opened(langid.bag("nur am ende: xyzzy"))[0]
    assert np.isin(end, langid.opened(langid.bag(long))[0]).all()


def test_sample_learns_whole_texts_and_repeated_rows_once(spark, make_docs):
    """What stands only after many subwords of a long text is learned from."""
    rows = [(i, "the house and the garden " * 400 + "zyxomma", "en") for i in range(6)] * 3
    rows += [(10 + i, "das haus und der garten " * 400, "de") for i in range(6)]
    got = langid.sample(make_docs(rows), F.lit(True), 100)
    assert len(got) == 12
    word = langid.opened(langid.bag("zyxomma"))[0]
    assert sum(np.isin(word, langid.opened(r["bag"])[0]).all() for r in got) == 6
