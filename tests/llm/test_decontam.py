import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from rxcover.llm import decontam as dc
from rxcover.llm.words import WORD_ASCII, word_hashes


def greedy(item, doc, least):
    """Mark the longest common unmarked run until none is long enough."""
    least = min(least, len(item))
    a, b, out = [False] * len(item), [False] * len(doc), []
    while least:
        best = (0, 0, 0)
        for p in range(len(item)):
            for t in range(len(doc)):
                k = 0
                while (p + k < len(item) and t + k < len(doc) and item[p + k] == doc[t + k]
                       and not a[p + k] and not b[t + k]):
                    k += 1
                best = max(best, (k, -p, -t))
        k, p, t = best[0], -best[1], -best[2]
        if k < least:
            break
        a[p:p + k] = [True] * k
        b[t:t + k] = [True] * k
        out.append((p, t, k))
    return out


@settings(max_examples=300, deadline=None)
@given(st.text("abc", max_size=14), st.text("abcd", max_size=24), st.integers(1, 4))
def test_tiling_equals_brute_force(item, doc, least):
    code = lambda s: word_hashes(" ".join(s), WORD_ASCII)
    assert dc.tiles(code(item), code(doc), least) == greedy(item, doc, least)


def words(rng, n):
    return [f"w{rng.randrange(4000)}" for _ in range(n)]


def test_pairs_equal_brute_force(spark, make_docs):
    rng = random.Random(1)
    items = [(i, " ".join(words(rng, rng.randrange(15, 40)))) for i in range(20)]
    items += [(30, "Three short words"), (31, None), (32, "..."), (33, "a b c d e f g"), (33, "a b c d e f g")]
    docs = [(i, " ".join(words(rng, 60))) for i in range(40)]
    for i in range(20):
        w = items[i][1].split()
        moved = w[len(w) // 2:] + ["x"] + w[:len(w) // 2]
        docs.append((100 + i, " ".join(words(rng, 30) + moved + words(rng, 20)).upper()))
        docs.append((200 + i, " ".join(w[:6] + words(rng, 30))))
    docs += [(300, None), (301, ""), (302, "say three, short; words!"), (303, "a b c d e f g " * 3000), (303, "A b c d"),
             (None, items[0][1]), (304, "x " * 500 + items[1][1])]
    got = dc.contaminated(make_docs(docs, extra=("grams", "rid", "words")), spark.createDataFrame(items, "item_id long, text string"))
    seen = sorted([(r.doc_id, r.item_id, r.covered, r.tiles) for r in got.collect()], key=repr)
    tok = lambda t: re.findall(r"\w+", (t or "").lower())
    want = []
    for d, t in docs:
        dt = tok(t)
        for i, x in items:
            it = tok(x)
            if it and len(set(it) & set(dt)) >= min(5, len(it)) and (d != 303 or i == 33):
                g = greedy(it, dt[:110], 5)
                c = sum(k for *_, k in g)
                if c >= 0.5 * len(it):
                    want.append((d, i, c, len(g)))
    drop = lambda rows: [r for r in rows if r[0] != 304]
    assert drop(seen) == drop(sorted(want, key=repr))
    assert (304, 1) in {r[:2] for r in seen}
    kept = dc.drop_contaminated(make_docs(docs, extra=("__k",)), spark.createDataFrame(items, "item_id long, text string"))
    assert kept.columns[-1] == "__k"
    ids = {r.doc_id for r in kept.collect()}
    assert ids.isdisjoint(range(100, 120)) and set(range(40)) <= ids and None not in ids


@pytest.mark.parametrize("docs,items", [([], [(1, "a b c d e f")]), ([(1, "a b c d e f")], [])])
def test_empty(spark, make_docs, docs, items):
    assert dc.contaminated(make_docs(docs), spark.createDataFrame(items, "item_id long, text string")).count() == 0


def test_given_documents(spark):
    d = "/root/testdata/sf0.01/"
    docs, items = spark.read.parquet(d + "documents.parquet"), spark.read.parquet(d + "benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in dc.contaminated(docs, items).collect()}
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in items.collect():
        for i, t in text.items():
            if r.text in t:
                assert (i, r.item_id) in got
    assert 0 < len({i for i, _ in got}) < 0.1 * len(text)
    assert np.mean([any(x.text in text[i] for x in items.collect()) for i, _ in got]) > 0.8
