import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from rxcover.llm import ngram_join as nj
from rxcover.llm.common import components


def grams(text, n):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(rows, n=4, num=85, den=100):
    sets = [grams(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted([(d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))], key=repr)


def corpus(seed=0):
    rng = random.Random(seed)
    word = lambda: f"w{min(rng.randrange(400), rng.randrange(400))}"
    line = " ".join(word() for _ in range(25))
    rows = []
    for g in range(25):
        base = [word() for _ in range(rng.choice([3, 6, 20, 80, 300]))]
        for _ in range(rng.choice([1, 1, 2, 4])):
            w = list(base)
            for _ in range(rng.randrange(0, 1 + len(w) // 25)):
                w[rng.randrange(len(w))] = word()
            rows.append(" ".join(w) + (" " + line if rng.random() < 0.3 else ""))
    base = [word() for _ in range(70)]
    for _ in range(120):      # a large group of near copies
        w = list(base)
        for _ in range(rng.randrange(0, 4)):
            w[rng.randrange(len(w))] = word() + "x"
        rows.append(" ".join(w))
    rows += [line + " " + " ".join(word() for _ in range(6)) for _ in range(60)]
    rows += [line] * 20 + ["", None, " \t\n", "one", "One", "a b c", "A B  C", "é É", "É É", "x " * 9000]
    out = list(enumerate(rows))
    rng.shuffle(out)
    return out + [(None, "one"), (None, "lonely"), (3, out[0][1])]


@pytest.mark.parametrize("seed,n,num,block", [(0, 4, 85, 512), (1, 5, 80, 16)])
def test_equals_brute_force(spark, make_docs, monkeypatch, seed, n, num, block):
    monkeypatch.setattr(nj, "BLOCK", block)
    rows = corpus(seed)
    got = nj.ngram_join(make_docs(rows, extra=("sig", "h", "n", "c")), n, num)
    assert sorted([tuple(r) for r in got.collect()], key=repr) == brute(rows, n, num)


def test_empty_and_representatives(spark, make_docs):
    assert nj.ngram_join(make_docs([])).count() == 0
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, None), (4, None), (5, "z"), (6, "q r s t u v w x")]
    kept = nj.keep_representatives(make_docs(rows, extra=("component_id",)))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5, 6] and kept.columns[-1] == "component_id"


def test_overlap_slices(monkeypatch):
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40))) for _ in range(30)]
    monkeypatch.setattr(nj, "SLICE", 7)
    want = [[len(np.intersect1d(a, b)) for b in sets[:11]] for a in sets]
    assert (nj.overlaps(sets, sets[:11]) == np.array(want)).all()


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 30)] + [(50, 60), (61, 60), (5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, **{i: 7 for i in range(7, 30)}, 50: 50, 60: 50, 61: 50}


@pytest.mark.parametrize("num,den", [(85, 100), (80, 100), (1, 2), (100, 100)])
def test_linked_sizes_lie_in_neighbouring_bands(spark, num, den):
    rows = spark.range(1, 1500).select("id", nj.band(F.col("id"), num, den).alias("v")).orderBy("id").collect()
    size, v = np.array([r.id for r in rows]), np.array([r.v for r in rows])
    linked = den * np.minimum.outer(size, size) >= num * np.maximum.outer(size, size)
    assert np.abs(np.subtract.outer(v, v))[linked].max() <= 1


def test_a_common_line_in_texts_of_all_sizes(spark, make_docs, monkeypatch):
    """One long column over many bands and blocks; few of its pairs link."""
    monkeypatch.setattr(nj, "BLOCK", 4)
    monkeypatch.setattr(nj, "SHORT", 4)
    rng = random.Random(3)
    line = [f"l{i}" for i in range(12)]
    rows = []
    for size in [0, 1, 2, 3, 5, 8, 13, 20, 30, 45, 70, 100, 150]:
        for _ in range(4):
            base = line + [f"w{rng.randrange(50)}" for _ in range(size)]
            near = base + [f"v{i}" for i in range(len(base) // 8)]
            rows += [" ".join(base), " ".join(near), " ".join(near[1:])]
    rows = list(enumerate(rows))
    rng.shuffle(rows)
    got = nj.ngram_join(make_docs(rows))
    assert sorted([tuple(r) for r in got.collect()], key=repr) == brute(rows)
