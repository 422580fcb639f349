"""Operator 11 against every period of every stretch, tried one by one."""

import hashlib
import random
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st
from rxcover.llm import periodic_runs as pr
from rxcover.llm.common import read
from rxcover.llm.queries import QUERIES

from tests.conftest import SMALL_SF


def brute_runs(w):
    """For every period, the longest stretches that keep it; of a stretch, the smallest period counts."""
    out = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                out.setdefault((i, j + q - i), q)
            i = j
    return sorted((s, n, q) for (s, n), q in out.items())


def brute_row(doc_id, text, plant):
    w = [x for x in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")]
    h = zlib.crc32(str(doc_id).encode())
    if plant and doc_id is not None and w and h % 10 == 0:
        g, n, o = h // 10, len(w), list(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [o[i] if i < a else o[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = sorted(runs, key=lambda r: (-r[1], r[0], r[2]))[0] if runs else (None, None, None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *best, best[1] * 1000 // best[2] if runs else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda r: (r[0], r[2])))),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), min_size=1, max_size=4))
def test_runs_equal_brute_force(docs):
    docs = [[bytes([97 + x]) for x in d] for d in docs]
    assert [sorted(r) for r in pr.runs_of(docs)] == [brute_runs(d) for d in docs]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 9), min_size=1, max_size=5), st.integers(1, 9)), max_size=9), st.integers(0, 3))
def test_powers_of_words(parts, cut):
    doc = [b"%d" % x for part, n in parts for x in (part * n)[:len(part) * n - cut]]
    assert pr.runs_of([doc, doc, []]) == [brute_runs(doc), brute_runs(doc), []]


def test_long_periodic_texts():
    rng = random.Random(3)
    period = [b"%d" % rng.randrange(50) for _ in range(997)]
    assert pr.runs_of([[b"a"] * 30_000])[0] == [(0, 30_000, 1)]
    (run,) = [r for r in pr.runs_of([[b"x"] + period * 20])[0] if r[2] > 5]
    assert run == (1, 997 * 20, 997)


def cases():
    return [(1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "a a a a a a"), (6, "a a a a a"), (7, "ab ab ab ab ab ab ab ab ab"),
            (8, "x y x y x y x y"), (9, "x y x y x y x z"), (10, "é ñ é ñ é ñ é ñ é ñ e"), (None, "a b a b a b a b"), (5, "a a a a a a"),
            *[(i, " ".join(f"w{(i * j) % 7}" for j in range(60))) for i in range(20, 90)], (200, "z " * 5000 + "end")]


def test_table_equals_brute_force(spark, make_docs):
    rows = cases()
    for plant in (None, pr.planted):
        got = pr.periodic_runs(make_docs(rows, extra=("start", "n_runs", "runs", "period")), rewrite=plant).collect()
        assert sorted([tuple(r)[:8] for r in got], key=repr) == sorted([brute_row(d, t, plant) for d, t in rows], key=repr)
        assert all(hashlib.sha256(r.collapsed.encode()).hexdigest() == r.collapsed_sha256 and len(r.runs) == r.n_runs for r in got)
    assert pr.periodic_runs(make_docs([])).count() == 0


def test_small_blocks(spark, make_docs, monkeypatch):
    monkeypatch.setattr(pr, "WORDS", 50)
    got = pr.periodic_runs(make_docs(cases()), texts=False).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([brute_row(d, t, False) for d, t in cases()], key=repr)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, SMALL_SF, "documents").collect()]
    got = QUERIES["op11_periodic_runs"](spark, SMALL_SF)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    short = {d for d, t in rows if len(t or "") < 6000}
    assert sorted([tuple(r) for r in got.collect() if r.doc_id in short], key=repr) == sorted(
        [brute_row(d, t, True) for d, t in rows if d in short], key=repr)
