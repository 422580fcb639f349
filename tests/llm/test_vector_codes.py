"""Operator 12 against plain integer arithmetic, entry by entry."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T
from rxcover.llm import vector_codes as vc

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("label", T.IntegerType())])


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 40), st.sampled_from([1, 3, 50, 30_000]))
def test_nearest_equals_all_entries(seed, many, top):
    rng = np.random.default_rng(seed)
    entries = rng.integers(-top, top + 1, (many, 3))
    points = np.concatenate([rng.integers(-top, top + 1, (30, 3)), entries])
    index, best = vc.nearest(vc.gnat(entries), entries, points)
    d = vc.squared(points, entries)
    assert (index == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()


def test_branches_are_left_out():
    entries = np.array([[1000 * (i // 4), i % 4] for i in range(16)])
    seen = []
    tree = vc.gnat(entries)
    real, vc.squared = vc.squared, lambda a, b: seen.append(len(a) * len(b)) or real(a, b)
    try:
        vc.nearest(tree, entries, np.array([[3, 1]] * 10))
    finally:
        vc.squared = real
    assert sum(seen) < 10 * len(entries)


def brute(rows, entries=16):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    ints = [[math.floor(4096 * float(np.float32(x))) for x in r[1]] for r in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))[:entries]
    w = len(ints[0]) // 8 if ints else 0
    books = [[ints[i][p * w:p * w + w] for i in order] for p in range(8)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [[min((dist(v[p * w:p * w + w], e), k) for k, e in enumerate(books[p])) for p in range(8)] for v in ints]

    for _ in range(6):
        got = assign()
        for p in range(8):
            for k in range(len(books[p])):
                own = [v[p * w:p * w + w] for v, a in zip(ints, got) if a[p][1] == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    got = assign()
    errors = [sum(d for d, _ in a) for a in got]
    by = {}
    for r, e in zip(kept, errors):
        by[r[2]] = by.get(r[2], 0) + e
    h = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(r[0], "".join(f"{k:02x}" for _, k in a), e, by[r[2]], h) for r, a, e in zip(kept, got, errors)]


def vectors(seed, many, dim=16):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.2, dim)], int(rng.integers(3)) if i % 5 else None) for i in range(many)]
    return rows + [(i, rows[3][1], 1) for i in range(many, many + 9)]


@pytest.mark.parametrize("seed,many", [(0, 60), (1, 5), (2, 200)])
def test_equals_brute_force(spark, seed, many):
    rows = vectors(seed, many) + [(-5, None, 1), (-4, [float("nan")] * 16, 1), (-3, [float("inf")] * 16, 2), (-2, [None] * 16, 0),
                                  (None, [0.5] * 16, None), (7, [0.25] * 16, 7), (7, [-0.25] * 16, 7)]
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    for c in ("v", "of", "code", "error", "part"):
        df = df.withColumn(c, F.lit("clash"))
    got = [tuple(r) for r in vc.compress(df).collect()]
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)


def test_empty_and_odd_tables(spark):
    assert vc.compress(spark.createDataFrame([], VECTORS)).count() == 0
    assert vc.compress(spark.createDataFrame([(1, None, 1)], VECTORS)).count() == 0
    for rows in ([(1, [0.5] * 12, 1)], [(1, [0.5] * 16, 1), (2, [0.5] * 8, 1)], [(1, [1e30] * 16, 1)]):
        with pytest.raises(Exception):  # noqa: B017
            vc.compress(spark.createDataFrame(rows, VECTORS)).collect()
