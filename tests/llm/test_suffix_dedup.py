import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from rxcover.llm import suffix_dedup as sd
from rxcover.llm.queries import QUERIES


@settings(max_examples=500, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40))
def test_order_equals_brute_force(s):
    assert sd.suffix_order(s) == sorted(range(len(s)), key=lambda i: s[i:])


@pytest.mark.parametrize("width", [10, 40])
def test_every_window_is_in_one_item(width):
    rng = np.random.default_rng(0)
    for data in (rng.integers(97, 99, 300), rng.integers(97, 120, 500), np.full(90, 97), np.tile([97, 98, 99], 50), np.full(width, 97)):
        data = data.astype(np.uint8)
        _, _, p, lo, hi = sd.items_of(data, width)
        starts = np.concatenate([np.arange(a, b + 1) for a, b in zip(lo, hi)])
        assert sorted(starts.tolist()) == list(range(len(data) - width + 1))
        assert ((lo <= p) & (p + width // 2 <= lo + width) & (hi <= p)).all()


def brute(rows, width):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i:i + width] for t in texts for i in range(len(t) - width + 1))
    out = []
    for (d, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - width + 1):
            if seen[t[i:i + width]] > 1:
                gone[i:i + width] = b"\1" * width
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed, width):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(rng.randrange(width // 5, width)) for _ in range(6)]
    rows = [text(rng.randrange(1, 200)) for _ in range(25)]
    rows += [text(rng.randrange(30)) + " " + rng.choice(passages)[rng.randrange(9):] + text(rng.randrange(30)) for _ in range(60)]
    base = text(150)
    for _ in range(25):       # near copies
        w = base.split()
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = word()
        rows.append(" ".join(w))
    rows += [passages[0]] * 3 + ["ab" * 500, "a" * (width - 1), "a" * width, "a" * (width + 1), "", None, "x" * (width - 1), "x" * (width - 1)]
    rows += [base[:width], base[1:width + 1], "tail " + passages[1][-width:], "abcabcab" * 60, text(20000 // width)]
    rng.shuffle(rows)
    return list(enumerate(rows)) + [(None, passages[2]), (0, rows[0])]


@pytest.mark.parametrize("seed,width,split", [(0, 60, 256), (1, 60, 4), (2, 48, 2), (3, 400, 8)])
def test_equals_brute_force(spark, make_docs, seed, width, split):
    rows = corpus(seed, width)
    got = sd.remove_repeats(make_docs(rows, extra=("sig", "g", "data", "n")), width, split)
    assert sorted([tuple(r)[:5] for r in got.collect()], key=repr) == brute(rows, width)


def test_kept_bytes_and_empty(spark, make_docs):
    assert sd.remove_repeats(make_docs([])).count() == 0
    shared = "".join(random.Random(5).choice("abcdefgh") for _ in range(450))
    got = {r.doc_id: r for r in sd.remove_repeats(make_docs([(1, "one " + shared + " end"), (2, shared + "two")])).collect()}
    assert bytes(got[1].kept) == b"one  end" and bytes(got[2].kept) == b"two" and got[1].n_removed == 450


def test_hot_anchor_at_full_width(spark, make_docs):
    """More distinct items of one anchor than are sorted together, at the contract's width."""
    rng = random.Random(11)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    core, tails = letters(330), [letters(90) for _ in range(3)]
    rows = list(enumerate(letters(100) + core + (tails[i % 3] if i % 7 == 0 else letters(90)) for i in range(sd.SPLIT + 44)))
    got = sd.remove_repeats(make_docs(rows), 400)
    assert sorted([tuple(r)[:5] for r in got.collect()], key=repr) == brute(rows, 400)


def test_passages_of_over_fifty_words(spark, make_docs, tmp_path):
    """A passage of over 50 words goes from 400 bytes on and stays below; other texts are left alone."""
    rng = random.Random(17)
    text = lambda n, size: " ".join("".join(rng.choices("abcdefghijklmnop", k=size)) for _ in range(n))
    passages = [text(52, 5), text(60, 6)[:399], text(60, 6)[:400], text(60, 7), text(90, 8)]
    assert [len(p) for p in passages] == [311, 399, 400, 479, 809] and all(len(p.split()) > 50 for p in passages)
    held = [(p, f"{text(40, 6)} {k}{p}{k} {text(40, 6)}") for p in passages for k in range(3)]
    held += [("", text(80, 6)) for _ in range(10)]
    make_docs([(i, t) for i, (_, t) in enumerate(held)]).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op10_suffix_dedup"](spark, str(tmp_path)).collect()}
    assert len(got) == len(held)
    for i, (p, t) in enumerate(held):
        gone = p if len(p) >= 400 else ""
        kept = hashlib.sha256(t.replace(gone, "").encode()).hexdigest()
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == (len(t), len(gone), bool(gone), kept)
