"""Operator 13 against the tokenizer, text by text, and the rules of packing."""

import itertools
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from rxcover.llm import packing as pk
from rxcover.llm.common import read
from rxcover.llm.queries import QUERIES
from tokenizers import Tokenizer

from tests.conftest import SMALL_SF

ODD = ["", " ", "It's the cat's, they'RE we'd'll 'S", "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>", "naïve CAFÉ café ́x",
       "Ca한국어 日本語テスト Іİstanbul ΣΣ Σ.", "a b c d\x85e\x1cf\x0bg", "1234 ½² ٣ Ⅷ", "‘quoted’ – — €5…",
       "\U0001f600\U0001f468‍\U0001f469 emoji", "x" * 300, "tab\tnew\nline\r\n\x0c", "ǅẞﬁ Å Ω", "\x00\x7f\xad", "don''t !!?? ...--- #$%"]


_TOKENIZER, _TOKENS = Tokenizer.from_file(pk.MODEL), pk.Tokens(pk.MODEL)


def expected(text):
    return _TOKENIZER.encode(text or "", add_special_tokens=False).ids + [1]


def test_ids_equal_the_tokenizer(monkeypatch):
    t = pk.Tokens(pk.MODEL)
    for texts in (ODD, [" ".join(ODD)], ODD):
        assert [np.frombuffer(x, "<u4").tolist() + [1] for x in t.encode(texts)] == [expected(x) for x in texts]
    monkeypatch.setattr(pk, "BLOCK", 7)
    assert [np.frombuffer(x, "<u4").tolist() + [1] for x in t.encode(ODD)] == [expected(x) for x in ODD]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    assert np.frombuffer(_TOKENS.encode([text])[0], "<u4").tolist() + [1] == expected(text)


def best_count(sizes, c):
    """Fewest bins by trying them all."""
    best = len(sizes)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(sizes):
            best = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + sizes[i] <= c:
                bins[k] += sizes[i]
                go(i + 1, bins)
                bins[k] -= sizes[i]
        go(i + 1, [*bins, sizes[i]])

    go(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=8))
def test_bound_and_fit(sizes):
    sizes = sorted(sizes, reverse=True)
    least = best_count(sizes, 20)
    bound = pk.lower_bound(np.bincount(np.array(sizes, np.int64), minlength=21))
    where, offset = pk.best_fit(np.array(sizes, np.int64), 20)
    assert bound <= least <= (where.max() + 1 if sizes else 0)
    for b in set(where.tolist()):
        own = [(o, n) for w, o, n in zip(where, offset, sizes) if w == b]
        assert [o for o, _ in own] == list(itertools.accumulate([0] + [n for _, n in own[:-1]])) and sum(n for _, n in own) <= 20


def test_bounds_beyond_the_sum():
    assert pk.lower_bound(np.bincount([11, 11, 11], minlength=21)) == 3
    assert pk.lower_bound(np.bincount([7] * 9, minlength=21)) == 5


def held(rows, pieces, sequence):
    """Pieces cover every document's ids; sequences are gapless."""
    by_doc = {}
    for p in sorted(pieces, key=lambda r: r.piece):
        by_doc.setdefault(p.doc_id, []).append(p)
    assert sorted(by_doc, key=repr) == sorted({d for d, _ in rows}, key=repr)
    for d, text in rows:
        ids, at = expected(text), 0
        for p in by_doc[d]:
            part = np.array(ids[at:at + sequence], "<u4")
            assert (p.start, p.length, p.ids_crc32) == (at, len(part), zlib.crc32(part.tobytes()))
            at += len(part)
        assert at == len(ids)
    seqs = {}
    for p in pieces:
        seqs.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for s in seqs.values():
        s.sort()
        assert [o for o, _ in s] == list(itertools.accumulate([0] + [n for _, n in s[:-1]])) and sum(n for _, n in s) <= sequence
    return len(seqs)


@pytest.mark.parametrize("group", [1 << 13, 6])
def test_pack_documents(spark, make_docs, monkeypatch, group):
    monkeypatch.setattr(pk, "GROUP_PIECES", group)
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["cat", "dog", "it's", "été"]) for _ in range(rng.randrange(0, 90)))) for i in range(70)]
    rows += [(100, None), (101, ""), (102, "long " * 1000), (None, "no id")]
    got = pk.pack_documents(make_docs(rows, extra=("row", "g", "bin", "ids", "sequence_id")), sequence=50, with_ids=True).collect()
    n = held(rows, got, 50)
    bound = pk.lower_bound(np.bincount([r.length for r in got], minlength=51))
    assert bound <= n <= bound + (0 if group > 100 else 2)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in got)
    assert pk.pack_documents(make_docs([])).count() == 0


def test_repeated_rows(spark, make_docs):
    got = pk.pack_documents(make_docs([(1, "a b"), (1, "a b"), (None, None), (None, None)])).collect()
    assert len(got) == 4 and len({(r.sequence_id, r.offset) for r in got}) == 4


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, SMALL_SF, "documents").collect()]
    df = QUERIES["op13_packing"](spark, SMALL_SF)
    assert df.dtypes == [("doc_id", "bigint"), ("piece", "int"), ("start", "bigint"), ("length", "bigint"), ("ids_crc32", "bigint"),
                         ("sequence_id", "bigint"), ("offset", "bigint")]
    got = df.collect()
    assert held(rows, got, 4096) == pk.lower_bound(np.bincount([r.length for r in got], minlength=4097))
