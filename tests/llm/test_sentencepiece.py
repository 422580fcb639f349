import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from rxcover.llm import sentencepiece as sp
from sentencepiece import SentencePieceProcessor

V = sp.Vocabulary.load()
ODD = ["", "  a  b", "日本語 テキスト\n\n\tx", "😀 é", "<s> </s> <0x0A> <unk>", "a" * 100, "the" * 60, "\x00\x01", " ", " " * 40,
       "Hello world, the quick brown fox.\r\n"]


def test_without_dropout_equals_the_library():
    lib = SentencePieceProcessor(model_file=sp.MODEL)
    for t, ids in zip(ODD, V.encode(ODD, [0] * len(ODD), dropout=0.0)):
        assert ids.tolist() == lib.encode(t)


def brute(text, key, dropout, seed):
    """All candidates anew after every merge; skipped ones by the same hash."""
    salt = int(sp.mix64(np.array([(key ^ (seed * sp._C[0])) & sp._M], np.uint64))[0])
    chars = list(" " + text) if text else []
    ids = [int(V.table("symbol")[ord(c)]) for c in chars]
    at = list(range(len(ids)))
    while True:
        best = None
        for i in range(len(ids) - 1):
            hit = V.table("pairs").get(ids[i] << 32 | ids[i + 1]) if ids[i] >= 0 <= ids[i + 1] else None
            if hit is None or best is not None and hit[0] >= best[0]:
                continue
            x = (salt + at[i] * sp._C[0]) & sp._M
            x ^= (ids[i] * sp._C[1] + ids[i + 1] * sp._C[2]) & sp._M
            if int(sp.mix64(np.array([x], np.uint64))[0]) < int(dropout * 2.0 ** 64):
                continue
            best = (hit[0], i, hit[1])
        if best is None:
            break
        ids[best[1]:best[1] + 2] = [best[2]]
        del at[best[1] + 1]
    out = []
    for i, a in zip(ids, at):
        out += [i] if i >= 0 else V.byte_ids[list(chars[a].encode())].tolist()
    return out


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="the andiou sé▁\n日", max_size=70), st.integers(0, 2 ** 63), st.sampled_from([0.1, 0.5]))
def test_dropout_equals_brute_force_and_is_lossless(text, key, dropout):
    got = V.encode([text], [key], dropout, 5)[0].tolist()
    assert got == brute(text, key, dropout, 5)
    assert V.decode(got) == text


@pytest.mark.parametrize("long", [1, 8, 40])
def test_matrix_and_heap_agree(monkeypatch, long):
    texts = ODD + ["Ofthedingble bletiti ha, for and the erhest " * 20]
    want = V.encode(texts, list(range(len(texts))))
    monkeypatch.setattr(sp, "LONG", long)
    for a, b in zip(want, V.encode(texts, list(range(len(texts))))):
        assert a.tolist() == b.tolist()


def test_varied_by_key_and_settled_by_seed():
    t = "The quick brown foxes were jumping over everything " * 4
    a, b, c = V.encode([t, t, t], [1, 2, 1])
    assert a.tolist() != b.tolist() and a.tolist() == c.tolist()
    assert V.encode([t], [1], seed=9)[0].tolist() != a.tolist()
    assert len(a) > len(V.encode([t], [1], dropout=0.0)[0])


def test_query_rows(spark, make_docs):
    rows = [(1, "a b"), (2, None), (3, ""), (4, "▁é\n" * 3), (5, "word " * 40000), (1, "a b"), (None, "x"), (7, "\u0000")]
    got = sp.summary(make_docs(rows, extra=("pieces", "decoded"))).collect()
    assert len(got) == len(rows) and all(r.lossless for r in got)
    by = {r.doc_id: r for r in got}
    assert by[2].n_pieces is None and by[3].n_pieces == 0 and by[5].n_chars == 200000
    assert sp.summary(make_docs([])).count() == 0
    pieces = sp.encode(make_docs(rows, extra=("pieces_", "lossless_")), ["doc_id", "pieces_"])
    texts = pieces.select("doc_id", sp.decoder(sp.Vocabulary.load())("pieces").alias("t")).collect()
    assert sorted([tuple(r) for r in texts], key=repr) == sorted(rows, key=repr)
