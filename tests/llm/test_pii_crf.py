import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from rxcover.llm import pii_crf as pc

# FIXED VALUES: the contract's patterns.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def brute(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end()) for m in re.finditer(EMAIL, text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(IP, text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(CARD, text):
        d = digits(m[0])
        s = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1]))
        if 12 <= len(d) <= 19 and s % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(PHONE, text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab@.-+ ()0123459é\n%", max_size=60))
def test_base_equals_the_patterns(text):
    assert pc.base_spans(text) == brute(text)


def test_runs_are_linear():
    assert pc.base_spans("1" * 200_000 + "a" * 200_000 + "@" + "+" * 200_000 + "1.1." * 50_000 + "a@b" * 50_000) is not None


ROWS = [(1, "call +1 (988) 555-2485 now. " + "word " * 500 + "again 1 988 555 2485 and 44 12 77 81 90 11"),
        (2, "card 4337166598464399 then 4337.1665.9846.4399 x"), (3, "mail jane.roe@ex.org; later jane.roe wrote, janeroe not"),
        (4, None), (5, ""), (6, "nothing 12345678901 here"), (7, "ip 42.144.35.254"), (7, "ip 42.144.35.254"),
        (None, "+1 (988) 555-2485"), (8, "9 " * 50000)]


def test_repeats_get_the_label(spark, make_docs):
    got = pc.find_pii(make_docs(ROWS, extra=("units", "spans", "i", "t"))).collect()
    assert len(got) == len(ROWS)
    text = dict(ROWS)
    by = {r.doc_id: r for r in got}
    for r in got:
        base = brute(text[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(",".join(f"{pc.KINDS[k]}:{a}:{b}" for a, k, b in base).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == q for _, q, _ in base) for k in range(4))
        assert {f"{pc.KINDS[k]}:{a}:{b}" for a, k, b in base} <= set(r.spans.split(","))  or not base
    cut = lambda i: [(s.split(":")[0], text[i][int(s.split(":")[1]):int(s.split(":")[2])]) for s in by[i].spans.split(",")]
    assert cut(1) == [("phone", "+1 (988) 555-2485"), ("phone", "1 988 555 2485")]
    assert cut(2) == [("card", "4337166598464399"), ("card", "4337.1665.9846.4399")]
    assert cut(3) == [("email", "jane.roe@ex.org"), ("email", "jane.roe")]
    assert by[4].spans == by[6].spans == by[8].spans == ""
    assert pc.find_pii(make_docs([])).count() == 0


def test_messages_match_enumeration():
    """On a small tree the messages are exact."""
    import itertools
    import numpy as np
    rng = random.Random(3)
    nodes = [(0, 5, 4, 11, 0, 9), (100, 110, 0, 11, 7, 9), (300, 310, 0, 12, 7, 10), (320, 330, 0, 13, 0, 11)]
    prior = np.array([[0.0] + [-rng.random() * 3 for _ in range(4)] for _ in range(20)])
    chain = np.zeros((5, 5))
    chain[1:, 1:] = np.eye(4) * 0.7
    marg = np.zeros((4, 5))
    for ys in itertools.product(range(5), repeat=4):
        if ys[0] != 4:
            continue
        s = sum(prior[n[5]][y] for n, y in zip(nodes, ys) if not n[2])
        for i, j, sort in pc.edges(nodes):
            s += (chain[ys[i], ys[j]] if sort == 0 else (ys[i] == ys[j] > 0) * (pc.SKIP_SAME if sort == 1 else pc.SKIP_SIMILAR))
        for i, y in enumerate(ys):
            marg[i, y] += np.exp(s)
    assert (pc.infer(nodes, prior, chain) == marg.argmax(axis=1)).all()


def test_similar_repeat_of_a_base_span_only(spark, make_docs):
    rows = [(1, "call +44 20 7946 0958 now. " + "word " * 50 + "again 020 7946 0958 please"),
            (2, "order 1234567 and " + "word " * 50 + "1234567, " + "word " * 50 + "1234567 or " + "word " * 50 + "1234567"),
            (3, " ".join("word " * 20 + f"{k}98 7654321" for k in range(40))),
            (4, "again 020 7946 0958. " + "word " * 50 + "020-7946-0958 or " + "word " * 50 + "+44 20 7946 0958")]
    by = {r.doc_id: r.spans for r in pc.find_pii(make_docs(rows)).collect()}
    cut = lambda i: [rows[i - 1][1][int(s.split(":")[1]):int(s.split(":")[2])] for s in by[i].split(",")]
    assert cut(1) == ["+44 20 7946 0958", "020 7946 0958"]
    assert by[2] == by[3] == ""
    assert cut(4) == ["020 7946 0958", "020-7946-0958", "+44 20 7946 0958"]


def test_weights_hold_at_the_least_prior():
    """Against the least prior a base span lifts its repeats; free units alone,
    beside averse or friendly neighbours, lift nothing at the best prior."""
    import numpy as np
    prior = np.full((20, 5), pc.NO_PATTERN - 3.0)
    prior[:, 0] = 0.0
    repeats = [(100 * i, 100 * i + 12, 4 * (i == 0), i % 3, 77, 11) for i in range(30)]
    assert (pc.infer(repeats, prior, np.zeros((5, 5))) == 4).all()
    prior[:, 4] = pc.NO_PATTERN
    chain = np.zeros((5, 5))
    chain[4, 4] = 1.0
    free = [(20 * i, 20 * i + 12, 0, 5, 77, 11) for i in range(200)]
    assert (pc.infer(free, prior, chain) == 0).all()
