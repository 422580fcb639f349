"""Personal data by patterns and a skip-chain conditional random field.

Patterns find the base spans. The field's nodes are a document's base spans
(their label is fixed) and its free units: number-like runs and mentions of
an e-mail's local part that no pattern accepts. Chain edges join neighbours;
skip edges join consecutive units, however far apart, whose digits or local
parts are equal, or similar (same last seven digits). Loopy sum-product messages carry labels along both, so a repeat that is
written differently gets the label of the occurrence that a pattern accepts.
Skip edges act only where a base span is among the units they connect: free
units alone give each other no label, however often they repeat.

Potentials: a unit's label prior by digit count, and the chain's label
affinities, are piecewise estimates from counts over all documents; the
weights of skip edges and the cost of a label without a pattern are
parameters. One scan of the texts stores the units; counts and messages run
on those.

Defined results: a null text is empty (no spans, the digest of the empty
string); offsets are code points, ends exclusive; added spans never overlap
base ones; repeated rows give repeated rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxcover.llm.common import stored

KINDS = ("email", "ip", "card", "phone")
#: One similar edge to a base span outweighs NO_PATTERN with the least prior
#: (-4 - 3); one same edge also two averse chain neighbours (-1 each).
SKIP_SAME, SKIP_SIMILAR, NO_PATTERN = 10.0, 8.0, -4.0
CHAIN_GAP = 40
MAX_STEPS, DAMPING, SETTLED = 30, 0.3, 1e-4
LEAST_DIGITS, LEAST_NAME = 7, 5

# Each equals the leftmost, non-overlapping reading of the contract's pattern
# in linear time: a match can only start where a run of digits starts.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NUMBER = re.compile(r"\+?\(?[0-9](?:[\x20().-]{0,2}[0-9])++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_MARKED = re.compile(r"[0-9._%+-]")  # a plain word is no mention of an address
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        # a run that ends here is not read again: it holds no other @
        done = max(done, at + 1)
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in order."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            d = _NOT_DIGIT.sub("", m[0])
            if 12 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    out.sort()
    return out


def _hash(s: str) -> int:
    return int.from_bytes(hashlib.blake2b(s.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def units(text: str) -> list[tuple[int, int, int, int, int, int]]:
    """(start, end, label, key, similar, digits): base spans with label 1 to
    4 and free units with label 0, by start."""
    base = base_spans(text)
    out, taken = [], []
    for a, k, b in base:
        s = text[a:b]
        if k == 0:
            key, sim, nd = _hash(s[:s.index("@")].lower()), 0, 0
        else:
            d = _NOT_DIGIT.sub("", s)
            key, sim, nd = _hash(d), _hash("~" + d[-LEAST_DIGITS:]) if len(d) >= LEAST_DIGITS else 0, len(d)
        out.append((a, b, k + 1, key, sim, nd))
        taken.append((a, b))
    taken.sort()
    free = []
    for m in _NUMBER.finditer(text):
        d = _NOT_DIGIT.sub("", m[0])
        if LEAST_DIGITS <= len(d) <= 19:
            free.append((m.start(), m.end(), 0, _hash(d), _hash("~" + d[-LEAST_DIGITS:]), len(d)))
    names = {text[a:b].split("@")[0].lower() for a, k, b in base if k == 0}
    for name in sorted(n for n in names if len(n) >= LEAST_NAME and _MARKED.search(n)):
        for m in re.finditer(rf"(?<![A-Za-z0-9._%+-]){re.escape(name)}(?![A-Za-z0-9._%+@-])", text, re.I):
            free.append((m.start(), m.end(), 0, _hash(name), 0, 0))
    free.sort()
    i, last = 0, -1
    for u in free:
        while i < len(taken) and taken[i][1] <= u[0]:
            i += 1
        j, clear = i, u[0] >= last
        while j < len(taken) and taken[j][0] < u[1]:
            clear = clear and taken[j][1] <= u[0]
            j += 1
        if clear:
            out.append(u)
            last = u[1]
    out.sort()
    return out


def edges(nodes: list[tuple]) -> list[tuple[int, int, int]]:
    """(i, j, sort) with sort 0 chain, 1 same, 2 similar; linear in number."""
    out, same, similar = [], {}, {}
    for j, (a, _, _, key, sim, _) in enumerate(nodes):
        if j and a - nodes[j - 1][1] <= CHAIN_GAP:
            out.append((j - 1, j, 0))
        i = same.get(key)
        if i is not None:
            out.append((i, j, 1))
        elif sim and sim in similar:
            out.append((similar[sim], j, 2))
        same[key] = j
        if sim:
            similar[sim] = j
    return out


def anchored(nodes: list[tuple], link: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """``link`` without the skip edges among units that skip edges connect to
    no base span. A unit has one skip edge to an earlier unit at most."""
    root = list(range(len(nodes)))
    for i, j, sort in link:
        if sort:
            root[j] = root[i]
    held = {r for r, u in zip(root, nodes) if u[2]}
    return [x for x in link if not x[2] or root[x[1]] in held]


def infer(nodes: list[tuple], prior: np.ndarray, chain: np.ndarray) -> np.ndarray:
    """The label of every node, 0 for none, by loopy sum-product messages."""
    n, k = len(nodes), len(KINDS) + 1
    label = np.array([u[2] for u in nodes])
    unary = np.full((n, k), -1e9)
    unary[np.arange(n)[label > 0], label[label > 0]] = 0.0
    free = np.flatnonzero(label == 0)
    unary[free] = prior[[nodes[i][5] for i in free]]
    link = anchored(nodes, edges(nodes))
    if not link:
        return unary.argmax(axis=1)
    same, similar = np.zeros((k, k)), np.zeros((k, k))
    for y in range(1, k):
        same[y, y], similar[y, y] = SKIP_SAME, SKIP_SIMILAR
    weight = np.stack((chain, same, similar))
    e = np.array(link)
    src, dst = np.concatenate((e[:, 0], e[:, 1])), np.concatenate((e[:, 1], e[:, 0]))
    back = np.concatenate((np.arange(len(e)) + len(e), np.arange(len(e))))
    w = np.exp(weight)[np.concatenate((e[:, 2], e[:, 2]))]
    msg = np.zeros((len(src), k))
    for _ in range(MAX_STEPS):
        belief = unary.copy()
        np.add.at(belief, dst, msg)
        out = belief[src] - msg[back]
        out -= out.max(axis=1, keepdims=True)
        new = np.log(np.einsum("ei,eij->ej", np.exp(out), w))
        new -= new.max(axis=1, keepdims=True)
        new = (1 - DAMPING) * new + DAMPING * msg
        done = np.abs(new - msg).max() < SETTLED
        msg = new
        if done:
            break
    belief = unary.copy()
    np.add.at(belief, dst, msg)
    return belief.argmax(axis=1)


def describe(nodes: list[tuple], prior: np.ndarray, chain: np.ndarray) -> tuple:
    base = sorted((a, y - 1, b) for a, b, y, *_ in nodes if y)
    spans = base
    if any(u[2] == 0 for u in nodes):
        found = infer(nodes, prior, chain)
        spans = sorted(base + [(u[0], int(y) - 1, u[1]) for u, y in zip(nodes, found) if u[2] == 0 and y])
    show = lambda x: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in x)
    return (*(sum(k == q for _, q, _ in base) for k in range(4)),
            hashlib.sha256(show(base).encode()).hexdigest(), show(spans))


# --------------------------------------------------------------------------
# Spark jobs

UNIT = "array<struct<a:int,b:int,y:int,key:bigint,sim:bigint,digits:int>>"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, units`` per row."""
    names = ("a", "b", "y", "key", "sim", "digits")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["i"], "units": [[dict(zip(names, u)) for u in units(t)] if t else []
                                                              for t in pdf["t"]]}).astype({"doc_id": "Int64"})

    return docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).mapInPandas(
        run, f"doc_id long, units {UNIT}")


def potentials(scanned: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Label priors by digit count (20 rows) and chain affinities, from
    counts over all documents; both tables have a fixed size."""
    k = len(KINDS) + 1
    prior, pair = np.ones((20, k)), np.ones((k, k))
    near = F.explode(F.filter(F.transform(F.sequence(F.lit(1), F.size("units") - 1), lambda i: F.struct(
        F.get("units", i - 1)["y"].alias("p"), F.get("units", i)["y"].alias("q"),
        (F.get("units", i)["a"] - F.get("units", i - 1)["b"]).alias("gap"))), lambda x: x["gap"] <= CHAIN_GAP)).alias("x")
    own = scanned.select(F.explode("units").alias("u")).groupBy(
        F.lit(0).alias("sort"), F.col("u.digits").alias("i"), F.col("u.y").alias("j")).count()
    two = scanned.where(F.size("units") > 1).select(near).groupBy(
        F.lit(1).alias("sort"), F.col("x.p").alias("i"), F.col("x.q").alias("j")).count()
    for r in own.union(two).collect():
        if r["sort"] == 0 and r["j"] > 0:
            prior[min(19, r["i"]), r["j"]] += r["count"]
        elif r["sort"] == 1:
            pair[r["i"], r["j"]] += r["count"]
    prior = NO_PATTERN + np.clip(np.log(prior / prior[:, 1:].sum(axis=1, keepdims=True)), -3, 0)
    prior[:, 0] = 0.0
    pair = pair + pair.T
    p = pair / pair.sum()
    pmi = np.clip(np.log(p / np.outer(p.sum(axis=1), p.sum(axis=0))), -1, 1)
    pmi[0, :] = pmi[:, 0] = 0.0
    return prior, pmi


def find_pii(docs: DataFrame, **kw) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans``; the
    counts and the digest are those of the base spans."""
    scanned = stored(scan(docs, **kw), "pii-units")
    prior, chain = potentials(scanned)
    names = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [describe([(u["a"], u["b"], u["y"], u["key"], u["sim"], u["digits"]) for u in us], prior, chain)
                    for us in pdf["units"]]
            out = pd.DataFrame(rows, columns=names)
            out.insert(0, "doc_id", pdf["doc_id"].to_numpy())
            yield out.astype({"doc_id": "Int64"})

    return scanned.mapInPandas(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                                    "base_sha256 string, spans string")
