"""Runs of periodic words: stretches that repeat a period four times or more.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical), of ``max(6, 4 * q)`` words or more, that no neighbouring word
extends. Every word of a run lies in a run of four words that occurs again in
its document, so words outside such repeats are left out first; what remains
are separate segments.

The suffixes of all segments of some documents are sorted by prefix doubling,
and neighbouring suffixes' common prefixes read off the doubled ranks. Edges
between neighbours are then taken by descending common prefix, as Kruskal
would: they unite the suffixes' classes, whose positions are kept in order.
Positions i < j that become neighbours in a class of common prefix c hold the
period d = j - i over d + c words, and no smaller one, as a smaller one would
have put a position between them before. If c is long enough and the word
before i differs from the word before j, they are the start of a run.

Defined results: a null text has no words; a text without words, or without
runs, has no runs, and its words stay; repeated rows give repeated rows; a
null ``doc_id`` is kept; an empty table gives no rows; other columns are not
read. A document's words are in one task.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxcover.llm.common import mix64

#: Least length, and repeats, of a run; words of the repeats that cover runs.
LEAST, REPEATS, GRAM = 6, 4, 4
#: Words a task holds at a time, unless one document has more.
WORDS = 1 << 19

Rewrite = Callable[[object, list[bytes]], list[bytes]]
Run = tuple[int, int, int]


class Ids(dict):
    def __missing__(self, word):
        self[word] = n = len(self)
        return n


# --------------------------------------------------------------------------
# segments and suffixes

def segments(ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the longest stretches covered by ``GRAM`` words that
    their document holds twice; ``starts`` are the documents' first words and,
    last, the number of words. A collision of hashes only keeps more."""
    n = len(ids)
    if n < LEAST:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(starts) - 1, dtype=np.int64), np.diff(starts))
    h = mix64(ids.astype(np.uint64) + np.uint64(1))
    key = mix64(doc[:n - GRAM + 1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    for k in range(GRAM):
        key = key * np.uint64(0xD1342543DE82EF95) + h[k:n - GRAM + 1 + k]
    inside = np.flatnonzero(doc[:n - GRAM + 1] == doc[GRAM - 1:])
    _, back, count = np.unique(key[inside], return_inverse=True, return_counts=True)
    at = inside[count[back] > 1]
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + GRAM, -1)
    on = np.concatenate(([False], np.cumsum(edge[:n]) > 0, [False]))
    cut = np.zeros(n + 1, bool)
    cut[starts] = True                       # a stretch ends with its document
    first = np.flatnonzero(on[1:-1] & (~on[:-2] | cut[:n]))
    last = np.flatnonzero(on[1:-1] & (~on[2:] | cut[1:])) + 1
    keep = last - first >= LEAST
    return first[keep], last[keep]


def suffixes(ids: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The suffixes of the segments laid end to end, in order, each segment by
    itself; common prefixes with the next; and each place's word rank."""
    size = last - first
    seg = np.repeat(np.arange(len(size)), size)
    begin = np.concatenate(([0], np.cumsum(size)))
    n = int(begin[-1])
    place = np.arange(n)
    words = ids[place - begin[seg] + first[seg]].astype(np.int64)
    end = begin[seg + 1]
    rank = np.unique(seg * (int(ids.max()) + 1) + words, return_inverse=True)[1].astype(np.int64)
    own, levels, k = rank, [rank.astype(np.int32)], 1
    while True:
        after = np.full(n, -1, np.int64)
        more = np.flatnonzero(place + k < end)
        after[more] = rank[more + k]
        key = rank * (n + 1) + after + 1
        order = np.argsort(key, kind="stable")
        step = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
        rank = np.empty(n, np.int64)
        rank[order] = step
        k *= 2
        if step[-1] == n - 1:
            break
        levels.append(rank.astype(np.int32))
    a, b = order[:-1], order[1:]
    common = np.zeros(max(n - 1, 0), np.int64)
    for up in range(len(levels) - 1, -1, -1):
        x, y = a + common, b + common
        ok = (x < end[a]) & (y < end[b])
        same = np.flatnonzero(ok)[levels[up][x[ok]] == levels[up][y[ok]]]
        common[same] += 1 << up
    return order, common, own


# --------------------------------------------------------------------------
# classes by descending common prefix

def kruskal(order: np.ndarray, common: np.ndarray, rank: np.ndarray, begins: np.ndarray) -> list[Run]:
    """Runs ``(place, length, period)``. Classes are lists of places in order;
    of two that unite, the smaller's places go into the larger's."""
    edges = np.flatnonzero(common >= LEAST - 1)
    edges = edges[np.argsort(-common[edges], kind="stable")]
    start = np.zeros(len(order), bool)
    start[begins] = True
    rank, start = rank.tolist(), start.tolist()
    up: dict[int, int] = {}
    of: dict[int, list[int]] = {}
    found: list[Run] = []

    def root(x: int) -> int:
        if x not in up:
            up[x] = x
            of[x] = [x]
            return x
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    def seed(i: int, j: int, c: int) -> None:
        d = j - i
        if d + c >= LEAST and c >= (REPEATS - 1) * d and (start[i] or rank[i - 1] != rank[j - 1]):
            found.append((i, d + c, d))

    for a, b, c in zip(order[edges].tolist(), order[edges + 1].tolist(), common[edges].tolist()):
        a, b = root(a), root(b)
        small, large = of.pop(a), of.pop(b)
        if len(small) > len(large):
            small, large = large, small
            a, b = b, a
        up[a] = b
        after = None                 # the small class's place put in last
        for k in range(len(small) - 1, -1, -1):
            p = small[k]
            at = bisect_left(large, p)
            if at < len(large) and large[at] != after:
                seed(p, large[at], c)
            if at and not (k and small[k - 1] > large[at - 1]):
                seed(large[at - 1], p, c)
            large.insert(at, p)
            after = p
        of[b] = large
    return found


def runs_of(docs: list[list[bytes]]) -> list[list[Run]]:
    """The runs ``(start, length, period)`` of every document's words, by
    start, then period."""
    known = Ids()
    ids = np.fromiter((known[w] for d in docs for w in d), np.int64)
    starts = np.concatenate(([0], np.cumsum([len(d) for d in docs]))).astype(np.int64)
    out: list[list[Run]] = [[] for _ in docs]
    first, last = segments(ids, starts)
    if not len(first):
        return out
    begin = np.concatenate(([0], np.cumsum(last - first)))
    order, common, rank = suffixes(ids, first, last)
    found = kruskal(order, common, rank, begin[:-1])
    seg = np.searchsorted(begin, [r[0] for r in found], side="right") - 1
    where = first[seg] + np.array([r[0] for r in found], np.int64) - begin[seg]
    of = np.searchsorted(starts, where, side="right") - 1
    for w, d, (_, length, period) in zip(where.tolist(), of.tolist(), found):
        out[d].append((w - int(starts[d]), length, period))
    for r in out:
        r.sort(key=lambda x: (x[0], x[2]))
    return out


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]


# --------------------------------------------------------------------------
# Spark job

def periodic_runs(docs: DataFrame, rewrite: Rewrite | None = None, texts: bool = True) -> DataFrame:
    """``doc_id, n_runs``, the longest run's ``start, length, period,
    exponent_milli``, ``runs_sha256`` and ``collapsed_sha256`` per document,
    and with ``texts`` the ``runs`` and the ``collapsed`` text. ``rewrite``
    changes a document's words before."""
    given = docs.select("doc_id", F.coalesce(F.encode("text", "utf-8"), F.lit(b"")).alias("text"))
    names = ("n_runs", "start", "length", "period", "exponent_milli")
    schema = T.StructType([given.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in names),
                           T.StructField("runs_sha256", T.StringType()), T.StructField("collapsed_sha256", T.StringType())])
    run = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    if texts:
        schema.add("runs", T.ArrayType(run)).add("collapsed", T.StringType())
    runs_type = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def row(words: list[bytes], runs: list[Run]) -> tuple:
        kept = b" ".join(collapsed(words, runs))
        start = length = period = milli = None
        if runs:
            start, length, period = max(runs, key=lambda r: (r[1], -r[0], -r[2]))
            milli = 1000 * length // period
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()
        out = (len(runs), start, length, period, milli, hashlib.sha256(lines).hexdigest(), hashlib.sha256(kept).hexdigest())
        return (*out, [dict(zip(("start", "length", "period"), r)) for r in runs], kept.decode("utf-8", "replace")) if texts else out

    def answer(batch: pa.RecordBatch, docs_: list[list[bytes]]) -> pa.RecordBatch:
        rows = [row(w, r) for w, r in zip(docs_, runs_of(docs_))]
        cols = list(zip(*rows))
        types = [pa.int64()] * 5 + [pa.string()] * 2 + ([runs_type, pa.string()] if texts else [])
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(cols, types))], names=schema.names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, data = batch.column("doc_id"), batch.column("text")
            first, some, many = 0, [], 0
            for i in range(batch.num_rows):
                words = data[i].as_py().split()              # bytes: splits at the contract's white space
                if rewrite is not None:
                    words = rewrite(ids[i].as_py(), words)
                some.append(words)
                many += len(words)
                if many >= WORDS or i == batch.num_rows - 1:
                    yield answer(batch.slice(first, len(some)), some)
                    first, some, many = i + 1, [], 0

    return given.mapInArrow(work, schema)


def planted(doc_id: object, words: list[bytes]) -> list[bytes]:
    """One document in ten, by the CRC of its id, made periodic from some word
    on (the registered query's rule). A null id leaves the words."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * (-(-(n - a) // p)))[:n - a]
