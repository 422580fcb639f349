"""Removal of repeated byte strings by suffix sorting.

A byte is removed when it is covered by a string of ``width`` bytes that also
starts anywhere else in the corpus. Every such string (window) has one anchor:
the leftmost run of ``KEY`` bytes in it with the least hash. Equal windows have
equal anchors at equal places, so

1. windows are grouped by anchor; a text's windows with one anchor are a run,
   an item. Anchors that occur once are dropped;
2. items with the same bytes are counted; all their windows are repeated;
3. the distinct items of an anchor are suffix-sorted together, and windows
   next to each other in that order are compared. Suffixes are sorted by
   linear grouping construction: groups of suffixes with the same Lyndon
   prefix are handled from the greatest down, each group extending the
   prefixes of its suffixes' previous smaller ones, then the groups are filled
   in ascending order, without renaming or recursion;
4. an anchor with more than ``SPLIT`` distinct items is split by the window's
   place around the anchor, first into blocks, then into single windows, which
   need only counting. So no group grows with the corpus.

Equal whole texts are one class. Texts and items are identified by 64-bit
hashes. Windows of different items are compared byte by byte where an anchor
has up to ``SPLIT`` of them; beyond, single windows are counted by their hash.

Defined results: a null text is empty; texts shorter than ``width`` keep all;
overlapping occurrences count; strings are judged on the input; repeated rows
are copies, so all of a text of ``width`` bytes or more goes; other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxcover.llm.common import bit_filter, mix64, stored
from rxcover.llm.words import powers, prefix_sums

WIDTH = 400
SPLIT = 256
BLOCKS = (20, 1)


# --------------------------------------------------------------------------
# suffix sorting

def suffix_order(s: list[int]) -> list[int]:
    """Start positions of the suffixes of ``s`` in ascending order."""
    n = len(s)
    if not n:
        return []
    # groups from low to high by first letter: the Lyndon prefixes of length 1
    letters = sorted(set(s))
    number = {c: g for g, c in enumerate(letters)}
    group = [number[c] for c in s]
    members: list[list[int]] = [[] for _ in letters]
    for i, g in enumerate(group):
        members[g].append(i)
    below = list(range(-1, len(letters) - 1))      # the next smaller group
    above = list(range(1, len(letters) + 1))
    length = [1] * n
    left = list(range(-1, n - 1))                  # previous smaller, once done
    done = bytearray(n)
    descending: list[int] = []
    g = len(letters) - 1
    while g >= 0:
        own = [i for i in members[g] if group[i] == g]
        if own:
            members[g] = own
            descending.append(g)
            for i in own:
                done[i] = 1
            times: dict[int, int] = {}
            for i in own:
                p = left[i]
                while p >= 0 and done[p]:
                    p = left[p]
                q = left[i]
                while q != p:                      # shorten the way for later
                    left[q], q = p, left[q]
                left[i] = p
                if p >= 0:
                    times[p] = times.get(p, 0) + 1
            grown = length[own[0]]
            new: dict[tuple[int, int], int] = {}
            order = times if len(times) == 1 else sorted(times, key=times.get, reverse=True)
            for p in order:
                k, old = times[p], group[p]
                h = new.get((old, k))
                if h is None:
                    h = new[old, k] = len(members)
                    members.append([])
                    # right above the old group, so below those of more times
                    up = above[old]
                    below.append(old)
                    above.append(up)
                    below[up] = above[old] = h
                members[h].append(p)
                group[p] = h
                length[p] += k * grown
        g = below[g]
    # fill the groups in ascending order: the rest of a suffix after its
    # Lyndon prefix is a smaller suffix, so it has its place already
    at = [0] * len(members)
    place = 0
    for g in reversed(descending):
        at[g] = place
        place += len(members[g])
    follow = [-1] * (n + 1)
    same = [-1] * n
    for i in range(n):
        e = i + length[i]
        same[i], follow[e] = follow[e], i
    out = [0] * n
    cursor, e = -1, n
    while True:
        i = follow[e]
        while i >= 0:
            g = group[i]
            out[at[g]] = i
            at[g] += 1
            i = same[i]
        cursor += 1
        if cursor == n:
            return out
        e = out[cursor]



# --------------------------------------------------------------------------
# windows, anchors and items of one text

def _sliding(x: np.ndarray, w: int, f) -> np.ndarray:
    """f over every w neighbours: the ends of two running extremes."""
    n = len(x)
    padded = np.full(-(-n // w) * w, x[-1], x.dtype)
    padded[:n] = x
    rows = padded.reshape(-1, w)
    ahead = f.accumulate(rows, axis=1).ravel()[:n]
    back = f.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()[:n]
    return f(back[:n - w + 1], ahead[w - 1:])


def spans_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, salt) -> np.ndarray:
    return mix64((sums[end] - sums[start]) * powers(len(sums))[1][start] + salt)


def items_of(data: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, item hash, anchor place, and first and last window start
    of every item of a text of at least ``width`` bytes."""
    key = width // 2
    w, n = width - key + 1, len(data)
    sums = prefix_sums(data)
    every = np.arange(n - key + 1)
    h = spans_hash(sums, every, every + key, np.uint64(0))
    least = _sliding(h, w, np.minimum)
    edge = np.zeros(w - 1, np.uint64)
    p = np.flatnonzero(_sliding(np.concatenate((edge, least, edge)), w, np.maximum) == h)
    hp = h[p]
    lo, hi = np.maximum(0, p - (w - 1)), np.minimum(p, n - width)
    for k in range(1, len(p)):
        near = p[k:] - p[:-k] < w
        if not near.any():
            break
        lo[k:] = np.where(near & (hp[:-k] <= hp[k:]), np.maximum(lo[k:], p[:-k] + 1), lo[k:])
        hi[:-k] = np.where(near & (hp[k:] < hp[:-k]), np.minimum(hi[:-k], p[k:] - w), hi[:-k])
    ok = lo <= hi
    p, lo, hi, hp = p[ok], lo[ok], hi[ok], hp[ok]
    x = spans_hash(sums, lo, hi + width, ((p - lo) * 1_000_003 + (hi - lo) + 1).astype(np.uint64))
    return hp, x, p, lo, hi


def split_items(data: np.ndarray, items: list, step: int, width: int) -> list[tuple]:
    """Items cut by the windows' place before the anchor into blocks of
    ``step``: (g, x, p, lo, hi, l0, l1)."""
    sums = prefix_sums(data)
    out = []
    for it in items:
        for a0 in range(it["l0"], it["l1"], step):
            a1 = min(a0 + step, it["l1"])
            near, far = max(a0, it["p"] - it["hi"]), min(a1 - 1, it["p"] - it["lo"])
            if near <= far:
                out.append((it["g"], a0, it["p"], it["p"] - far, it["p"] - near, a0, a1))
    g, a0, p, lo, hi, l0, l1 = (np.array(c, np.int64) for c in zip(*out))
    core = spans_hash(sums, p - l0, p - l1 + 1 + width, mix64(g.view(np.uint64) + a0.astype(np.uint64)))
    x = spans_hash(sums, lo, hi + width, ((p - lo) * 1_000_003 + (hi - lo) + 1).astype(np.uint64))
    return list(zip(core.view(np.int64).tolist(), x.view(np.int64).tolist(), p.tolist(), lo.tolist(), hi.tolist(),
                    l0.tolist(), l1.tolist()))


def repeated(pieces: list[tuple[bytes, int, int]], core: int, width: int) -> list[np.ndarray]:
    """``pieces``: (bytes, bytes before the core, windows) of an anchor's
    distinct items; ``core`` bytes are common to all. For each, whether each
    of its windows equals another window of the pieces.

    For the order, the core is one letter and the bytes behind it are packed
    eight to a letter, which keeps the order of the suffixes that start before
    it; neighbours in the order are compared byte by byte."""
    m = len(pieces)
    behind = [np.frombuffer(d[b + core:].ljust(-(-(len(d) - b - core) // 8) * 8, b"\0"), ">u8") for d, b, _ in pieces]
    packed = np.unique(np.concatenate(behind))
    text: list[int] = []
    owner: list[tuple[int, int] | None] = []
    for k, (data, before, count) in enumerate(pieces):
        text += [m + c for c in data[:before]]
        text.append(m + 256)
        text += (np.searchsorted(packed, behind[k]) + (m + 257)).tolist()
        text.append(k)
        owner += [(k, i) for i in range(count)]
        owner += [None] * (len(text) - len(owner))
    out = [np.zeros(count, bool) for _, _, count in pieces]
    last = None
    for at in suffix_order(text):
        own = owner[at]
        if own is None:
            continue
        k, i = own
        window = pieces[k][0][i:i + width]
        if last is not None and window == last[0]:
            out[k][i] = out[last[1]][last[2]] = True
        last = (window, k, i)
    return out


def runs(mask: np.ndarray) -> list[tuple[int, int]]:
    edge = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
    return list(zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist()))


def cut(data: bytes, ranges: list[tuple[int, int]], width: int) -> tuple[bytes, int, int]:
    """What is left without the windows that start in ``ranges`` (first and
    last start), the bytes removed and the maximal removed runs."""
    kept, removed, spans, at = [], 0, 0, 0
    end = -1
    for lo, hi in sorted(ranges):
        if lo > end:
            if end >= 0:
                at = end
            kept.append(data[at:lo])
            spans += 1
            end = lo
        new = max(end, hi + width)
        removed += new - end
        end = new
    kept.append(data[max(end, 0):])
    return b"".join(kept), removed, spans


# --------------------------------------------------------------------------
# Spark jobs

ITEM = "g long, x long, sig long, p int, lo int, hi int, l0 int, l1 int"
LISTED = "array<struct<g:bigint,x:bigint,p:int,lo:int,hi:int,l0:int,l1:int,d:bigint,many:boolean>>"


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def text_id(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def _scan(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, sig, n, sha`` of every row, and its items as arrays (once
    for equal texts met together)."""
    names = ["g", "x", "p", "lo", "hi"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out, seen = [], set()
            for i, text in zip(pdf["i"], pdf["t"]):
                data = _bytes(text)
                sig = text_id(data)
                items = [[]] * 5
                if len(data) >= width and sig not in seen:
                    seen.add(sig)
                    g, x, p, lo, hi = items_of(np.frombuffer(data, np.uint8), width)
                    items = [g.view(np.int64), x.view(np.int64), p.astype(np.int32), lo.astype(np.int32), hi.astype(np.int32)]
                out.append((i, sig, len(data), hashlib.sha256(data).hexdigest(), *items))
            yield pd.DataFrame(out, columns=["doc_id", "sig", "n", "sha", *names]).astype({"doc_id": "Int64"})

    return stored(docs.select(F.col("doc_id").cast("long").alias("i"), F.col("text").alias("t")).mapInPandas(
        run, "doc_id long, sig long, n long, sha string, g array<bigint>, x array<bigint>, p array<int>, lo array<int>, "
             "hi array<int>"), "windows")


def _texts(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``sig, data`` of the wanted texts, each once."""
    held = bit_filter(wanted, "sig")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = {}
            for text in pdf["t"]:
                data = _bytes(text)
                if len(data) >= width:
                    out.setdefault(text_id(data), data)
            sigs = np.fromiter(out, np.int64, len(out))
            yield pd.DataFrame([(int(s), out[int(s)]) for s in sigs[held.has(sigs)]], columns=["sig", "data"])

    found = docs.select(F.col("text").alias("t")).mapInPandas(run, "sig long, data binary")
    return stored(found.groupBy("sig").agg(F.first("data").alias("data")), "window-texts")


def _sorted(items: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """``sig, lo, hi``: runs of repeated windows in items that occur once."""
    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for sig, data, found in zip(pdf["sig"], pdf["data"], pdf["items"]):
                data = bytes(data)
                out += [(it["g"], it["many"], sig, it["lo"], it["p"] - it["l0"] - it["lo"], it["hi"] - it["lo"] + 1,
                         width - (it["l1"] - 1 - it["l0"]), data[it["lo"]:it["hi"] + width]) for it in found]
            yield pd.DataFrame(out, columns=["g", "many", "sig", "lo", "before", "count", "core", "data"])

    def sort(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list = []

        def settle(group: list) -> list[tuple[int, int, int]]:
            found = repeated([(bytes(r.data), r.before, r.count) for r in group], group[0].core, width)
            return [(r.sig, r.lo + a, r.lo + b) for r, mask in zip(group, found) if not r.many for a, b in runs(mask)]

        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False, name="Piece"):
                if held and held[0].g != r.g:
                    out += settle(held)
                    held = []
                held.append(r)
            yield pd.DataFrame(out, columns=["sig", "lo", "hi"])
        if held:
            yield pd.DataFrame(settle(held), columns=["sig", "lo", "hi"])

    listed = items.groupBy("sig").agg(F.collect_list(F.struct("g", "x", "p", "lo", "hi", "l0", "l1", "d", "many")).alias("items"))
    pieces = listed.join(texts, "sig").mapInPandas(
        take, "g long, many boolean, sig long, lo int, before int, count int, core int, data binary")
    # an anchor has at most SPLIT items here; a task reads them one by one
    return pieces.repartition("g").sortWithinPartitions("g", "sig", "lo").mapInPandas(sort, "sig long, lo int, hi int")


def _blocks(items: DataFrame, texts: DataFrame, step: int, width: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for sig, data, found in zip(pdf["sig"], pdf["data"], pdf["items"]):
                cut_up = split_items(np.frombuffer(bytes(data), np.uint8), list(found), step, width)
                out += [(g, x, sig, *rest) for g, x, *rest in cut_up]
            yield pd.DataFrame(out, columns=["g", "x", "sig", "p", "lo", "hi", "l0", "l1"])

    listed = items.groupBy("sig").agg(F.collect_list(F.struct("g", "x", "p", "lo", "hi", "l0", "l1", "d", "many")).alias("items"))
    return listed.join(texts, "sig").mapInPandas(run, ITEM)


def _counted(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ranges of the items that occur again, and the distinct items of the
    anchors where one that occurs once meets others."""
    one = F.min(F.struct("sig", "p", "lo", "hi", "l0", "l1")).alias("r")
    by_item = stored(rows.groupBy("g", "x").agg(F.count(F.lit(1)).alias("c"), one), "window-items")
    again = by_item.where("c > 1").select("g", "x")
    sure = rows.join(again, ["g", "x"]).select("sig", "lo", "hi")
    # written, so that the join is of two plain tables and a hot anchor can be split
    anchors = stored(by_item.groupBy("g").agg(F.count(F.lit(1)).alias("d"), F.sum((F.col("c") == 1).cast("int")).alias("once"))
                     .where("d > 1 and once > 0").select("g", "d"), "window-anchors")
    open_ = by_item.join(anchors, "g").select(
        "g", "x", "d", (F.col("c") > 1).alias("many"), "r.*")
    return sure, stored(open_, "window-open")


def repeated_ranges(docs: DataFrame, scanned: DataFrame, whole: DataFrame, width: int = WIDTH,
                    split: int = SPLIT) -> tuple[DataFrame, DataFrame | None]:
    """``sig, lo, hi`` of all repeated windows (but of whole copies), and the
    texts that they are in."""
    core = width // 2
    rows = scanned.select("sig", F.explode(F.arrays_zip("g", "x", "p", "lo", "hi")).alias("i")).select(
        "sig", "i.*", F.lit(0).alias("l0"), F.lit(width - core + 1).alias("l1"))
    shared = stored(rows.groupBy("g").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("g"), "window-shared")
    rows = stored(rows.join(shared, "g", "left_semi"), "window-rows")
    sure, items = _counted(rows)
    out = [stored(sure.distinct().join(whole, "sig", "left_anti"), "window-sure")]
    texts = _texts(docs, out[0].select("sig").union(items.select("sig")).distinct(), width)
    for step in BLOCKS:
        out.append(_sorted(items.where(F.col("d") <= split), texts, width))
        hot = items.where(F.col("d") > split)
        # an item that occurs again stands for itself and a partner
        sure, items = _counted(stored(_blocks(hot, texts, step, width), "window-blocks"))
        out.append(sure)
    # items of single windows are equal or not: none is left open
    ranges = out[0]
    for more in out[1:]:
        ranges = ranges.unionByName(more)
    return ranges, texts


def remove_repeats(docs: DataFrame, width: int = WIDTH, split: int = SPLIT) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` per row;
    ``kept`` is the remaining bytes where some but not all are removed."""
    scanned = _scan(docs, width)
    whole = stored(scanned.groupBy("sig").agg(F.count(F.lit(1)).alias("c"), F.first("n").alias("n")).where(
        (F.col("c") > 1) & (F.col("n") >= width)).select("sig"), "window-copies")
    ranges, texts = repeated_ranges(docs, scanned, whole, width, split)
    listed = ranges.join(whole, "sig", "left_anti").groupBy("sig").agg(F.collect_set(F.struct("lo", "hi")).alias("found"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for sig, data, found in zip(pdf["sig"], pdf["data"], pdf["found"]):
                kept, removed, spans = cut(bytes(data), [(r["lo"], r["hi"]) for r in found], width)
                out.append((sig, removed, spans, hashlib.sha256(kept).hexdigest(), kept))
            yield pd.DataFrame(out, columns=["sig", "removed", "spans", "left", "kept"])

    cuts = stored(listed.join(texts, "sig").mapInPandas(
        run, "sig long, removed long, spans long, left string, kept binary"), "window-cuts")
    empty = hashlib.sha256(b"").hexdigest()
    fates = cuts.select("sig", "removed", "spans", "left", "kept", F.lit(False).alias("gone")).unionByName(whole.select(
        "sig", F.lit(None).cast("long").alias("removed"), F.lit(1).cast("long").alias("spans"), F.lit(empty).alias("left"),
        F.lit(b"").alias("kept"), F.lit(True).alias("gone")))
    zero = F.lit(0).cast("long")
    return scanned.select("doc_id", "sig", "n", "sha").join(fates, "sig", "left").select(
        "doc_id", F.col("n").alias("n_bytes"), F.when(F.col("gone"), F.col("n")).otherwise(F.coalesce("removed", zero)).alias("n_removed"),
        F.coalesce("spans", zero).alias("n_spans"), F.coalesce("left", "sha").alias("kept_sha256"), "kept")
