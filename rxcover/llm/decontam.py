"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are sequences of words (lower-cased; runs of
ASCII letters, digits, underscores and characters beyond ASCII). Runs of
``least`` words that a document shares with an item are the seeds: a filter of
fixed size over the items' seeds prunes the documents' runs while these are
scanned, and an exact join on the seeds finds the pairs. A pair whose seeds
could cover the threshold is tiled: running Karp-Rabin hashes give all
matches, the longest unmarked one is marked again and again, and the item's
share of marked words decides. Tiles are found in any order, so a passage is
caught when its parts are moved about.

Defined results: null or wordless texts match nothing; an item of fewer than
``least`` words must occur whole; equal-length matches are marked by their
place in the item, then in the document; repeated documents and items each
give their own rows; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxcover.llm.common import bit_filter, free_names, stored
from rxcover.llm.words import WORD_ASCII, gram_hashes, word_hashes

LEAST, COVERAGE = 5, 0.5


def tiles(item: np.ndarray, doc: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(place in the item, place in the document, words) of the greedy
    tiling, in the order of marking."""
    least = min(least, len(item))
    if not least:
        return []
    a, b = gram_hashes(item, least), gram_hashes(doc, least)
    order = np.argsort(a, kind="stable")
    lo, hi = np.searchsorted(a[order], b, "left"), np.searchsorted(a[order], b, "right")
    n = hi - lo
    t = np.repeat(np.arange(len(b)), n)
    p = order[np.repeat(lo, n) + np.arange(len(t)) - np.repeat(np.cumsum(n) - n, n)] if len(t) else t
    if not len(t):
        return []
    by = np.lexsort((p, t - p))
    p, t = p[by], t[by]
    new = np.ones(len(p), bool)
    new[1:] = (np.diff(t - p) != 0) | (np.diff(p) != 1)
    first = np.flatnonzero(new)
    runs = np.diff(np.append(first, len(p)))
    heap = [(-int(k) - least + 1, int(p[i]), int(t[i])) for i, k in zip(first, runs)]
    heapq.heapify(heap)
    in_item, in_doc = np.zeros(len(item), bool), np.zeros(len(doc), bool)
    out = []
    while heap:
        k, x, y = heapq.heappop(heap)
        free = ~(in_item[x:x - k] | in_doc[y:y - k])
        if free.all():
            if (item[x:x - k] == doc[y:y - k]).all():
                in_item[x:x - k] = in_doc[y:y - k] = True
                out.append((x, y, -k))
            continue
        edge = np.diff(np.concatenate(([0], free.astype(np.int8), [0])))
        for s, e in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
            if e - s >= least:
                heapq.heappush(heap, (-int(e - s), x + int(s), y + int(s)))
    return out


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def contaminated(docs: DataFrame, items: DataFrame, **kw) -> DataFrame:
    """``doc_id, item_id, item_words, covered, tiles, coverage`` of every
    document and item whose tiling covers enough of the item."""
    return tiled(docs, items, **kw).drop("code")


def tiled(docs: DataFrame, items: DataFrame, least: int = LEAST, coverage: float = COVERAGE,
          log2_bits: int = 24) -> DataFrame:
    """As ``contaminated``, with a hash of the document's text (``code``)."""
    def item_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for i, text in zip(pdf["item_id"], pdf["text"]):
                w = word_hashes(text, WORD_ASCII)
                if len(w):
                    out.append((i, min(least, len(w)), _signed(w).tolist(),
                                _signed(gram_hashes(w, min(least, len(w)))).tolist()))
            yield pd.DataFrame(out, columns=["item_id", "size", "words", "grams"])

    kind = items.schema["item_id"].dataType.simpleString()
    known = stored(items.select("item_id", "text").mapInPandas(
        item_rows, f"item_id {kind}, size int, words array<bigint>, grams array<bigint>")
        .withColumn("row", F.monotonically_increasing_id()), "items")
    seeds = known.select("row", F.size("words").alias("n"), "size", F.posexplode("grams").alias("place", "gram"))
    sizes = [r["size"] for r in known.select("size").distinct().collect()]  # at most ``least`` numbers
    held = bit_filter(seeds, "gram", log2_bits)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for i, code, row, text in zip(pdf["doc_id"], pdf["code"], pdf["rid"], pdf["text"]):
                w = word_hashes(text, WORD_ASCII)
                found = [g[held.has(g)] for g in (gram_hashes(w, s) for s in sizes)]
                found = np.unique(np.concatenate(found)) if found else []
                if len(found):
                    out.append((i, code, row, _signed(found).tolist(), _signed(w).tolist()))
            yield pd.DataFrame(out, columns=["doc_id", "code", "rid", "grams", "words"]).astype({"doc_id": "Int64"})

    hits = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("code"),
                              F.monotonically_increasing_id().alias("rid"), "text").mapInPandas(
        scan, "doc_id long, code long, rid long, grams array<bigint>, words array<bigint>"), "seed-hits")
    shared = hits.select("rid", F.explode("grams").alias("gram")).join(seeds, "gram")
    places = F.array_distinct(F.flatten(F.collect_set(F.sequence("place", F.col("place") + F.col("size") - 1))))
    pairs = shared.groupBy("rid", "row").agg(F.size(places).alias("reach"), F.first("n").alias("n")).where(
        F.col("reach") >= F.lit(coverage) * F.col("n")).select("rid", "row")
    both = pairs.join(known.select("row", "item_id", F.col("words").alias("item")), "row").join(
        hits.select("rid", "doc_id", "code", "words"), "rid")

    def tile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                item = np.asarray(r.item, np.int64).view(np.uint64)
                found = tiles(item, np.asarray(r.words, np.int64).view(np.uint64), least)
                covered = sum(k for _, _, k in found)
                if covered >= coverage * len(item):
                    out.append((r.doc_id, r.code, r.item_id, len(item), covered, len(found), covered / len(item)))
            yield pd.DataFrame(out, columns=["doc_id", "code", "item_id", "item_words", "covered", "tiles", "coverage"]).astype(
                {"doc_id": "Int64"})

    return both.select("doc_id", "code", "item_id", "item", "words").mapInPandas(
        tile, f"doc_id long, code long, item_id {kind}, item_words int, covered int, tiles int, coverage double")


def drop_contaminated(docs: DataFrame, items: DataFrame, **kw) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    bad_id, bad_code, own = free_names(docs, "__bad", "__code", "__own")
    bad = tiled(docs.select("doc_id", "text"), items, **kw).select(
        F.col("doc_id").alias(bad_id), F.col("code").alias(bad_code)).distinct()
    return docs.withColumn(own, F.xxhash64("text")).join(
        bad, F.col("doc_id").cast("long").eqNullSafe(F.col(bad_id)) & (F.col(own) == F.col(bad_code)),
        "left_anti").select(*docs.columns)
