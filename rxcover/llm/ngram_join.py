"""Jaccard similarity join of documents on word n-grams.

The document by n-gram incidence matrix is multiplied with its transpose in
blocks, and pairs are discarded by bounds that follow from their sizes:

1. Documents with the same n-gram set are one class (a 64-bit digest of the
   set); a count sketch of fixed size estimates how common each n-gram is.
2. With n-grams ordered from rare to common, sets of sizes a and b that link
   share at least ``s`` of the first ``size - ceil(t * size) + s`` columns of
   either. ``s`` grows with the size, so that a few chance n-grams of long
   texts make no pair. Only these columns enter the first product.
3. A column of up to ``SHORT`` classes adds 1 to the overlap count of its
   pairs within the size bound; pairs below the bound on the count go.
   In a longer column, each class is paired with three leaders of it.
4. The surviving pairs' whole sets are compared exactly. Components follow.
5. A longer column whose classes are not all in one component by then is
   multiplied in blocks: classes outside its largest component against its
   classes of the same and the neighbouring bands of sizes (others are too
   large or too small to link), accumulating overlaps over slices of n-grams.
   This settles all links that leaders can't show.

No pairs within a group of copies are made, no column is gathered whole, and
what is broadcast has a fixed size.

Defined results: words are lower-cased in A-Z only; a text with fewer words
than n has its whole sequence as its one n-gram; null, empty and wordless
texts have no n-grams and link with nothing; repeated rows each give a row;
other columns are not read. A component is named by its smallest doc_id (null
only if it has none).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxcover.llm.common import bit_filter, components, free_names, mix64, stored
from rxcover.llm.words import LOWER_ASCII, gram_hashes, word_hashes

SHORT = 32          # classes in a column whose pairs are counted one by one
BLOCK = 512         # classes on a side of a block of the product
SLICE = 4096        # n-grams whose overlaps are accumulated at a time
LOG2_SKETCH = 20
STEP = 1024


def shingles(text: str | None, n: int) -> np.ndarray:
    """The distinct n-grams as sorted hashes."""
    w = word_hashes(text, LOWER_ASCII)
    return np.unique(gram_hashes(w, n if len(w) >= n else max(1, len(w))))


def set_id(grams: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(grams.tobytes(), digest_size=8).digest(), "little", signed=True)


def shared_floor(size):
    """How many leading columns linked sets share at least."""
    return 1 + size // 20


def leading(size: int, num: int, den: int) -> int:
    return min(size, size - -(-num * size // den) + shared_floor(size))


def band(size: Column, num: int, den: int) -> Column:
    """Bands of sizes: linked sets lie in the same or in neighbouring bands."""
    # a little wider than den / num, so that rounding can't part linked sizes by two
    return F.floor(F.log(size) / math.log(1.0001 * den / num)).cast("int")


def text_code():
    """Tells rows of one doc_id with different texts apart."""
    return F.xxhash64(F.col("text"))


def _measure(docs: DataFrame, n: int) -> tuple[DataFrame, np.ndarray]:
    """``doc_id, code, n, sig`` of every row, and the count sketch."""
    width = 1 << LOG2_SKETCH

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sketch = np.zeros(width, np.int64)
        for pdf in batches:
            out, grams = [], []
            for i, code, text in zip(pdf["i"], pdf["code"], pdf["t"]):
                g = shingles(text, n)
                out.append((i, code, len(g), set_id(g)))
                grams.append(g)
            if out:
                slots = (mix64(np.concatenate(grams)) >> np.uint64(64 - LOG2_SKETCH)).astype(np.int64)
                sketch += np.bincount(slots, minlength=width)
                yield pd.DataFrame(out, columns=["doc_id", "code", "n", "sig"]).assign(chunk=-1, counts=None).astype({"doc_id": "Int64"})
        used = np.flatnonzero(sketch.reshape(-1, STEP).any(axis=1))
        if len(used):
            counts = np.minimum(sketch, 2 ** 31 - 1).astype(np.int32)
            yield pd.DataFrame({"doc_id": pd.array([None] * len(used), "Int64"), "code": 0, "n": 0, "sig": 0, "chunk": used,
                                "counts": [counts[c * STEP:(c + 1) * STEP].tobytes() for c in used]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(STEP, np.int64)
        for b in pdf["counts"]:
            total += np.frombuffer(b, np.int32)
        return pd.DataFrame({"chunk": [int(pdf["chunk"].iloc[0])], "counts": [np.minimum(total, 2 ** 31 - 1).astype(np.int32).tobytes()]})

    both = stored(docs.select(F.col("doc_id").cast("long").alias("i"), text_code().alias("code"), F.col("text").alias("t")).mapInPandas(
        run, "doc_id long, code long, n int, sig long, chunk int, counts binary"), "shingle-sizes")
    sketch = np.zeros(width, np.int32)
    for r in both.where("chunk >= 0").select("chunk", "counts").groupBy("chunk").applyInPandas(
            add, "chunk int, counts binary").collect():
        sketch[r["chunk"] * STEP:(r["chunk"] + 1) * STEP] = np.frombuffer(bytes(r["counts"]), np.int32)
    return both.where("chunk < 0").select("doc_id", "code", "n", "sig"), sketch


def _columns(docs: DataFrame, n: int, num: int, den: int, sketch: np.ndarray) -> DataFrame:
    """``h, sig, n``: the leading columns of every class."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            seen, hs, sigs, sizes = set(), [], [], []
            for text in pdf["t"]:
                g = shingles(text, n)
                sig = set_id(g)
                if not len(g) or sig in seen:
                    continue
                seen.add(sig)
                common = sketch[(mix64(g) >> np.uint64(64 - LOG2_SKETCH)).astype(np.int64)]
                k = leading(len(g), num, den)
                hs.append(g[np.lexsort((g, common))[:k]])
                sigs.append(np.full(k, sig, np.int64))
                sizes.append(np.full(k, len(g), np.int32))
            if hs:
                yield pd.DataFrame({"h": np.concatenate(hs).view(np.int64), "sig": np.concatenate(sigs), "n": np.concatenate(sizes)})

    return docs.select(F.col("text").alias("t")).mapInPandas(run, "h long, sig long, n int")


def _sets(docs: DataFrame, n: int, wanted: DataFrame) -> DataFrame:
    """``sig, grams`` of the wanted classes, each once."""
    held = bit_filter(wanted, "sig")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            seen, out = set(), []
            for text in pdf["t"]:
                g = shingles(text, n)
                sig = set_id(g)
                if len(g) and sig not in seen:
                    seen.add(sig)
                    out.append((sig, g.view(np.int64)))
            if out:
                keep = held.has(np.array([s for s, _ in out], np.int64))
                yield pd.DataFrame([x for x, k in zip(out, keep) if k], columns=["sig", "grams"])

    found = docs.select(F.col("text").alias("t")).mapInPandas(run, "sig long, grams array<bigint>")
    return stored(found.groupBy("sig").agg(F.first("grams").alias("grams")), "shingle-sets")


def _compared(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs ``a, b`` that link, by their whole sets."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep = []
            for x, y in zip(pdf["x"], pdf["y"]):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(den * both >= num * (len(x) + len(y) - both))
            yield pdf.loc[keep, ["a", "b"]]

    one = sets.select(F.col("sig").alias("a"), F.col("grams").alias("x"))
    two = sets.select(F.col("sig").alias("b"), F.col("grams").alias("y"))
    return pairs.select("a", "b").join(one, "a").join(two, "b").mapInPandas(run, "a long, b long")


def overlaps(rows: list[np.ndarray], cols: list[np.ndarray]) -> np.ndarray:
    """Overlap counts of all rows with all columns, by slices of n-grams."""
    out = np.zeros((len(rows), len(cols)), np.int64)
    ra, ca = np.concatenate(rows), np.concatenate(cols)
    shared = np.intersect1d(ra, ca)
    ri, ci = np.repeat(np.arange(len(rows)), [len(x) for x in rows]), np.repeat(np.arange(len(cols)), [len(x) for x in cols])
    for s in range(0, len(shared), SLICE):
        part = shared[s:s + SLICE]
        dense = []
        for values, owner, count in ((ra, ri, len(rows)), (ca, ci, len(cols))):
            at = np.minimum(np.searchsorted(part, values), len(part) - 1)
            hit = part[at] == values
            m = np.zeros((count, len(part)), np.float32)
            m[owner[hit], at[hit]] = 1
            dense.append(m)
        out += (dense[0] @ dense[1].T).astype(np.int64)
    return out


def _strays(long_rows: DataFrame, edges: DataFrame, sets: DataFrame,
            num: int, den: int) -> DataFrame:
    """Links that the leaders of long columns leave open."""
    roots = components(edges).select(F.col("node").alias("sig"), "component")
    rows = long_rows.join(roots, "sig", "left").withColumn("c", F.coalesce("component", "sig")).drop("component")
    parts = rows.groupBy("h", "c").agg(F.count(F.lit(1)).alias("k"))
    top = stored(parts.groupBy("h").agg(F.max(F.struct("k", "c")).alias("top"), F.sum("k").alias("all"))
                 .where("top.k < all").select("h", F.col("top.c").alias("most")), "stray-tops")
    rows = rows.join(top, "h")
    # columns of the same classes are one column
    same = rows.groupBy("h").agg(F.bit_xor(F.xxhash64("sig")).alias("p"), F.bit_xor(F.xxhash64("sig", F.lit(1))).alias("q"),
                                 F.count(F.lit(1)).alias("k")).groupBy("p", "q", "k").agg(F.min("h").alias("h"))
    rows = stored(rows.join(same.select("h"), "h", "left_semi").select(
        "h", "sig", "n", "c", (F.col("c") != F.col("most")).alias("stray"), band(F.col("n"), num, den).alias("v"),
        F.xxhash64("sig", F.lit(7)).alias("code")), "stray-rows")
    # a band's classes against the strays of its own and the next bands
    near = Window.partitionBy("h").orderBy("v").rangeBetween(-1, 1)
    cells = stored(rows.groupBy("h", "v").agg(F.count(F.lit(1)).alias("k"), F.count_if("stray").alias("s"))
                   .withColumn("s", F.sum("s").over(near)).where("s > 0")
                   .select("h", "v", F.ceil(F.col("k") / BLOCK).cast("int").alias("nr"),
                           F.ceil(F.col("s") / BLOCK).cast("int").alias("ns")), "stray-cells")
    rb, sb = F.pmod("code", "nr").cast("int"), F.pmod("code", "ns").cast("int")
    upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    own = rows.join(cells, ["h", "v"]).select(
        "h", "v", rb.alias("rb"), upto("ns").alias("sb"), "stray", sb.alias("home"), F.lit(True).alias("own"), "sig", "c", "n")
    own = own.withColumn("stray", F.col("stray") & (F.col("sb") == F.col("home")))
    away = rows.where("stray").withColumns({"home": F.col("v"), "v": F.explode(F.array(F.col("v") - 1, "v", F.col("v") + 1))})
    away = away.join(cells, ["h", "v"]).select(
        "h", "v", upto("nr").alias("rb"), sb.alias("sb"), "stray",
        F.when(F.col("v") == F.col("home"), rb).otherwise(-1).alias("home"), F.lit(False).alias("own"), "sig", "c", "n")
    # in the one block where a stray is on both sides, its own row serves
    away = away.where("rb <> home")

    def product(pdf: pd.DataFrame) -> pd.DataFrame:
        r, q = pdf[pdf["own"]], pdf[pdf["stray"]]
        if not len(r) or not len(q):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        both = overlaps([np.asarray(x) for x in r["grams"]], [np.asarray(x) for x in q["grams"]])
        union = r["n"].to_numpy()[:, None] + q["n"].to_numpy()[None, :] - both
        i, j = np.nonzero((den * both >= num * union) & (r["c"].to_numpy()[:, None] != q["c"].to_numpy()[None, :]))
        found = pd.DataFrame({"a": r["sig"].to_numpy()[i], "b": q["sig"].to_numpy()[j], "x": r["c"].to_numpy()[i],
                              "y": q["c"].to_numpy()[j]})
        return found.drop_duplicates(["x", "y"])[["a", "b"]]

    blocks = own.unionByName(away).drop("home").join(sets, "sig")
    return blocks.groupBy("h", "v", "rb", "sb").applyInPandas(product, "a long, b long")


def classified(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """``doc_id, code, n, c`` per row: the size of its set and its component
    (null without a set)."""
    sizes, sketch = _measure(docs, n)
    columns = stored(_columns(docs, n, num, den, sketch), "shingle-columns")
    some = columns.groupBy("h").agg(F.min("sig").alias("lo"), F.max("sig").alias("hi")).where("lo < hi").select("h")
    shared = stored(columns.join(some, "h", "left_semi").distinct(), "shingle-shared")
    length = shared.groupBy("h").agg(F.count(F.lit(1)).alias("k"))
    short = length.where(F.col("k") <= SHORT).select("h")
    long_rows = stored(shared.join(length.where(F.col("k") > SHORT).select("h"), "h"), "shingle-long")

    # short columns: overlap counts of their pairs within the size bound
    lists = shared.join(short, "h", "left_semi").groupBy("h").agg(F.array_sort(F.collect_list(F.struct("sig", "n"))).alias("m"))
    left = lists.select("m", F.posexplode("m").alias("p", "a"))
    pair = left.select("a", F.explode(F.slice("m", F.col("p") + 2, SHORT)).alias("b"))
    fit = lambda x, y: F.lit(den) * F.least(x, y) >= F.lit(num) * F.greatest(x, y)
    counted = pair.where(fit(F.col("a.n"), F.col("b.n"))).groupBy(
        F.col("a.sig").alias("a"), F.col("b.sig").alias("b"), F.least("a.n", "b.n").alias("least")).agg(F.count(F.lit(1)).alias("k"))
    in_long = long_rows.groupBy("sig").agg(F.count(F.lit(1)).alias("w"))
    counted = (counted.join(in_long.select(F.col("sig").alias("a"), F.col("w").alias("wa")), "a", "left")
               .join(in_long.select(F.col("sig").alias("b"), F.col("w").alias("wb")), "b", "left"))
    unseen = F.least(F.coalesce("wa", F.lit(0)), F.coalesce("wb", F.lit(0)))
    cold = counted.where(F.col("k") + unseen >= shared_floor_column(F.col("least"))).select("a", "b")

    # long columns: every class with three leaders
    ranked = long_rows.join(in_long, "sig")
    heads = stored(ranked.groupBy("h").agg(F.array(
        F.max(F.struct("w", "sig", "n")), F.min(F.struct(F.col("n").alias("w"), "sig", "n")),
        F.max(F.struct(F.col("n").alias("w"), "sig", "n"))).alias("l")), "shingle-leaders")
    led = long_rows.join(heads.select("h", F.explode("l").alias("l")), "h").where(
        (F.col("sig") != F.col("l.sig")) & fit(F.col("n"), F.col("l.n"))).select(
        F.least("sig", "l.sig").alias("a"), F.greatest("sig", "l.sig").alias("b"))
    pairs = stored(cold.union(led).distinct(), "shingle-pairs")

    wanted = pairs.select(F.col("a").alias("sig")).union(pairs.select("b")).union(long_rows.select("sig")).distinct()
    sets = _sets(docs, n, wanted)
    edges = stored(_compared(pairs, sets, num, den), "shingle-edges")
    more = stored(_strays(long_rows, edges, sets, num, den), "shingle-strays")
    roots = components(edges.union(more)).select(F.col("node").alias("sig"), "component")

    return stored(sizes.where("n > 0").join(roots, "sig", "left").select(
        "doc_id", "code", "n", F.coalesce("component", "sig").alias("c")).unionByName(
        sizes.where("n = 0").select("doc_id", "code", "n", F.lit(None).cast("long").alias("c"))), "shingle-classes")


def ngram_join(docs: DataFrame, n: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row: rows link when their
    n-gram sets have a Jaccard similarity of ``num / den`` or more."""
    rows = classified(docs, n, num, den).withColumn("n", F.col("n").cast("long"))
    # stored, so that a hot component's rows can be split in the join
    least = stored(rows.where("c is not null").groupBy("c").agg(F.min("doc_id").alias("component_id")), "shingle-least")
    linked = rows.where("c is not null").join(least, "c").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return linked.unionByName(rows.where("c is null").select("doc_id", F.col("n").alias("n_shingles"),
                                                             F.col("doc_id").alias("component_id")))


def shared_floor_column(size):
    return F.lit(1) + F.floor(size / 20)


def keep_representatives(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the
    smallest doc_id (null last), every text without n-grams, and one of fully
    repeated rows."""
    rows = classified(docs.select("doc_id", "text"), n, num, den)
    key = F.struct(F.col("doc_id").isNull().alias("nul"), "doc_id", "code")
    heads = rows.where("c is not null").groupBy("c").agg(F.min(key).alias("k")).select("k.doc_id", "k.code").union(
        rows.where("c is null").select("doc_id", "code")).distinct()
    head_id, head_code, own = free_names(docs, "__id", "__code", "__own")
    heads = heads.select(F.col("doc_id").alias(head_id), F.col("code").alias(head_code))
    out = docs.withColumn(own, text_code()).join(
        heads, F.col("doc_id").cast("long").eqNullSafe(F.col(head_id)) & (F.col(own) == F.col(head_code)))
    # repeated rows share the join's own keys: no exchange
    return out.dropDuplicates([head_id, head_code]).select(*docs.columns)
