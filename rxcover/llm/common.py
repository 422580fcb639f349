"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxcover.session import scratch_path

#: White space as the contracts define it: space and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: cuts the
    lineage, survives lost executors and fixes the rows of a step."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", label, unique=True)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The ``names``, each lengthened until no column of ``df`` has it (Spark
    compares names without case)."""
    held = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in held:
            name += "_"
        held.add(name.lower())
        out.append(name)
    return out


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of unsigned 64-bit integers (vectorised)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


# --------------------------------------------------------------------------
# fixed-size bit filter: a broadcast whose size does not grow with the data

class BitFilter:
    """A Bloom filter with a fixed number of bits. It has no false
    negatives, so it may prune before an exact join but never decides."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.mask = np.uint64(len(bits) * 8 - 1)

    @staticmethod
    def slots(keys: np.ndarray, mask: np.uint64) -> tuple[np.ndarray, np.ndarray]:
        h = mix64(keys.view(np.uint64) if keys.dtype == np.int64 else keys)
        return h & mask, (h >> np.uint64(32)) & mask

    def has(self, keys: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(0, bool)
        a, b = self.slots(keys, self.mask)
        out = np.ones(len(keys), bool)
        for s in (a, b):
            out &= (self.bits[(s >> np.uint64(3)).astype(np.int64)] >> (s & np.uint64(7)).astype(np.uint8)) & 1 != 0
        return out


def bit_filter(keys: DataFrame, column: str, log2_bits: int = 24, step: int = 4096) -> BitFilter:
    """Bits of all values of the long ``column``. Every task sets its own
    bits; tasks' bits are united in pieces of ``step`` bytes on the
    executors; the driver gets ``2 ** log2_bits`` bits, whatever the size of
    the input."""
    size = (1 << log2_bits) // 8
    mask = np.uint64((1 << log2_bits) - 1)

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.zeros(size, np.uint8)
        some = False
        for pdf in batches:
            some = some or len(pdf) > 0
            for s in BitFilter.slots(pdf[column].to_numpy(np.int64), mask):
                np.bitwise_or.at(bits, (s >> np.uint64(3)).astype(np.int64),
                                 np.uint8(1) << (s & np.uint64(7)).astype(np.uint8))
        if some:
            used = np.flatnonzero(bits.reshape(-1, step).any(axis=1))
            yield pd.DataFrame({"chunk": used, "bits": [bits[c * step:(c + 1) * step].tobytes() for c in used]})

    def union(pdf: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros(step, np.uint8)
        for b in pdf["bits"]:
            out |= np.frombuffer(b, np.uint8)
        return pd.DataFrame({"chunk": [int(pdf["chunk"].iloc[0])], "bits": [out.tobytes()]})

    kept = keys.select(F.col(column).cast("long").alias(column)).where(F.col(column).isNotNull())
    parts = kept.mapInPandas(part, "chunk int, bits binary")
    rows = parts.groupBy("chunk").applyInPandas(union, "chunk int, bits binary").collect()
    bits = np.zeros(size, np.uint8)
    for r in rows:
        bits[r["chunk"] * step:(r["chunk"] + 1) * step] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return BitFilter(bits)


# --------------------------------------------------------------------------
# connected components

def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of the edges ``(a, b)``: the
    smallest node reachable. Large-star and small-star steps; each round is a
    written table, and a node's neighbours are never gathered in one row."""
    e = stored(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
               .where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
               "cc")
    mark = None
    for _ in range(rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # least neighbours are stored: a hot node's side of a join with a
        # plain table can be split, with an aggregate it can't
        low = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "cc-least")
        large = stored(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")), "cc-large")
        # small star: every node's smaller neighbours and itself to the least
        low2 = stored(large.groupBy("u").agg(F.min("v").alias("m")), "cc-least")
        small = (large.join(low2, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low2.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        e = stored(small, "cc")
        last, mark = mark, e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).collect()
        if mark == last:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
