"""Vectors compressed to codes: each of eight parts by its nearest entry.

Components become integers, so every distance, mean and tie is exact. The
codebooks start as the parts of the smallest ids' vectors; each round is one
pass over the rows, whose tasks return sums and counts per entry (a fixed
number of them), added up by Spark; the driver holds the codebooks only.

The nearest entry is found in a GNAT built over a part's entries: a node's
split points store the range of their distances to the entries of every
child. A row's distances to the split points, and the best so far, rule out
whole children where the ranges leave no room, strictly, with square roots
rounded to the safe side; what is left is compared by exact integer distances,
ties to the lower index. The rows of a batch go down the tree together.

Defined results: vectors that are null or hold null or non-finite components
are dropped; other columns are not read. Null ids come after all others, and
equal ids by their components. With fewer rows than entries the codebooks are
as short as that. An empty table gives no rows. Vectors of other lengths than
that of the smallest id, or not divisible by the parts, raise ``ValueError``,
as do components so large that a distance could pass 64 bits (about 46,000
for 64 components at the scale of 4,096).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxcover.llm.common import stored

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Split points of a node; so few entries need no children.
SPLITS, LEAF = 4, 4


# --------------------------------------------------------------------------
# nearest entry

def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of ``a`` to those of ``b``."""
    d = a[:, None, :] - b[None, :, :]
    return np.einsum("ijk,ijk->ij", d, d)


def floor_root(d: np.ndarray) -> np.ndarray:
    """At most the square root, whatever the rounding of the float root."""
    return np.maximum(np.floor(np.sqrt(d.astype(np.float64))).astype(np.int64) - 1, 0)


def ceil_root(d: np.ndarray) -> np.ndarray:
    """At least the square root."""
    return np.ceil(np.sqrt(d.astype(np.float64))).astype(np.int64) + 1


@dataclass
class Node:
    """Split points by index, and children with, per split point, the least
    and greatest distance to the child's entries."""
    splits: np.ndarray
    children: list[tuple[Node, np.ndarray, np.ndarray]]


def gnat(entries: np.ndarray, of: np.ndarray | None = None) -> Node:
    """The tree of the entries ``of`` (all). The first split point is the
    lowest index, each next one the farthest from those before; every other
    entry goes to the child of its nearest split point."""
    of = np.arange(len(entries)) if of is None else of
    if len(of) <= LEAF:
        return Node(of, [])
    chosen = [0]
    d = squared(entries[of], entries[of])
    while len(chosen) < SPLITS:
        near = d[:, chosen].min(axis=1)
        near[chosen] = -1
        chosen.append(int(near.argmax()))
    rest = np.setdiff1d(np.arange(len(of)), chosen)
    nearest = d[np.ix_(rest, chosen)].argmin(axis=1)
    children = []
    for j in range(SPLITS):
        own = rest[nearest == j]
        if len(own):
            r = d[np.ix_(chosen, own)]
            children.append((gnat(entries, of[own]), floor_root(r.min(axis=1)), ceil_root(r.max(axis=1))))
    return Node(of[chosen], children)


def nearest(tree: Node, entries: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of every point and the squared distance, ties to the
    lower index."""
    best = np.full(len(points), np.iinfo(np.int64).max)
    index = np.full(len(points), len(entries), np.int64)

    def visit(node: Node, rows: np.ndarray) -> None:
        d = squared(points[rows], entries[node.splits])
        for k, e in enumerate(node.splits):
            won = (d[:, k] < best[rows]) | ((d[:, k] == best[rows]) & (e < index[rows]))
            best[rows[won]], index[rows[won]] = d[won, k], e
        if not node.children:
            return
        low, high = floor_root(d), ceil_root(d)
        for child, least, most in node.children:
            reach = ceil_root(best[rows])[:, None]
            out = ((low - reach > most) | (high + reach < least)).any(axis=1)
            if not out.all():
                visit(child, rows[~out])

    if len(points):
        visit(tree, np.arange(len(points)))
    return index, best


# --------------------------------------------------------------------------
# rows of a batch

def whole_parts(column: pa.Array, dim: int, parts: int, scale: int) -> np.ndarray:
    """The vectors as integers: rows x parts x components of a part."""
    if pa.compute.list_value_length(column).to_numpy(zero_copy_only=False).tolist() != [dim] * len(column):
        raise ValueError(f"all vectors need {dim} components")
    x = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    if len(x) and np.abs(x).max() >= (2.0 ** 63 / (4 * dim)) ** 0.5:
        raise ValueError("a component is too large for 64-bit squared distances")
    return x.astype(np.int64).reshape(len(column), parts, dim // parts)


def compress(vectors: DataFrame, vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             scale: int = SCALE) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` per kept row."""
    v = F.col(vector)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = stored(vectors.select("vec_id", v.alias("v"), "label").where(v.isNotNull() & ~odd), "vectors")
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).select("v").collect()
    dim = len(first[0]["v"]) if first else parts
    if dim % parts or not dim:
        raise ValueError(f"vectors of {dim} components have no {parts} equal parts")
    start = pa.array([r["v"] for r in first], pa.list_(pa.float64()))
    books = whole_parts(start, dim, parts, scale).swapaxes(0, 1).copy()     # parts x entries x components
    held, width = books.shape[1], dim // parts

    def assigned(batch: pa.RecordBatch, books: np.ndarray, trees: list[Node]):
        x = whole_parts(batch.column("v"), dim, parts, scale)
        return x, [nearest(trees[p], books[p], x[:, p]) for p in range(parts)]

    def sums(books: np.ndarray) -> DataFrame:
        trees = [gnat(b) for b in books]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, count = np.zeros_like(books), np.zeros((parts, held), np.int64)
            for batch in batches:
                x, found = assigned(batch, books, trees)
                for p, (index, _) in enumerate(found):
                    np.add.at(total[p], index, x[:, p])
                    count[p] += np.bincount(index, minlength=held)
            at = np.argwhere(count > 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at[:, 0], pa.int32()), pa.array(at[:, 1], pa.int32()), pa.array(count[count > 0], pa.int64()),
                 pa.array(total[count > 0].tolist(), pa.list_(pa.int64()))], names=["part", "entry", "n", "total"])

        tasks = kept.select("v").mapInArrow(run, "part int, entry int, n long, total array<long>")
        each = [F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(width)]
        return tasks.groupBy("part", "entry").agg(F.sum("n").alias("n"), *each)

    for _ in range(rounds if held else 0):
        # parts x entries rows, whatever the input
        for r in sums(books).collect():
            books[r["part"], r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(width)]
    trees = [gnat(b) for b in books]
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, found = assigned(batch, books, trees)
            index = np.stack([i for i, _ in found], axis=1).astype(np.uint8)
            error = sum(d for _, d in found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array([r.tobytes().hex() for r in index], pa.string()), pa.array(error, pa.int64())],
                names=["vec_id", "label", "code", "error"])

    schema = T.StructType([kept.schema["vec_id"], kept.schema["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    codes = stored(kept.mapInArrow(code, schema), "codes")
    by_label = stored(codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of"), "labels")
    out = codes.join(by_label, codes["label"].eqNullSafe(by_label["of"]))
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same by comparing every part with every entry, for 64 components."""
    width = 64 // parts
    ctes = [f"""k AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
p AS MATERIALIZED (SELECT vec_id, part, v[part * {width} + 1:part * {width} + {width}] AS x FROM k, range({parts}) r(part)),
b0 AS MATERIALIZED (
  SELECT part, (dense_rank() OVER (ORDER BY vec_id) - 1)::INT AS entry, x FROM p
  WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT {entries}))"""]
    for i in range(rounds + 1):
        d = " + ".join(f"(p.x[{j}] - b.x[{j}]) * (p.x[{j}] - b.x[{j}])" for j in range(1, width + 1))
        ctes.append(f"a{i} AS MATERIALIZED (SELECT p.vec_id, p.part, p.x, min(({d}) * {entries} + b.entry) AS m FROM p JOIN b{i} b USING (part) GROUP BY ALL)")
        if i < rounds:
            mean = ", ".join(f"floor(sum(x[{j}])::DOUBLE / count(*))::BIGINT" for j in range(1, width + 1))
            ctes.append(f"""b{i + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(n.x, b.x) AS x FROM b{i} b
  LEFT JOIN (SELECT part, m % {entries} AS entry, [{mean}] AS x FROM a{i} GROUP BY 1, 2) n USING (part, entry))""")
    return "WITH " + ",\n".join(ctes) + f""",
c AS (SELECT vec_id, string_agg(format('{{:02x}}', m % {entries}), '' ORDER BY part) AS code, sum(m // {entries})::BIGINT AS error FROM a{rounds} GROUP BY vec_id),
h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM c JOIN k USING (vec_id), h"""
