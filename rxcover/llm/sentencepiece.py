"""SentencePiece BPE encoding with seeded merge-dropout, and decoding.

The vocabulary (pieces, scores, byte fallback) is read from a public model
file whose path is a parameter; nothing is trained. A text becomes symbols;
candidate merges are taken from an agenda, best score first, then leftmost. A
candidate is skipped for good when the keyed hash of (seed, key of the text,
position, left piece, right piece) falls below the dropout rate. As the hash
belongs to the candidate and not to a moment, the same text and key always
give the same segmentation, and different keys varied ones.

Texts are cut where no piece joins two neighbouring characters; the agendas
of all cuts of one length advance together as rows of a matrix, and long cuts
use a heap. Both give the same pieces.

Decoding joins the pieces' bytes and is exact for every text: a character
without a piece, and a literal U+2581, is written as its UTF-8 bytes.

Defined results: a null text has null pieces and decodes to null; an empty
text has no pieces and decodes to the empty text; repeated rows give repeated
rows; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxcover.llm.common import mix64

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT, SEED = 0.1, 2024
SPACE = "▁"
#: Cuts up to this length advance in matrices; characters handled at a time.
LONG, BLOCK = 40, 1 << 19
#: Rows whose pieces a task holds at a time.
ROWS = 512
NONE = np.int32(2 ** 31 - 1)
_M = (1 << 64) - 1
_C = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


@dataclass
class Vocabulary:
    """Pieces by id: their bytes when decoded, and the text of those that
    merge (None for control, unknown, byte and unused pieces)."""
    texts: list[str | None]
    raw: list[bytes]
    scores: np.ndarray
    byte_ids: np.ndarray
    _tables: dict = field(default_factory=dict)

    @staticmethod
    def load(path: str = MODEL) -> Vocabulary:
        from sentencepiece import SentencePieceProcessor
        m = SentencePieceProcessor(model_file=path)
        texts, raw, byte_ids = [], [], np.full(256, -1, np.int32)
        for i in range(m.get_piece_size()):
            p = m.id_to_piece(i)
            if m.is_byte(i):
                byte_ids[int(p[3:5], 16)] = i
                texts.append(None)
                raw.append(bytes([int(p[3:5], 16)]))
            elif m.is_control(i) or m.is_unknown(i) or m.is_unused(i):
                texts.append(None)
                raw.append(b"")
            else:
                texts.append(p)
                raw.append(p.replace(SPACE, " ").encode())
        if (byte_ids < 0).any():
            raise ValueError("a model without byte fallback can't encode every text")
        return Vocabulary(texts, raw, np.array([m.get_score(i) for i in range(len(texts))]), byte_ids)

    def __getstate__(self):
        return {**self.__dict__, "_tables": {}}

    # -- tables derived on each worker

    def table(self, name: str):
        if not self._tables:
            self._derive()
        return self._tables[name]

    def _derive(self) -> None:
        ids = {t: i for i, t in enumerate(self.texts) if t is not None}
        n = len(self.texts)
        for t in list(ids):  # characters inside pieces that are no pieces
            for c in t:
                if c not in ids:
                    ids[c] = n
                    n += 1
        rank = {t: r for r, t in enumerate(sorted((t for t in ids if ids[t] < len(self.texts) and len(t) > 1),
                                                  key=lambda t: (-self.scores[ids[t]], ids[t])))}
        # equal scores take the leftmost of all their candidates
        order, level, last = {}, -1, None
        for t in rank:
            s = self.scores[ids[t]]
            level, last = (level + 1, s) if s != last else (level, last)
            order[t] = level
        pairs: dict[int, tuple[int, int]] = {}
        chars = sorted({c for t in rank for c in t})
        col = {c: i + 1 for i, c in enumerate(chars)}
        joins = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for t, r in order.items():
            for k in range(1, len(t)):
                joins[col[t[k - 1]], col[t[k]]] = True
                a, b = ids.get(t[:k]), ids.get(t[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = (r, ids[t])
        symbol, column = np.full(0x110000, -1, np.int32), np.zeros(0x110000, np.int32)
        for t, i in ids.items():
            if len(t) == 1:
                symbol[ord(t)] = i
        for c, i in col.items():
            column[ord(c)] = i
        # the space is written as the mark; a literal mark goes by its bytes
        symbol[32], column[32] = symbol[ord(SPACE)], column[ord(SPACE)]
        symbol[ord(SPACE)], column[ord(SPACE)] = -1, 0
        for c in range(128):
            if symbol[c] < 0:
                symbol[c] = self.byte_ids[c]
        keys = np.fromiter(pairs, np.uint64, len(pairs))
        size = 1 << max(4, int(np.ceil(np.log2(4 * len(keys) + 1))))
        slot_key, slot_val = np.full(size, _M, np.uint64), np.zeros((size, 2), np.int32)
        slot_val[:, 0] = NONE
        at = (mix64(keys) & np.uint64(size - 1)).astype(np.int64)
        for k, s, v in zip(keys.tolist(), at.tolist(), pairs.values()):
            while slot_key[s] != _M:
                s = (s + 1) & (size - 1)
            slot_key[s], slot_val[s] = k, v
        self._tables = {"pairs": pairs, "symbol": symbol, "column": column, "joins": joins, "slot_key": slot_key,
                        "slot_val": slot_val, "real": len(self.texts)}

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Level (NONE if they don't join) and merged piece of each pair."""
        slot_key, slot_val = self.table("slot_key"), self.table("slot_val")
        key = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        mask = len(slot_key) - 1
        at = (mix64(key) & np.uint64(mask)).astype(np.int64)
        found = slot_key[at]
        out = slot_val[at]
        wrong = np.flatnonzero((found != key) & (found != np.uint64(_M)))
        out[(found != key)] = (NONE, 0)
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & mask
            f = slot_key[at[wrong]]
            hit = f == key[wrong]
            out[wrong[hit]] = slot_val[at[wrong[hit]]]
            wrong = wrong[~hit & (f != np.uint64(_M))]
        return out[:, 0], out[:, 1]

    # -- encoding

    def encode(self, texts: list[str], keys: list[int], dropout: float = DROPOUT, seed: int = SEED) -> list[np.ndarray]:
        """Piece ids of each text; ``keys`` are the texts' 64-bit keys."""
        out: list[np.ndarray] = []
        start = 0
        while start < len(texts):
            end, size = start, 0
            while end < len(texts) and (end == start or size + len(texts[end]) < BLOCK):
                size += len(texts[end])
                end += 1
            out += self._encode(texts[start:end], keys[start:end], dropout, seed)
            start = end
        return out

    def _encode(self, texts: list[str], keys: list[int], dropout: float, seed: int) -> list[np.ndarray]:
        limit = int(dropout * 2.0 ** 64)
        marked = [" " + t if t else "" for t in texts]
        sizes = np.array([len(t) for t in marked])
        points = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32)
        n = len(points)
        if not n:
            return [np.zeros(0, np.int32) for _ in texts]
        begin = np.concatenate(([0], np.cumsum(sizes)))
        salt = mix64(np.array([(k ^ (seed * _C[0])) & _M for k in keys], np.uint64))
        symbol, column = self.table("symbol")[points], self.table("column")[points]
        cut = np.ones(n + 1, bool)
        cut[1:-1] = ~self.table("joins")[column[:-1], column[1:]]
        cut[begin] = True
        at = np.flatnonzero(cut)
        length = np.diff(at)
        owner = np.repeat(np.arange(len(texts)), sizes)
        result = symbol.copy()
        dead = np.zeros(n, bool)      # characters whose piece starts further left
        by = np.argsort(length, kind="stable")
        bounds = np.searchsorted(length[by], np.arange(2, LONG + 2))
        for size in range(2, LONG + 1):
            rows = at[by[bounds[size - 2]:bounds[size - 1]]]
            if len(rows):
                self._advance(rows, size, symbol, begin, owner, salt, limit, result, dead)
        for k in by[bounds[LONG - 1]:]:
            a, b, o = int(at[k]), int(at[k + 1]), int(owner[at[k]])
            ids = self.agenda(symbol[a:b].tolist(), a - int(begin[o]), int(salt[o]), limit)
            result[a:a + len(ids)] = ids
            dead[a + len(ids):b] = True
        real = self.table("real")
        odd = np.flatnonzero(((result < 0) | (result >= real)) & ~dead)
        out = []
        live = ~dead
        for i, (a, b) in enumerate(zip(begin[:-1], begin[1:])):
            lo, hi = np.searchsorted(odd, (a, b))
            if lo == hi:
                out.append(result[a:b][live[a:b]])
                continue
            parts, p = [], a
            for q in odd[lo:hi]:
                c = chr(points[q]) if result[q] < 0 else self._char(int(result[q]))
                parts += [result[p:q][live[p:q]], self.byte_ids[np.frombuffer(c.encode("utf-8", "surrogatepass"), np.uint8)]]
                p = q + 1
            parts.append(result[p:b][live[p:b]])
            out.append(np.concatenate(parts))
        return out

    def _char(self, virtual: int) -> str:
        """The character of a symbol inside pieces that is no piece."""
        return chr(int(np.flatnonzero(self.table("symbol") == virtual)[0]))

    def _skipped(self, salt: np.ndarray, at: np.ndarray, left: np.ndarray, right: np.ndarray, limit: int) -> np.ndarray:
        x = salt + at.astype(np.uint64) * np.uint64(_C[0])
        x ^= left.astype(np.uint64) * np.uint64(_C[1]) + right.astype(np.uint64) * np.uint64(_C[2])
        return mix64(x) < np.uint64(limit)

    def _level(self, left, right, at, salt, limit):
        level, merged = self.lookup(left, right)
        if limit:
            some = np.flatnonzero(level != NONE)
            level[some[self._skipped(salt[some], at[some], left[some], right[some], limit)]] = NONE
        return level, merged

    def _advance(self, rows, size, symbol, begin, owner, salt, limit, result, dead) -> None:
        """The agendas of all cuts of one length, one merge each a step."""
        ids = symbol[rows[:, None] + np.arange(size)]
        where = (rows - begin[owner[rows]])[:, None] + np.arange(size)
        key = salt[owner[rows]]
        level, merged = (x.reshape(len(rows), -1) for x in self._level(
            ids[:, :-1].ravel(), ids[:, 1:].ravel(), where[:, :-1].ravel(), np.repeat(key, size - 1), limit))
        full = size
        while True:
            j = level.argmin(axis=1)
            r = np.arange(len(rows))
            go = level[r, j] != NONE
            if not go.all():
                stop = np.flatnonzero(~go)
                spot = rows[stop][:, None]
                result[spot + np.arange(size)] = ids[stop]
                dead[spot + np.arange(size, full)] = True
                rows, ids, where, key, level, merged, j = (x[go] for x in (rows, ids, where, key, level, merged, j))
                r = np.arange(len(rows))
            if not len(rows):
                return
            ids[r, j] = merged[r, j]
            keep = np.ones(ids.shape, bool)
            keep[r, j + 1] = False
            size -= 1
            ids, where = ids[keep].reshape(-1, size), where[keep].reshape(-1, size)
            if size == 1:
                result[rows] = ids[:, 0]
                dead[rows[:, None] + np.arange(1, full)] = True
                return
            keep = np.ones(level.shape, bool)
            keep[r, j] = False
            level, merged = level[keep].reshape(-1, size - 1), merged[keep].reshape(-1, size - 1)
            for some, c in ((np.flatnonzero(j > 0), j - 1), (np.flatnonzero(j < size - 1), j)):
                k = c[some]
                a, b = self._level(ids[some, k], ids[some, k + 1], where[some, k], key[some], limit)
                level[some, k], merged[some, k] = a, b

    def agenda(self, ids: list[int], start: int, salt: int, limit: int) -> list[int]:
        """One cut by a heap of candidates; the same result as _advance."""
        pairs = self.table("pairs")
        n = len(ids)
        prev, nxt = list(range(-1, n - 1)), list(range(1, n + 1))
        alive = [True] * n
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            if i < 0 or j >= n or ids[i] < 0 or ids[j] < 0:
                return
            hit = pairs.get(ids[i] << 32 | ids[j])
            if hit is None:
                return
            if limit:
                x = (salt + (start + i) * _C[0]) & _M
                x ^= (ids[i] * _C[1] + ids[j] * _C[2]) & _M
                x ^= x >> 30
                x = x * 0xBF58476D1CE4E5B9 & _M
                x ^= x >> 27
                x = x * 0x94D049BB133111EB & _M
                x ^= x >> 31
                if x < limit:
                    return
            heapq.heappush(heap, (hit[0], i, ids[i], ids[j], hit[1]))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = nxt[i] if alive[i] else n
            if j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j], nxt[i] = new, False, nxt[j]
            if nxt[j] < n:
                prev[nxt[j]] = i
            offer(prev[i], i)
            offer(i, nxt[i])
        return [x for x, live in zip(ids, alive) if live]

    def decode(self, ids) -> str:
        raw = self.raw
        return b"".join([raw[i] for i in ids]).decode("utf-8", "surrogatepass")[1:]


# --------------------------------------------------------------------------
# Spark jobs

def encode(docs: DataFrame, carry: list[str], path: str = MODEL, dropout: float = DROPOUT, seed: int = SEED,
           text: str = "text", key: Column | None = None) -> DataFrame:
    """The columns ``carry`` of ``docs``, the ``pieces`` of the text, and
    whether they decode to it (``lossless``). A task holds the pieces of few
    rows at a time, whatever Spark's batch size."""
    vocabulary = Vocabulary.load(path)
    key = F.xxhash64(F.col("doc_id").cast("string")) if key is None else key
    given = docs.select(*carry, key.alias("__key"), F.col(text).alias("__text"))
    schema = T.StructType([*docs.select(*carry).schema.fields, T.StructField("pieces", T.ArrayType(T.IntegerType())),
                           T.StructField("lossless", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                texts = batch.column("__text").to_pylist()
                keys = batch.column("__key").to_pylist()
                known = [i for i, t in enumerate(texts) if t is not None]
                found = vocabulary.encode([texts[i] for i in known], [keys[i] for i in known], dropout, seed)
                right = [True] * len(texts)
                sizes = np.zeros(len(texts), np.int64)
                for i, ids in zip(known, found):
                    right[i] = vocabulary.decode(ids.tolist()) == texts[i]
                    sizes[i] = len(ids)
                ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                pieces = pa.ListArray.from_arrays(
                    pa.array(ends), pa.array(np.concatenate(found) if found else np.zeros(0, np.int32), pa.int32()),
                    mask=pa.array([t is None for t in texts]))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carry), pieces, pa.array(right, pa.bool_())],
                                                 names=[*carry, "pieces", "lossless"])

    return given.mapInArrow(run, schema)


def decoder(vocabulary: Vocabulary):
    """A column function of ``array<int>`` giving the text."""
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for ids in batches:
            yield pd.Series([None if x is None else vocabulary.decode(x.tolist()) for x in ids], dtype=object)
    return run


def summary(docs: DataFrame, **kw) -> DataFrame:
    """``doc_id, n_chars, n_pieces, pieces_hash, lossless`` per document."""
    sized = docs.select("doc_id", F.length("text").cast("long").alias("n_chars"), "text")
    out = encode(sized, ["doc_id", "n_chars"], **kw)
    return out.select("doc_id", "n_chars", F.when(F.col("pieces").isNotNull(), F.size("pieces")).cast("long").alias("n_pieces"),
                      F.when(F.col("pieces").isNotNull(), F.xxhash64("pieces")).alias("pieces_hash"), "lossless")
