"""Packing tokenised documents into sequences of a fixed length.

A text becomes ids of a public tokenizer (its file is a parameter; nothing is
trained) and an end id. Longer documents are cut into pieces of the sequence
length, and every piece is packed whole. Pieces are dealt by hash over
partitions of bounded size; each partition packs its pieces best fit
decreasing and bounds its number of sequences from below by dual feasible
functions of the piece lengths. Bound and count equal: the partition is proven
best. While all together need more sequences than the bound over all lengths,
partitions with gaps (sequences that are not full) hand those sequences'
pieces to new partitions, which mix the pieces of many, and these run best fit
decreasing again. A round is kept if it needs fewer sequences.

Words repeat, so the ids of a word are looked up; words not met yet are
tokenised in batches. A text of other characters than those of ``PLAIN`` is
looked up by what stands between white space, as the tokenizer drops that.

Defined results: a null or empty text is the end id alone; a null or repeated
``doc_id`` is packed like any other; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxcover.llm.common import stored

MODEL = "/opt/tokenizers/word_bpe_49k.json"
SEQUENCE, END_ID = 4096, 1
#: Bounds of a partition that one task packs; exchanged ones are larger by SPREAD.
GROUP_PIECES, GROUP_TOKENS, SPREAD = 1 << 13, 1 << 24, 4
#: Rounds of exchange at most; after each round without gain, one in so many
#: filled sequences is exchanged too, and after the last of these they end.
ROUNDS, MIX = 8, (0, 16, 4)
#: Texts a task tokenises at a time, characters of a text at a time, words kept.
TEXTS, BLOCK, WORDS = 256, 1 << 20, 1 << 19
#: New words tokenised as one line, and what marks a word's last piece.
LINE, WORD_END = 500, "</w>"

#: Characters that the tokenizer's normal form leaves alone but for the case,
#: and its split of such texts into words (a fixed pattern of the vocabulary).
PLAIN = re.compile(r"[\t-\r\x20-\x7e\xa1-\xff‐-‧‰-⁞€]*")
SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^\sa-z0-9ªµºß-öø-ÿ²³¹¼½¾]+")
SPACES = re.compile(r"[\t-\r ]+")


# --------------------------------------------------------------------------
# tokens

class Tokens:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.marks = tuple(x.content for x in self.tokenizer.get_added_tokens_decoder().values())
        self.known: dict[str, bytes] = {}
        # words in normal form need the merges only; a word's last id ends it
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = WhitespaceSplit()
        ids = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(ids.values()) + 1, bool)
        self.ends[[i for piece, i in ids.items() if piece.endswith(WORD_END)]] = True

    def learn_words(self, words: list[str]) -> None:
        lines = [words[i:i + LINE] for i in range(0, len(words), LINE)]
        coded = self.merges.encode_batch_fast([" ".join(map(byte_form, line)) for line in lines], add_special_tokens=False)
        for line, e in zip(lines, coded):
            ids = np.array(e.ids, "<u4")
            data, at = ids.tobytes(), 0
            for word, end in zip(line, (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist(), strict=True):
                self.known[word], at = data[at:end], end

    def learn_chunks(self, chunks: list[str]) -> None:
        for chunk, e in zip(chunks, self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)):
            self.known[chunk] = np.array(e.ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > WORDS:
            self.known.clear()
        plain, other, split = set(), set(), []
        for t in texts:
            easy = PLAIN.fullmatch(t) and not any(m in t for m in self.marks)
            parts = [SPLIT.findall(part.lower()) if easy else SPACES.split(part) for part in blocks(t)]
            (plain if easy else other).update(*parts)
            split.append(parts)
        self.learn_words(list(plain.difference(self.known)))
        self.learn_chunks(list(other.difference(self.known)))
        return [b"".join(b"".join(map(self.known.__getitem__, part)) for part in parts) for parts in split]


_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: The vocabulary's letter of every byte: itself if it can be shown, else the next from U+0100.
BYTE_FORM = dict(zip([*_SHOWN, *sorted(set(range(256)) - set(_SHOWN))], [*_SHOWN, *range(256, 512)]))


def byte_form(word: str) -> str:
    return word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_FORM)


def blocks(text: str) -> Iterator[str]:
    """The text in parts that end before white space."""
    at = 0
    while len(text) - at > BLOCK:
        cut = SPACES.search(text, at + BLOCK)
        if not cut:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def pieces(docs: DataFrame, path: str = MODEL, sequence: int = SEQUENCE, end_id: int = END_ID, text: str = "text",
           with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``) of every piece."""
    given = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = T.StructType([given.schema["doc_id"], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
                           T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())])
    if with_ids:
        schema.add("ids", T.ArrayType(T.IntegerType()))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(path)
        for whole in batches:
            for first in range(0, whole.num_rows, TEXTS):
                batch = whole.slice(first, TEXTS)
                row, piece, size, crc, ids = [], [], [], [], []
                for i, data in enumerate(tokens.encode(batch.column("text").to_pylist())):
                    data += end
                    for k, at in enumerate(range(0, len(data), 4 * sequence)):
                        part = data[at:at + 4 * sequence]
                        row.append(i)
                        piece.append(k)
                        size.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        if with_ids:
                            ids.append(np.frombuffer(part, "<i4"))
                out = [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                       pa.array([k * sequence for k in piece], pa.int64()), pa.array(size, pa.int64()), pa.array(crc, pa.int64())]
                if with_ids:
                    ends = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
                    out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32())))
                yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return given.mapInArrow(run, schema)


# --------------------------------------------------------------------------
# one partition

def lower_bound(counts: np.ndarray) -> int:
    """Sequences that pieces need at least; ``counts[x]`` pieces have length
    x, the last length fills a sequence.

    The best of two families of dual feasible functions: one rounds lengths
    over ``c - k`` up to c and those below k down to 0 (k up to c / 2), the
    other rounds multiples of c / (k + 1) (Fekete and Schepers)."""
    c = len(counts) - 1
    x = np.arange(c + 1, dtype=np.int64)
    n = np.concatenate(([0], np.cumsum(counts)))            # pieces shorter than i
    s = np.concatenate(([0], np.cumsum(counts * x)))
    k = np.arange(c // 2 + 1)
    best = int((n[c + 1] - n[c - k + 1] + -(-(s[c - k + 1] - s[k]) // c)).max())
    for k in range(1, 65):
        whole = (k + 1) * x // c
        value = np.where((k + 1) * x % c == 0, x * k, whole * c)
        best = max(best, -(-int((counts * value).sum()) // (k * c)))
    return best


def best_fit(lengths: np.ndarray, sequence: int) -> tuple[np.ndarray, np.ndarray]:
    """The sequence and offset of every piece, best fit in the given order:
    the fullest sequence that still holds it. Open sequences are kept by the
    room they have left, the rooms in use as the bits of one integer."""
    room: list[list[int]] = [[] for _ in range(sequence + 1)]
    bits = used = 0
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, n in enumerate(lengths.tolist()):
        fits = bits >> n
        if fits:
            left = n + (fits & -fits).bit_length() - 1
            b = room[left].pop()
            if not room[left]:
                bits ^= 1 << left
        else:
            left, b = sequence, used
            used += 1
        where[i], offset[i] = b, sequence - left
        if left > n:
            left -= n
            room[left].append(b)
            bits |= 1 << left
    return where, offset


def packed(pdf: pd.DataFrame, sequence: int) -> pd.DataFrame:
    """A partition's pieces with their sequence, offset, the tokens of that
    sequence, and the partition's count and bound."""
    pdf = pdf.sort_values(["length", "row"], ascending=[False, True], ignore_index=True)
    where, offset = best_fit(pdf["length"].to_numpy(), sequence)
    fill = np.bincount(where, pdf["length"].to_numpy()).astype(np.int64)
    bound = lower_bound(np.bincount(pdf["length"].to_numpy(), minlength=sequence + 1))
    return pdf.assign(bin=where, offset=offset, fill=fill[where], bins=len(fill), bound=bound)


# --------------------------------------------------------------------------
# Spark job

def groups(pieces_: DataFrame, salt: int) -> Column:
    """A partition number per piece: as many as the bounds ask for, dealt by a
    hash of the row, so that no key can be hot."""
    n, tokens = pieces_.agg(F.count(F.lit(1)), F.sum("length")).first()
    size = SPREAD if salt else 1
    many = max(1, -(-n // (size * GROUP_PIECES)), -(-(tokens or 0) // (size * GROUP_TOKENS)))
    return F.pmod(F.xxhash64(F.col("row"), F.lit(salt)), F.lit(many))


def pack(pieces_: DataFrame, sequence: int = SEQUENCE, rounds: int = ROUNDS) -> DataFrame:
    """Places of pieces ``(row, length)``: ``row, length, sequence_id,
    offset``. ``row`` names a piece, ``length`` is at most ``sequence``."""
    given = pieces_.select("row", "length")
    place = T.StructType([given.schema["row"], T.StructField("length", T.LongType()), T.StructField("g", T.LongType()),
                          *(T.StructField(c, T.LongType()) for c in ("bin", "offset", "fill", "bins", "bound"))])

    def run(rows: DataFrame, salt: int) -> DataFrame:
        dealt = rows.select("row", "length", groups(rows, salt).cast("long").alias("g"))
        out = dealt.groupBy("g").applyInPandas(lambda pdf: packed(pdf, sequence), place)
        return stored(out.withColumn("sequence_id", F.lit(salt << 56) + F.shiftleft("g", 24) + F.col("bin")), "packed")

    def sequences(rows: DataFrame) -> int:
        return rows.where("offset = 0").count()

    counts = np.zeros(sequence + 1, np.int64)
    for r in given.groupBy("length").count().collect():     # one row a length at most
        counts[r["length"]] = r["count"]
    least = lower_bound(counts)
    now = run(given, 0)
    total, idle = sequences(now), 0
    for salt in range(1, rounds + 1):
        if total <= least or idle >= len(MIX):
            break
        spare = F.col("fill") < sequence
        if MIX[idle]:
            spare = spare | (F.pmod(F.xxhash64("sequence_id", F.lit(salt)), F.lit(MIX[idle])) == 0)
        free = stored(now.where(spare), "spare")
        again = run(free, salt)
        had, has = sequences(free), sequences(again)
        idle = 0 if has < had else idle + 1
        if has < had:
            now = stored(now.where(~spare).unionByName(again), "packed")
            total += has - had
    return now.select("row", "length", "sequence_id", "offset")


def pack_documents(docs: DataFrame, path: str = MODEL, sequence: int = SEQUENCE, end_id: int = END_ID,
                   with_ids: bool = False, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every
    piece, and its ``ids`` if asked for."""
    cut = stored(pieces(docs, path, sequence, end_id, with_ids=with_ids)
                 .withColumn("row", F.monotonically_increasing_id()), "pieces")
    placed = pack(cut, sequence, rounds).select("row", "sequence_id", "offset")
    return cut.join(placed, "row").drop("row")
