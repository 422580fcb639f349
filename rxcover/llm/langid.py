"""Language identification: averaged hashed subword embeddings, a linear
softmax trained by stochastic gradient descent, and calibrated rejection.

A text is lower-cased; its subwords are the byte 3-grams and 4-grams of its
words with their boundaries, hashed to a fixed number of buckets. Training
reads a bounded, documented sample of labelled rows (``SAMPLE_ROWS`` rows by
least hash of the id and ``LABEL_ROWS`` rows of each label by the same, so that
every label is learned), each as its bucket counts over the whole text (six
bytes for a bucket that occurs, so at most 384 KB a row however long the text),
and runs on the driver on those numbers alone, whose size grows with the number
of labels but not of documents. Prediction reads every whole text, in pieces of
bounded size; there embeddings and softmax collapse into one table of bucket by
language.

The probability is calibrated by a temperature fitted on a held-back part of
the sample. A text is rejected when its calibrated probability, or the share
of its subwords ever seen in training, is below what the held-back texts
show; ``und`` texts are always rejected.

Defined results: a null text or one without a letter is ``und`` with score 0;
rows with a null label are not learned from; rows of one id, label and text are
learned from once; without any labelled row every text is ``und``; copies and
ties change nothing; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxcover.llm.common import free_names, stored

SAMPLE_ROWS = 4000
#: Each label has so many rows in the sample, or all that it has.
LABEL_ROWS = 200
LOG2_BUCKETS = 16
DIMENSION = 16
EPOCHS = 8
PIECE = 1 << 20

_ASCII_GAPS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def subwords(data: np.ndarray) -> np.ndarray:
    """Buckets of the byte 3-grams and 4-grams that span no gap between
    words (a gap is one or more spaces here)."""
    a = data.astype(np.uint32)
    if len(a) < 3:
        return np.zeros(0, np.uint16)
    space = data == 32
    two = space[:-1] & space[1:]                     # doubled gaps
    inner = space[1:-1]                              # a gap inside a 3-gram
    g3 = (a[:-2] << 16) | (a[1:-1] << 8) | a[2:]
    ok3 = ~inner & ~(space[:-2] & space[2:] & inner)
    h3 = (g3[ok3] * np.uint32(2654435761)) >> np.uint32(32 - LOG2_BUCKETS)
    if len(a) < 4:
        return h3.astype(np.uint16)
    g4 = (g3[:-1] << 8) | a[3:]
    ok4 = ~(inner[:-1] | inner[1:]) & ~two[:-2]
    h4 = ((g4[ok4] ^ np.uint32(0x9E3779B9)) * np.uint32(2246822519)) >> np.uint32(32 - LOG2_BUCKETS)
    return np.concatenate((h3, h4)).astype(np.uint16)


def pieces(text: str) -> Iterator[np.ndarray]:
    """The lower-cased bytes of a text with its gaps as spaces, in pieces
    that overlap by one subword less a byte; each starts 3 bytes back."""
    data = np.frombuffer(b" " + text.lower().encode("utf-8", "replace").translate(_ASCII_GAPS) + b" ", np.uint8)
    for at in range(0, len(data), PIECE):
        yield data[max(0, at - 3):at + PIECE]


def bag(text: str) -> bytes:
    """Bucket counts of a whole text: the buckets that occur (16 bits each),
    then their counts (32 bits each)."""
    counts = np.zeros(1 << LOG2_BUCKETS, np.int64)
    for piece in pieces(text):
        counts += np.bincount(subwords(piece), minlength=len(counts))
    ids = np.flatnonzero(counts)
    return ids.astype("<u2").tobytes() + np.minimum(counts[ids], 2 ** 32 - 1).astype("<u4").tobytes()


def opened(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a bag and their counts."""
    n = len(data) // 6
    return np.frombuffer(data, "<u2", n), np.frombuffer(data, "<u4", n, 2 * n)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray          # bucket x language: embeddings times softmax weights
    bias: np.ndarray
    seen: np.ndarray           # bucket was met in training
    temperature: float
    least_score: float
    least_seen: float

    def logits(self, text: str) -> tuple[np.ndarray, float]:
        total, n, known = np.zeros(len(self.languages)), 0, 0
        for piece in pieces(text):
            h = subwords(piece)
            n += len(h)
            known += int(np.count_nonzero(self.seen[h]))
            total += self.table[h].sum(axis=0, dtype=np.float64)
        return (total / n if n else total) + self.bias, known / n if n else 0.0

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not self.languages or not has_letter(text):
            return "und", 0.0, True
        z, known = self.logits(text)
        p = softmax(z / self.temperature)
        k = int(np.argmax(p))
        score = round(float(min(1.0, p[k])), 6)
        return self.languages[k], score, score < self.least_score or known < self.least_seen


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def sample(docs: DataFrame, learn: Column, rows: int, label_rows: int = LABEL_ROWS) -> list:
    """The ``rows`` labelled rows with the least hash of the id, and of every
    label the ``label_rows`` with the least, each as its label and the bag of
    its whole text."""
    keyed = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.xxhash64(F.col("doc_id").cast("string")).alias("h"), "lang", "text")
    # only texts with a letter are learned from
    counts = {r["lang"]: r["count"] for r in keyed.where(F.col("text").rlike(r"\p{L}")).groupBy("lang").count().collect()}
    if not counts:
        return []

    def bound(want: int, n: int) -> int:
        share = min(1.0, 1.5 * want / n + 100 / n)
        return min(int(-(2 ** 63) + share * (2 ** 64 - 1)), 2 ** 63 - 1)

    least = bound(rows, sum(counts.values()))
    of = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, max(least, bound(label_rows, n)))])
    keyed = keyed.where(F.col("h") <= F.coalesce(F.try_element_at(of, F.col("lang")), F.lit(least)))

    def bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for h, lang, text in zip(pdf["h"], pdf["lang"], pdf["text"]):
                if has_letter(text):
                    out.append((h, lang, bag(text)))
                if len(out) == 256:
                    yield pd.DataFrame(out, columns=["h", "lang", "bag"])
                    out = []
            yield pd.DataFrame(out, columns=["h", "lang", "bag"])

    found = stored(keyed.mapInPandas(bags, "h long, lang string, bag binary").withColumn("d", F.xxhash64("bag")),
                   "langid-sample")
    # rows are chosen by their keys; only the chosen ones' bags are read
    keys = stored(found.select("h", "lang", "d").distinct(), "langid-keys")
    first = keys.orderBy("h", "lang", "d").limit(rows)
    each = keys.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h", "d"))).where(
        F.col("k") <= label_rows).drop("k")
    chosen = found.join(first.union(each).distinct(), ["h", "lang", "d"], "left_semi")
    # a partition at a time: the driver's JVM never holds the whole sample
    got = {(r["h"], r["lang"], r["d"]): r for r in stored(chosen, "langid-chosen").toLocalIterator()}
    return [got[k] for k in sorted(got)]


def fit(rows: list, epochs: int = EPOCHS, dimension: int = DIMENSION, seed: int = 7) -> Model:
    """Stochastic gradient descent over the sampled bags, on the driver."""
    languages = sorted({r["lang"] for r in rows})
    size = 1 << LOG2_BUCKETS
    empty = Model(languages, np.zeros((size, len(languages)), np.float32), np.zeros(len(languages)),
                  np.ones(size, bool), 1.0, 0.0, 0.0)
    if len(languages) < 2:
        return empty
    bags = [opened(bytes(r["bag"])) for r in rows]
    y = np.array([languages.index(r["lang"]) for r in rows])
    use = [i for i, b in enumerate(bags) if len(b[0])]
    learned = {y[i] for i in use if i % 5 != 4}
    held = [i for i in use if i % 5 == 4 and y[i] in learned]
    train = [i for i in use if i % 5 != 4 or y[i] not in learned]
    rng = np.random.default_rng(seed)
    e = rng.uniform(-1 / dimension, 1 / dimension, (size, dimension)).astype(np.float32)
    w, b = np.zeros((dimension, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    steps, step = epochs * len(train), 0
    for _ in range(epochs):
        for i in rng.permutation(train):
            rate = 1.0 * (1 - step / steps)
            step += 1
            ids, c = bags[i][0], bags[i][1].astype(np.float32)
            c /= c.sum()
            x = c @ e[ids]
            g = softmax(x @ w + b)
            g[y[i]] -= 1
            back = w @ g
            w -= rate * np.outer(x, g)
            b -= 0.1 * rate * g
            e[ids] -= rate * 4 * c[:, None] * back
    seen = np.zeros(size, bool)
    for i in train:
        seen[bags[i][0]] = True
    table = (e @ w).astype(np.float32)
    table[~seen] = 0
    if not held:
        return Model(languages, table, b.astype(np.float64), seen, 1.0, 0.0, 0.0)
    z = np.array([(bags[i][1] / bags[i][1].sum()) @ table[bags[i][0]] + b for i in held])
    heat = min(np.geomspace(0.1, 10, 81), key=lambda t: -np.log(np.maximum(1e-12, softmax(z / t)[np.arange(len(held)), y[held]])).mean())
    score = softmax(z / heat).max(axis=1)
    known = np.array([bags[i][1][seen[bags[i][0]]].sum() / bags[i][1].sum() for i in held])
    # rejected: below half of what all but 1 in 1000 held-back texts reach
    return Model(languages, table, b.astype(np.float64), seen, float(heat),
                 float(min(0.5, np.quantile(score, 0.001) / 2 + 0.5 / len(languages))), float(np.quantile(known, 0.001) / 2))


def train(docs: DataFrame, learn: Column, rows: int = SAMPLE_ROWS) -> Model:
    return fit(sample(docs, learn, rows))


def predicted(model: Model, text: Column) -> Column:
    """A struct ``lang_pred, score, rejected`` of a text column."""
    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score", "rejected"])
    return run(text)


def held_out(doc_id: Column) -> Column:
    """Rows never learned from by the registered query."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` per document."""
    model = train(docs.select("doc_id", "text", "lang"), ~held_out(F.col("doc_id")))
    out = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predicted(model, F.col("text")).alias("p"))
    return out.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.rejected")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is not rejected, all columns."""
    model = train(docs.select("doc_id", "text", "lang"), ~held_out(F.col("doc_id")))
    p, = free_names(docs, "__p")
    return docs.withColumn(p, predicted(model, F.col("text"))).where(~F.col(p)["rejected"]).select(*docs.columns)
