"""Text quality by the votes of labelled nearest neighbours in a latent-semantic space."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.llm.arrays import LOWER, SEPARATOR, U, run_hashes, text_chunks
from stocktide.llm.labelled import fold, sample

SCHEMA = "doc_id bigint, held_out boolean, score double, predicted int"
WORD_BITS, SIGN_BITS = 12, 7
WORDS, SIGNS, SHAPES = 1 << WORD_BITS, 1 << SIGN_BITS, 16
TERMS = WORDS + SIGNS + SHAPES
BLOCK = 512

UPPER = np.zeros(256, bool)
UPPER[65:91] = True
ALPHA = UPPER.copy()
ALPHA[97:123] = ALPHA[128:] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True


def counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Term counts of every text: hashed words, hashed runs of signs at the end of words, and word shapes.

    Shapes: how many words are in capitals, capitalised, without a letter, with a digit, ending in a sign, equal to the
    word before, equal to one of the same text (by what share are new), and by length.
    """
    n = len(offsets) - 1
    out = np.zeros((n, TERMS), np.float32)
    live = ~SEPARATOR[data]
    first = live.copy()
    first[1:] &= ~live[:-1]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[begins] = live[begins]
    starts = np.flatnonzero(first)
    if not len(starts):
        return out
    bounds = np.searchsorted(starts, offsets)
    text = np.repeat(np.arange(n), np.diff(bounds))
    alpha = ALPHA[data]
    plain = run_hashes(LOWER[data], starts, alpha)
    sign = live & ~alpha
    signs = run_hashes(data, starts, sign)

    def per_word(mask):
        return np.add.reduceat(mask, starts, dtype=np.int64)

    letters, capitals, digits, marks = per_word(alpha), per_word(UPPER[data]), per_word(DIGIT[data]), per_word(sign)
    size = letters + marks
    again = np.zeros(len(starts), bool)
    again[1:] = (plain[1:] == plain[:-1]) & (text[1:] == text[:-1])
    key = plain ^ (text.astype(U) * U(0xD6E8FEB86659FD93))
    _, where = np.unique(key, return_index=True)
    new = np.zeros(len(starts), bool)
    new[where] = True
    shapes = [(capitals == letters) & (letters > 1), UPPER[data[starts]], letters == 0, digits > 0, marks > 0, marks > 1, marks > 2, again,
              new, size <= 3, (size > 3) & (size <= 8), (size > 8) & (size <= 16), size > 16]
    flat = [text * TERMS + ((plain * U(0x9E3779B97F4A7C15)) >> U(64 - WORD_BITS)).astype(np.int64)]
    flat.append((text * TERMS + WORDS + ((signs * U(0x9E3779B97F4A7C15)) >> U(64 - SIGN_BITS)).astype(np.int64))[marks > 0])
    flat += [(text * TERMS + WORDS + SIGNS + k)[mask] for k, mask in enumerate(shapes)]
    return np.bincount(np.concatenate(flat), minlength=n * TERMS).reshape(n, TERMS).astype(np.float32)


def weighted(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Log counts times inverse frequencies for words; shares of the words for signs and shapes. Each kind has a fixed length."""
    out = np.empty_like(tf)
    total = np.maximum(tf[:, :WORDS].sum(axis=1, keepdims=True), 1)
    for a, b, weight in ((0, WORDS, 0.5), (WORDS, WORDS + SIGNS, 0.5), (WORDS + SIGNS, TERMS, 1.0)):
        part = np.log1p(tf[:, a:b]) * idf[a:b] if a == 0 else np.sqrt(tf[:, a:b] / total)
        norm = np.sqrt((part * part).sum(axis=1, keepdims=True)) if a == 0 else 1.0
        out[:, a:b] = weight * part / np.maximum(norm, 1e-9)
    return out


@dataclass
class Model:
    idf: np.ndarray
    axes: np.ndarray  # terms x latent dimensions
    vectors: np.ndarray  # labelled texts, of length one
    labels: np.ndarray
    neighbours: int
    empty: float  # the score of a text without words: the share of good labels

    def place(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        z = weighted(counts(data, offsets), self.idf) @ self.axes
        return z / np.maximum(np.sqrt((z * z).sum(axis=1, keepdims=True)), 1e-9)

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Votes of the nearest labelled texts, each weighed by its cosine. Every labelled text is compared, in blocks."""
        out = np.full(len(offsets) - 1, self.empty)
        k = min(self.neighbours, len(self.labels))
        for i in range(0, len(out), BLOCK):
            j = min(i + BLOCK, len(out))
            z = self.place(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            near = z @ self.vectors.T
            best = np.argpartition(-near, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(near, best, axis=1), 0).astype(np.float64) ** 8
            some = (weight.sum(axis=1) > 0) & np.any(z != 0, axis=1)
            out[i:j][some] = ((weight * self.labels[best]).sum(axis=1)[some] / weight.sum(axis=1)[some])
        return np.clip(out, 0, 1)


def fit(texts: list[str], labels: list[int], width: int = 64, neighbours: int = 15, seed: int = 0) -> Model:
    """Latent axes by randomised subspace iteration on the labelled texts' weighted counts, then their places there."""
    tf = [counts(data, offsets) for _, _, data, offsets in text_chunks(pa.array(texts, pa.string()), 1 << 18)]
    tf = np.concatenate(tf) if tf else np.zeros((0, TERMS), np.float32)
    idf = np.log((1 + len(tf)) / (1 + (tf > 0).sum(axis=0))).astype(np.float32) + 1
    x = weighted(tf, idf)
    width = min(width, len(x))
    q = np.random.default_rng(seed).normal(size=(TERMS, width)).astype(np.float32)
    for _ in range(5):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    model = Model(idf, q.astype(np.float32), np.zeros((0, width), np.float32), np.asarray(labels, float), neighbours, float(np.mean(labels)))
    z = x @ model.axes
    model.vectors = (z / np.maximum(np.sqrt((z * z).sum(axis=1, keepdims=True)), 1e-9)).astype(np.float32)
    return model


def train(docs: DataFrame, labels: DataFrame, most: int = 1500) -> Model | None:
    """A model from at most ``most`` texts of each label, of the training folds; None if there are none.

    Several labels of one document: the lowest counts.
    """
    rows = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id", 4) != 2))
    rows = rows.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    found = [sample(docs, rows.where(F.col("quality") == k), most) for k in (0, 1)]
    texts = [t for f in found for t in f["text"]]
    return fit(texts, [int(t) for f in found for t in f["quality"]]) if texts else None


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """The quality of every whole text by its labelled neighbours' votes; at most two times ``most`` vectors are broadcast.

    Null, empty and wordless texts get the share of good labels in the fit; without a model every score is 0. Repeated rows
    and null ids give a row each (a null id is not held out). Only the text is read for the score; other columns, whatever
    their names, are not read. No shuffle; memory is a few times the longest text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        model = shared.value
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for i, j, data, offsets in text_chunks(batch.column("text"), 1 << 21) if model else ():
                scores[i:j] = model.scores(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores), pa.array((scores >= 0.7).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text",
                       F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out")).mapInArrow(score, SCHEMA)
