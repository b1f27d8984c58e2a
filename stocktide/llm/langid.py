"""Language identification: averaged hashed subword embeddings under a linear softmax."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.llm.arrays import SMALL_CHUNK_BYTES, U, text_chunks
from stocktide.llm.labelled import fold, sample

SCHEMA = "doc_id bigint, held_out boolean, lang_pred string, score double, rejected boolean"
UNDETERMINED = "und"

#: A-Z are lower-cased, letters and all bytes beyond ASCII stay, anything else is a word boundary.
FOLDED = np.full(256, 32, np.uint8)
FOLDED[97:123] = FOLDED[65:91] = np.arange(97, 123)
FOLDED[128:] = np.arange(128, 256)
ORDERS = (2, 3, 4)


def subwords(data: np.ndarray, offsets: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order: where subwords begin that lie in one text and hold no boundary but at their ends, and their buckets."""
    signs = FOLDED[data]
    gap = signs == 32
    out = []
    for n in ORDERS:
        m = len(signs) - n + 1
        if m <= 0:
            continue
        code = signs[:m].astype(np.uint32)
        ok = ~(gap[:m] & gap[n - 1 :])
        for k in range(1, n):
            code = code << np.uint32(8) | signs[k : m + k]
            if k < n - 1:
                ok &= ~gap[k : m + k]
        for k in range(1, n):  # not across the end of a text
            at = offsets[1:-1] - k
            ok[at[(at >= 0) & (at < m)]] = False
        at = np.flatnonzero(ok)
        code = code[at].astype(U) * U(0x9E3779B97F4A7C15) + U(n * 0x632BE59BD9B4E019 % 2**64)
        out.append((at, ((code * U(0xA0761D6478BD642F)) >> U(64 - bits)).astype(np.int64)))
    return out


@dataclass
class Model:
    classes: list[str]
    table: np.ndarray  # bucket -> class scores: embeddings times softmax weights
    bias: np.ndarray
    temperature: float
    threshold: float
    bits: int

    def logits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Class scores of every text: the mean of its subwords' scores (the mean of embeddings, then the linear layer)."""
        n = len(offsets) - 1
        total, count = np.zeros((n, len(self.classes))), np.zeros(n)
        for at, bucket in subwords(data, offsets, self.bits):
            bounds = np.searchsorted(at, offsets)
            some = np.flatnonzero(np.diff(bounds))
            if len(some):
                total[some] += np.add.reduceat(self.table[bucket], bounds[some], axis=0)
                count += np.diff(bounds)
        return total / np.maximum(count, 1)[:, None] + self.bias

    def probabilities(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return softmax(self.logits(data, offsets) / self.temperature)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def features(texts: list[str], bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for _, _, data, offsets in text_chunks(pa.array(texts, pa.string()), 1):
        found = [b for _, b in subwords(data, offsets, bits)]
        buckets, counts = np.unique(np.concatenate(found) if found else np.zeros(0, np.int64), return_counts=True)
        out.append((buckets.astype(np.int32), (counts / max(1, counts.sum())).astype(np.float32)))
    return out


def fit(texts: list[str], labels: list[str], bits: int = 16, width: int = 16, epochs: int = 6, rate: float = 6.0,
        keep: float = 0.998, seed: int = 0) -> Model:
    """Stochastic gradient descent over single texts, four fifths of them; the rest sets temperature and threshold.

    The temperature minimises the rest's log loss. The threshold is the score that all but a share ``1 - keep`` of the
    rest's rightly labelled texts reach: below it a text is rejected.
    """
    classes = sorted(set(labels))
    rng = np.random.default_rng(seed)
    y = np.array([classes.index(c) for c in labels])
    x = features(texts, bits)
    order = rng.permutation(len(x))
    held = order[: len(x) // 5] if len(x) >= 50 else order
    train = order[len(x) // 5 :] if len(x) >= 50 else order
    e = rng.normal(0, 1 / width, (1 << bits, width)).astype(np.float32)
    w = np.zeros((width, len(classes)), np.float32)
    b = np.zeros(len(classes), np.float32)
    steps, done = epochs * len(train), 0
    for _ in range(epochs):
        for i in rng.permutation(train):
            at, share = x[i]
            mean = share @ e[at]
            p = softmax((mean @ w + b)[None])[0]
            p[y[i]] -= 1
            step = rate * (1 - done / steps)
            pull = w @ p
            w -= step * 0.1 * np.outer(mean, p)
            b -= step * 0.01 * p
            e[at] -= step * share[:, None] * pull
            done += 1
    model = Model(classes, (e @ w).astype(np.float32), b, 1.0, 0.0, bits)
    z = np.array([x[i][1] @ model.table[x[i][0]] + b for i in held])
    grid = np.exp(np.linspace(np.log(0.5), np.log(8), 40))
    loss = [-np.log(np.maximum(softmax(z / t)[np.arange(len(held)), y[held]], 1e-12)).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    p = softmax(z / model.temperature)
    right = p.max(axis=1)[p.argmax(axis=1) == y[held]]
    model.threshold = float(np.quantile(right, 1 - keep)) if len(right) else 0.0
    return model


def shares(counts: dict[str, int], most: int) -> dict[str, int]:
    """Of each language as many of ``most`` texts as of any other; what a rare one leaves goes to the others. One at least."""
    out, left = {}, most
    for done, (lang, count) in enumerate(sorted(counts.items(), key=lambda c: (c[1], c[0]))):
        out[lang] = min(count, max(1, left // (len(counts) - done)))
        left -= out[lang]
    return out


def train(docs: DataFrame, most: int = 4000) -> Model | None:
    """A model from at most ``most`` texts with a language, of the training folds, dealt evenly to the languages (at least one
    text of each); None if there are none."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id", 4) != 2))
    rows = rows.where("text is not null").groupBy("doc_id").agg(F.min("lang").alias("lang"))
    share = shares({r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}, most)
    each = [rows.where(F.col("lang") == lang).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for lang, n in sorted(share.items())]
    if not each:
        return None
    found = sample(docs, reduce(DataFrame.union, each), sum(share.values()))
    return fit(found["text"].tolist(), found["lang"].tolist()) if len(found) else None


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """Language and its calibrated probability for every whole text; ``rejected`` marks scores below the model's threshold.

    Only the text is read. A text that is null or has no letter is ``und`` with score 0, and rejected; so is every text if
    there is no model. Repeated rows and null ids give a row each (a null id is in no held-out fold). Ties go to the
    language that sorts first. Other columns, whatever their names, are not read. No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def label(batches):
        model = shared.value
        for batch in batches:
            letters = np.array(batch.column("letters").to_pylist(), bool)
            langs, scores = np.full(len(letters), UNDETERMINED, object), np.zeros(len(letters))
            for i, j, data, offsets in text_chunks(batch.column("text"), SMALL_CHUNK_BYTES) if model else ():
                p = model.probabilities(data, offsets)
                langs[i:j] = np.array(model.classes, object)[p.argmax(axis=1)]
                scores[i:j] = p.max(axis=1)
            langs[~letters], scores[~letters] = UNDETERMINED, 0
            threshold = model.threshold if model else 1.0
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(scores),
                 pa.array(~letters | (scores < threshold))], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text",
        F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters")).mapInArrow(label, SCHEMA)


def accepted(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` less those that ``predict`` would reject; columns and other rows stay as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches):
        model = shared.value
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for i, j, data, offsets in text_chunks(batch.column("text"), SMALL_CHUNK_BYTES) if model else ():
                scores[i:j] = model.probabilities(data, offsets).max(axis=1)
            yield batch.filter(pa.array(scores >= (model.threshold if model else 1.0)))

    return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))).mapInArrow(keep, docs.schema)
