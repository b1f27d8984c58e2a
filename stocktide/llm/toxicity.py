"""Toxicity: a linear sentence classifier with a counterfactual penalty on identity terms."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.llm.arrays import SMALL_CHUNK_BYTES, U, run_hashes, text_chunks
from stocktide.llm.labelled import fold, sample
from stocktide.llm.langid import FOLDED

SCHEMA = "doc_id bigint, held_out boolean, score double, predicted int"
PREFIXES = (4, 6)  # bytes of a word that make features beside the whole word
RARE, EVIDENCE = 4, 16.0
SENTENCE_WORDS = 40  # a longer sentence is cut, so that the score of a text without full stops means the same

#: Neutral names of groups. Terms of one line may replace one another in a labelled sentence without changing its label.
IDENTITY_TERMS = [
    ["women", "men", "girls", "boys", "woman", "man", "girl", "boy"],
    ["christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "christians", "muslims", "jews", "hindus"],
    ["black", "white", "asian", "african", "european", "latino", "arab", "indian", "mexican", "chinese"],
    ["gay", "straight", "lesbian", "bisexual", "transgender", "heterosexual", "queer"],
    ["deaf", "blind", "disabled", "elderly", "young", "old"],
    ["frauen", "männer", "muslime", "christen", "juden", "ausländer", "deutsche", "schwule", "behinderte"],
    ["femmes", "hommes", "musulmans", "chrétiens", "juifs", "étrangers", "français", "homosexuels", "handicapés"],
    ["mujeres", "hombres", "musulmanes", "cristianos", "judíos", "extranjeros", "españoles", "homosexuales", "discapacitados"],
]
ENDS = np.zeros(256, bool)
ENDS[[ord(c) for c in ".!?\n"]] = True


def sentences(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of every word's features (one row a word), where sentences begin among the words, and those of each text
    among the sentences."""
    signs = FOLDED[data]
    live = signs != 32
    first = live.copy()
    first[1:] &= ~live[:-1]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[begins] = live[begins]
    starts = np.flatnonzero(first)
    n = len(starts)
    if not n:
        return np.zeros((0, 1 + len(PREFIXES)), np.int32), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    hashes = [run_hashes(signs, starts, live)]
    lengths = np.diff(np.append(starts, len(signs)))
    at = np.arange(starts[0], len(signs)) - np.repeat(starts, lengths)
    for k in PREFIXES:
        part = live.copy()
        part[starts[0] :] &= at < k
        hashes.append(run_hashes(signs, starts, part) ^ U(k))
    buckets = np.stack([(h * U(0x9E3779B97F4A7C15)) >> U(64 - bits) for h in hashes], axis=1).astype(np.int32)
    stops = np.cumsum(ENDS[data])[starts]
    texts = np.searchsorted(offsets, starts, "right")
    fresh = np.ones(n, bool)
    fresh[1:] = (stops[1:] != stops[:-1]) | (texts[1:] != texts[:-1])
    at = np.flatnonzero(fresh)
    place = np.arange(n) - np.repeat(at, np.diff(np.append(at, n)))
    at = np.flatnonzero(place % SENTENCE_WORDS == 0)
    return buckets, at, np.searchsorted(at, np.searchsorted(starts, offsets))


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    bits: int

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Of every text: the score of its most toxic sentence; without a word, that of an empty sentence."""
        buckets, at, bounds = sentences(data, offsets, self.bits)
        worst = np.zeros(len(offsets) - 1)
        if len(at):
            each = np.add.reduceat(self.weights[buckets].sum(axis=1, dtype=np.float64), at)
            some = np.flatnonzero(np.diff(bounds))
            worst[some] = np.maximum.reduceat(each, bounds[some])
        return 1 / (1 + np.exp(-np.clip(worst + self.bias, -30, 30)))


def fit(texts: list[str], labels: list[int], bits: int = 21, epochs: int = 8, rate: float = 0.15, decay: float = 1e-4,
        penalty: float = 2.0, terms: list[list[str]] | None = None, seed: int = 0) -> Model:
    """Logistic regression on the most toxic sentence of each text, by stochastic gradient descent.

    Weights begin at the log-odds of those features whose share of toxic texts is beyond chance (a log-likelihood ratio),
    others at zero; features of fewer than ``RARE`` texts stay there. For each labelled text, an
    identity term in the deciding sentence is swapped for another one of its line (a sentence without one gets a term), and
    ``penalty`` times the squared change of the score is added to the loss.
    """
    rng = np.random.default_rng(seed)
    terms = IDENTITY_TERMS if terms is None else terms

    def of_terms(words):
        return sentences(*text_of(" ".join(words)), bits)[0]

    def text_of(text):
        raw = np.frombuffer(text.encode(), np.uint8)
        return raw, np.array([0, len(raw)])

    lines = [of_terms(line) for line in terms]
    place = {int(row[0]): (k, i) for k, line in enumerate(lines) for i, row in enumerate(line)}
    y = np.asarray(labels, float)
    x = [sentences(data, offsets, bits) for _, _, data, offsets in text_chunks(pa.array(texts, pa.string()), 1)]
    seen = np.zeros((2, 1 << bits), np.int32)
    for (buckets, _, _), label in zip(x, labels):
        seen[int(label), np.unique(buckets)] += 1
    n = np.array([(y == 0).sum(), (y == 1).sum()]) + 1.0
    usual = seen.sum(axis=0) >= RARE
    at = np.flatnonzero(usual)
    good, bad, share = seen[0, at], seen[1, at], n[1] / n.sum()
    observed = bad / (good + bad)
    evidence = 2 * (good + bad) * (observed * np.log(np.maximum(observed, 1e-9) / share)
                                   + (1 - observed) * np.log(np.maximum(1 - observed, 1e-9) / (1 - share)))
    odds = np.log((bad + 0.5) / n[1]) - np.log((good + 0.5) / n[0])
    w = np.zeros(1 << bits)
    w[at] = np.where((odds > 1) & (evidence > EVIDENCE), np.minimum(odds, 3), 0.0)
    del seen
    bias = -2.0
    done, steps = 0, epochs * len(x)
    for _ in range(epochs):
        for i in rng.permutation(len(x)):
            buckets, at, _ = x[i]
            step = rate * (1 - done / steps)
            done += 1
            if not len(at):
                bias -= step * (1 / (1 + np.exp(-bias)) - y[i])
                continue
            each = np.add.reduceat(w[buckets].sum(axis=1), at)
            k = int(each.argmax())
            words = buckets[at[k] : at[k + 1] if k + 1 < len(at) else len(buckets)]
            z = each[k] + bias
            g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[i]
            touched = words[usual[words]]
            np.add.at(w, touched, -step * (g / np.sqrt(len(words)) + decay * w[touched]))
            bias -= 0.1 * step * g
            if lines:
                known = [place[int(r[0])] for r in words if int(r[0]) in place]
                line, here = known[int(rng.integers(len(known)))] if known else (int(rng.integers(len(lines))), None)
                old = lines[line][here] if here is not None else None
                new = lines[line][int(rng.integers(len(lines[line])))]
                change = w[new].sum() - (w[old].sum() if old is not None else 0.0)
                pull = min(0.1, step * penalty) * change / len(new)
                w[new] -= pull
                if old is not None:
                    w[old] += pull
    return Model(w.astype(np.float32), float(bias), bits)


def train(docs: DataFrame, labels: DataFrame, most: tuple[int, int] = (4000, 2000)) -> Model | None:
    """A model from at most ``most`` clean and toxic texts of the training folds; None if there are none.

    Several labels of one document: the highest counts.
    """
    rows = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id", 5) != 0))
    rows = rows.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    found = [sample(docs, rows.where(F.col("toxic") == k), most[k]) for k in (0, 1)]
    texts, toxic = [t for f in found for t in f["text"]], [int(t) for f in found for t in f["toxic"]]
    del found
    return fit(texts, toxic) if texts else None


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """The toxicity of every whole text, as that of its most toxic sentence.

    Null and empty texts get the score of an empty sentence; without a model every score is 0. Repeated rows and null ids
    give a row each (a null id is not held out). Only the text is read for the score; other columns, whatever their names,
    are not read. No shuffle; memory is a few times the longest text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        model = shared.value
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for i, j, data, offsets in text_chunks(batch.column("text"), SMALL_CHUNK_BYTES) if model else ():
                scores[i:j] = model.scores(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text",
                       F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out")).mapInArrow(score, SCHEMA)


def without_toxic(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` less those of score 0.5 or more; columns and other rows stay as they are. Without a model all stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches):
        model = shared.value
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for i, j, data, offsets in text_chunks(batch.column("text"), SMALL_CHUNK_BYTES) if model else ():
                scores[i:j] = model.scores(data, offsets)
            yield batch.filter(pa.array(scores < 0.5))

    return docs.mapInArrow(keep, docs.schema)
