"""Packing documents into fixed windows whose tokens come from the sources in target proportions."""

from __future__ import annotations

import os
import zlib
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stocktide.llm.arrays import PieceCache, end_to_end, text_chunks
from stocktide.llm.store import kept

ENCODED = "part int, lane int, at bigint, doc_id bigint, n bigint, ids binary"
CHUNK_BYTES = 3 << 20  # a larger block has fewer different pre-tokens for its size
NARROW, WIDE = "<u2", "<u4"  # of stored ids, by the size of the vocabulary
SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
          "offset bigint, source string")


def width_of(tokenizer, end_id: int) -> str:
    return NARROW if max(tokenizer.get_vocab_size() - 1, end_id) < 1 << 16 else WIDE


@lru_cache(maxsize=2)
def cache_of(path: str) -> tuple:
    """One per Python worker: pre-tokens it has met, with the ids that the tokenizer gives for each."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True

    return tokenizer, PieceCache(piece_encoder(tokenizer))


def byte_lengths(tokenizer) -> np.ndarray:
    """Bytes of every id in a byte-level vocabulary, where each sign of a token stands for one byte."""
    out = np.zeros(max(tokenizer.get_vocab().values(), default=-1) + 1, np.int64)
    for token, i in tokenizer.get_vocab().items():
        out[i] = len(token)
    return out


def piece_encoder(tokenizer):
    """Encodes pre-tokens as the words of one sequence, which costs no object a piece. Their bytes say where each ends; where
    the bytes of the ids don't meet those ends, each piece is encoded by itself."""
    lengths = byte_lengths(tokenizer)

    def encode(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not pieces:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        (found,) = tokenizer.encode_batch_fast([pieces], is_pretokenized=True, add_special_tokens=False)
        ids = np.array(found.ids, np.uint32)
        reached = np.cumsum(lengths[ids])
        wanted = np.cumsum(np.fromiter((len(p.encode()) for p in pieces), np.int64, len(pieces)))
        ends = np.searchsorted(reached, wanted) + 1
        if len(ids) and ends[-1] == len(ids) and np.array_equal(reached[ends - 1], wanted):
            return ids, ends
        return end_to_end([e.ids for e in tokenizer.encode_batch_fast(pieces, add_special_tokens=False)])

    return encode


class Rounds:
    """What each queue has given after ``x`` tokens: deficit round-robin in closed form.

    In each round (a window) a queue is credited its share of the window, pays for the tokens it gives and carries the rest,
    its deficit, into the next. Shares are taken queue by queue from what the earlier ones left, rounded down, so every
    window is full, no queue ever gives a negative number and a deficit stays below one token per queue before it. The
    state at any window follows from ``x`` alone: deficits carry over windows and partitions without one task that walks
    them all. Where targets differ from the amounts in the queues, a queue runs dry; the rest share what comes after in
    the same proportions (a new phase).
    """

    def __init__(self, totals: list[int], targets: list[float] | None = None):
        self.totals = totals
        left = list(totals)
        self.phases: list[tuple[int, list[int], list[int]]] = []  # tokens and queue states at its start, amounts in it
        at, given = 0, [0] * len(totals)
        while any(left):
            live = [i for i, n in enumerate(left) if n]
            weight = {i: n for i, n in enumerate(totals)} if targets is None else dict(enumerate(targets))
            if targets is None or not any(weight[i] > 0 for i in live):
                amounts = list(left)
            else:
                first = min((i for i in live if weight[i] > 0), key=lambda i: left[i] / weight[i])
                time = left[first] / weight[first]
                amounts = [min(left[i], max(0, round(weight[i] * time))) for i in range(len(left))]
                amounts[first] = left[first]
            self.phases.append((at, list(given), amounts))
            at += sum(amounts)
            given = [g + a for g, a in zip(given, amounts)]
            left = [n - a for n, a in zip(left, amounts)]
        self.total = at
        self.known: dict[int, list[int]] = {}
        self.sums: dict[int, list[int]] = {}

    def given(self, x: int) -> list[int]:
        """Tokens each queue has given after ``x`` in all."""
        out = self.known.get(x)
        if out is None:
            start, before, amounts = next(p for p in reversed(self.phases) if p[0] <= x)
            out, open_, pool = [], min(x, self.total) - start, sum(amounts)
            for g, a in zip(before, amounts):
                took = open_ * a // pool if pool else 0
                out.append(g + took)
                open_, pool = open_ - took, pool - a
            if len(self.known) > 20_000:
                self.known.clear()
            self.known[x] = out
        return out

    def ahead(self, x: int) -> list[int]:
        """Of the first ``x`` tokens, how many the queues before each one have given."""
        out = self.sums.get(x)
        if out is None:
            out = [0, *accumulate(self.given(x))]
            if len(self.sums) > 20_000:
                self.sums.clear()
            self.sums[x] = out
        return out

    def window_of(self, lane: int, position: int, width: int) -> int:
        """The window that holds a queue's token."""
        low, high = 0, -(-self.total // width)
        guess = min(high - 1, position * self.total // max(1, self.totals[lane]) // width) if len(self.phases) == 1 else None
        if guess is not None:
            low, high = max(0, guess - 2), min(high, guess + 3)
            if self.given(low * width)[lane] > position:
                low = 0
            if self.given(high * width)[lane] <= position:
                high = -(-self.total // width)
        while high - low > 1:
            middle = (low + high) // 2
            if self.given(middle * width)[lane] <= position:
                low = middle
            else:
                high = middle
        return low


def encode_parts(docs: DataFrame, tokenizer_path: str, end_id: int, lanes: dict[str | None, int]) -> DataFrame:
    """Each document's ids once, with its place among the same task's documents of its queue."""

    def encode(batches):
        from pyspark import TaskContext

        part, reached = TaskContext.get().partitionId(), {}
        tokenizer, cache = cache_of(tokenizer_path)
        kind = width_of(tokenizer, end_id)
        other = max(lanes.values(), default=-1) + 1
        for batch in batches:
            sources, ids_of = batch.column("source").to_pylist(), batch.column("doc_id")
            for i, j, data, offsets in text_chunks(batch.column("text"), CHUNK_BYTES):
                ids, bounds = cache.ids(data, offsets)
                ids = np.insert(ids, bounds[1:], end_id).astype(kind)
                bounds = bounds + np.arange(len(bounds))
                lane = [lanes.get(s, other) for s in sources[i:j]]
                at = []
                for k, n in zip(lane, np.diff(bounds).tolist()):
                    at.append(reached.get(k, 0))
                    reached[k] = at[-1] + n
                blobs = [ids[a:b].tobytes() for a, b in zip(bounds.tolist(), bounds[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * (j - i), pa.int32()), pa.array(lane, pa.int32()), pa.array(at, pa.int64()),
                     ids_of.slice(i, j - i), pa.array(np.diff(bounds), pa.int64()), pa.array(blobs, pa.binary())],
                    ["part", "lane", "at", "doc_id", "n", "ids"])

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "text", "cast(source as string) source").mapInArrow(encode, ENCODED)


def pack(docs: DataFrame, tokenizer_path: str, width: int = 2048, end_id: int = 1, targets: dict[str | None, float] | None = None,
         max_queues: int = 256) -> DataFrame:
    """Pieces of documents, placed without gaps in sequences of ``width`` tokens.

    There is one queue per source; its share of every window is its share of all tokens, or ``targets[source]`` (sources
    left out: 0, they follow once the others ran dry). Beyond ``max_queues`` sources, those of fewest documents share one
    more queue: this bounds what each task must know, and drops nothing. Only the last sequence is shorter than ``width``.

    The text is encoded once, into a table in the shared folder; sums per task and queue (a small table) turn places within
    a task into places within the queue; each task then cuts its documents by itself. No shuffle of text or ids.

    Null text: the end id alone. Null source: a queue like any other. Repeated rows are packed each. Extra columns are not
    read. An empty table gives an empty result.
    """
    sources = docs.groupBy(F.col("source").cast("string").alias("source")).count().orderBy(F.desc("count"), "source").limit(max_queues).collect()
    names = sorted((r["source"] for r in sources), key=lambda s: (s is None, s or ""))
    lanes = {s: i for i, s in enumerate(names)}
    stored = kept(encode_parts(docs, tokenizer_path, end_id, lanes), "encoded")
    sums = stored.groupBy("part", "lane").agg(F.sum("n").alias("n"))
    totals = [0] * (len(lanes) + 1)
    for row in sums.groupBy("lane").agg(F.sum("n").alias("n")).collect():
        totals[row["lane"]] = row["n"]
    shares = None if targets is None else [float(targets.get(s, 0)) for s in names] + [0.0]
    ahead = Window.partitionBy("lane").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("part", "lane", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))

    queue = [*names, None]

    def cut(batches):
        rounds = Rounds(totals, shares)
        kind = width_of(cache_of(tokenizer_path)[0], end_id)
        for batch in batches:
            out: dict[str, list] = {name: [] for name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source")}
            columns = [batch.column(c).to_pylist() for c in ("lane", "at", "base", "doc_id", "n")]
            for lane, at, base, doc_id, n, ids in zip(*columns, batch.column("ids")):
                view, first, start = np.frombuffer(ids.as_buffer(), kind).astype(WIDE), base + at, 0
                window = rounds.window_of(lane, first, width)
                while start < n:
                    before, after = rounds.given(window * width), rounds.given((window + 1) * width)
                    length = min(n - start, after[lane] - first - start)
                    if length > 0:
                        offset = rounds.ahead((window + 1) * width)[lane] - rounds.ahead(window * width)[lane] + first + start - before[lane]
                        for name, value in zip(out, (doc_id, start, length, zlib.crc32(view[start : start + length]), n, window, offset, queue[lane])):
                            out[name].append(value)
                        start += length
                    window += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, pa.string() if k == "source" else pa.int64()) for k, v in out.items()], list(out))

    placed = stored.join(kept(bases, "bases"), ["part", "lane"]).select("lane", "at", "base", "doc_id", "n", "ids")
    return placed.mapInArrow(cut, SCHEMA)
