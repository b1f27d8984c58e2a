"""Byte-level BPE: each pre-token is merged through a queue of ranks held in a hierarchical bitmap."""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stocktide.llm.arrays import PieceCache, text_chunks

SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


class RankQueue:
    """Positions by merge rank. Three levels of 64-bit words say which ranks have positions, so the lowest rank is three
    find-first-set steps away. A bucket gives its positions from left to right; entries that later merges made stale stay
    and are skipped by the reader."""

    def __init__(self, ranks: int):
        words = (ranks >> 6) + 1
        self.low, self.middle, self.high = [0] * words, [0] * ((words >> 6) + 1), 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            heappush(bucket, position)
            return
        self.buckets[rank] = [position]
        word = rank >> 6
        self.low[word] |= 1 << (rank & 63)
        self.middle[word >> 6] |= 1 << (word & 63)
        self.high |= 1 << (word >> 6)

    def pop(self) -> tuple[int, int] | None:
        """The leftmost position of the lowest rank."""
        if not self.high:
            return None
        group = (self.high & -self.high).bit_length() - 1
        bits = self.middle[group]
        word = (group << 6) | ((bits & -bits).bit_length() - 1)
        bits = self.low[word]
        rank = (word << 6) | ((bits & -bits).bit_length() - 1)
        bucket = self.buckets[rank]
        position = heappop(bucket)
        if not bucket:
            del self.buckets[rank]
            self.low[word] &= ~(1 << (rank & 63))
            if not self.low[word]:
                self.middle[word >> 6] &= ~(1 << (word & 63))
                if not self.middle[word >> 6]:
                    self.high &= ~(1 << (word >> 6))
        return rank, position


class Bpe:
    """Encoder and decoder over a table of ranks; a rank is the id of its token, too."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.queue = RankQueue(max(ranks.values(), default=0) + 1)

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one pre-token. O(n log n) for n bytes: every merge adds at most two entries."""
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        n, queue = len(piece), self.queue
        ends = list(range(1, n + 1))  # where the part that begins here ends; 0 once it was merged away
        before = list(range(-1, n - 1))
        for i in range(n - 1):
            r = ranks.get(piece[i : i + 2])
            if r is not None:
                queue.push(r, i)
        while (best := queue.pop()) is not None:
            rank, i = best
            j = ends[i]
            if not j or j == n:
                continue
            end = ends[j]
            if ranks.get(piece[i:end]) != rank:
                continue
            ends[i], ends[j] = end, 0
            if end < n:
                before[end] = i
                r = ranks.get(piece[i : ends[end]])
                if r is not None:
                    queue.push(r, i)
            p = before[i]
            if p >= 0:
                r = ranks.get(piece[p:end])
                if r is not None:
                    queue.push(r, p)
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : ends[i]]])
            i = ends[i]
        return out

    def encode_pieces(self, pieces: list[str]) -> list[list[int]]:
        return [self.encode_piece(p.encode("utf-8")) for p in pieces]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


@lru_cache(maxsize=2)
def codec(path: str) -> tuple[Bpe, PieceCache]:
    """One per Python worker, kept over its tasks."""
    bpe = Bpe(read_ranks(path))
    return bpe, PieceCache(bpe.encode_pieces, 1_000_000)  # a merge in Python costs more than the memory of its result


def encode_documents(docs: DataFrame, ranks_path: str) -> DataFrame:
    """Token count and digests of the encoded and of the decoded text of every document.

    The rank file is read on each worker, where ``ranks_path`` must exist. The text is cut by the public pattern over the
    whole document, each distinct pre-token of a block is merged once, and the ids are decoded again from the vocabulary.
    Memory is a few times the longest document plus a cache of bounded size. No shuffle.

    Null or empty text: no tokens, digests of nothing. Repeated rows and null ids give a row each; other columns are not
    read. An empty table gives an empty result.
    """

    def encode(batches):
        bpe, cache = codec(ranks_path)
        digits = np.array([str(i) for i in range(max(bpe.tokens) + 1)], dtype=object)
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for _, _, data, offsets in text_chunks(batch.column("text")):
                ids, bounds = cache.ids(data, offsets)
                shown, bounds = digits[ids], bounds.tolist()
                for a, b in zip(bounds, bounds[1:]):
                    counts.append(b - a)
                    ids_sha.append(hashlib.sha256(",".join(shown[a:b].tolist()).encode()).hexdigest())
                    text_sha.append(hashlib.sha256(bpe.decode(ids[a:b].tolist())).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(encode, SCHEMA)
