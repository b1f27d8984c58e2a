"""Exact top-k inner products over a bit-sliced index."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stocktide.llm.store import kept

HITS = "query_id bigint, score bigint, place binary, vec_id bigint"
#: Whole numbers of smaller size are indexed by slices; the few vectors with larger ones are multiplied as Python integers.
SLICED = 1 << 62
MOST = (1 << 63) - 1


def taking_part(vectors: DataFrame) -> DataFrame:
    """Rows that take part: id, components as double and their count."""
    fine = F.forall("embedding", lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    return (vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0))
            .where(F.coalesce(fine, F.lit(False)))
            .select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"), F.size("embedding").alias("dim")))


def quantised(values: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of floor(``scale`` * x), and which of them stay below ``SLICED``; the others are given as zeros."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * float(scale))
    small = (np.abs(scaled) < float(SLICED)).all(axis=1)
    return np.where(small[:, None], scaled, 0).astype(np.int64), small


def exactly(row: np.ndarray, scale: int) -> list[int]:
    """floor(``scale`` * x) of components of any size; those that are too large to have a fraction are multiplied as integers."""
    return [int(x) * scale if abs(x) >= 2.0**53 else int(np.floor(x * float(scale))) for x in row.tolist()]


def place_of(score: int) -> bytes:
    """Bytes that sort like the number."""
    size = (abs(score).bit_length() + 7) // 8
    digits = size.to_bytes(4, "big") + abs(score).to_bytes(size, "big")
    return b"\x01" + digits if score >= 0 else b"\x00" + bytes(255 - b for b in digits)


class Slices:
    """Bitmaps over rows: bit ``b`` of attribute ``d`` of every row, each value taken from the block's least one up."""

    def __init__(self, values: np.ndarray):
        self.rows, dims = values.shape
        self.base = values.min(axis=0)
        shifted = (values - self.base).astype(np.uint64)
        self.bits = max(1, int(shifted.max()).bit_length())
        words = -(-self.rows // 64)
        padded = np.zeros((words * 64, dims), np.uint64)
        padded[: self.rows] = shifted
        self.maps = np.empty((dims, self.bits, words), np.uint64)
        for b in range(self.bits):
            bit = ((padded >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)
            self.maps[:, b] = np.packbits(np.ascontiguousarray(bit.T), axis=1, bitorder="little").view(np.uint64)
        self.live = np.packbits(np.arange(words * 64) < self.rows, bitorder="little").view(np.uint64)

    def sums(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices of ``query . row`` less a constant, and the constant.

        Each set bit of a weight adds an attribute's slices at its place; of a negative weight, their complements. All
        slices of one place are added at once by full adders, three to a sum and a carry to the next place.
        """
        places: list[list[np.ndarray]] = []
        constant = int(query.astype(object) @ self.base.astype(object))
        full = (1 << self.bits) - 1
        for d, weight in enumerate(query.tolist()):
            size = abs(weight)
            slices = self.maps[d] if weight > 0 else ~self.maps[d]
            if weight < 0:
                constant -= size * full
            for k in range(size.bit_length()):
                if size >> k & 1:
                    while len(places) < k + self.bits:
                        places.append([])
                    for b in range(self.bits):
                        places[k + b].append(slices[b])
        out, k = [], 0
        carried: np.ndarray | None = None
        while k < len(places) or carried is not None:
            here = places[k] if k < len(places) else []
            stack = np.stack(here) if here else np.zeros((0, len(self.live)), np.uint64)
            if carried is not None:
                stack = np.concatenate([stack, carried])
            carries = []
            while len(stack) > 1:
                third = len(stack) // 3
                if third:
                    a, b, c = stack[:third], stack[third : 2 * third], stack[2 * third : 3 * third]
                    either = a ^ b
                    carries.append((a & b) | (either & c))
                    stack = np.concatenate([either ^ c, stack[3 * third :]])
                else:
                    carries.append((stack[:1] & stack[1:]))
                    stack = stack[:1] ^ stack[1:]
            out.append(stack[0] if len(stack) else np.zeros_like(self.live))
            carried = np.concatenate(carries) if carries else None
            k += 1
        return out, constant

    def best(self, query: np.ndarray, k: int, leave_out: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` rows of highest product, ties to the earlier row, and their products; rows in ``leave_out`` don't count.

        From the most significant slice down: rows that surely belong are set apart, rows that tie so far go on. What ties
        to the end is settled by row order.
        """
        slices, constant = self.sums(query)
        sure, tied = np.zeros_like(self.live), self.live.copy()
        if leave_out is not None:
            for row in leave_out.tolist():
                tied[row >> 6] &= ~np.uint64(1 << (row & 63))
        if not k:
            tied[:] = 0
        for s in reversed(slices):
            ahead = tied & s
            n = int(np.bitwise_count(sure | ahead).sum())
            if n > k:
                tied = ahead
            else:
                sure |= ahead
                tied &= ~s
                if n == k:
                    tied[:] = 0
                    break
        rows = np.concatenate([self._rows(sure), self._rows(tied)[: k - int(np.bitwise_count(sure).sum())]])
        score = np.full(len(rows), constant, object)
        for b, s in enumerate(slices):
            score += ((s[rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1)).astype(object) * (1 << b)
        return rows, score

    @staticmethod
    def _rows(bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def _packed(vectors: DataFrame, key: str, rows: int, count: int) -> DataFrame:
    """About ``rows`` vectors to a row: blocks of one dimension, as ids (in order) and values in two binaries."""
    blocks = max(1, -(-count // rows))

    def gather(table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        values = table.column("v").combine_chunks()
        values = values.flatten().to_numpy().reshape(len(ids), -1)[order]
        return pa.table({"dim": pa.array([values.shape[1]], pa.int32()), key: pa.array([table.column(key)[0].as_py()], pa.int32()),
                         "ids": pa.array([ids[order].astype("<i8").tobytes()], pa.binary()),
                         "values": pa.array([values.astype("<f8").tobytes()], pa.binary())})

    dealt = vectors.withColumn(key, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int"))
    return dealt.groupBy("dim", key).applyInArrow(gather, f"dim int, {key} int, ids binary, values binary")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, scale: int = 1024, block_rows: int = 1 << 14, query_rows: int = 128) -> DataFrame:
    """Of each query the ``k`` rows of highest inner product of floor(``scale`` x component), ties to the smaller id.

    ``vectors``: (vec_id, embedding). ``queries`` has rows of the same form; a query is never its own candidate (rows of
    the query's id are left out). Rows are dealt to blocks of about ``block_rows``, each a bit-sliced index, and queries to
    sets of ``query_rows``. Each set meets each block once, in a task of its own, and only ``k`` rows per query leave it.
    Nothing is broadcast and no task holds more than one block and one set.

    Vectors that are null, empty, or hold null or non-finite components take no part, nor do null ids; every other vector
    does. Products are exact at any size: components of 2^62 and more after scaling are multiplied as integers, beside the
    index. A product beyond 64 bits is ranked exactly and shown as the largest (or smallest) long. Vectors of different length aren't compared. Repeated rows each take a rank; of several vectors with a query's id the
    smallest asks. Other columns aren't read; an empty table gives an empty result.
    """
    rows = kept(taking_part(vectors), "vectors")
    asked = kept(taking_part(queries).groupBy("vec_id", "dim").agg(
        F.min_by("v", F.transform("v", lambda x: F.floor(x * float(scale)))).alias("v")), "asked")
    n, q = rows.count(), asked.count()
    blocks, sets = max(1, -(-n // block_rows)), max(1, -(-q // query_rows))
    index = _packed(rows, "block", block_rows, n).withColumn("set", F.explode(F.sequence(F.lit(0), F.lit(sets - 1))))
    asking = _packed(asked, "set", query_rows, q).withColumnsRenamed({"ids": "query_ids", "values": "query_values"})
    asking = asking.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    met = index.join(asking, ["dim", "block", "set"])

    def search(batches):
        known: tuple = (None,)
        for batch in batches:
            for dim, block, ids, values, query_ids, query_values in zip(*(batch.column(c).to_pylist() for c in (
                    "dim", "block", "ids", "values", "query_ids", "query_values"))):
                if known[0] != (dim, block):
                    own, raw = np.frombuffer(ids, "<i8"), np.frombuffer(values, "<f8").reshape(-1, dim)
                    whole, small = quantised(raw, scale)
                    large = [(int(own[r]), exactly(raw[r], scale)) for r in np.flatnonzero(~small)]
                    known = ((dim, block), own[small], Slices(whole[small]) if small.any() else None, whole[small], large)
                _, own, slices, whole, large = known
                out: tuple[list, ...] = ([], [], [], [])
                raw = np.frombuffer(query_values, "<f8").reshape(-1, dim)
                asked, small = quantised(raw, scale)
                for query_id, query, fits, given in zip(np.frombuffer(query_ids, "<i8").tolist(), asked, small.tolist(), raw):
                    best: list[tuple[int, int]] = []
                    if slices and fits:
                        same = np.arange(np.searchsorted(own, query_id), np.searchsorted(own, query_id, "right"))
                        found, scores = slices.best(query, k, same)
                        best = list(zip(scores.tolist(), own[found].tolist()))
                    exact = exactly(given, scale) if large or not fits else []
                    others = large if fits else [*large, *zip(own.tolist(), whole.tolist())]
                    best += [(sum(a * b for a, b in zip(exact, row)), i) for i, row in others if i != query_id]
                    if others:
                        best = sorted(best, key=lambda x: (-x[0], x[1]))[:k]
                    out[0].extend([query_id] * len(best))
                    out[1].extend([max(-MOST - 1, min(MOST, score)) for score, _ in best])
                    out[2].extend([place_of(score) for score, _ in best])
                    out[3].extend([i for _, i in best])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.binary() if n == 2 else pa.int64()) for n, c in enumerate(out)], ["query_id", "score", "place", "vec_id"])

    hits = met.mapInArrow(search, HITS)
    order = Window.partitionBy("query_id").orderBy(F.desc("place"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
