"""Exact removal of repeated substrings: front-coded suffix runs, merged with common-prefix-aware loser trees."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.llm.arrays import U, give_back, mixed, text_bytes
from stocktide.llm.store import discard, kept, release

SCHEMA = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
ANCHOR = 16  # bytes of an anchor
PIECE = 1 << 19  # bytes looked at together; a longer document is cut with an overlap
POSITION = 24  # bits of a position in a piece
NULL_ID = (1 << 63) - 1  # a document without an id comes after all others


def _pieces(offsets: np.ndarray, width: int) -> Iterator[tuple[int, int, int, int]]:
    """(first document, end document, first byte, end byte): whole documents, or a part of one that overlaps the next."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + PIECE, "right")) - 1)
        a, b = int(offsets[i]), int(offsets[j])
        while b - a > PIECE:
            yield i, j, a, a + PIECE
            a += PIECE - width + 1
        yield i, j, a, b
        i = j


def super_windows(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Every ``width``-byte string (window) of every document, gathered by its anchor.

    A window's anchor is the leftmost ``ANCHOR``-byte string of least hash in it, so equal windows have equal anchors at
    equal places. Neighbouring windows of one anchor form a super-window. Returns for each: document, first byte of the
    first window, number of windows, anchor's place after that byte, anchor's hash.
    """
    out = []
    span = width - ANCHOR + 1
    for i, j, a, b in _pieces(offsets, width):
        n = b - a
        if n < width:
            continue
        padded = np.zeros(n + 8, np.uint8)
        padded[:n] = data[a:b]
        word = np.ndarray((n,), "<u8", padded, 0, (1,)).copy()
        h = word[: n - ANCHOR + 1] * U(0x9E3779B97F4A7C15)
        h = mixed((h ^ (h >> U(29))) * U(0xBF58476D1CE4E5B9) + word[8 : n - ANCHOR + 9] * U(0x94D049BB133111EB))
        least = (h & ~U((1 << POSITION) - 1)) | np.arange(len(h), dtype=U)
        step = 1
        while step * 2 <= span:
            least = np.minimum(least[: len(least) - step], least[step:])
            step *= 2
        if span > step:
            least = np.minimum(least[: len(least) - (span - step)], least[span - step :])
        anchor = (least & U((1 << POSITION) - 1)).astype(np.int64)
        bounds = np.clip(offsets[i : j + 1] - a, 0, n)
        doc = np.repeat(np.arange(j - i), np.diff(bounds))[: len(anchor)]
        whole = np.arange(len(anchor)) + width <= bounds[doc + 1]
        fresh = np.ones(len(anchor) + 1, bool)
        fresh[1:-1] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]) | (whole[1:] != whole[:-1])
        cuts = np.flatnonzero(fresh)
        first, many = cuts[:-1], np.diff(cuts)
        ok = whole[first]
        first, many = first[ok], many[ok]
        at = anchor[first]
        out.append((doc[first] + i, first + a - offsets[doc[first] + i], many, at - first, h[at]))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, U))
    return tuple(np.concatenate(c) for c in zip(*out))


# --- rows of a task's block, answered by others: (block, row, from, to) packed, with the block's documents

ANSWER = "block bigint, rows binary, a binary, b binary, dids binary, ths binary"


def _answer(block, rows=b"", a=b"", b=b"", dids=b"", ths=b""):
    return pa.table({"block": pa.array([block], pa.int64()), **{k: pa.array([v], pa.binary()) for k, v in (
        ("rows", rows), ("a", a), ("b", b), ("dids", dids), ("ths", ths))}})


def _joined(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(x for x in column.to_pylist() if x), kind)


def by_document(answers: DataFrame) -> DataFrame:
    """Answers of many tasks brought together for each block, then told by document: (did, th, a, b). A group is as large
    as the block of documents that it came from."""

    def gather(table: pa.Table) -> pa.Table:
        dids, ths = _joined(table["dids"], "<i8"), _joined(table["ths"], "<i8")
        rows, a, b = _joined(table["rows"], "<u4"), _joined(table["a"], "<u4"), _joined(table["b"], "<u4")
        order = np.lexsort((a, rows))
        rows, a, b = rows[order], a[order], b[order]
        found, starts = np.unique(rows, return_index=True)
        cuts = [*starts.tolist(), len(rows)]
        return pa.table({"did": pa.array(dids[found]), "th": pa.array(ths[found]),
                         "a": pa.array([a[x:y].tobytes() for x, y in zip(cuts, cuts[1:])], pa.binary()),
                         "b": pa.array([b[x:y].tobytes() for x, y in zip(cuts, cuts[1:])], pa.binary())})

    told = answers.groupBy("block").applyInArrow(gather, "did bigint, th bigint, a binary, b binary")
    return told.groupBy("did", "th").agg(F.max("a").alias("a"), F.max_by("b", "a").alias("b"))


def _block_ids() -> Iterator[int]:
    from pyspark import TaskContext

    base = TaskContext.get().partitionId() << 31
    while True:
        yield base
        base += 1


# --- first pass: which super-windows have an anchor that occurs in several documents

ANCHORS = f"bucket int, high binary, low binary, place binary, shape binary, marks binary, {ANSWER}"


def shared_anchors(docs: DataFrame, width: int, buckets: int) -> DataFrame:
    """(did, th, a, b): per document the super-windows (first byte; windows and anchor's place) worth sorting.

    Anchors go by hash to buckets, 48 bits of it each. One that several documents of a block have is settled there and goes
    as a mark only, so a bucket gets no anchor more than once from a block, however common it is.
    """

    def send(batches):
        blocks = _block_ids()
        for batch in batches:
            block = next(blocks)
            data, offsets = text_bytes(batch.column("text"))
            doc, first, many, place, h = super_windows(data, offsets, width)
            h = h >> U(16)
            order = np.argsort(h, kind="stable")
            doc, first, shape, h = doc[order], first[order], (many | place << 8)[order], h[order]
            starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
            dids = batch.column("did").to_numpy()
            several = (np.minimum.reduceat(dids[doc], starts) != np.maximum.reduceat(dids[doc], starts)) if len(h) else np.zeros(0, bool)
            settled = np.repeat(several, np.diff(np.append(starts, len(h))))
            marks, ready, sent = h[starts[several]], np.flatnonzero(settled), np.flatnonzero(~settled)
            of_mark, of_sent = (marks % U(buckets)).astype(np.int64), (h[sent] % U(buckets)).astype(np.int64)
            by_mark, by_sent = np.argsort(of_mark, kind="stable"), np.argsort(of_sent, kind="stable")
            mark_cuts = np.searchsorted(of_mark[by_mark], np.arange(buckets + 1))
            sent_cuts = np.searchsorted(of_sent[by_sent], np.arange(buckets + 1))
            columns: dict[str, list] = {k: [] for k in ("bucket", "high", "low", "place", "shape", "marks", "block", "rows", "a", "b", "dids", "ths")}
            home = block % buckets
            for k in range(buckets):
                s, m = sent[by_sent[sent_cuts[k] : sent_cuts[k + 1]]], marks[by_mark[mark_cuts[k] : mark_cuts[k + 1]]]
                r = ready[k::buckets]
                if not (len(s) or len(m) or len(r) or k == home):
                    continue
                for name, value in (
                        ("bucket", k), ("high", (h[s] >> U(16)).astype("<u4").tobytes()), ("low", (h[s] & U(0xFFFF)).astype("<u2").tobytes()),
                        ("place", np.stack([doc[s], first[s]], axis=1).astype("<u4").tobytes()), ("shape", shape[s].astype("<u2").tobytes()),
                        ("marks", m.astype("<u8").tobytes()), ("block", block), ("rows", doc[r].astype("<u4").tobytes()),
                        ("a", first[r].astype("<u4").tobytes()), ("b", shape[r].astype("<u4").tobytes()),
                        ("dids", dids.astype("<i8").tobytes() if k == home else b""),
                        ("ths", batch.column("th").to_numpy().astype("<i8").tobytes() if k == home else b"")):
                    columns[name].append(value)
            kinds = {"bucket": pa.int32(), "block": pa.int64()}
            yield pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k, pa.binary())) for k, v in columns.items()], list(columns))
            columns.clear()
            give_back()

    def answer(table: pa.Table) -> pa.Table:
        h = (_joined(table["high"], "<u4").astype(U) << U(16)) | _joined(table["low"], "<u2").astype(U)
        counts = [len(x) // 4 for x in table["high"].to_pylist()]
        source = np.repeat(np.arange(len(counts)), counts)
        # within a block an anchor that is sent belongs to one document: several sources are several documents
        order = np.argsort(h, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]])) if len(h) else np.zeros(0, np.int64)
        shared = np.zeros(len(h), bool)
        if len(h):
            own = source[order]
            several = np.minimum.reduceat(own, starts) != np.maximum.reduceat(own, starts)
            marked = np.unique(_joined(table["marks"], "<u8"))
            several |= np.isin(h[order][starts], marked)
            shared[order] = np.repeat(several, np.diff(np.append(starts, len(h))))
        place, shape = _joined(table["place"], "<u4").reshape(-1, 2), _joined(table["shape"], "<u2").astype("<u4")
        cuts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        out = []
        for k, block in enumerate(table["block"].to_pylist()):
            at = np.flatnonzero(shared[cuts[k] : cuts[k + 1]]) + cuts[k]
            row = {c: table[c][k].as_py() for c in ("rows", "a", "b", "dids", "ths")}
            out.append(_answer(block, row["rows"] + place[at, 0].tobytes(), row["a"] + place[at, 1].tobytes(),
                               row["b"] + shape[at].tobytes(), row["dids"], row["ths"]))
        return pa.concat_tables(out)

    return by_document(docs.mapInArrow(send, ANCHORS).groupBy("bucket").applyInArrow(answer, ANSWER))


# --- second pass: sorted runs of the super-windows that may repeat

RUNS = f"bucket int, lcps binary, sizes binary, rests binary, offs binary, least binary, refs binary, {ANSWER}"


def _prefixes(sorted_rows: np.ndarray) -> np.ndarray:
    """Common prefix of each row with the one before."""
    out = np.zeros(len(sorted_rows), np.int64)
    if len(sorted_rows) > 1:
        same = sorted_rows[1:] == sorted_rows[:-1]
        out[1:] = np.where(same.all(axis=1), sorted_rows.shape[1], same.argmin(axis=1))
    return out


def sorted_runs(found: DataFrame, width: int, buckets: int) -> DataFrame:
    """Super-windows as strings - from the anchor on, then what lies before it backwards - in sorted, front-coded runs.

    Of equal ones in a block, those of larger ids are settled at once: the smallest id has every window of theirs. Only the
    smallest id's go on, so a run holds no string twice. ``refs``: row and first byte of each.
    """
    longest = 2 * width - ANCHOR  # width after the anchor's start and width - ANCHOR before it

    def run(batches):
        blocks, pack = _block_ids(), zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            block = next(blocks)
            data, offsets = text_bytes(batch.column("text"))
            dids = batch.column("did").to_numpy().astype("<i8")
            sizes = [len(x) // 4 for x in batch.column("a").to_pylist()]
            doc = np.repeat(np.arange(len(sizes)), sizes)
            first, shape = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").astype(np.int64) for c in "ab")
            many, off = shape & 255, shape >> 8
            at = offsets[doc] + first + off
            after = many - 1 + width - off  # bytes from the anchor on
            total = after + off
            columns = np.arange(longest)
            strings = np.zeros((len(doc), longest), np.uint8)
            for i in range(0, len(doc), 1 << 14):
                j = min(i + (1 << 14), len(doc))
                x, y = at[i:j, None], after[i:j, None]
                place = np.where(columns < y, x + columns, x - 1 - (columns - y))
                live = columns < total[i:j, None]
                strings[i:j] = np.where(live, data[np.where(live, place, 0)], 0) if len(data) else 0
            heads = np.ascontiguousarray(strings[:, :ANCHOR]).view("<u8") if len(doc) else np.zeros((0, 2), "<u8")
            bucket = (mixed(heads[:, 0] * U(0x9E3779B97F4A7C15) ^ mixed(heads[:, 1])) % U(buckets)).astype(np.int64)
            order = np.argsort(strings.view(f"S{longest}").ravel(), kind="stable") if len(doc) else np.zeros(0, np.int64)
            order = order[np.argsort(bucket[order], kind="stable")]
            s, b, o, t, d = strings[order], bucket[order], off[order], total[order], dids[doc[order]]
            new = np.ones(len(order), bool)
            if len(order):
                new[1:] = (s[1:] != s[:-1]).any(axis=1) | (o[1:] != o[:-1]) | (t[1:] != t[:-1]) | (b[1:] != b[:-1])
            heads = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            least = np.minimum.reduceat(d, heads) if len(heads) else d
            later = d > least[group] if len(heads) else np.zeros(0, bool)
            row, begin = doc[order].astype("<u4"), first[order].astype("<u4")
            end = (first + total)[order].astype("<u4")
            lcps = _prefixes(s[heads])
            stay = np.flatnonzero(~later)
            counts = np.bincount(group[stay], minlength=len(heads))
            cuts = np.searchsorted(b[heads], np.arange(buckets + 1))
            ref_cuts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
            gone = np.flatnonzero(later)
            out = []
            home = block % buckets
            for k in range(buckets):
                x, y = int(cuts[k]), int(cuts[k + 1])
                g = gone if k == home else gone[:0]
                if x == y and k != home:
                    continue
                h, r = heads[x:y], stay[ref_cuts[x] : ref_cuts[y]]
                l = lcps[x:y].copy()
                l[:1] = 0
                l = np.minimum(l, t[h])
                keep = (columns >= l[:, None]) & (columns < t[h][:, None])
                answer = _answer(block, row[g].tobytes(), begin[g].tobytes(), end[g].tobytes(), dids.tobytes() if k == home else b"",
                                 batch.column("th").to_numpy().astype("<i8").tobytes() if k == home else b"")
                refs = np.stack([np.repeat(np.arange(y - x), counts[x:y]).astype("<u4"), row[r], begin[r]], axis=1).astype("<u4") if y > x else np.zeros((0, 3), "<u4")
                out.append(pa.table({"bucket": pa.array([k], pa.int32()), **{n: pa.array([v], pa.binary()) for n, v in (
                    ("lcps", l.astype(np.uint8).tobytes()), ("sizes", t[h].astype(np.uint8).tobytes()), ("rests", pack(s[h][keep].tobytes())),
                    ("offs", o[h].astype(np.uint8).tobytes()), ("least", pack(least[x:y].astype("<i8").tobytes())), ("refs", pack(refs.T.tobytes())))}}
                    | {c: answer[c] for c in answer.column_names}))
            yield from pa.concat_tables(out).combine_chunks().to_batches()
            out.clear()
            give_back()

    return found.mapInArrow(run, RUNS)


class LoserTree:
    """Merges sorted runs of strings, each given with the prefix it shares with the one before it in its run.

    Every waiting string carries the length of the prefix that it shares with the last one given out. Of two, the longer
    shared prefix is the smaller string; only where both are equal are bytes compared, from there on.
    """

    def __init__(self, runs: list[Iterator[tuple[int, bytes, int]]]):
        self.runs = runs
        self.size = 1 << max(0, (len(runs) - 1).bit_length())
        self.heads: list = [next(r, None) for r in runs] + [None] * (self.size - len(runs))
        self.shared = [0] * self.size
        self.losers = [0] * self.size
        winners = list(range(self.size))
        level = self.size
        while level > 1:
            level >>= 1
            pairs = []
            for i in range(level):
                a, b = winners[2 * i], winners[2 * i + 1]
                won, lost = self._play(a, b)
                self.losers[level + i] = lost
                pairs.append(won)
            winners = pairs
        self.winner = winners[0]

    def _play(self, a: int, b: int) -> tuple[int, int]:
        x, y = self.heads[a], self.heads[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        p, q = self.shared[a], self.shared[b]
        if p != q:
            return (a, b) if p > q else (b, a)
        s, t = x[1], y[1]
        n = min(len(s), len(t))
        while p < n and s[p] == t[p]:
            p += 1
        if p == len(s) if p == n else s[p] < t[p]:
            self.shared[b] = p
            return a, b
        self.shared[a] = p
        return b, a

    def __iter__(self) -> Iterator[tuple[int, bytes, int, int]]:
        """(prefix shared with the string before, string, run, its place in the run) in order."""
        heads, shared, losers, runs = self.heads, self.shared, self.losers, self.runs
        while (head := heads[self.winner]) is not None:
            w = self.winner
            yield shared[w], head[1], w, head[2]
            heads[w] = after = next(runs[w], None)
            if after is not None:
                shared[w] = after[0]
            i = (self.size + w) >> 1
            while i:
                rival = losers[i]
                y = heads[rival]
                if y is not None:
                    if heads[w] is None:
                        losers[i], w = w, rival
                    else:
                        p, q = shared[w], shared[rival]
                        if p < q:
                            losers[i], w = w, rival
                        elif p == q:
                            won, lost = self._play(w, rival)
                            losers[i], w = lost, won
                i >>= 1
            self.winner = w


def _decoded(lcps: bytes, sizes: bytes, rests: bytes) -> Iterator[tuple[int, bytes, int]]:
    """Strings of a front-coded run."""
    at, last = 0, b""
    for i, (p, n) in enumerate(zip(lcps, sizes)):
        last = last[:p] + rests[at : at + n - p]
        at += n - p
        yield p, last, i


def _repeats(strings: np.ndarray, sizes: np.ndarray, offs: np.ndarray, least: np.ndarray, group: np.ndarray, width: int):
    """Of each window of each string: the smallest id that has it. Flat, with where each string's windows begin."""
    n, longest = strings.shape
    many = sizes - width + 1
    ends = np.concatenate([[0], np.cumsum(many)])
    of = np.repeat(np.arange(n), many)
    columns = np.arange(longest)
    # back to text order: what lies before the anchor comes first
    place = np.where(columns < offs[:, None], sizes[:, None] - 1 - columns, columns - offs[:, None])
    text = np.zeros((n, longest + 8), np.uint8)
    text[:, :longest] = np.where(columns < sizes[:, None], np.take_along_axis(strings, np.clip(place, 0, longest - 1), axis=1), 0)
    at = of * (longest + 8) + np.arange(ends[-1]) - np.repeat(ends[:-1], many)
    word = np.ndarray((text.size - 7,), "<u8", text, 0, (1,))
    h = group[of].astype(U) * U(0xD6E8FEB86659FD93)
    for k in [*range(0, width - 7, 8), width - 8] if width >= 8 else []:
        h = mixed(h ^ word[at + k])
    order = np.argsort(h, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]]))
    smallest = np.empty(len(h), np.int64)
    smallest[order] = np.repeat(np.minimum.reduceat(least[of][order], starts), np.diff(np.append(starts, len(h))))
    return smallest, ends


FLUSH = 20_000  # strings whose windows are compared together, in whole groups of one anchor


def merged(runs: DataFrame, width: int) -> DataFrame:
    """Repeated windows over all runs of a bucket, told to the blocks they came from."""
    longest = 2 * width - ANCHOR

    def merge(table: pa.Table) -> pa.Table:
        rows = table.num_rows
        offs = [x.as_py() for x in table["offs"]]
        unpack = zstandard.ZstdDecompressor().decompress
        least = [np.frombuffer(unpack(x.as_py()), "<i8") for x in table["least"]]
        refs = [np.frombuffer(unpack(x.as_py()), "<u4").reshape(3, -1).T for x in table["refs"]]
        ref_cuts = [np.searchsorted(r[:, 0], np.arange(len(o) + 1)) for r, o in zip(refs, offs)]
        tree = LoserTree([_decoded(table["lcps"][k].as_py(), table["sizes"][k].as_py(), unpack(table["rests"][k].as_py())) for k in range(rows)])
        told: list[list[np.ndarray]] = [[] for _ in range(rows)]
        strings, shapes, groups, members = [], [], [], []  # distinct strings since the last flush; (run, place, string) of each
        group = -1

        def flush() -> None:
            if not strings:
                return
            sizes = np.array([len(s) for s in strings])
            own = np.array([least[r][i] for r, i, _ in members], np.int64)
            of = np.array([k for _, _, k in members])
            smallest_of = np.full(len(strings), NULL_ID, np.int64)
            np.minimum.at(smallest_of, of, own)
            matrix = np.frombuffer(b"".join(s.ljust(longest, b"\0") for s in strings), np.uint8).reshape(-1, longest)
            smallest, ends = _repeats(matrix, sizes, np.array(shapes), smallest_of, np.array(groups), width)
            lowest = np.minimum.reduceat(smallest, ends[:-1])
            for k in np.flatnonzero(own > lowest[of]).tolist():
                r, i, c = members[k]
                repeated = smallest[ends[c] : ends[c + 1]] < own[k]
                edges = np.flatnonzero(np.diff(np.concatenate([[0], repeated.view(np.int8), [0]])))
                for _, row, first in refs[r][ref_cuts[r][i] : ref_cuts[r][i + 1]].tolist():
                    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
                        told[r].append((row, first + a, first + b - 1 + width))
            strings.clear(), shapes.clear(), groups.clear(), members.clear()

        for shared, string, r, i in tree:
            off = offs[r][i]
            if shared < ANCHOR:
                if len(strings) >= FLUSH:
                    flush()
                group += 1
                begin = len(strings)
            if not (len(strings) > begin and shared == len(string) == len(strings[-1]) and off == shapes[-1]):
                strings.append(string)
                shapes.append(off)
                groups.append(group)
            members.append((r, i, len(strings) - 1))
        flush()
        out = []
        for r in range(rows):
            row = {c: table[c][r].as_py() for c in ("block", "rows", "a", "b", "dids", "ths")}
            t = np.array(told[r], "<u4").reshape(-1, 3)
            out.append(_answer(row["block"], row["rows"] + t[:, 0].tobytes(), row["a"] + t[:, 1].tobytes(), row["b"] + t[:, 2].tobytes(),
                               row["dids"], row["ths"]))
        return pa.concat_tables(out)

    return runs.groupBy("bucket").applyInArrow(merge, ANSWER)


def union_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by the intervals [a, b); touching intervals are one run."""
    if not len(a):
        return a, b
    order = np.argsort(a, kind="stable")
    a, reach = a[order], np.maximum.accumulate(b[order])
    fresh = np.concatenate([[True], a[1:] > reach[:-1]])
    starts = np.flatnonzero(fresh)
    return a[starts], reach[np.append(starts[1:], len(a)) - 1]


def repeated_spans(docs: DataFrame, width: int = 50) -> DataFrame:
    """(did, th, a, b): first and end bytes of what is repeated in documents of smaller ids, for documents that have any.

    ``docs``: (did, th, text). Blocks and buckets follow the number of input partitions, so tasks keep their size as data
    grow. Anchors and spans are written to the shared folder; what lies before them is let go.
    """
    buckets = max(8, 3 * docs.rdd.getNumPartitions())
    shared = kept(shared_anchors(docs, width, buckets), "anchors")
    release(docs.sparkSession)
    found = docs.join(shared, ["did", "th"]).select("did", "th", "text", "a", "b")
    spans = kept(by_document(merged(sorted_runs(found, width, buckets), width)), "spans")
    del found
    discard(shared)
    release(docs.sparkSession)
    return spans


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_ID)).alias("did"), F.xxhash64("text").alias("th"), "text", *more)


def _cut(text: bytes, a: bytes | None, b: bytes | None) -> tuple[bytes, int, int]:
    """What is left, the bytes removed, and in how many runs."""
    if not a:
        return text, 0, 0
    begins, ends = union_of(np.frombuffer(a, "<u4").astype(np.int64), np.frombuffer(b, "<u4").astype(np.int64))
    parts, at = [], 0
    for x, y in zip(begins.tolist(), ends.tolist()):
        parts.append(text[at:x])
        at = y
    parts.append(text[at:])
    return b"".join(parts), int((ends - begins).sum()), len(begins)


def remove_repeats(docs: DataFrame, width: int = 50) -> DataFrame:
    """Every byte removed that lies in a ``width``-byte string which also starts in a document of smaller id.

    All strings are judged on the input. Windows are gathered by anchors (``super_windows``); anchors that one document
    alone has are set aside by an exact exchange of hashes; what is left is sorted in front-coded runs, merged by loser
    trees, and windows of one anchor are compared. 48-bit hashes only ever let too much through to the sort; windows are
    told apart by 64 bits within an anchor.

    One row per row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256. Null text is empty. Rows of one
    id never remove from each other; a null id is larger than any other. Other columns aren't read; an empty table gives an
    empty result.
    """
    rows = keyed(docs)
    spans = repeated_spans(rows, width)

    def digest(batches):
        for batch in batches:
            out: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
            data, offsets = text_bytes(batch.column("text"))
            for k, (a, b) in enumerate(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())):
                text = data[offsets[k] : offsets[k + 1]].tobytes()
                left, removed, runs = _cut(text, a, b)
                for name, value in zip(out, (len(text), removed, runs, hashlib.sha256(left).hexdigest())):
                    out[name].append(value)
            ids = batch.column("did").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, mask=ids == NULL_ID), *(pa.array(v, pa.string() if k == "kept_sha256" else pa.int64()) for k, v in out.items())],
                ["doc_id", *out])

    return rows.join(spans, ["did", "th"], "left").select("did", "text", "a", "b").mapInArrow(digest, SCHEMA)


def without_repeats(docs: DataFrame, width: int = 50) -> DataFrame:
    """``docs`` with its own columns, ``text`` less the repeated bytes (a character that is cut in two goes as a whole) and
    ``n_chars``, if there is one, counted anew. Null texts stay null."""
    names = docs.columns
    rows = docs.withColumns({"__did": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_ID)), "__th": F.xxhash64("text")})
    spans = repeated_spans(keyed(docs), width).withColumnsRenamed({"did": "__did", "th": "__th", "a": "__a", "b": "__b"})

    @F.pandas_udf("string")
    def cut(text: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else _cut(t.encode(), x, y)[0].decode("utf-8", "ignore") for t, x, y in zip(text, a, b)], dtype=object)

    joined = rows.join(spans, ["__did", "__th"], "left")
    text = F.when(F.col("__a").isNotNull(), cut("text", "__a", "__b")).otherwise(F.col("text"))
    out = joined.withColumn("text", text)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(F.col("__a").isNotNull(), F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*names)
