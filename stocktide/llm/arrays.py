"""Columns of texts as flat arrays: byte buffers, words, pre-tokens and their 64-bit hashes, without a loop per character."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

try:
    _libc = ctypes.CDLL("libc.so.6")
except OSError:  # another C library
    _libc = None

U = np.uint64
#: Odd multipliers of the polynomial and shingle hashes.
BASE = 0x9E3779B97F4A7C15
STEPS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], dtype=U)
CHUNK_BYTES = 2 << 20
#: Where each byte or word takes many bytes of arrays and nothing is gained from seeing more texts at once.
SMALL_CHUNK_BYTES = 1 << 19


def mixed(h: np.ndarray) -> np.ndarray:
    """Bits of 64-bit hashes spread evenly (splitmix finaliser)."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and where each begins and ends; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1 + column.offset)[column.offset :] if n else np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``limit`` bytes; a longer text makes a range of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = text_bytes(column)
    for i, j in chunks(offsets, limit):
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
    give_back()


def give_back() -> None:
    """Hands freed memory back to the system: a worker that waits for its next task then holds no more than its caches."""
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


@lru_cache(maxsize=4)
def _powers(n: int) -> np.ndarray:
    out = np.full(n, U(BASE))
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(n: int) -> np.ndarray:
    """At least the first ``n`` powers of the hash base, in a table that grows by doubling."""
    return _powers(max(1024, 1 << max(0, n - 1).bit_length()))


def run_hashes(values: np.ndarray, starts: np.ndarray, live: np.ndarray | None = None) -> np.ndarray:
    """A hash of each run of ``values``: runs begin at ``starts`` and end at the next; values that aren't live add nothing."""
    if not len(starts):
        return np.zeros(0, U)
    lengths = np.diff(np.append(starts, len(values)))
    at = np.arange(starts[0], len(values)) - np.repeat(starts, lengths)
    v = (values[starts[0] :].astype(U) + U(1)) * powers(int(lengths.max()))[at]
    if live is not None:
        v[~live[starts[0] :]] = 0
    return mixed(np.add.reduceat(v, starts - starts[0]))


def place_hashes(values: np.ndarray, starts: np.ndarray, live: np.ndarray) -> np.ndarray:
    """Like ``run_hashes``, as the sum of a number per (value, place) drawn by a mixing function: no word pair is constructed
    for it, and by chance two different runs of n share a hash with probability below n^2 / 2^65."""
    if not len(starts):
        return np.zeros(0, U)
    lengths = np.diff(np.append(starts, len(values)))
    at = np.arange(starts[0], len(values), dtype=np.int64) - np.repeat(starts, lengths)
    v = mixed((at.astype(U) * U(BASE)) ^ ((values[starts[0] :].astype(U) + U(1)) * STEPS[1]))
    v[~live[starts[0] :]] = 0
    return mixed(np.add.reduceat(v, starts - starts[0]))


SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(data: np.ndarray, offsets: np.ndarray, hashes=run_hashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased, and where the words of each text begin."""
    live = ~SEPARATOR[data]
    first = live.copy()
    first[1:] &= ~live[:-1]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[begins] = live[begins]
    starts = np.flatnonzero(first)
    return hashes(LOWER[data], starts, live), np.searchsorted(starts, offsets)


def shingles(words: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word shingles of each text and where those of each text begin; a text of fewer words is one shingle."""
    counts = np.diff(bounds)
    total = len(words)
    steps = np.multiply.accumulate(np.full(n, STEPS[0]))  # wraps around
    if total >= n:
        h = words[: total - n + 1] * steps[0]
        for k in range(1, n):
            h += words[k : total - n + 1 + k] * steps[k]
    else:
        h = np.zeros(0, U)
    full = np.maximum(counts - n + 1, 0)
    short = np.flatnonzero((counts > 0) & (counts < n))
    sizes = full.copy()
    sizes[short] = 1
    ends = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(sizes, out=ends[1:])
    at = np.arange(ends[-1]) + np.repeat(bounds[:-1] - ends[:-1], sizes)
    out = np.zeros(ends[-1], U)
    whole = np.ones(ends[-1], bool)
    whole[ends[short]] = False
    out[whole] = h[at[whole]]
    for i in short:
        k = counts[i]
        out[ends[i]] = (words[bounds[i] : bounds[i + 1]] * steps[:k]).sum(dtype=U) ^ U(int(k) * int(STEPS[1]) % 2**64)
    return mixed(out), ends


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Per code point: 1 letter, 2 number, 3 white space, 0 anything else."""
    import regex

    out = np.zeros(0x110000, np.uint8)
    everything = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    for k, pattern in ((1, r"\p{L}+"), (2, r"\p{N}+"), (3, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, everything):
            out[np.frombuffer(m[0].encode("utf-32-le"), np.uint32)] = k
    return out


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[str, np.ndarray, np.ndarray]:
    """The texts as one string, its code points, and where each text begins and ends in them."""
    text = data.tobytes().decode("utf-8", "replace")
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    begins = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=begins[1:])
    return text, points, begins[offsets]


def pretokens(points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where each pre-token of the public byte-level pattern begins.

    A run of letters, of numbers or of other signs takes one plain space before it; white space before anything leaves its
    last sign to stand alone (or to join what follows, if it is a plain space); an apostrophe that starts a match takes one
    of the fixed English endings.
    """
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = _classes()[points]
    fresh = np.ones(n + 1, bool)
    fresh[1:n] = kind[1:] != kind[:-1]
    fresh[bounds] = True
    runs = np.flatnonzero(fresh[:n])
    ends = np.append(runs[1:], n)
    closing = np.zeros(n + 1, bool)
    closing[bounds] = True
    space = (kind[runs] == 3) & ~closing[ends]
    last, after = ends[space] - 1, ends[space]
    fresh[last] = True
    fresh[after[points[last] == 0x20]] = False
    quotes = runs[(points[runs] == 0x27) & (ends - runs == 1) & fresh[runs] & ~closing[ends]]
    if len(quotes):
        limit = bounds[np.searchsorted(bounds, quotes, "right")]
        one = points[quotes + 1]
        two = np.where(quotes + 2 < limit, points[np.minimum(quotes + 2, n - 1)], 0)
        #: The endings of the public pattern, 's 't 'm 'd and 're 've 'll.
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        fresh[quotes[short | long] + 1] = False
        fresh[quotes[short] + 2] = True
        fresh[quotes[long] + 3] = True
    return np.flatnonzero(fresh[:n])


def end_to_end(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pre-tokens in one array, and where those of each end."""
    ends = np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)))
    return np.fromiter(chain.from_iterable(lists), np.uint32, int(ends[-1]) if len(ends) else 0), ends


class PieceCache:
    """Ids of pre-tokens seen before, by the pre-token itself; ``encode`` gives those of new ones, as lists or
    as ``end_to_end`` joins them. Two generations of at most ``most`` / 2 pre-tokens each: when
    the younger is full it becomes the older one, so what comes up often stays."""

    def __init__(self, encode, most: int = 400_000):
        self.encode, self.most = encode, most
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def distinct(self, text: str, points: np.ndarray, starts: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The different pre-tokens, and which of them each pre-token is. Hashes only group them; every pre-token is compared
        with the one that stands for its group, and a block in which a hash deceives is grouped by the strings themselves."""
        ends = np.append(starts[1:], len(points))
        hashes = run_hashes(points, starts)
        order = np.argsort(hashes)  # any of a group may stand for it, so the sort needn't be stable
        fresh = np.ones(len(order), bool)
        np.not_equal(hashes[order[1:]], hashes[order[:-1]], out=fresh[1:])
        where, inverse = order[fresh], np.empty(len(order), np.int64)
        inverse[order] = np.cumsum(fresh) - 1
        sizes, first = ends - starts, starts[where][inverse]
        same = np.array_equal(sizes, (ends - starts)[where][inverse])
        if same and len(starts):
            shift = np.repeat(first - starts, sizes)
            shift += np.arange(starts[0], len(points))
            same = np.array_equal(points[shift], points[starts[0] :])
        if same:
            return [text[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist())], inverse
        place: dict[str, int] = {}
        inverse = np.array([place.setdefault(text[a:b], len(place)) for a, b in zip(starts.tolist(), ends.tolist())], np.int64)
        return list(place), inverse

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and where those of each text begin."""
        text, points, bounds = code_points(data, offsets)
        starts = pretokens(points, bounds)
        pieces, inverse = self.distinct(text, points, starts)
        found = list(map(self.young.get, pieces))
        absent = [i for i, ids in enumerate(found) if ids is None]
        if absent:
            names = [pieces[i] for i in absent]
            ids_of = list(map(self.old.get, names))
            missing = [i for i, ids in enumerate(ids_of) if ids is None]
            encoded = self.encode([names[i] for i in missing])
            pool, ends = encoded if isinstance(encoded, tuple) else end_to_end(encoded)
            pool, ends = pool.tobytes(), ends * 4
            begin = 0
            for i, end in zip(missing, ends.tolist()):
                ids_of[i], begin = pool[begin:end], end
            for i, ids in zip(absent, ids_of):
                found[i] = ids
            if len(self.young) > self.most // 2:
                self.old, self.young = self.young, {}
            self.young.update(zip(names, ids_of))
        pool = np.frombuffer(b"".join(found), np.uint32)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) >> 2
        begins = np.cumsum(sizes) - sizes
        taken = sizes[inverse]
        ends = np.zeros(len(inverse) + 1, np.int64)
        np.cumsum(taken, out=ends[1:])
        at = np.arange(ends[-1]) + np.repeat(begins[inverse] - ends[:-1], taken)
        return pool[at], ends[np.searchsorted(starts, bounds)]
