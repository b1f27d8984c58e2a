"""Token alignment of two tokenizers over the same texts; each distinct text is tokenised and aligned once."""

from __future__ import annotations

import hashlib
import os
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stocktide.llm.arrays import PieceCache, text_chunks
from stocktide.llm.store import discard, kept

#: Texts of about so many bytes share one table of pair counts.
BLOCK_BYTES = 8 << 20
#: Longer texts go to the sentence-piece library in parts of about so many characters.
PART = 1 << 15
ALIGNED = ("block bigint, digest binary, copies bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
           "groups_sha256 string, pairs binary, times binary")
MEASURES = "digest binary, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


class Alignment(NamedTuple):
    """``documents``: measures per document. ``pairs``: (a, b, n) of every pair of ids that is ever linked."""

    documents: DataFrame
    pairs: DataFrame


class Vocabulary:
    """Bytes of every token as one pool, and its id in decimal with either sign that may follow it."""

    def __init__(self, tokens: list[bytes], inner: bytes, last: bytes):
        if not all(tokens):
            raise ValueError("a token without bytes can't be aligned")
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.pool = np.frombuffer(b"".join(tokens), np.uint8)
        self.shown = np.array([b"%d%s" % (i, sign) for sign in (inner, last) for i in range(len(tokens))], object)

    def __len__(self) -> int:
        return len(self.sizes)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return self.pool[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.begins[ids] - ends + sizes, sizes)]

    def spells(self, ids: np.ndarray, bounds: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which texts the tokens' bytes give back exactly."""
        reached = np.append(0, np.cumsum(self.sizes[ids]))[bounds]
        lengths = np.diff(offsets)
        ok = np.diff(reached) == lengths
        of_bytes = np.repeat(np.arange(len(lengths))[ok], lengths[ok])
        given = data if ok.all() else data[np.repeat(ok, lengths)]
        wrong = self.spell(ids[np.repeat(ok, np.diff(bounds))]) != given
        ok[of_bytes[wrong]] = False
        return ok


def byte_level(entry: str) -> bytes:
    """Bytes of an entry of a byte-level vocabulary: printable Latin-1 bytes stand for themselves, the others, in order, for
    the code points from 256 on."""
    return bytes(map(_byte_of().__getitem__, entry))


@lru_cache(maxsize=1)
def _byte_of() -> dict[str, int]:
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Byte:
    """The byte-level tokenizer, by pre-token."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        size = tokenizer.get_vocab_size()
        added = tokenizer.get_added_tokens_decoder()
        self.vocabulary = Vocabulary(
            [added[i].content.encode() if i in added else byte_level(tokenizer.id_to_token(i)) for i in range(size)], b",", b"|")
        self.cache = PieceCache(lambda pieces: [e.ids for e in tokenizer.encode_batch_fast(pieces, add_special_tokens=False)])


class Piece:
    """The sentence-piece tokenizer. No piece of its vocabulary holds a space after anything else, so no merge spans the place
    before a run of spaces: there a long text is cut, which bounds the library's memory. The space that it puts before a text
    takes the place of the one that was cut at."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = model = SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.vocabulary = Vocabulary(
            [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)], b",", b";")
        self.divisible = not any("▁" in p.lstrip("▁") for p in pieces)

    def parts(self, text: str) -> list[str]:
        if len(text) <= PART or not self.divisible:
            return [text]
        out, begin = [], 0
        while len(text) - begin > PART:
            at = text.find(" ", begin + PART)
            while at > 0 and text[at - 1] == " ":  # inside a run of spaces
                at = text.find(" ", at + 1)
            if at < 0 or not text[at:].strip(" "):
                break
            out.append(text[begin:at])
            begin = at + 1
        return [*out, text[begin:]]

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts = [self.parts(t) for t in texts]
        ids = self.model.encode(list(chain.from_iterable(parts)), num_threads=1)
        ends = np.append(0, np.cumsum([len(x) for x in ids]))
        bounds = ends[np.append(0, np.cumsum([len(p) for p in parts]))]
        return np.fromiter(chain.from_iterable(ids), np.int64, int(ends[-1])), bounds


@lru_cache(maxsize=2)
def tokenizers_of(a_path: str, b_path: str) -> tuple[Byte, Piece]:
    """One pair per Python worker, kept over its tasks."""
    return Byte(a_path), Piece(b_path)


def align_chunk(a: Byte, b: Piece, texts: list[str], data: np.ndarray, offsets: np.ndarray):
    """For texts whose bytes, each after a space, are ``data``: which are aligned, and of those the bounds in A, B and link
    order, the tokens in output order, and the ids of both sides of every link."""
    ids_a, bounds_a = a.cache.ids(data, offsets)
    ids_a = ids_a.astype(np.int64)
    ids_b, bounds_b = b.ids(texts)
    ok = a.vocabulary.spells(ids_a, bounds_a, data, offsets) & b.vocabulary.spells(ids_b, bounds_b, data, offsets) & (np.diff(offsets) > 1)
    if not ok.all():
        ids_a, ids_b = ids_a[np.repeat(ok, np.diff(bounds_a))], ids_b[np.repeat(ok, np.diff(bounds_b))]
        bounds_a, bounds_b = (np.append(0, np.cumsum(np.diff(x)[ok])) for x in (bounds_a, bounds_b))
    ends_a, ends_b = np.cumsum(a.vocabulary.sizes[ids_a]), np.cumsum(b.vocabulary.sizes[ids_b])
    total = int(ends_a[-1]) + 1 if len(ends_a) else 1
    mark = np.zeros(total, bool)
    mark[ends_b] = True
    cut_a = mark[ends_a]
    mark[:] = False
    mark[ends_a] = True
    cut_b = mark[ends_b]
    last_a, last_b = np.flatnonzero(cut_a), np.flatnonzero(cut_b)
    # A's tokens of a group come before B's: each moves on by the other side's tokens that precede it
    shown = np.empty(len(ids_a) + len(ids_b), object)
    shown[np.arange(len(ids_a)) + np.append(0, last_b + 1)[np.cumsum(cut_a) - cut_a]] = a.vocabulary.shown[ids_a + cut_a * len(a.vocabulary)]
    if len(ids_b):
        shown[np.arange(len(ids_b)) + (last_a + 1)[np.cumsum(cut_b) - cut_b]] = b.vocabulary.shown[ids_b + cut_b * len(b.vocabulary)]
    links = np.append(0, np.cumsum(cut_a))[bounds_a]
    return ok, bounds_a, bounds_b, links, shown, ids_a[last_a], ids_b[last_b]


def align_texts(texts: DataFrame, a_path: str, b_path: str, groups: bool = False) -> DataFrame:
    """``texts`` (text, digest, copies), all different, each tokenised and aligned once, in blocks.

    ``groups``: also the groups as text ``a1,a2|b1;a3|b2,b3``. ``pairs``, ``times``: the linked pairs of the text as numbers
    ``a * size of B + b`` and how often each is linked there.
    """

    def align(batches):
        from pyspark import TaskContext

        a, b = tokenizers_of(a_path, b_path)
        n_b = len(b.vocabulary)
        kind = pair_type(len(a.vocabulary) * n_b)
        block, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), batch.column("text").cast(pa.large_string()),
                                                 pa.scalar("", pa.large_string()))
            for i, j, data, offsets in text_chunks(spaced):
                ok, bounds_a, bounds_b, links, shown, left, right = align_chunk(a, b, batch.column("text").slice(i, j - i).to_pylist(), data, offsets)
                counts = {name: np.zeros(j - i, np.int64) for name in ("n_a", "n_b", "n_links")}
                for name, bounds in zip(counts, (bounds_a, bounds_b, links)):
                    counts[name][ok] = np.diff(bounds)
                size = len(a.vocabulary) * n_b
                keys, times = np.unique(np.repeat(np.arange(int(ok.sum())), np.diff(links)) * size + left * n_b + right, return_counts=True)
                at = np.searchsorted(keys, np.arange(int(ok.sum()) + 1) * size).tolist()
                codes, times = (keys % size).astype(kind), times.astype("<u4")
                strings, pairs, often = [b""] * (j - i), [b""] * (j - i), [b""] * (j - i)
                ends = (bounds_a + bounds_b).tolist()
                for k, t in enumerate(np.flatnonzero(ok).tolist()):
                    strings[t] = b"".join(shown[ends[k] : ends[k + 1]].tolist())[:-1]
                    pairs[t], often[t] = codes[at[k] : at[k + 1]].tobytes(), times[at[k] : at[k + 1]].tobytes()
                blocks = []
                for n in np.diff(offsets).tolist():
                    if held and held + n > BLOCK_BYTES:
                        block, held = block + 1, 0
                    held += n
                    blocks.append(block)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(blocks, pa.int64()), batch.column("digest").slice(i, j - i), batch.column("copies").slice(i, j - i),
                     *(pa.array(counts[n]) for n in ("n_a", "n_b", "n_links", "n_links")),
                     pa.array([s.decode() for s in strings] if groups else [None] * (j - i), pa.string()),
                     pa.array([hashlib.sha256(s).hexdigest() if s else "" for s in strings], pa.string()),
                     pa.array(pairs, pa.binary()), pa.array(often, pa.binary())],
                    [f.split()[0] for f in ALIGNED.split(", ")])

    return texts.select("text", "digest", "copies").mapInArrow(align, ALIGNED)


def pair_type(pairs: int) -> str:
    return "<u4" if pairs <= 1 << 32 else "<u8"


def distinct_texts(docs: DataFrame) -> DataFrame:
    """(text, digest, copies): every different text that isn't null or empty, shuffled by the full text."""
    found = docs.select(F.col("text").cast("string").alias("text")).where("text <> ''")
    return found.groupBy("text").agg(F.count("*").alias("copies")).withColumn("digest", F.unhex(F.sha2("text", 256)))


def _block_counts(aligned: DataFrame, kind: str) -> DataFrame:
    """(block, pair, n): how many links of the block hold the pair, copies of a text included."""

    def count(batches):
        def summed(block, keys, weights):
            codes, at = np.unique(np.concatenate(keys), return_inverse=True)
            n = np.zeros(len(codes), np.int64)
            np.add.at(n, at, np.concatenate(weights))
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(codes), block)), pa.array(codes.astype(np.int64)), pa.array(n)],
                                              ["block", "pair", "n"])

        current, keys, weights = None, [], []
        for batch in batches:
            for block, copies, pairs, times in zip(*(batch.column(c) for c in ("block", "copies", "pairs", "times"))):
                block = block.as_py()
                if block != current:
                    if keys:
                        yield summed(current, keys, weights)
                    current, keys, weights = block, [], []
                keys.append(np.frombuffer(pairs.as_buffer(), kind))
                weights.append(np.frombuffer(times.as_buffer(), "<u4").astype(np.int64) * copies.as_py())
        if keys:
            yield summed(current, keys, weights)

    return aligned.select("block", "copies", "pairs", "times").mapInArrow(count, "block bigint, pair bigint, n bigint")


def align_documents(docs: DataFrame, a_path: str, b_path: str) -> Alignment:
    """How the tokens of two tokenizers line up in every document, and how often each pair of ids ends together.

    ``a_path``: a byte-level tokenizer file, which reads a space and the text; ``b_path``: a sentence-piece model, which adds
    the space itself. The files must exist on every worker. Special tokens are never produced.

    Texts are shuffled whole, copies meeting in the map tasks first; each distinct text is tokenised and aligned once and
    written with its linked pairs. Pair counts are summed within a block of about 8 MB of text, copies weighing as often as
    they occur, then over blocks, so a pair that every text holds has one row per block. Totals return to the blocks by the
    same rows, never as one broadcast table. The measures of a text reach its documents by the text's sha256; a text that
    very many rows hold makes one hot key of that join, which adaptive execution splits.

    Null text, empty text, or a text whose tokens don't spell it (the second tokenizer takes U+2581 for a space): zeros and an
    empty digest. Repeated rows and null ids give a row each. Other columns aren't read. An empty table gives an empty result.
    One text is held whole in a task.
    """
    a, b = tokenizers_of(a_path, b_path)
    n_b = len(b.vocabulary)
    kind = pair_type(len(a.vocabulary) * n_b)
    aligned = kept(align_texts(distinct_texts(docs), a_path, b_path).drop("groups"), "aligned")
    by_block = kept(_block_counts(aligned, kind), "block-pairs")
    totals = kept(by_block.groupBy("pair").agg(F.sum("n").alias("total")).withColumn(
        "best", F.col("total") == F.max("total").over(Window.partitionBy(F.col("pair") % n_b))), "pairs")

    def measure(texts: pa.Table, counts: pa.Table) -> pa.Table:
        codes, total, best = (counts.column(c).to_numpy() for c in ("pair", "total", "best"))
        order = np.argsort(codes)
        codes, total, best = codes[order], total[order], best[order]
        n_best, sums = [], []
        for pairs, times in zip(texts.column("pairs"), texts.column("times")):
            at = np.searchsorted(codes, np.frombuffer(pairs.as_buffer(), kind).astype(np.int64))
            times = np.frombuffer(times.as_buffer(), "<u4").astype(np.int64)
            n_best.append(int(times[best[at].astype(bool)].sum()))
            sums.append(int((times * total[at]).sum()))
        names = ["digest", "n_a", "n_b", "n_groups", "n_links"]
        return pa.table([*(texts.column(n) for n in names), pa.array(n_best, pa.int64()), pa.array(sums, pa.int64()), texts.column("groups_sha256")],
                        names=[*names, "n_best", "count_sum", "groups_sha256"])

    back = by_block.select("block", "pair").join(totals, "pair").select("block", "pair", "total", "best")
    measures = kept(aligned.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(measure, MEASURES), "measures")
    discard(aligned)
    discard(by_block)
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.unhex(F.sha2(F.col("text").cast("string"), 256)).alias("digest"))
    documents = rows.join(measures, "digest", "left").select(
        "doc_id", *(F.coalesce(n, F.lit(0).cast("bigint")).alias(n) for n in numbers), F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
    pairs = totals.select(F.expr(f"pair div {n_b}").alias("a"), (F.col("pair") % n_b).alias("b"), F.col("total").alias("n"))
    return Alignment(documents, pairs)
