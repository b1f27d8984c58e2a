"""Phrases that occur together more often than their parts suggest, counted as stripes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stocktide.llm.arrays import LOWER, U, give_back, mixed, run_hashes, text_chunks
from stocktide.llm.store import discard, kept, kept_apart, release

LONGEST = 4
#: Texts of about so many bytes make a block; their stripes leave it as one.
BLOCK_BYTES = 4 << 20
#: Bytes of text whose stripes are merged in one task, on average; a stripe is split into so many parts by the next word.
SLOT_BYTES = 32 << 20
PARTS = 64

BREAK = np.zeros(256, bool)
BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
NO_WORD = BREAK.copy()
NO_WORD[[0x20, 0x09]] = True

VOCABULARY = "block bigint, payload binary, lang string, word string, id bigint, f bigint"
LEVEL = "block bigint, slot bigint, payload binary"
MERGED = "block bigint, payload binary, prefix bigint, next bigint, id bigint, f bigint, longest bigint"


# --- words of a block ----------------------------------------------------------------------------------------


def find_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words of lower-cased texts begin and end, and which begin a new piece."""
    live = ~NO_WORD[data]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    first = live.copy()
    first[1:] &= ~live[:-1]
    first[begins] = live[begins]
    last = live.copy()
    last[:-1] &= ~live[1:]
    tails = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[tails] = live[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    pieces = np.cumsum(BREAK[data])[starts] + np.searchsorted(offsets, starts, "right")  # grows at each break and each text
    fresh = np.ones(len(starts), bool)
    fresh[1:] = pieces[1:] != pieces[:-1]
    return starts, ends, fresh


def distinct_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lang: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One place of each different (language, word), which of them each word is, and a hash of each word by itself. Words are grouped by hash and compared
    with the one that stands for their group; where a hash deceives, they are grouped by their bytes."""
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U)
    sizes = ends - starts
    # runs without the gaps: word bytes end to end
    heads = np.cumsum(sizes) - sizes
    places = np.arange(int(sizes.sum())) + np.repeat(starts - heads, sizes)
    solid = data[places]
    hashes = np.empty(len(starts), U)
    step = 200_000
    for i in range(0, len(starts), step):
        j = min(i + step, len(starts))
        a = int(heads[i])
        hashes[i:j] = run_hashes(solid[a : int(heads[j - 1] + sizes[j - 1])], heads[i:j] - a)
    _, where, inverse = np.unique(mixed(hashes + lang.astype(U) * U(0x9E3779B97F4A7C15)), return_index=True, return_inverse=True)
    stand = where[inverse]
    same = np.array_equal(sizes, sizes[stand]) and np.array_equal(lang, lang[stand])
    if same:
        same = np.array_equal(solid, solid[np.arange(len(solid)) + np.repeat(heads[stand] - heads, sizes)])
    if same:
        return where, inverse, hashes[where]
    place: dict = {}
    text = solid.tobytes()
    keys = zip(lang.tolist(), (text[a : a + n] for a, n in zip(heads.tolist(), sizes.tolist())))
    inverse = np.array([place.setdefault(k, len(place)) for k in keys], np.int64)
    where = np.zeros(len(place), np.int64)
    where[inverse[::-1]] = np.arange(len(inverse))[::-1]
    return where, inverse, hashes[where]


def _read_words(slots: int):
    """Blocks of texts as word numbers (slot -1), and of each block the stripe of the empty prefix: how often each word of each
    language occurs in it, dealt to ``slots`` by the word."""

    def read(batches):
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            langs = pc.dictionary_encode(batch.column("lang"))
            for i, j, data, offsets in text_chunks(batch.column("text"), BLOCK_BYTES):
                data = LOWER[data]
                starts, ends, fresh = find_words(data, offsets)
                of_text = np.searchsorted(offsets, starts, "right") - 1
                lang = langs.indices.slice(i, j - i).to_numpy(zero_copy_only=False)[of_text].astype(np.int64)
                where, inverse, hashes = distinct_words(data, starts, ends, lang)
                counts = np.bincount(inverse, minlength=len(where))
                order = np.argsort(-counts, kind="stable")  # frequent words get small numbers, which pack well
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(len(order))
                sequence = np.insert(rank[inverse] + 1, np.flatnonzero(fresh), 0).astype("<u4") if len(inverse) else np.zeros(0, "<u4")
                slot = (hashes % U(slots)).astype(np.int64)
                by_slot = np.argsort(slot, kind="stable")
                text, at = data.tobytes(), where[by_slot]
                words = pa.table({
                    "lang": langs.dictionary.take(pa.array(lang[at])).cast(pa.string()),
                    "word": pa.array([text[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())], pa.binary()).cast(pa.string()),
                    "n": pa.array(counts[by_slot], pa.int64()), "local": pa.array(rank[by_slot], pa.int64())})
                bounds = np.searchsorted(slot[by_slot], np.arange(slots + 1)).tolist()
                used = [k for k in range(slots) if bounds[k] < bounds[k + 1]]
                payloads = [to_bytes(words.slice(bounds[k], bounds[k + 1] - bounds[k])) for k in used]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * (len(used) + 1), pa.int64()), pa.array([*used, -1], pa.int64()), pa.array([*payloads, squeezed(sequence)], pa.binary())],
                    ["block", "slot", "payload"])
                block += 1
            give_back()

    return read


def squeezed(*columns: np.ndarray) -> bytes:
    """Columns of numbers as bytes: first bytes of all numbers first, then their second bytes, and so on, compressed."""
    sizes = np.array([len(c) for c in columns], "<i8")
    raw = b"".join(np.ascontiguousarray(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), c.itemsize).T).tobytes() for c in columns)
    return sizes.tobytes() + len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)


def unsqueezed(payload, *kinds: str) -> list[np.ndarray]:
    view = memoryview(payload)
    head = np.frombuffer(view, "<i8", len(kinds) + 1).tolist()
    raw = pa.Codec("zstd").decompress(view[8 * len(head) :], head[-1], asbytes=True)
    out, at = [], 0
    for n, kind in zip(head, map(np.dtype, kinds)):
        columns = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(columns.T).view(kind).reshape(n))
        at += n * kind.itemsize
    return out


def to_bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def _merge_words(least: int):
    """Sum of the blocks' word counts: frequent words with ids, the number of words per language, and for each block which of
    its words are frequent."""
    names = [f.split()[0] for f in VOCABULARY.split(", ")]

    def merge(key, table):
        slot, read = key[0].as_py(), []
        for block, payload in zip(table.column("block").to_pylist(), table.column("payload")):
            part = pa.ipc.open_stream(payload.as_buffer()).read_all()
            read.append(part.append_column("block", pa.array(np.full(len(part), block))))
        words = pa.concat_tables(read)
        summed = words.group_by(["lang", "word"]).aggregate([("n", "sum")])
        lengths = summed.group_by("lang").aggregate([("n_sum", "sum")])
        frequent = summed.filter(pc.greater_equal(summed["n_sum"], least)).sort_by([("lang", "ascending"), ("word", "ascending")])
        ids = pa.array((slot << 36) + np.arange(1, len(frequent) + 1))
        frequent = frequent.append_column("id", ids)
        hits = words.select(["lang", "word", "block", "local"]).join(frequent.select(["lang", "word", "id"]), ["lang", "word"], join_type="inner")
        block, local, of = (hits[c].to_numpy() for c in ("block", "local", "id"))
        order = np.lexsort((local, block))
        block, local, of = block[order], local[order], of[order]
        heads = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(block) else np.zeros(0, np.int64)
        ends = np.append(heads[1:], len(block))
        payloads = [squeezed(local[a:b].astype("<i8"), of[a:b].astype("<i8")) for a, b in zip(heads.tolist(), ends.tolist())]
        a, f, n = len(heads), len(frequent), len(lengths)
        flat = lambda column: column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        out = pa.table([
            pa.concat_arrays([pa.array(block[heads], pa.int64()), pa.nulls(f + n, pa.int64())]),
            pa.concat_arrays([pa.array(payloads, pa.binary()), pa.nulls(f + n, pa.binary())]),
            pa.concat_arrays([pa.nulls(a, pa.string()), flat(frequent["lang"]), flat(lengths["lang"])]),
            pa.concat_arrays([pa.nulls(a, pa.string()), flat(frequent["word"]), pa.nulls(n, pa.string())]),
            pa.concat_arrays([pa.nulls(a, pa.int64()), ids.cast(pa.int64()), pa.nulls(n, pa.int64())]),
            pa.concat_arrays([pa.nulls(a, pa.int64()), flat(frequent["n_sum"]), flat(lengths["n_sum_sum"])])], names=names)
        give_back()
        return out

    return merge


# --- stripes of a block --------------------------------------------------------------------------------------


class Block:
    """Words of a block and, at each, the frequent gram of ``length`` words that begins there.

    ``words``, ``grams``: numbers from 1 into the sorted ids ``word_ids`` and ``gram_ids``; 0 is a break (the end of a piece
    or a word that can't be part of a frequent phrase) or no gram.
    """

    def __init__(self, words: np.ndarray, word_ids: np.ndarray, grams: np.ndarray, gram_ids: np.ndarray, length: int):
        self.words, self.word_ids, self.grams, self.gram_ids, self.length = words, word_ids, grams, gram_ids, length

    @classmethod
    def of_words(cls, sequence: np.ndarray, local: np.ndarray, ids: np.ndarray) -> Block:
        """From word numbers of the block (0: break) and the ids of its frequent words."""
        order = np.argsort(ids)
        number = np.zeros(max(int(sequence.max(initial=0)), int(local.max(initial=-1)) + 1) + 1, np.uint32)
        number[local[order] + 1] = np.arange(1, len(ids) + 1)
        words = number[sequence]
        return cls(words, ids[order], words, ids[order], 1).trimmed()

    def trimmed(self) -> Block:
        """Without words that no gram covers; what lay apart stays apart."""
        covered = self.grams > 0
        for k in range(1, self.length):
            covered[k:] |= self.grams[:-k] > 0
        stay = covered.copy()
        stay[1:] |= covered[:-1]  # one break after each stretch
        words = np.where(covered, self.words, 0)[stay]
        return Block(words, self.word_ids, words if self.length == 1 else self.grams[stay], self.gram_ids, self.length)

    def extensions(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of grams, and the number of the word that may extend each: 0 if none does, or only to a phrase whose last
        words aren't frequent together."""
        at = np.flatnonzero(self.grams)
        following = np.append(self.words[self.length :], np.zeros(self.length, np.uint32))[at]
        # the gram that begins one word later must be frequent, too
        return at, np.where(np.append(self.grams[1:], 0)[at] > 0, following, 0)

    def stripes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of every gram its next words (id 0: any other, or the end) and how often each follows: prefix, next, count."""
        at, following = self.extensions()
        keys, counts = np.unique(self.grams[at].astype(U) << U(32) | following.astype(U), return_counts=True)
        ids = np.append(0, self.word_ids)
        return self.gram_ids[(keys >> U(32)).astype(np.int64) - 1], ids[(keys & U(0xFFFFFFFF)).astype(np.int64)], counts

    def grown(self, prefix: np.ndarray, following: np.ndarray, ids: np.ndarray) -> Block:
        """With the frequent grams of one more word: (prefix id, next id) has an id of its own."""
        order = np.argsort(ids)
        prefix, following, ids = prefix[order], following[order], ids[order]
        keys = (np.searchsorted(self.gram_ids, prefix).astype(U) + U(1)) << U(32) | (np.searchsorted(self.word_ids, following).astype(U) + U(1))
        by_key = np.argsort(keys)
        at, here = self.extensions()
        wanted = self.grams[at].astype(U) << U(32) | here.astype(U)
        grams = np.zeros(len(self.words), np.uint32)
        if len(keys):
            found = np.minimum(np.searchsorted(keys[by_key], wanted), len(keys) - 1)
            hit = keys[by_key][found] == wanted
            grams[at[hit]] = by_key[found[hit]] + 1
        return Block(self.words, self.word_ids, grams, ids, self.length + 1).trimmed()

    def packed(self) -> bytes:
        own = self.grams is not self.words  # at length 1 they are the same
        columns = [np.array([self.length, own], "<i8"), self.words.astype("<u4"), self.word_ids.astype("<i8")]
        return squeezed(*columns, *([self.grams.astype("<u4"), self.gram_ids.astype("<i8")] if own else [np.zeros(0, "<u4"), np.zeros(0, "<i8")]))

    @classmethod
    def unpacked(cls, payload) -> Block:
        (length, own), words, word_ids, grams, gram_ids = unsqueezed(payload, "<i8", "<u4", "<i8", "<u4", "<i8")
        return cls(words, word_ids, grams if own else words, gram_ids if own else word_ids, int(length))


def pack_stripes(prefix: np.ndarray, following: np.ndarray, counts: np.ndarray) -> bytes:
    """Stripes sorted by prefix: each prefix once, the length of its stripe, next words and counts of all."""
    heads = np.flatnonzero(np.append(True, prefix[1:] != prefix[:-1]))
    lengths = np.diff(np.append(heads, len(prefix)))
    return squeezed(prefix[heads].astype("<i8"), lengths.astype("<u4"), following.astype("<i8"), counts.astype("<u4"))


def unpack_stripes(payload) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    prefix, lengths, following, counts = unsqueezed(payload, "<i8", "<u4", "<i8", "<u4")
    return np.repeat(prefix, lengths), following, counts


def slots_of(prefix: np.ndarray, following: np.ndarray, slots: int) -> np.ndarray:
    """The merging task of each entry: a stripe is dealt to ``PARTS`` tasks by its next words, so that of a prefix that is
    everywhere none holds it whole."""
    part = mixed(following.astype(U)) % U(PARTS)
    return (mixed(prefix.astype(U) * U(PARTS) + part) % U(slots)).astype(np.int64)


def _level_rows(block_id: int, block: Block, slots: int, last: bool) -> pa.Table:
    prefix, following, counts = block.stripes()
    slot = slots_of(prefix, following, slots)
    order = np.lexsort((following, prefix, slot))
    slot, prefix, following, counts = slot[order], prefix[order], following[order], counts[order]
    heads = np.flatnonzero(np.append(True, slot[1:] != slot[:-1])) if len(slot) else np.zeros(0, np.int64)
    ends = np.append(heads[1:], len(slot))
    payloads = [pack_stripes(prefix[a:b], following[a:b], counts[a:b]) for a, b in zip(heads.tolist(), ends.tolist())]
    slots_here = slot[heads].tolist()
    if not last:
        payloads.append(block.packed())
        slots_here.append(-1)
    return pa.table([pa.array([block_id] * len(payloads), pa.int64()), pa.array(slots_here, pa.int64()), pa.array(payloads, pa.binary())],
                    names=["block", "slot", "payload"])


def merge_stripes(stripes: list, least: int, slot: int):
    """Elementwise sum of the blocks' stripes, and what comes of it: sums per (prefix, next); ids of those of at least
    ``least``; per entry of the input the place of its sum; per prefix (of this part) its total and its largest extension."""
    prefix, following, counts = (np.concatenate(x) for x in zip(*stripes))
    order = np.lexsort((following, prefix))
    p, x = prefix[order], following[order]
    fresh = np.append(True, (p[1:] != p[:-1]) | (x[1:] != x[:-1]))
    heads = np.flatnonzero(fresh)
    sums = np.add.reduceat(counts[order].astype(np.int64), heads)
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(fresh) - 1
    p, x = p[heads], x[heads]
    frequent = (sums >= least) & (x != 0)
    ids = np.where(frequent, (slot << 36) + np.cumsum(frequent), 0)
    starts = np.flatnonzero(np.append(True, p[1:] != p[:-1]))
    totals = np.add.reduceat(sums, starts)
    longest = np.maximum.reduceat(np.where(frequent, sums, 0), starts)
    return (p, x, sums, ids), place, (p[starts], totals, longest)


def _merge(least: int):
    names = [f.split()[0] for f in MERGED.split(", ")]

    def merge(key, table):
        blocks = table.column("block").to_pylist()
        stripes = [unpack_stripes(x.as_buffer()) for x in table.column("payload")]
        (p, x, sums, ids), place, (heads, totals, longest) = merge_stripes(stripes, least, key[0].as_py())
        answered, payloads, at = [], [], 0
        for block, stripe in zip(blocks, stripes):
            mine = place[at : at + len(stripe[0])]
            at += len(stripe[0])
            mine = mine[ids[mine] > 0]
            if len(mine):
                answered.append(block)
                payloads.append(squeezed(*(c[mine].astype("<i8") for c in (p, x, ids))))
        hit = ids > 0
        a, g, h = len(answered), int(hit.sum()), len(heads)

        def column(grams, prefixes):
            return pa.concat_arrays([pa.nulls(a, pa.int64()), pa.nulls(g, pa.int64()) if grams is None else pa.array(grams, pa.int64()),
                                     pa.nulls(h, pa.int64()) if prefixes is None else pa.array(prefixes, pa.int64())])

        return pa.table(
            [pa.concat_arrays([pa.array(answered, pa.int64()), pa.nulls(g + h, pa.int64())]),
             pa.concat_arrays([pa.array(payloads, pa.binary()), pa.nulls(g + h, pa.binary())]),
             column(p[hit], heads), column(x[hit], None), column(ids[hit], None), column(sums[hit], totals), column(None, longest)], names=names)

    def merged_and_trimmed(key, table):
        out = merge(key, table)
        give_back()
        return out

    return merged_and_trimmed


# --- the operator --------------------------------------------------------------------------------------------


def count_phrases(docs: DataFrame, least: int = 30) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f, longer) of every phrase of one to four words that occurs at least ``least`` times in its
    language, and (lang, n), the number of words; ``longer``: the largest count of a phrase of one more word that contains it.

    A block of texts becomes a sequence of word numbers once. Then, for prefixes of one, two and three frequent words, every
    block sends its stripes (prefix: next word -> count) to merging tasks, which add them element by element. The merged
    stripe of a prefix gives its extensions, its total and the largest extension; the frequent extensions, now with ids, go back
    to the blocks they came from and are the prefixes of the next round. A phrase whose parts aren't frequent is never sent.
    Counts are exact: words are compared as bytes, then stand under ids.
    """
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slots = 1 + size // SLOT_BYTES

    def merged_of(stripes: DataFrame, merge, schema: str, name: str) -> DataFrame:
        """Merged stripes, and those of the blocks deleted."""
        merged = kept(stripes.groupBy("slot").applyInArrow(merge, schema), name)
        discard(stripes)
        release(docs.sparkSession)
        return merged

    def answered(states: DataFrame, merged: DataFrame, grow) -> tuple[DataFrame, DataFrame]:
        """The next level: every block with what became of its own entries. What was needed for it is deleted."""
        answers = merged.where("block is not null").select("block", "payload")
        after = kept_apart(states.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(grow, LEVEL), "level", "slot >= 0")
        discard(states)
        discard(merged)
        release(docs.sparkSession)
        return after

    stripes, states = kept_apart(rows.mapInArrow(_read_words(slots), LEVEL), "words", "slot >= 0")
    merged = merged_of(stripes, _merge_words(least), VOCABULARY, "merged")
    lengths = kept(merged.where("block is null and word is null").groupBy("lang").agg(F.sum("f").alias("n")), "lengths")
    vocabulary = kept(merged.where("word is not null").select("lang", "word", "id", "f"), "vocabulary")

    def first(sequences: pa.Table, answers: pa.Table) -> pa.Table:
        parts = [np.array(unsqueezed(x.as_buffer(), "<i8", "<i8")) for x in answers.column("payload")]
        local, ids = np.concatenate(parts, axis=1) if parts else np.zeros((2, 0), np.int64)
        block = Block.of_words(unsqueezed(sequences.column("payload")[0].as_buffer(), "<u4")[0], local, ids)
        rows = _level_rows(sequences.column("block")[0].as_py(), block, slots, False)
        give_back()
        return rows

    def following(last: bool):
        def grow(states: pa.Table, answers: pa.Table) -> pa.Table:
            block = Block.unpacked(states.column("payload")[0].as_buffer())
            parts = [np.array(unsqueezed(x.as_buffer(), "<i8", "<i8", "<i8")) for x in answers.column("payload")]
            prefix, following, ids = np.concatenate(parts, axis=1) if parts else np.zeros((3, 0), np.int64)
            rows = _level_rows(states.column("block")[0].as_py(), block.grown(prefix, following, ids), slots, last)
            give_back()
            return rows

        return grow

    stripes, states = answered(states, merged, first)
    counts = [vocabulary.select("id", "lang", F.col("word").alias("phrase"), F.lit(1).alias("size"), "f")]
    longer = []
    for size in range(2, LONGEST + 1):
        merged = merged_of(stripes, _merge(least), MERGED, "merged")
        last_words = vocabulary.select(F.col("id").alias("next"), "word")
        grams = merged.where("id is not null").select("id", "prefix", "next", "f").join(
            counts[-1].select(F.col("id").alias("prefix"), "lang", "phrase"), "prefix").join(last_words, "next")
        grams = kept(grams.select("id", "lang", F.concat_ws(" ", "phrase", "word").alias("phrase"), F.lit(size).alias("size"), "f"), "grams")
        extended = kept(merged.where("id is null and block is null").groupBy("prefix").agg(F.max("longest").alias("longer")), "extended")
        longer.append(counts[-1].join(extended, counts[-1]["id"] == extended["prefix"]).select("lang", "phrase", "longer"))
        longer.append(grams.select("lang", F.substring_index("phrase", " ", 1 - size).alias("phrase"), F.col("f").alias("longer")))
        counts.append(grams)
        if size < LONGEST:
            stripes, states = answered(states, merged, following(size + 1 == LONGEST))
    discard(states)
    discard(merged)
    phrases = counts[0]
    for more in counts[1:]:
        phrases = phrases.union(more)
    extensions = longer[0]
    for more in longer[1:]:
        extensions = extensions.union(more)
    found = phrases.drop("id").join(extensions.groupBy("lang", "phrase").agg(F.max("longer").alias("longer")), ["lang", "phrase"], "left")
    return kept(found, "phrases"), lengths


def collocations(docs: DataFrame, least: int = 30, most: int = 2000) -> DataFrame:
    """The ``most`` best phrases of two to four words of each language: (lang, rank, phrase, a, l, r, n, score).

    ``a`` occurrences of the phrase, at least ``least``; ``l`` and ``r`` of the parts of its worst cut; score: twice a million
    times a / (l + r), rounded down; ``n`` words in the language. Phrases that a longer one holds in four of five
    occurrences are left out: it is enough to look at longer ones by one word, since a still longer one that holds a phrase so
    often makes the one between do so, too.

    Null language: ``und``. Null or empty text: no words. Repeated rows count each. Other columns aren't read. An empty table
    gives an empty result. A text is held whole in a task.
    """
    phrases, lengths = count_phrases(docs, least)
    chosen = phrases.where("size > 1 and (longer is null or 5 * longer < 4 * f)").select("lang", "phrase", "size", F.col("f").alias("a"))
    cuts = chosen.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"), "size").select(
        "lang", "phrase", "a", "k", F.expr("substring_index(phrase, ' ', k)").alias("left"), F.expr("substring_index(phrase, ' ', k - size)").alias("right"))
    parts = phrases.select("lang", "phrase", "f")
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"]).join(
        parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    score = F.expr("(cast(a as decimal(20, 0)) * cast(2000000 as decimal(7, 0))) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))")
    worst = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("c")).select(
        "lang", "phrase", "a", "c.l", "c.r", "c.score")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = worst.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most)
    return ranked.join(lengths, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
