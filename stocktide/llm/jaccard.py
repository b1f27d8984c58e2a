"""Similarity join of documents by the Jaccard index of their word n-grams, with the n-gram order cut into fragments."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocktide.llm.arrays import SMALL_CHUNK_BYTES, U, mixed, place_hashes, shingles, text_chunks, words
from stocktide.llm.components import components
from stocktide.llm.store import discard, kept, release
from stocktide.operators.late import _maybe

PARTS = 4  # fragments in which overlaps of candidate pairs are counted
FILTER_BITS = 23  # of the filter that spares documents without a candidate the way to the join


class Classes:
    """Size classes of sets, and the fragments each class cuts the n-gram order into.

    Sets of sizes a <= b whose Jaccard index is t differ in at most (a + b)(1 - t)/(1 + t) n-grams. Cut into more fragments
    than that, ``slack`` + 1 fragments at least hold the same n-grams of both. The larger the slack, the more agreement can
    be asked of a candidate pair. Sets in neighbouring classes may link, so a set close to the next class is signed there,
    too; a pair counts in the class of its larger set.
    """

    def __init__(self, percent: int, ratio: float = 1.5):
        self.percent, self.starts = percent, [1]
        while self.starts[-1] < 1 << 40:
            a = self.starts[-1]
            self.starts.append(max(a + 1, int(a * ratio), -(-a * 100 // percent)))
        self.starts = np.array(self.starts)
        top = self.starts[1:] - 1
        self.differ = 2 * top * (100 - percent) // (100 + percent)
        self.slack = np.maximum(2, self.differ // 4)
        self.fragments = self.differ + 1 + self.slack

    def signed(self, sizes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(rows, class) pairs: the own class of each set and, where it may link up, the next one. Classes whose sets only
        link when equal need no signature."""
        own = np.searchsorted(self.starts, sizes, "right") - 1
        rows = np.flatnonzero((sizes > 0) & (self.differ[np.maximum(own, 0)] > 0))
        up = np.flatnonzero((sizes > 0) & (100 * sizes >= self.percent * self.starts[np.maximum(own, 0) + 1]))
        up = up[self.differ[own[up] + 1] > 0]
        return [(rows, own[rows]), (up, own[up] + 1)]


def sets_of(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of every text in ascending order, and where those of each text begin."""
    h, bounds = shingles(*words(data, offsets, place_hashes), n)
    each = [np.unique(h[a:b]) for a, b in zip(bounds.tolist(), bounds[1:].tolist())]
    ends = np.zeros(len(each) + 1, np.int64)
    np.cumsum([len(e) for e in each], out=ends[1:])
    return np.concatenate(each) if each else h, ends


def _sum(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    out = np.zeros(len(bounds) - 1, U)
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        out[some] = np.add.reduceat(values, bounds[some])
    return out


def digests(h: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name a set."""
    a = _sum(mixed(h ^ U(0x51ED270B35A1C3F7)), bounds)
    b = _sum(mixed(h ^ U(0xB492B66FBE98F273)), bounds)
    return a.view(np.int64), b.view(np.int64)


def signatures(h: np.ndarray, bounds: np.ndarray, rows: np.ndarray, kind: np.ndarray, classes: Classes) -> tuple[np.ndarray, ...]:
    """(row, signature, class and empty fragments of the set) of each fragment's n-grams in the sets ``rows``.

    Fragments without an n-gram are signed only in sets that have so many of them that a link could rest on those alone.
    """
    sizes = np.diff(bounds)[rows]
    at = np.arange(sizes.sum()) + np.repeat(bounds[rows] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) if len(rows) else np.zeros(0, np.int64)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, U), np.zeros(0, np.int64)
    grams, row, many = h[at], np.repeat(np.arange(len(rows)), sizes), np.repeat(classes.fragments[kind], sizes).astype(U)
    fragment = ((grams >> U(32)) * many) >> U(32)
    fresh = np.ones(len(at), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (fragment[1:] != fragment[:-1])
    starts = np.flatnonzero(fresh)
    owner = row[starts]
    place = mixed((kind[owner].astype(U) << U(48)) | fragment[starts])
    sign = mixed(np.add.reduceat(mixed(grams), starts) ^ place)
    filled = np.bincount(owner, minlength=len(rows))
    empty = classes.fragments[kind] - filled
    owners, signs = [owner], [sign]
    reach = np.searchsorted(owner, np.arange(len(rows) + 1))
    for i in np.flatnonzero(empty > classes.slack[kind]):
        missing = np.setdiff1d(np.arange(classes.fragments[kind[i]]), fragment[starts[reach[i] : reach[i + 1]]].astype(np.int64)).astype(U)
        signs.append(mixed(mixed((U(int(kind[i])) << U(48)) | missing)))
        owners.append(np.full(len(missing), i))
    owner, sign = np.concatenate(owners), np.concatenate(signs)
    return rows[owner], sign, kind[owner].astype(np.int64) << 33 | empty[owner] << 1


@lru_cache(maxsize=4)
def _classes(percent: int) -> Classes:
    return Classes(percent)


def _digest(docs: DataFrame, n: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch.column("text"), SMALL_CHUNK_BYTES):
                h, bounds = sets_of(data, offsets, n)
                a, b = digests(h, bounds)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array(np.diff(bounds)), pa.array(a), pa.array(b)], ["doc_id", "n", "a", "b"])

    return docs.mapInArrow(run, "doc_id bigint, n bigint, a bigint, b bigint")


def _signed(docs: DataFrame, n: int, percent: int) -> DataFrame:
    def run(batches):
        classes = _classes(percent)
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for i, j, data, offsets in text_chunks(batch.column("text"), SMALL_CHUNK_BYTES):
                h, bounds = sets_of(data, offsets, n)
                own = ids[i:j]
                # of equal sets in this block the smallest id signs for all
                a, b = digests(h, bounds)
                order = np.lexsort((own, b, a))
                first = np.ones(j - i, bool)
                first[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
                signs = np.zeros(j - i, bool)
                signs[order[first]] = True
                for up, (rows, kind) in enumerate(classes.signed(np.diff(bounds))):
                    keep = signs[rows]
                    row, sign, shape = signatures(h, bounds, rows[keep], kind[keep], classes)
                    if len(row):
                        yield pa.RecordBatch.from_arrays([pa.array(sign.view(np.int64)), pa.array(own[row]), pa.array(shape | up)],
                                                         ["sign", "doc_id", "shape"])

    return docs.where("doc_id is not null").mapInArrow(run, "sign bigint, doc_id bigint, shape bigint")


def _needed(shape: str, empty: str, percent: int) -> Column:
    """How many signatures of a class a linked pair shares at least, given the fragments that may be empty in both."""
    slack = F.array(*(F.lit(int(x)) for x in _classes(percent).slack))
    return F.greatest(F.lit(1), F.element_at(slack, F.expr(f"cast(shiftright({shape}, 33) + 1 as int)")) + 1 - F.expr(empty))


def _bit(column: str):
    return F.pmod(F.xxhash64(column), F.lit(1 << FILTER_BITS))


def _segments(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """The sets of documents in ``wanted`` (doc_id), one row per fragment: doc_id, a, n, part, grams.

    A filter of fixed size goes to the tasks and spares most other documents; the semi-join makes it exact.
    """
    bits = wanted.select(_bit("doc_id").alias("bit")).groupBy(F.expr("bit div 32768").alias("word")).agg(
        F.expr("bitmap_construct_agg(bit % 32768)").alias("bits"))
    whole = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for row in bits.collect():  # 2**FILTER_BITS bits at most
        whole[row["word"] * 4096 : (row["word"] + 1) * 4096] = np.frombuffer(row["bits"], np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(whole)

    def run(batches):
        for batch in batches:
            bit = batch.column("bit").to_numpy()
            batch = batch.filter(pa.array((shared.value[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)))
            for i, j, data, offsets in text_chunks(batch.column("text"), SMALL_CHUNK_BYTES):
                h, bounds = sets_of(data, offsets, n)
                a, _ = digests(h, bounds)
                sizes = np.diff(bounds)
                cuts = np.concatenate([np.searchsorted(h[x:y], np.arange(1, PARTS, dtype=U) << U(64 - (PARTS - 1).bit_length())) + x
                                       for x, y in zip(bounds.tolist(), bounds[1:].tolist())]).reshape(j - i, PARTS - 1)
                cuts = np.concatenate([bounds[:-1, None], cuts, bounds[1:, None]], axis=1)
                rows = np.repeat(np.arange(j - i), PARTS)
                grams = [h[x:y].tobytes() for c in cuts.tolist() for x, y in zip(c, c[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i).take(pa.array(rows)), pa.array(a[rows]), pa.array(sizes[rows]),
                     pa.array(np.tile(np.arange(PARTS, dtype=np.int32), j - i)), pa.array(grams, pa.binary())],
                    ["doc_id", "a", "n", "part", "grams"])

    found = docs.select("doc_id", "text", _bit("doc_id").alias("bit")).where("doc_id is not null")
    return found.mapInArrow(run, "doc_id bigint, a bigint, n bigint, part int, grams binary").join(wanted, "doc_id", "left_semi")


def _linked(docs: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """Those pairs (x, y) whose sets are similar enough: overlaps counted fragment by fragment, then summed per pair."""
    wanted = kept(pairs.select(F.col("x").alias("doc_id")).union(pairs.select("y")).distinct(), "wanted")
    segments = kept(_segments(docs, wanted, n), "segments")
    left = pairs.join(segments.select(F.col("doc_id").alias("x"), F.col("a").alias("ax"), F.col("n").alias("nx"), "part", F.col("grams").alias("gx")), "x")
    right = segments.select(F.col("doc_id").alias("y"), F.col("a").alias("ay"), F.col("n").alias("ny"), "part", F.col("grams").alias("gy"))
    met = left.join(right, ["y", "part"]).select("x", "y", "ax", "ay", "nx", "ny", "part", "gx", "gy")

    def overlap(batches):
        for batch in batches:
            counts = []
            for x, y in zip(batch.column("gx"), batch.column("gy")):
                both = np.concatenate([np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)])
                both.sort()
                counts.append(int(np.count_nonzero(both[1:] == both[:-1])))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("x", "y", "ax", "ay", "nx", "ny", "part")), pa.array(counts, pa.int64())],
                                             ["x", "y", "ax", "ay", "nx", "ny", "part", "shared"])

    partial = met.mapInArrow(overlap, "x bigint, y bigint, ax bigint, ay bigint, nx bigint, ny bigint, part int, shared bigint")
    partial = partial.groupBy("x", "y", "ax", "ay", "nx", "ny", "part").agg(F.max("shared").alias("shared"))  # a repeated row counts once
    sums = partial.groupBy("x", "y", "ax", "ay").agg(F.sum("shared").alias("shared"), F.max("nx").alias("nx"), F.max("ny").alias("ny"))
    links = kept(sums.where(f"100 * shared >= {percent} * (nx + ny - shared)").select("x", "y").distinct(), "linked")
    discard(wanted), discard(segments)
    return links


FEW = 8  # documents of a bucket whose pairs are made one by one
BLOCK = 256  # documents of a cluster of candidates compared at once


def _clusters(rows: DataFrame) -> DataFrame:
    """(doc_id, cluster) of the documents of large buckets: rows (sign, first, hub, many), ``hub`` one of the bucket's documents.

    Buckets that share documents are compared as one cluster, each pair once. Where they only form a chain, so that a cluster
    has more pairs than all of its buckets, each of these is a cluster of its own.
    """
    rows = kept(rows, "large")
    heads = rows.select("first", "hub").distinct()
    parts = kept(components(heads, "first", "hub"), "parts")
    placed = rows.join(parts, F.col("first") == F.col("id")).drop("id")
    made = rows.select("sign", "hub", "many").distinct().join(parts, F.col("hub") == F.col("id")).groupBy("component").agg(
        F.sum(F.expr("cast(many as double) * many")).alias("made"))
    sizes = parts.groupBy("component").agg(F.count("*").alias("size")).join(made, "component")
    chains = sizes.where((F.col("size") > BLOCK) & (F.col("made") < F.expr("cast(size as double) * size"))).select(
        "component", F.lit(True).alias("chain"))
    return placed.join(chains, "component", "left").select(
        F.col("first").alias("doc_id"), F.when(F.col("chain"), F.col("sign")).otherwise(F.col("component")).alias("cluster"),
        F.coalesce("chain", F.lit(False)).alias("chain")).distinct()


def _linked_in_blocks(docs: DataFrame, clusters: DataFrame, n: int, percent: int) -> DataFrame:
    """Links (x, y) that join everything which linked pairs inside ``clusters`` (doc_id, cluster, chain) join.

    A cluster's documents are dealt to blocks, and each pair of blocks is compared in a group of its own: overlaps of all its documents fragment by fragment, as products of incidence matrices,
    summed. Of the links found only those leave the task that connect something new there, one per document at most, so a
    large group of similar documents never becomes a list of its pairs.
    """
    name = ["cluster", "chain"]
    sizes = clusters.groupBy(*name).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = clusters.join(sizes, name).withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    segments = kept(_segments(docs, clusters.select("doc_id"), n), "segments")
    rows = segments.dropDuplicates(["doc_id", "a", "part"]).join(placed, "doc_id").withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        *name, F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "doc_id", "a", "n", "part", "grams")

    def compare(table: pa.Table) -> pa.Table:
        ids, a, part, own, many = (table.column(c).to_numpy() for c in ("doc_id", "a", "part", "own", "n"))
        nodes, node = np.unique(np.stack([ids, a], axis=1), axis=0, return_inverse=True)
        node = node.ravel()
        size, block = np.zeros(len(nodes), np.int64), np.zeros(len(nodes), np.int64)
        size[node], block[node] = many, own
        shared = np.zeros((len(nodes), len(nodes)), np.int64)
        grams = table.column("grams").combine_chunks()
        for k in range(PARTS):
            at = np.flatnonzero(part == k)
            lengths = [len(grams[int(i)].as_buffer()) // 8 for i in at]
            tokens = np.frombuffer(b"".join(grams[int(i)].as_py() for i in at), U)
            owner = np.repeat(node[at], lengths)
            _, code, counts = np.unique(tokens, return_inverse=True, return_counts=True)
            keep = counts[code] > 1
            owner, code = owner[keep], (np.cumsum(counts > 1) - 1)[code[keep]]
            order = np.argsort(code, kind="stable")
            owner, code = owner[order], code[order]
            for start in range(0, int(code[-1]) + 1 if len(code) else 0, 8192):
                x, y = np.searchsorted(code, [start, start + 8192])
                there = np.zeros((len(nodes), 8192), np.float32)
                there[owner[x:y], code[x:y] - start] = 1
                shared += (there @ there.T).astype(np.int64)
        near = 100 * shared >= percent * (size[:, None] + size[None] - shared)
        near &= (block[:, None] != block[None]) if table.column("p")[0].as_py() != table.column("q")[0].as_py() else True
        root = list(range(len(nodes)))

        def top(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        found = []
        for i, j in zip(*(c.tolist() for c in np.nonzero(np.triu(near, 1)))):
            x, y = top(i), top(j)
            if x != y:
                root[max(x, y)] = min(x, y)
                if nodes[i, 0] != nodes[j, 0]:
                    found.append((max(nodes[i, 0], nodes[j, 0]), min(nodes[i, 0], nodes[j, 0])))
        found = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"x": found[:, 0], "y": found[:, 1]})

    links = kept(rows.groupBy(*name, "p", "q").applyInArrow(compare, "x bigint, y bigint").distinct(), "linked")
    discard(segments)
    return links


def similarity_groups(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """Groups of documents that links of Jaccard index ``percent``/100 or more connect.

    A document's set: the distinct ``n``-word shingles of its words (A-Z lower-cased, split at blanks; fewer words are one
    shingle), as 64-bit hashes. Equal sets are joined by a 128-bit digest and count once. The hash order is cut into
    fragments by size class (see ``Classes``), so that linked sets agree in some fragment: those are the candidates.
    Candidate pairs are counted fragment by fragment and summed. First every document of a bucket meets the bucket's
    smallest id only. Where a bucket of at most ``FEW`` documents still spans several components, its pairs across components
    follow, if they share as many fragments as a linked pair must; larger such buckets never become a list of pairs: their
    documents are compared in blocks.

    What a step wrote is deleted once no later step reads it.

    One row per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id reachable). Without words (null or empty
    text): 0 shingles, linked with nothing. A null id has no links and no component. Rows of one id are one document: it
    links if any of its texts does. Other columns aren't read; an empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    digest = kept(_digest(docs, n), "digest")
    named = digest.where("doc_id is not null and n > 0")
    firsts = named.groupBy("a", "b").agg(F.min("doc_id").alias("first"))
    equal = kept(named.join(firsts, ["a", "b"]).select("doc_id", "first", "n").distinct(), "equal")
    over = Window.partitionBy("sign")
    buckets = _signed(docs, n, percent).withColumn("first", F.min("doc_id").over(over)).withColumn("last", F.max("doc_id").over(over))
    buckets = kept(buckets.where("first < last").select("sign", "doc_id", "shape", F.col("first").alias("centre")), "buckets")
    release(docs.sparkSession)

    def canonical(frame: DataFrame, column: str) -> DataFrame:
        return frame.join(equal.select(F.col("doc_id").alias(column), F.col("first").alias(f"_{column}")), column).drop(column).withColumnRenamed(f"_{column}", column)

    # half of what a linked pair shares is asked here, as a bucket shows a document to its centre only; no pair is lost by it
    stars = buckets.where("doc_id <> centre").groupBy(F.col("doc_id").alias("x"), F.col("centre").alias("y")).agg(
        F.count("*").alias("shared"), F.max(_needed("shape", "(shape >> 1) & 4294967295", percent)).alias("needed"))
    stars = stars.where("2 * shared >= needed").select("x", "y")
    stars = canonical(canonical(stars, "x"), "y").where("x <> y").distinct().select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct()
    stars = kept(stars, "stars")
    same = equal.where("doc_id <> first").select(F.col("doc_id").alias("x"), F.col("first").alias("y"))
    links = kept(_linked(docs, stars, n, percent).union(same), "links")
    release(docs.sparkSession)
    groups = kept(components(links, "x", "y"), "groups")

    labelled = equal.select("doc_id", "first", "n").join(groups.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn(
        "component", F.coalesce("component", "doc_id"))
    rows = buckets.select("sign", "doc_id", "shape").join(labelled, "doc_id").select("sign", "first", "n", "component", "shape").distinct()
    every = kept(rows, "every")
    discard(buckets)
    del rows, buckets
    release(docs.sparkSession)
    open_ = every.groupBy("sign").agg(F.min("component").alias("c"), F.max("component").alias("d")).where("c < d").select("sign")
    rows = kept(every.join(open_, "sign"), "open")
    discard(every)
    del every, open_
    release(docs.sparkSession)
    # a linked pair shares ``needed`` signatures, so a document of fewer has no partner; leaving out the commonest ones of each
    # document, fewer than that, loses none
    common = rows.join(rows.groupBy("sign").agg(F.count("*").alias("many")), "sign")
    spare = F.expr("cast(needed - 1 as int) * 3 div 4")
    own = Window.partitionBy("first", F.expr("shiftright(shape, 33)"))
    common = common.withColumn("needed", _needed("shape", "(shape >> 1) & 4294967295", percent)).withColumn(
        "place", F.row_number().over(own.orderBy(F.desc("many"), "sign"))).withColumn("held", F.count("*").over(own)).where(
        (F.col("place") > spare) & (F.col("held") >= F.col("needed"))).select("sign", "first", "n", "component", "shape")
    common = kept(common, "common")
    discard(rows)
    buckets = common.groupBy("sign").agg(F.count("*").alias("many"), F.min("first").alias("hub"), F.min("component").alias("c"),
                                         F.max("component").alias("d")).where("c < d").select("sign", "many", "hub")
    buckets = kept(buckets, "sizes")
    # small buckets: pair by pair, fewer than FEW for each row of a bucket
    small = common.join(buckets.where(F.col("many") <= FEW).select("sign"), "sign")
    left, right = (small.select("sign", *(F.col(c).alias(c + s) for c in ("first", "n", "component", "shape"))) for s in "xy")
    pairs = left.join(right, "sign").where("componentx < componenty").where(
        f"100 * least(nx, ny) >= {percent} * greatest(nx, ny) and (shapex & shapey & 1) = 0").select(
        F.greatest("firstx", "firsty").alias("x"), F.least("firstx", "firsty").alias("y"),
        _needed("shapex", "least((shapex >> 1) & 4294967295, (shapey >> 1) & 4294967295)", percent).alias("needed"))
    pairs = pairs.groupBy("x", "y").agg(F.count("*").alias("shared"), F.min("needed").alias("needed"))
    pairs = pairs.where(F.col("shared") >= F.col("needed") - spare).select("x", "y")
    pairs = kept(pairs.join(stars, ["x", "y"], "left_anti"), "pairs")
    # a pair that shares a large bucket, too, may share too few small ones to be among them: its bucket is compared in blocks
    clusters = kept(_clusters(common.join(buckets.where(F.col("many") > FEW), "sign").select("sign", "first", "hub", "many")), "clusters")
    more = links.limit(0)
    if not pairs.isEmpty():
        more = _linked(docs, pairs, n, percent)
    if not clusters.isEmpty():
        more = more.union(_linked_in_blocks(docs, clusters, n, percent))
    more = kept(more, "links")
    if not more.isEmpty():
        groups = kept(components(links.union(more), "x", "y"), "groups")
    release(docs.sparkSession)
    return digest.select("doc_id", F.col("n").alias("n_shingles")).join(groups.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def one_of_each_group(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group of ``similarity_groups``, that of the smallest id; columns stay as they are.

    Rows of one id are one document, of which one row stays. Documents without an id or without words all stay. Rows that
    a filter of the marked ids' hashes rules out are not shuffled, however many ids are marked; exact joins follow for the
    others.
    """
    groups = similarity_groups(docs, n, percent).where("doc_id is not null")
    marked = groups.groupBy(F.col("doc_id").alias("__id")).agg(
        (F.count("*") > 1).alias("_several"), F.max(F.expr("doc_id <> component_id")).alias("_other")).where("_several or _other")
    marked = kept(marked, "marked")
    release(docs.sparkSession)
    rows = docs.withColumn("__id", F.col("doc_id").cast("bigint"))
    held = _maybe(rows, marked, ["__id"]).withColumn("_maybe", F.expr("_maybe and __id is not null"))
    out = held.where("not _maybe").unionByName(held.where("_maybe").join(marked, "__id", "left_anti"))
    repeated = marked.where("_several and not _other").select("__id")
    if not repeated.isEmpty():
        several = _maybe(rows, repeated, ["__id"]).where("_maybe").join(repeated, "__id", "left_semi").dropDuplicates(["__id"])
        out = out.unionByName(several, allowMissingColumns=True)
    return out.select(*docs.columns)
