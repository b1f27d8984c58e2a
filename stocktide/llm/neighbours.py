"""Near-duplicate vectors by NN-descent: neighbour lists improved through neighbours of neighbours."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stocktide.llm.components import components
from stocktide.llm.store import kept, release

CELL = 256  # nodes compared with each other when lists begin
BLOCK = 512  # nodes of a saturated component compared at once
CHUNK = 1024  # centres of blocks compared at once
SAMPLE = 256  # nodes whose links the audit counts by brute force at first
ENOUGH = 100  # linked nodes the audit's sample is to hold
VALUES = 1 << 20  # components of vectors that go to the tasks at once to be compared with all
RECALL = 0.98  # of the audit; below it the lists begin anew with other cells beside what is known
ROUNDS = 3  # after which all nodes are compared


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as unit rows in double precision."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return matrix_of(column.flatten().to_numpy().reshape(len(column), -1))


def matrix_of(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow of the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _edges(u: np.ndarray, w: np.ndarray, sim: np.ndarray) -> pa.Table:
    return pa.table({"u": pa.array(u, pa.int64()), "w": pa.array(w, pa.int64()), "sim": pa.array(sim, pa.float64())})


def _best(edges: DataFrame, k: int) -> DataFrame:
    """The ``k`` most similar neighbours of every node, ties to the smaller id."""
    order = Window.partitionBy("u").orderBy(F.desc("sim"), "w")
    return edges.groupBy("u", "w").agg(F.max("sim").alias("sim")).withColumn("r", F.row_number().over(order)).where(F.col("r") <= k)


def _planes(count: int) -> int:
    return max(1, math.ceil(math.log2(max(2, count / (CELL / 2)))))


def _tables(count: int, threshold: float, least: int = 4) -> int:
    """Tables of cells in one of which a pair of cosine ``threshold`` meets but for half of what the audit lets pass."""
    together = (1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** _planes(count)
    return least if together >= 1 else max(least, math.ceil(math.log((1 - RECALL) / 2) / math.log1p(-together))) if together > 0 else least


def _begin(nodes: DataFrame, count: int, k: int, seed: list[int], tables: int, least: float = -2.0) -> DataFrame:
    """First lists: nodes that lie on the same sides of random planes, in cells of bounded size; neighbours from ``least`` up."""
    bits = _planes(count)

    def sides(batches):
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = np.array(batch.column("dim").to_pylist(), np.int64)
            codes = np.zeros((len(dims), tables), np.int64)
            for d in np.unique(dims):
                rows = np.flatnonzero(dims == d)
                if d not in planes:
                    planes[d] = np.random.default_rng([*seed, d]).normal(size=(d, tables * bits))
                above = matrix(batch.column("v").take(pa.array(rows))) @ planes[d] > 0
                codes[rows] = above.reshape(len(rows), tables, bits) @ (1 << np.arange(bits))
            for t in range(tables):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("v"), batch.column("dim"), pa.array([t] * len(dims), pa.int32()),
                     pa.array(codes[:, t])], ["id", "v", "dim", "t", "code"])

    kind = nodes.schema["v"].dataType.simpleString()
    dealt = nodes.select("id", "v", "dim").mapInArrow(sides, f"id bigint, v {kind}, dim int, t int, code bigint")
    sizes = dealt.groupBy("dim", "t", "code").count()
    cells = dealt.join(sizes, ["dim", "t", "code"]).withColumn(
        "part", F.pmod(F.xxhash64("id", *map(F.lit, seed)), F.ceil(F.col("count") / CELL)))

    def compare(table: pa.Table) -> pa.Table:
        ids, x = table.column("id").to_numpy(), matrix(table.column("v"))
        sim = x @ x.T
        np.fill_diagonal(sim, -2)
        n = min(k, len(ids) - 1)
        near = np.argpartition(-sim, n - 1, axis=1)[:, :n] if n else np.zeros((len(ids), 0), np.int64)
        u, w, sim = np.repeat(ids, n), ids[near.ravel()], np.take_along_axis(sim, near, axis=1).ravel()
        high = sim >= least
        return _edges(u[high], w[high], sim[high])

    return cells.select("dim", "t", "code", "part", "id", "v").groupBy("dim", "t", "code", "part").applyInArrow(
        compare, "u bigint, w bigint, sim double")


def _refine(nodes: DataFrame, lists: DataFrame, k: int) -> DataFrame:
    """Pairs of neighbours of a common node that would enter one of their lists. A node has at most ``k`` neighbours and
    ``k`` nodes that name it here, so no group grows with the data."""
    worst = lists.groupBy("u").agg(F.when(F.count("*") >= k, F.min("sim")).otherwise(-2.0).alias("worst"))
    named = _best(lists.select(F.col("w").alias("u"), F.col("u").alias("w"), "sim"), k)
    meet = lists.select("u", "w").union(named.select("u", "w")).union(lists.select("u", F.col("u").alias("w"))).distinct()
    known = nodes.join(worst, F.col("id") == F.col("u"), "left").select("id", "v", F.coalesce("worst", F.lit(-2.0)).alias("worst"))
    met = meet.join(known, F.col("w") == F.col("id")).select("u", "id", "v", "worst")

    def join(table: pa.Table) -> pa.Table:
        ids, worst, x = table.column("id").to_numpy(), table.column("worst").to_numpy(), matrix(table.column("v"))
        sim = x @ x.T
        np.fill_diagonal(sim, -3)
        a, b = np.nonzero(sim > worst[:, None])
        return _edges(ids[a], ids[b], sim[a, b])

    return met.groupBy("u").applyInArrow(join, "u bigint, w bigint, sim double")


def _lists(nodes: DataFrame, count: int, k: int, seed: int, known: DataFrame | None, threshold: float, rounds: int = 6) -> DataFrame:
    """Lists begin in four tables of cells; the others, more the more planes there are, add links only, four tables at a time."""
    first = _begin(nodes, count, k, [seed], 4)
    if known is not None:
        first = first.union(known.select("u", "w", "sim"))
    for turn, done in enumerate(range(4, tables := _tables(count, threshold), 4)):
        first = first.union(kept(_begin(nodes, count, k, [seed, turn], min(4, tables - done), threshold), "cells"))
        release(nodes.sparkSession)
    lists = kept(_best(first, k), "lists")
    total = lists.agg(F.sum("sim"), F.count("*")).first()
    for _ in range(rounds):
        lists = kept(_best(lists.select("u", "w", "sim").union(_refine(nodes, lists, k)), k), "lists")
        release(nodes.sparkSession)
        new = lists.agg(F.sum("sim"), F.count("*")).first()
        if total[0] is None or new[1] == total[1] and new[0] - total[0] <= 0.002 * new[1]:
            break
        total = new
    return lists


def _blocks(placed: DataFrame) -> DataFrame:
    """About ``BLOCK`` nodes of one component to a row, with the direction of their mean and the widest angle from it."""
    kind = "<f4" if placed.schema["v"].dataType.elementType.simpleString() == "float" else "<f8"
    sizes = placed.groupBy("dim", "component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = placed.join(sizes, ["dim", "component"]).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))

    def gather(table: pa.Table) -> pa.Table:
        x = matrix(table.column("v"))
        centre = x.mean(axis=0)
        length = np.linalg.norm(centre)
        wide = np.pi
        if length > 1e-6:
            centre = centre / length
            wide = float(np.arccos(np.clip(x @ centre, -1, 1)).max())
        values = table.column("v").combine_chunks().flatten().to_numpy().astype(kind)
        ids, many = (table.column(c).to_numpy().astype("<i8").tobytes() for c in ("id", "many"))
        return pa.table({"dim": pa.array([x.shape[1]], pa.int32()), "component": pa.array([table.column("component")[0].as_py()], pa.int64()),
                         "ids": pa.array([ids], pa.binary()), "many": pa.array([many], pa.binary()), "values": pa.array([values.tobytes()], pa.binary()),
                         "centre": pa.array([centre.tobytes()], pa.binary()), "wide": pa.array([wide], pa.float64())})

    packed = dealt.select("dim", "component", "own", "id", "many", "v").groupBy("dim", "component", "own").applyInArrow(
        gather, "dim int, component bigint, ids binary, many binary, values binary, centre binary, wide double")
    return kept(packed.withColumn("block", F.monotonically_increasing_id()), "blocks")


def _close(blocks: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of blocks that may hold a link: left out are those whose centres lie further apart than both widths and the
    angle of a link together, so no link is lost."""
    chunks = F.lit(max(1, -(-blocks.count() // CHUNK)))

    def gather(table: pa.Table) -> pa.Table:
        return pa.table({"dim": table.column("dim")[:1], "chunk": table.column("chunk")[:1],
                         "ids": pa.array([table.column("block").to_numpy().tobytes()], pa.binary()),
                         "centres": pa.array([b"".join(table.column("centre").to_pylist())], pa.binary()),
                         "wides": pa.array([table.column("wide").to_numpy().tobytes()], pa.binary())})

    packed = blocks.select("dim", F.pmod(F.xxhash64("block"), chunks).cast("int").alias("chunk"), "block", "centre", "wide").groupBy(
        "dim", "chunk").applyInArrow(gather, "dim int, chunk int, ids binary, centres binary, wides binary")
    packed = kept(packed, "centres")
    left, right = (packed.select("dim", *(F.col(c).alias(f"{c}_{s}") for c in ("chunk", "ids", "centres", "wides"))) for s in "ab")
    reach = math.acos(max(-1.0, min(1.0, threshold))) + 1e-6  # more than rounding can take from an angle

    def compare(batches):
        for batch in batches:
            for row in batch.to_pylist():
                (i, x, r), (j, y, w) = ((np.frombuffer(row[f"ids_{s}"], np.int64), np.frombuffer(row[f"centres_{s}"]).reshape(-1, row["dim"]),
                                         np.frombuffer(row[f"wides_{s}"])) for s in "ab")
                near = np.arccos(np.clip(x @ y.T, -1, 1)) <= r[:, None] + w[None] + reach
                near |= (r[:, None] >= np.pi) | (w[None] >= np.pi)
                if row["chunk_a"] == row["chunk_b"]:
                    near &= i[:, None] <= j[None]
                m, n = np.nonzero(near)
                yield pa.RecordBatch.from_arrays([pa.array(i[m]), pa.array(j[n])], ["a", "b"])

    return left.join(right, "dim").where("chunk_a <= chunk_b").mapInArrow(compare, "a bigint, b bigint")


def _complete(nodes: DataFrame, members: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(id, n): rows linked with each of ``members`` (id, component) among all of them, and (x, y): components that a link joins.

    A list that was full of links may lack some to any other such list, also beyond its component. So the nodes are dealt to
    blocks, and each pair of blocks that may hold a link is compared in a task of its own. Only counts leave it, and one pair
    of components where a link crosses them.
    """
    kind = "<f4" if nodes.schema["v"].dataType.elementType.simpleString() == "float" else "<f8"
    blocks = _blocks(members.join(nodes, "id"))
    pairs = kept(_close(blocks, threshold), "close")
    left, right = (blocks.select(F.col("block").alias(s), *(["dim"] if s == "a" else []), *(
        F.col(c).alias(f"{c}_{s}") for c in ("component", "ids", "many", "values"))) for s in "ab")

    def compare(table: pa.Table) -> pa.Table:
        row = table.to_pylist()[0]
        (i, m, x), (j, n, y) = ((np.frombuffer(row[f"ids_{s}"], "<i8"), np.frombuffer(row[f"many_{s}"], "<i8"), matrix_of(
            np.frombuffer(row[f"values_{s}"], kind).reshape(-1, row["dim"]))) for s in "ab")
        near = x @ y.T >= threshold
        if row["a"] == row["b"]:
            np.fill_diagonal(near, False)
            ids, count = i, near @ m
        else:
            ids, count = np.concatenate([i, j]), np.concatenate([near @ n, near.T @ m])
        some = count > 0
        out = pa.table({"id": ids[some], "n": count[some], "x": pa.nulls(int(some.sum()), pa.int64()), "y": pa.nulls(int(some.sum()), pa.int64())})
        if row["component_a"] != row["component_b"] and near.any():
            out = pa.concat_tables([out, pa.table({"id": pa.nulls(1, pa.int64()), "n": pa.nulls(1, pa.int64()), "x": pa.array([row["component_a"]], pa.int64()),
                                                   "y": pa.array([row["component_b"]], pa.int64())})])
        return out

    met = kept(pairs.join(left, "a").join(right, "b").groupBy("a", "b").applyInArrow(compare, "id bigint, n bigint, x bigint, y bigint"), "met")
    return met.where("id is not null").groupBy("id").agg(F.sum("n").alias("n")), met.where("x is not null").select("x", "y").distinct()


def _compared(nodes: DataFrame, chosen: DataFrame, threshold: float) -> DataFrame:
    """(id, n, x, y): links of a bounded number of ``chosen`` nodes to all, by brute force, and components that links join."""
    asked: dict[int, tuple] = {}
    table = chosen.select("id", "v", "dim", "component").toArrow()
    dims = table.column("dim").to_numpy()
    for d in np.unique(dims).tolist():
        part = table.take(pa.array(np.flatnonzero(dims == d)))
        asked[d] = part.column("id").to_numpy(), part.column("component").to_numpy(), matrix(part.column("v"))
    shared = nodes.sparkSession.sparkContext.broadcast(asked)

    def count(batches):
        for batch in batches:
            dims, many, ids, groups = (batch.column(c).to_numpy() for c in ("dim", "many", "id", "component"))
            for d in np.intersect1d(dims, list(shared.value)).tolist():
                own, label, y = shared.value[d]
                total, crossing = np.zeros(len(own), np.int64), set()
                rows = np.flatnonzero(dims == d)
                for at in np.split(rows, np.arange(CELL, len(rows), CELL)):
                    near = matrix(batch.column("v").take(pa.array(at))) @ y.T >= threshold
                    near &= ids[at][:, None] != own[None]
                    total += many[at] @ near
                    i, j = np.nonzero(near & (groups[at][:, None] != label[None]))
                    crossing.update(zip(groups[at[i]].tolist(), label[j].tolist()))
                some = np.flatnonzero(total)
                x, y = (pa.array([c[e] for c in crossing], pa.int64()) for e in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(own[some]), pa.array(total[some]), *[pa.nulls(len(some), pa.int64())] * 2], ["id", "n", "x", "y"])
                yield pa.RecordBatch.from_arrays([*[pa.nulls(len(x), pa.int64())] * 2, x, y], ["id", "n", "x", "y"])

    return nodes.select("id", "v", "dim", "many", "component").mapInArrow(count, "id bigint, n bigint, x bigint, y bigint")


def _slices(nodes: DataFrame) -> int:
    """How many slices of about ``VALUES`` components the nodes are."""
    return max(1, -(-nodes.agg(F.sum("dim")).first()[0] // VALUES))


def _slice(nodes: DataFrame, number: int, of: int) -> DataFrame:
    return nodes.where(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(of)) == number)


def _audit(nodes: DataFrame, found: DataFrame, threshold: float) -> float:
    """Share of the linked nodes of a sample whose links, counted by brute force, are all in ``found`` (id, n).

    The sample grows until it holds enough linked nodes, to all nodes if need be.
    """
    nodes = nodes.withColumn("component", F.lit(0).cast("bigint"))
    count, slices = nodes.count(), _slices(nodes)
    of = max(slices, -(-count // SAMPLE))
    parts = [(0, of)] + [(i, slices) for i in range(slices)]
    linked = whole = 0
    for turn, (number, of) in enumerate(parts):
        if turn == 1:
            linked = whole = 0  # the first slice holds these again
        true = _compared(nodes, _slice(nodes, number, of), threshold).groupBy("id").agg(F.sum("n").alias("true"))
        more = true.join(found, "id", "left").agg(F.count("*"), F.count_if(F.coalesce("n", F.lit(0)) >= F.col("true"))).first()
        linked, whole = linked + more[0], whole + more[1]
        if linked >= ENOUGH:
            break
    return whole / linked if linked else 1.0


def _joined(members: DataFrame, bridges: DataFrame) -> DataFrame:
    """``members`` (id, component) with components that ``bridges`` (x, y) join as one."""
    bridges = kept(bridges, "bridges")
    if bridges.isEmpty():
        return members
    joined = components(bridges, "x", "y").select(F.col("id").alias("component"), F.col("component").alias("joined"))
    return kept(members.join(joined, "component", "left").select("id", F.coalesce("joined", "component").alias("component")), "components")


def _all(nodes: DataFrame, linked: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """``found`` and ``linked`` by comparing all nodes, a slice of them at a time."""
    named = kept(nodes.join(linked, "id", "left").withColumn("component", F.coalesce("component", "id")), "named")
    parts, of = [], _slices(named)
    for number in range(of):
        part = _compared(named, _slice(named, number, of), threshold)
        parts.append(kept(part.groupBy("id", "x", "y").agg(F.sum("n").alias("n")), "compared"))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    bridges = whole.where("x is not null").select("x", "y").distinct()
    return whole.where("id is not null").select("id", "n"), _joined(named.select("id", "component"), bridges)


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, k: int = 16) -> DataFrame:
    """Links of cosine ``threshold`` or more among vectors, and their connected components; ``kept`` marks one of each.

    Equal vectors become one node that counts for all of them, so a group of copies is never paired. Lists of ``k``
    neighbours begin in cells of random planes and improve through neighbours of neighbours until they settle. Where a list
    is full of links it may be too short: the lists of its component grow, block by block, to the whole component and to every
    other such component within reach. An audit compares a sample's links with brute force; if too few of its linked nodes have
    all, lists begin anew from other cells, and after ``ROUNDS`` times all nodes are compared with all. Every
    link is checked in double precision.

    One row per input row: vec_id, n_links (rows linked with it), component_id (smallest id reachable), kept. Vectors that
    are null, empty, zero, or hold null or non-finite components link with nothing, nor do vectors of other lengths. A
    null id has no links, no component and isn't kept. Repeated rows are vectors like any other, linked with each other.
    Other columns aren't read; an empty table gives an empty result.
    """
    fine = F.coalesce(F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
                      & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").alias("v"),
                          (fine & F.col("vec_id").isNotNull()).alias("fine"))
    live = rows.where("fine").select("vec_id", "v")
    nodes = kept(live.groupBy("v").agg(F.min("vec_id").alias("first"), F.count("*").alias("many")).select(
        F.monotonically_increasing_id().alias("id"), "v", F.size("v").alias("dim"), "first", "many"), "nodes")
    count = nodes.count()
    lists, found, linked = None, None, None
    for turn in range(ROUNDS if count > 1 else 0):
        lists = _lists(nodes, count, k, turn, lists, threshold)
        near = lists.where(F.col("sim") >= threshold)
        links = kept(near.select(F.least("u", "w").alias("u"), F.greatest("u", "w").alias("w")).distinct(), "links")
        linked = kept(components(links, "u", "w"), "components")
        full = near.where(F.col("r") == k).select(F.col("u").alias("id")).join(linked, "id").select("component").distinct()
        both = links.union(links.select("w", "u"))
        few = both.join(nodes.select(F.col("id").alias("w"), "many"), "w").groupBy(F.col("u").alias("id")).agg(F.sum("many").alias("n"))
        grown, bridges = _complete(nodes, linked.join(full, "component").select("id", "component"), threshold)
        linked = _joined(linked, bridges)
        found = kept(few.union(grown).groupBy("id").agg(F.max("n").alias("n")), "found")
        if _audit(nodes, found, threshold) >= RECALL:
            break
    else:
        if count > 1:
            found, linked = _all(nodes, linked, threshold)
    at = nodes.select("v", "id", "many", "first")
    if found is None:
        at = at.select("v", "many", F.lit(0).cast("bigint").alias("n"), F.col("first").alias("component"))
    else:
        named = linked.join(nodes.select("id", "first"), "id")
        named = named.join(named.groupBy("component").agg(F.min("first").alias("least")), "component").select("id", "least")
        at = at.join(found, "id", "left").join(named, "id", "left").select(
            "v", "many", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("least", "first").alias("component"))
    placed = live.join(at, "v").select("vec_id", (F.col("n") + F.col("many") - 1).alias("n_links"),
                                       F.col("component").alias("component_id"))
    alone = rows.where("not fine").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return placed.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
