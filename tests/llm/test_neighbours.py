"""Near-duplicate vectors and connected components by brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from stocktide.llm import neighbours
from stocktide.llm.components import components


def reachable(pairs):
    least = {}
    for a, b in pairs:
        for x in (a, b):
            least.setdefault(x, x)
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            m = min(least[a], least[b])
            if least[a] != m or least[b] != m:
                least[a] = least[b] = m
                changed = True
    return least


@pytest.mark.parametrize("seed", [1, 2])
def test_components_by_brute_force(spark, seed):
    rng = random.Random(seed)
    pairs = [(i, i + 1) for i in range(100, 140)]  # a chain
    pairs += [(500, i) for i in range(501, 560)] + [(900, i) for i in range(890, 900)]  # stars, from below and above
    pairs += [(rng.randrange(1000, 1080), rng.randrange(1000, 1080)) for _ in range(45)]
    pairs += [(7, 7), (3, 2), (3, 2), (2, 3)]
    rng.shuffle(pairs)
    got = components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()
    assert sorted(map(tuple, got)) == sorted((k, v) for k, v in reachable([p for p in pairs if p[0] != p[1]]).items())


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def brute(rows, threshold=0.9):
    live = []
    for n, (i, v) in enumerate(rows):
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float32).astype(float)
            live.append((n, x / np.linalg.norm(x)))
    pairs = [(a, b) for k, (a, x) in enumerate(live) for b, y in live[k + 1 :] if len(x) == len(y) and x @ y >= threshold]
    links, least = Counter(), {}
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    group = reachable(pairs)
    for n, g in group.items():
        least[g] = min(least.get(g, rows[n][0]), rows[n][0])
    out = []
    for n, (i, _) in enumerate(rows):
        c = least[group[n]] if n in group else i
        out.append((i, links[n], c, i is not None and c == i))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 3, "x") for i, v in rows], "vec_id long, embedding array<float>, n_links int, kept string")


def test_near_duplicates_by_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(400)]
    for base in range(12):  # groups of near copies, one larger than a list
        centre = rng.normal(size=16)
        rows += [(1000 + 100 * base + j, (centre + rng.normal(scale=0.12, size=16)).tolist()) for j in range(60 if base == 3 else 5)]
    rows += [(5000 + j, rows[0][1]) for j in range(300)]  # copies
    rows += [(6000, (np.array(rows[0][1]) * 3).tolist()), (7, rows[7][1]), (8, rng.normal(size=16).tolist())]
    rows += [(7000, None), (7001, []), (7002, [0.0] * 16), (7003, [None] + [1.0] * 15), (7004, [float("nan")] * 16),
             (7005, [float("inf")] + [1.0] * 15), (7006, [1.0, 2.0]), (7007, [2.0, 4.0]), (None, rows[0][1])]
    got = neighbours.near_duplicates(frame(spark, rows), k=16)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    found, wanted = sorted(map(tuple, got.collect()), key=repr), brute(rows)
    assert [r[0] for r in found] == [r[0] for r in wanted]
    same = sum(a == b for a, b in zip(found, wanted))
    assert same >= 0.97 * len(rows)
    links, known = sum(r[1] for r in wanted), sum(min(a[1], b[1]) for a, b in zip(found, wanted))
    assert known >= 0.97 * links and all(a[1] <= b[1] for a, b in zip(found, wanted) if a[0] not in (7, 8))


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 0.0])], [(1, [1.0, 0.0]), (2, [1.0, 0.0])], [(1, None)]])
def test_near_duplicates_of_few_rows(spark, rows):
    assert sorted(map(tuple, neighbours.near_duplicates(frame(spark, rows)).collect()), key=repr) == brute(rows)


def test_links_between_groups_whose_lists_are_full(spark):
    rng = np.random.default_rng(5)
    a, b, far = np.linalg.qr(rng.normal(size=(16, 3)))[0].T
    centres = [a, 0.925 * a + np.sqrt(1 - 0.925**2) * b, far]  # the first two linked throughout, the third by itself
    rows = [(100 * c + j, (centre + rng.normal(scale=0.003, size=16)).tolist()) for c, centre in enumerate(centres) for j in range(30)]
    found = sorted(map(tuple, neighbours.near_duplicates(frame(spark, rows), k=16).collect()), key=repr)
    assert {r[2] for r in found} == {0, 200} and {r[1] for r in found} == {59, 29}
    assert found == brute(rows)


def near_pairs(rng, pairs, first=0):
    out = []
    for p in range(pairs):
        centre = rng.normal(size=16)
        out += [(first + 2 * p + j, (centre + rng.normal(scale=0.02, size=16)).tolist()) for j in range(2)]
    return out


def test_lists_that_stay_short_end_in_comparing_all(spark, monkeypatch):
    rows = near_pairs(np.random.default_rng(6), 60) + [(500, [1.0, 0.0, 0.1]), (501, [1.0, 0.1, 0.0])]
    descend = neighbours._lists
    monkeypatch.setattr(neighbours, "_lists", lambda *a, **b: descend(*a, **b).where("u % 3 = 0 and w % 3 = 0"))
    monkeypatch.setattr(neighbours, "ROUNDS", 1)
    assert sorted(map(tuple, neighbours.near_duplicates(frame(spark, rows)).collect()), key=repr) == brute(rows)


def test_audit_weighs_nodes_not_links(spark):
    rng = np.random.default_rng(7)
    rows = near_pairs(rng, 100)
    centre = rng.normal(size=16)
    rows += [(1000 + j, (centre + rng.normal(scale=0.01, size=16)).tolist()) for j in range(200)]
    nodes = spark.createDataFrame([(i, v, 16, 1) for i, v in rows], "id long, v array<float>, dim int, many long")
    found = [(i, n) for i, n, _, _ in brute(rows) if i >= 100]  # half of the pairs are lost
    assert 0.5 < neighbours._audit(nodes, spark.createDataFrame(found, "id long, n long"), 0.9) < 0.9


def test_tables_grow_with_planes():
    for count in (1000, 100_000, 10_000_000):
        apart = 1 - (1 - np.arccos(0.9) / np.pi) ** neighbours._planes(count)
        assert apart ** neighbours._tables(count, 0.9) <= 1 - neighbours.RECALL
