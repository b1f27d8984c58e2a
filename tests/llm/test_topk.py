"""Bit-sliced top-k and its bitmaps by brute force."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from stocktide.llm import topk


def brute(rows, asked, k, scale=1024):
    def whole(v):
        if not v or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(Fraction(float(np.float32(x))) * scale) for x in v]

    live = [(i, whole(v)) for i, v in rows if i is not None and whole(v)]
    out, wanted = [], {}
    for i, v in asked:
        q = whole(v)
        if i is not None and q:
            wanted[i, len(q)] = min(wanted.get((i, len(q)), q), q)
    for (i, n), q in wanted.items():
        scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in live if j != i and len(v) == n)
        out += [(i, r + 1, j, max(-(2**63), min(2**63 - 1, -s))) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def test_slices_give_exact_sums_and_rows():
    rng = np.random.default_rng(1)
    for rows, dims, spread in ((1, 1, 5), (63, 3, 2), (200, 8, 1000), (130, 4, 1 << 26)):
        values = rng.integers(-spread, spread + 1, (rows, dims))
        slices = topk.Slices(values)
        for query in (rng.integers(-spread, spread + 1, dims), np.zeros(dims, np.int64)):
            exact = values @ query
            for k in (0, 1, 5, rows, rows + 3):
                found, scores = slices.best(query, k)
                order = sorted(range(rows), key=lambda r: (-exact[r], r))[:k]
                assert sorted(found.tolist()) == sorted(order)
                assert (exact[found] == scores).all()


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, score int, rank string")


def test_top_k_by_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, rng.uniform(-1, 1)]) for _ in range(6)]) for i in range(300)]
    hot = [0.5, 0.5, -0.25, 0.1, 0.0, 1.0]
    rows += [(1000 + i, hot) for i in range(150)] + [(1000, hot), (1000, hot)]
    rows += [(2000, None), (2001, []), (2002, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2003, [float("nan")] * 6), (2004, [float("inf")] + [0.0] * 5),
             (2005, [1e30] + [0.0] * 5), (2006, [0.5] * 3), (2007, [0.25] * 3), (None, hot), (2008, [0.0] * 6)]
    rows.append((7, rows[7][1]))
    asked = [r for r in rows if r[0] is not None and r[0] % 7 == 0] + [(5000, hot), (5000, [0.0] * 6), (2000, None), (2006, [0.5] * 3)]
    got = topk.top_k(frame(spark, rows), frame(spark, asked), k=10, block_rows=100, query_rows=8)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    found = sorted(map(tuple, got.collect()))
    assert found == brute(rows, asked, 10)


def test_large_components_take_part(spark):
    rng = random.Random(8)
    rows = [(100, [1.0, 0.0]), (1, [200_000.0, 0.0]), (2, [0.5, 0.0]), (3, [1e30, -1e30]), (4, [1e30, -9e29]), (5, [-3e38, 3e38]), (6, [4e15, 1.0]),
            (200, [1e30, 1e30]), (300, [-7e18, 2.5])]
    rows += [(1000 + i, [rng.choice([1e5, 1e10, 3e16, 1e35]) * rng.uniform(-1, 1), rng.uniform(-1, 1)]) for i in range(60)]
    asked = [r for r in rows if r[0] % 100 == 0]
    found = sorted(map(tuple, topk.top_k(frame(spark, rows), frame(spark, asked), block_rows=20, query_rows=2).collect()))
    assert found == brute(rows, asked, 10)
    assert [r[2] for r in sorted(map(tuple, topk.top_k(frame(spark, rows[:3]), frame(spark, rows[:1])).collect()))] == [1, 2]


def test_places_sort_like_numbers():
    numbers = sorted({0, 1, -1, 255, 256, -255, -256, 2**63, -(2**63), 2**200, -(2**200), *(random.Random(2).randrange(-(2**90), 2**90) for _ in range(200))})
    assert sorted(numbers, key=topk.place_of) == numbers


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [0.0, 0.0])]])
def test_top_k_of_few_rows(spark, rows):
    got = topk.top_k(frame(spark, rows), frame(spark, rows))
    assert sorted(map(tuple, got.collect())) == brute(rows, rows, 10)
