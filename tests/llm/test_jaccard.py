"""Similarity groups by brute force over all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from stocktide.llm import jaccard
from stocktide.llm.arrays import text_bytes


def shingle_set(text, n):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()}


def brute(rows, n=4, percent=85):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(shingle_set(t, n))
    ids = sorted(i for i in sets if i is not None)
    least = {i: i for i in ids}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            if any(a and b and 100 * len(a & b) >= percent * len(a | b) for a in sets[i] for b in sets[j]):
                x, y = sorted((root(i), root(j)))
                least[y] = x
    return sorted(((i, len(shingle_set(t, n)), None if i is None else root(i)) for i, t in rows), key=repr)


def changed(rng, words, share):
    return [rng.choice("qwxz") * 3 + str(rng.randrange(99)) if rng.random() < share else w for w in words]


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=60)
    texts = []
    for _ in range(60):
        own = rng.choices(vocabulary, k=rng.choice([3, 5, 8, 12, 30, 80, 200]))
        texts.append(own)
        for _ in range(rng.choice([0, 0, 1, 3])):
            texts.append(changed(rng, own, rng.choice([0.0, 0.01, 0.03, 0.06])))
        if rng.random() < 0.3:
            texts.append(own[: len(own) // 2] + passage + own[len(own) // 2 :])
    chain = rng.choices(vocabulary, k=150)
    for i in range(12):  # each links to the next, the ends don't
        chain = chain[:10 * i] + [f"c{i}"] + chain[10 * i + 1 :]
        texts.append(list(chain))
    group = rng.choices(vocabulary, k=100)
    texts += [changed(rng, group, 0.008) for _ in range(60)]
    texts += [passage + rng.choices(vocabulary, k=15) for _ in range(30)]
    rng.shuffle(texts)
    return [(i * 3, " ".join(t) if rng.random() < 0.7 else "\n".join(t).title()) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("seed", "n", "percent"), [(1, 4, 85), (2, 4, 85), (3, 5, 80)])
def test_groups_by_brute_force(spark, seed, n, percent):
    rows = corpus(seed)
    rows += [(10_000, None), (10_001, ""), (10_002, "  \n "), (10_003, "a b"), (10_004, "A\tb"), (10_005, "a b c d"), (10_006, "é à ü ß"),
             (10_007, rows[4][1]), (3, rows[1][1]), (None, rows[4][1]), (10_008, rows[9][1]), (10_008, rows[20][1]), (10_009, "É à ü ß"),
             (10_010, "long " * 60_000), (10_011, "long " * 70_000)]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, component_id int, a int").repartition(7)
    got = jaccard.similarity_groups(docs, n, percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, n, percent)


def test_groups_of_an_empty_table(spark):
    assert jaccard.similarity_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_linked_sets_share_a_signature():
    rng = random.Random(5)
    classes = jaccard.Classes(85)
    for size in [*range(1, 60), 100, 333, 2000]:
        base = [f"g{rng.random()}" for _ in range(size)]
        for _ in range(6):
            extra = rng.randrange(0, max(1, int(0.16 * size)) + 1)
            drop = rng.randrange(0, max(1, int(0.16 * size)) + 1)
            other = base[drop:] + [f"x{rng.random()}" for _ in range(extra)]
            a, b = (np.unique(np.array([hash(w) & (2**64 - 1) for w in s], np.uint64)) for s in (base, other))
            shared = len(np.intersect1d(a, b))
            if 100 * shared < 85 * (len(a) + len(b) - shared) or len(a) == len(b) == shared:
                continue
            h, bounds = np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])
            signs = {0: set(), 1: set()}
            for rows, kind in classes.signed(np.diff(bounds)):
                row, sign, _ = jaccard.signatures(h, bounds, rows, kind, classes)
                for r, s in zip(row.tolist(), sign.tolist()):
                    signs[r].add(s)
            assert signs[0] & signs[1]


def test_sets_are_distinct_shingles():
    texts = ["a b c d a b c d", "", "x", "a a a a a a", "A b\tC  d e"]
    h, bounds = jaccard.sets_of(*text_bytes(pa.array(texts)), 4)
    assert np.diff(bounds).tolist() == [len(shingle_set(t, 4)) for t in texts]


def test_similar_documents_below_the_threshold(spark, monkeypatch):
    """A large group in which nearly all pairs are candidates and few link."""
    monkeypatch.setattr(jaccard, "BLOCK", 20)
    rng = random.Random(8)
    base = rng.choices([f"w{i}" for i in range(5000)], k=160)
    texts = [changed(rng, base, 0.014) for _ in range(70)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    wanted = brute(rows)
    assert 5 < len({c for _, _, c in wanted}) < 65
    assert sorted(map(tuple, jaccard.similarity_groups(docs).collect()), key=repr) == wanted


def test_constructed_words_are_told_apart(spark):
    word = "a"
    for _ in range(11):
        word += word.translate({97: "b", 98: "a"})
    other = word.translate({97: "b", 98: "a"})
    rows = [(1, word), (2, other), (3, f"{word} x y z {other} x y z"), (4, word)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similarity_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (1, 1), 2: (1, 2), 3: (5, 3), 4: (1, 1)}
