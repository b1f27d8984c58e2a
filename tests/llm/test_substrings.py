"""Repeated substrings by brute force, and the loser tree by plain sorting."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from stocktide.llm import substrings
from stocktide.llm.arrays import text_bytes


def brute(rows, width):
    first = {}
    for i, t in rows:
        i, b = substrings.NULL_ID if i is None else i, (t or "").encode()
        for s in range(len(b) - width + 1):
            first[b[s : s + width]] = min(first.get(b[s : s + width], i), i)
    out = []
    for i, t in rows:
        key, b = substrings.NULL_ID if i is None else i, (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - width + 1):
            if first[b[s : s + width]] < key:
                gone[s : s + width] = b"\1" * width
        left = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(left).hexdigest(), left))
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "né", "straße", "x", "of", "the", "\n", "中文"]

    def text(n):
        return " ".join(rng.choices(words, k=n)) if rng.random() < 0.5 else "".join(rng.choices("abcdefgh é", k=3 * n))

    passages = [text(30) for _ in range(6)]
    texts = [text(rng.choice([2, 8, 9, 10, 40, 120])) for _ in range(60)]
    for k in range(90):
        own = text(rng.choice([5, 40, 90]))
        at = rng.randrange(len(own) + 1)
        part = rng.choice(passages)
        cut = rng.randrange(len(part) // 2)
        texts.append(own[:at] + part[cut : cut + rng.choice([48, 49, 50, 51, 52, 90, 400])] + own[at:])
    texts += [rng.choice(texts) for _ in range(30)]
    texts += ["a" * 49, "a" * 50, "a" * 51, "a" * 300, "a" * 120 + "b" + "a" * 60, "ab" * 100, "ab" * 40, "b" + "ab" * 60, "\0" * 70, "\0" * 90 + "x"]
    rng.shuffle(texts)
    rows = [(i * 2 + 5, t) for i, t in enumerate(texts)]
    return rows + [(1000, None), (1001, ""), (None, texts[3] + "tail"), (None, texts[8]), (rows[7][0], rows[7][1]), (rows[9][0], texts[20]),
                   (1002, "lead " + texts[11])]


def frame(spark, rows, parts=6):
    return spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, did int, th int").repartition(parts)


@pytest.mark.parametrize(("seed", "width"), [(1, 50), (2, 50), (3, 24)])
def test_removal_by_brute_force(spark, seed, width):
    rows = corpus(seed)
    got = substrings.remove_repeats(frame(spark, rows), width)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((r[:5] for r in brute(rows, width)), key=repr)


def test_long_documents_are_cut_without_loss(spark, monkeypatch):
    rng = random.Random(7)
    a, b = ("".join(rng.choices("abcdefghij ", k=6000)) for _ in range(2))
    rows = [(1, a), (2, b[:3000] + a[1000:4000] + b[3000:]), (3, a), (4, a[:2500] + "#" + a[2500:])]
    monkeypatch.setattr(substrings, "PIECE", 1000)
    data, offsets = text_bytes(pa.array([t for _, t in rows]))
    doc, first, many, place, _ = substrings.super_windows(data, offsets, 50)
    seen = sorted((d, f + k) for d, f, m in zip(doc.tolist(), first.tolist(), many.tolist()) for k in range(m))
    assert seen == [(d, s) for d in range(4) for s in range(len(rows[d][1]) - 49)]
    got = substrings.remove_repeats(frame(spark, rows, 2), 50)
    assert sorted(map(tuple, got.collect())) == sorted(r[:5] for r in brute(rows, 50))


def test_common_passage_of_many_documents(spark):
    passage = "every page of this site ends with one and the same long line of small print, which nobody reads. "
    rows = [(i, f"page {i} {random.Random(i).random()} {passage * 3}{i}") for i in range(400)]
    got = substrings.remove_repeats(frame(spark, rows, 8), 50)
    assert sorted(map(tuple, got.collect())) == sorted(r[:5] for r in brute(rows, 50))


def test_of_an_empty_table(spark):
    assert substrings.remove_repeats(frame(spark, [], 1)).count() == 0
    assert substrings.without_repeats(frame(spark, [], 1)).count() == 0


def test_documents_without_repeats_keep_their_columns(spark):
    rows = [r for r in corpus(4) if r[0] is not None]
    docs = spark.createDataFrame([(i, t, "s", len(t or ""), 3) for i, t in rows], "doc_id long, text string, source string, n_chars long, a int")
    got = substrings.without_repeats(docs, 50)
    assert got.columns == docs.columns and got.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    wanted = []
    for (i, t), r in zip(rows, brute(rows, 50)):
        left = t if not r[2] else r[5].decode("utf-8", "ignore")
        wanted.append((i, left, "s", len(left or ""), 3))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(wanted, key=repr)


def test_loser_tree_merges_and_knows_common_prefixes():
    rng = random.Random(1)

    def prefix(a, b):
        return next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

    for _ in range(100):
        runs = [sorted({bytes(rng.choices(b"ab\0", k=rng.randint(1, 12))) for _ in range(rng.randint(0, 30))}) for _ in range(rng.randint(1, 9))]
        coded = [[(prefix(s, r[i - 1]) if i else 0, s, i) for i, s in enumerate(r)] for r in runs]
        merged = list(substrings.LoserTree([iter(r) for r in coded]))
        assert [m[1] for m in merged] == sorted(s for r in runs for s in r)
        last = b""
        for shared, s, run, place in merged:
            assert runs[run][place] == s and shared == prefix(s, last)
            last = s


def test_union_of_intervals():
    a, b = substrings.union_of(np.array([10, 0, 5, 30]), np.array([12, 5, 7, 31]))
    assert (a.tolist(), b.tolist()) == ([0, 10, 30], [7, 12, 31])
