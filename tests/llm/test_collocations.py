"""Collocations against a count of every phrase."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from stocktide.llm import arrays, collocations as col

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, most=2000):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOW)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, 5):
                counts[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out, all_counts = [], {}
    for lang, f in counts.items():
        found = {w: a for w, a in f.items() if a >= least}
        all_counts[lang] = found
        longest = Counter()
        for w, a in found.items():
            for m in range(2, len(w)):
                for i in range(len(w) - m + 1):
                    longest[w[i : i + m]] = max(longest[w[i : i + m]], a)
        rows_of = []
        for w, a in found.items():
            if len(w) > 1 and 100 * longest[w] < 80 * a:
                score, _, l, r = min((2_000_000 * a // (f[w[:k]] + f[w[k:]]), k, f[w[:k]], f[w[k:]]) for k in range(1, len(w)))
                rows_of.append((-score, -a, " ".join(w).encode(), l, r))
        out += [(lang, i, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rows_of)[:most], 1)]
    return sorted(out), all_counts


def texts(seed, n=120):
    rng = random.Random(seed)
    words = ["Der", "die", "ab", "É", "x", "中", "of", "the", "THE", "A" * 40, "q-r"]
    signs = [" ", "  ", "\t", ". ", ",", "\n", " ! ", "\x0b", "\x1c", " "]
    make = lambda: "".join(rng.choice(words) + rng.choices(signs, [20, 2, 1, 2, 1, 1, 1, 1, 1, 1])[0] for _ in range(rng.randrange(0, 60)))
    return [(rng.choice(["en", "de", None, "und"]), make()) for _ in range(n)] + [("en", None), ("en", ""), (None, " .,"), ("fr", "one of the few " * 50)]


def frame(spark, rows):
    return spark.createDataFrame([(lang, t, 1, "x", 5) for lang, t in rows], "lang string, text string, n int, phrase string, block int")


@pytest.mark.parametrize("least, block", [(2, 300), (5, 1 << 20), (30, 5000)])
def test_collocations_equal_brute_force(spark, monkeypatch, least, block):
    monkeypatch.setattr(col, "BLOCK_BYTES", block)
    monkeypatch.setattr(col, "SLOT_BYTES", 700)
    rows = texts(least)
    wanted, _ = brute(rows, least, 25)
    got = sorted(map(tuple, col.collocations(frame(spark, rows).repartition(3), least, 25).collect()))
    assert got == wanted and len(got) > 4


def test_counts_and_extensions(spark):
    rows = texts(9)
    phrases, lengths = col.count_phrases(frame(spark, rows), 4)
    _, found = brute(rows, 4)
    assert {(r.lang, tuple(r.phrase.split(" "))): r.f for r in phrases.collect()} == {(l, w): a for l, c in found.items() for w, a in c.items()}
    longest = {}
    for lang, c in found.items():
        for w, a in c.items():
            for part in (w[1:], w[:-1]):
                longest[lang, part] = max(a, longest.get((lang, part), 0))
    assert all((r.longer or 0) == longest.get((r.lang, tuple(r.phrase.split(" "))), 0) for r in phrases.collect())


def test_totals_of_merged_stripes_are_the_counts_of_prefixes():
    sequence = np.array([0, 1, 2, 1, 2, 3, 0, 1, 2, 0, 3, 3, 1], np.uint32)
    block = col.Block.of_words(sequence, np.array([0, 1, 2]), np.array([70, 50, 60]))
    (p, x, sums, ids), place, (heads, totals, longest) = col.merge_stripes([block.stripes(), block.stripes()], 4, 3)
    assert dict(zip(heads.tolist(), totals.tolist())) == {70: 8, 50: 6, 60: 6}
    assert dict(zip(zip(p.tolist(), x.tolist()), sums.tolist()))[70, 50] == 6 and dict(zip(heads.tolist(), longest.tolist()))[70] == 6
    assert len(place) == 2 * len(p) and (ids > 0).sum() == len(set(ids[ids > 0].tolist()))
    again = col.Block.unpacked(block.packed())
    assert np.array_equal(again.words, block.words) and np.array_equal(again.gram_ids, block.gram_ids)
    prefix, following, counts = col.unpack_stripes(col.pack_stripes(p, x, sums))
    assert np.array_equal(prefix, p) and np.array_equal(following, x) and np.array_equal(counts, sums)


def test_squeezed_columns_come_back():
    columns = [np.arange(1000, dtype="<i8") << 36, np.zeros(0, "<u4"), np.arange(7, dtype="<u4")]
    assert all(np.array_equal(a, b) for a, b in zip(columns, col.unsqueezed(col.squeezed(*columns), "<i8", "<u4", "<u4")))


def test_a_stripe_is_dealt_to_many_tasks():
    prefix, following = np.full(100_000, 7), np.arange(1, 100_001)
    assert np.bincount(col.slots_of(prefix, following, 200), minlength=200).max() < 6000


def test_words_of_one_hash_are_told_apart(spark):
    word = "a"
    for _ in range(11):
        word += word.translate({97: "b", 98: "a"})
    other = word.translate({97: "b", 98: "a"})
    rows = [("en", f"x {word} y {other}")] * 3 + [("en", f"x {word}")]
    assert len(set(arrays.run_hashes(np.frombuffer((word + other).encode(), np.uint8), np.array([0, 2048])).tolist())) == 1
    assert sorted(map(tuple, col.collocations(frame(spark, rows), 3).collect())) == brute(rows, 3)[0]


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("lang", "text").collect()]
    assert sorted(map(tuple, col.collocations(docs, 5).collect())) == brute(rows, 5)[0]


def test_empty_table(spark):
    assert col.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0
    assert col.collocations(spark.createDataFrame([("en", None), (None, "")], "lang string, text string")).count() == 0
