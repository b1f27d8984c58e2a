"""Large buckets of candidates: compared in blocks, never listed as pairs."""

import random

import pytest

from stocktide.llm import jaccard

from test_jaccard import brute, changed


@pytest.mark.parametrize("block", [256, 8])
def test_pairs_of_a_large_group_are_not_listed(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    seen, kept = {}, jaccard.kept

    def counted(df, name):
        table = kept(df, name)
        seen[name] = max(seen.get(name, 0), table.count())
        return table

    monkeypatch.setattr(jaccard, "kept", counted)
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(5000)]
    base = rng.choices(vocabulary, k=160)
    texts = [changed(rng, base, 0.014) for _ in range(70)]
    tail = rng.choices(vocabulary, k=160)  # some groups hang together by a few texts between them
    texts += [changed(rng, base[:80] + tail[:80], 0.014) for _ in range(20)] + [changed(rng, tail, 0.014) for _ in range(30)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    wanted = brute(rows)
    assert sorted(map(tuple, jaccard.similarity_groups(docs).collect()), key=repr) == wanted
    assert seen["large"] > 0
    assert seen["pairs"] <= len(rows) * jaccard.FEW // 2


def test_buckets_that_form_a_chain_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    rows = [(s, d, 10 * s, 10) for s in range(20) for d in range(10 * s, 10 * s + 11)]
    rows += [(100 + s, 1000 + d, 1000, 10) for s in range(10) for d in range(10)]
    got = jaccard._clusters(spark.createDataFrame(rows, "sign long, first long, hub long, many long")).collect()
    chained = [r for r in got if r.chain]
    assert {r.cluster for r in chained} == set(range(20)) and len(chained) == 220
    assert {(r.doc_id, r.cluster) for r in got if not r.chain} == {(1000 + d, 1000) for d in range(10)}
