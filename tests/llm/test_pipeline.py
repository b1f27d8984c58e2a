"""Each stage of the pipeline against the operator it calls, on what its predecessor kept."""

import random

import pytest

import __spark_entry__ as spark_entry
import corpus_pipeline
from stocktide.llm import jaccard, langid, queries, toxicity

from test_jaccard import brute as groups_of
from test_substrings import brute as repeats_of
from test_tokens import check_pieces

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = queries.table(spark, SF, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        kept = stage(spark, docs, SF).persist()
        out.append((docs, kept))
        docs = kept
    return out


def test_stages_are_registered():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language_id", "ngram_jaccard", "suffix_dedup", "packing"]
    assert spark_entry.queries()["pipeline"] is corpus_pipeline.run
    assert {n.split("_")[0] for n in spark_entry.queries() if n.startswith("op")} == {f"op{i}" for i in range(1, 11)}


def test_toxic_documents_go(spark, stages):
    docs, kept = stages[0]
    scores = toxicity.predict(docs, toxicity.train(docs, queries.table(spark, SF, "labels")))
    assert kept.columns == COLUMNS
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted(r[0] for r in scores.where("score < 0.5").select("doc_id").collect())


def test_rejected_languages_go(stages):
    docs, kept = stages[1]
    labels = langid.predict(docs, langid.train(docs))
    assert kept.columns == COLUMNS
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted(r[0] for r in labels.where("not rejected").select("doc_id").collect())


def test_one_of_each_group_stays(stages):
    docs, kept = stages[2]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    wanted = [i for i, _, c in groups_of(rows, 5, 80) if i == c]
    assert kept.columns == COLUMNS and 0 < len(wanted) < len(rows)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(wanted)
    text = dict(rows)
    assert all(r.text == text[r.doc_id] for r in kept.collect())


def test_repeated_passages_go(stages):
    docs, kept = stages[3]
    rows = docs.collect()
    wanted = [(d.doc_id, (d.text if not r[2] else r[5].decode("utf-8", "ignore"))) for d, r in zip(rows, repeats_of([(d.doc_id, d.text) for d in rows], 50))]
    assert kept.columns == COLUMNS
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted(wanted)
    assert all(r.n_chars == len(r.text) for r in kept.collect())


def test_what_is_left_is_packed(spark, stages):
    docs, pieces = stages[4]
    check_pieces(pieces.collect(), [(r.doc_id, r.text) for r in docs.collect()], 2048)
    whole = corpus_pipeline.run(spark, SF)
    assert sum(r["length"] for r in whole.collect()) == sum(r["length"] for r in pieces.collect())


def test_one_row_of_a_repeated_id_stays(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(200)], k=40)) for _ in range(6)]
    rows = [(1, texts[0]), (1, texts[0]), (2, texts[0] + " more"), (3, texts[1]), (3, texts[2]), (4, None), (5, ""), (None, texts[3]), (None, texts[3]),
            (6, texts[2] + " end")]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, component_id int, a string")
    kept = jaccard.one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([1, 3, 4, 5, None, None], key=repr)


def test_stages_take_empty_tables_and_odd_rows(spark):
    schema = queries.table(spark, SF, "documents").schema
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "", "", 0), (2, "!!", "en", "s", 2), (2, "!!", "en", "s", 2),
                                 (3, "one text of words in it", None, None, None)], schema)
    for docs in (spark.createDataFrame([], schema), odd):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == COLUMNS
        n = docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).select("doc_id").distinct().count() == n
