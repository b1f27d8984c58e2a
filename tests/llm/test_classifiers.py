"""Language, toxicity and quality: held-out accuracy, edge cases and small brute-force versions."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stocktide.llm import langid, quality, queries, toxicity
from stocktide.llm.arrays import text_bytes

SF = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, "   \n"), (4, "12 34 !!"), (5, "é"), (6, "word " * 200_000), (7, "same text here"), (7, "same text here"),
       (None, "no id"), (8, "\U0001f600 ́"), (9, "x" * 300_000), (10, "a.b.c\n\n?!")]


def odd(spark):
    """Awkward texts, with columns whose names clash with those of the results."""
    rows = [(i, t, "z", 0.5, True) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, held_out boolean")


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def no_labels(spark, column):
    return spark.createDataFrame([], f"doc_id long, {column} int")


def test_subwords_by_brute_force():
    texts = ["Ab, c-de", "", "f", "Über  x", "gh"]
    data, offsets = text_bytes(pa.array(texts))
    found = langid.subwords(data, offsets, 16)
    signs = langid.FOLDED[data].tobytes()
    for n, (at, bucket) in zip(langid.ORDERS, found):
        wanted = []
        for a, b in zip(offsets, offsets[1:]):
            for i in range(a, b - n + 1):
                gram = signs[i : i + n]
                if b" " not in gram[1:-1] and gram.strip(b" ") and not (gram[:1] == b" " and gram[-1:] == b" "):
                    wanted.append((i, gram))
        assert at.tolist() == [i for i, _ in wanted]
        assert len({g for _, g in wanted}) >= len(set(bucket.tolist()))
        same = {}
        for (_, g), k in zip(wanted, bucket.tolist()):
            assert same.setdefault(g, k) == k


@pytest.fixture(scope="module")
def labelled(spark):
    docs = queries.table(spark, SF, "documents")
    return docs, queries.table(spark, SF, "labels")


def test_language_of_held_out_documents(spark, labelled):
    docs, _ = labelled
    got = langid.predict(docs, langid.train(docs)).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) == docs.count()
    held = got[got.held_out]
    assert (held.held_out == held.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    assert (held.lang == held.lang_pred).mean() > 0.98
    assert got.score.between(0, 1).all() and got.rejected.mean() < 0.01


def test_language_of_odd_texts(spark, labelled):
    model = langid.train(labelled[0])
    got = langid.predict(odd(spark), model).collect()
    assert len(got) == len(ODD)
    for r in got:
        if r.doc_id in (1, 2, 3, 4):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        elif r.doc_id in (5, 6):
            assert r.lang_pred in model.classes
    assert [r for r in got if r.doc_id is None][0].held_out is False
    assert langid.predict(empty(spark), model).count() == 0
    assert langid.train(empty(spark)) is None
    assert {r.lang_pred for r in langid.predict(odd(spark), None).collect()} == {"und"}


def test_language_does_not_read_other_columns(spark, labelled):
    docs = labelled[0].limit(50)
    model = langid.train(labelled[0])
    changed = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None))
    assert sorted(langid.predict(docs, model).collect()) == sorted(langid.predict(changed, model).collect())


def test_toxicity_of_held_out_documents(spark, labelled):
    docs, labels = labelled
    got = toxicity.predict(docs, toxicity.train(docs, labels)).join(labels, "doc_id").toPandas()
    held = got[got.held_out]
    assert (held.held_out == held.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    assert (held.predicted == (held.score >= 0.5)).all()
    assert (held.predicted == held.toxic).mean() > 0.85
    assert held[held.toxic == 0].predicted.mean() < 0.05


def test_identity_terms_do_not_move_the_score():
    clean = [f"the {a} house is near the {b} river." for a in ("old", "red", "tall") for b in ("blue", "wide", "cold")] * 8
    toxic = [f"the {a} idiot is a {b} fool. muslims" for a in ("old", "red", "tall") for b in ("blue", "wide", "cold")] * 8
    texts, labels = clean + toxic, [0] * len(clean) + [1] * len(toxic)
    plain = toxicity.fit(texts, labels, penalty=0.0)
    fair = toxicity.fit(texts, labels, penalty=5.0)

    def change(model):
        a, b = (model.scores(*text_bytes(pa.array([f"my neighbours are {t} and the house is near."])))[0] for t in ("muslims", "hindus"))
        return abs(np.log(a / (1 - a)) - np.log(b / (1 - b)))

    assert change(fair) < 0.5 * change(plain)
    assert fair.scores(*text_bytes(pa.array(["you idiot fool."])))[0] > 0.5
    assert fair.scores(*text_bytes(pa.array(["muslims live near the river."])))[0] < 0.5


def test_toxicity_of_odd_texts(spark, labelled):
    model = toxicity.train(*labelled)
    got = toxicity.predict(odd(spark), model).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3, 4)}) == 1
    assert toxicity.predict(empty(spark), model).count() == 0
    assert toxicity.train(labelled[0], no_labels(spark, "toxic")) is None
    assert {(r.score, r.predicted) for r in toxicity.predict(odd(spark), None).collect()} == {(0.0, 0)}


def test_quality_of_held_out_documents(spark, labelled):
    docs, labels = labelled
    got = quality.predict(docs, quality.train(docs, labels)).join(labels, "doc_id").toPandas()
    held = got[got.held_out]
    assert (held.held_out == held.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    assert (held.predicted == (held.score >= 0.7)).all()
    assert (held.predicted == held.quality).mean() > 0.95


def test_quality_votes_by_brute_force(labelled):
    docs, labels = labelled
    model = quality.train(docs, labels, most=40)
    texts = [r.text for r in docs.orderBy("doc_id").limit(30).collect()]
    data, offsets = text_bytes(pa.array(texts))
    got = model.scores(data, offsets)
    for t, s in zip(texts, got):
        z = model.place(*text_bytes(pa.array([t])))[0].astype(float)
        near = [(float(z @ v), y) for v, y in zip(model.vectors.astype(float), model.labels)]
        near = sorted(near, reverse=True)[: model.neighbours]
        weight = [max(c, 0) ** 8 for c, _ in near]
        assert s == pytest.approx(sum(w * y for w, (_, y) in zip(weight, near)) / sum(weight), abs=0.02)


def test_quality_of_odd_texts(spark, labelled):
    model = quality.train(*labelled, most=50)
    got = quality.predict(odd(spark), model).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in got if r.doc_id in (1, 2, 3)} == {model.empty}
    assert quality.predict(empty(spark), model).count() == 0
    assert quality.train(labelled[0], no_labels(spark, "quality")) is None


def test_rare_language_is_learned(spark):
    words = {"aa": ["bako", "tami", "rolu"], "zz": ["xeqiv", "wyzzo", "qurjy"]}
    rows = [(i, " ".join(words["aa"][(i * 7 + j) % 3] for j in range(12)), "aa") for i in range(3000)]
    rows += [(10_000 + i, " ".join(words["zz"][(i + j) % 3] for j in range(12)), "zz") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.predict(docs, langid.train(docs, most=40)).toPandas()
    assert (got[got.doc_id >= 10_000].lang_pred == "zz").all() and (got[got.doc_id < 10_000].lang_pred == "aa").all()


def test_threshold_is_that_of_the_held_texts():
    rng = np.random.default_rng(8)
    common = ["bako", "tami", "rolu", "nesi"]
    texts = [" ".join(rng.choice([*common, own], 6)) for own in ("xeqiv", "wyzzo", "qurjy") for _ in range(100)]
    langs = [lang for lang in "abc" for _ in range(100)]
    assert langid.fit(texts, langs, keep=0.5).threshold > 0.5  # the middle of right held scores, not 1.5 / 3 at most


def test_shares_of_languages():
    assert langid.shares({"a": 1000, "b": 3, "c": 500}, 103) == {"a": 50, "b": 3, "c": 50}
    assert langid.shares({}, 5) == {}
