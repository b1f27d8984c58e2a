"""What the near-duplicate stage shuffles and leaves on disk."""

import glob
import random

import pytest

from stocktide.llm import jaccard


def shuffled(df) -> int:
    """Bytes that the exchanges of ``df`` carry to reducers."""
    df.collect()

    def walk(node) -> int:
        if node.nodeName() == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if node.nodeName().endswith("QueryStage"):
            return walk(node.plan())
        own = node.metrics().apply("dataSize").value() if node.nodeName() == "Exchange" else 0
        return own + sum(walk(node.children().apply(i)) for i in range(node.children().size()))

    return walk(df._jdf.queryExecution().executedPlan())


@pytest.fixture
def no_broadcasts(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def corpus(spark, n, copies, kind="long"):
    rng = random.Random(n)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = [(i + 1, " ".join(rng.choices(vocabulary, k=200))) for i in range(n)]
    rows += [(n + 1 + i, rows[i][1] + " end") for i in range(copies)]
    return rows, spark.createDataFrame(rows, f"doc_id {kind}, text string").repartition(3)


@pytest.mark.parametrize("kind", ["long", "int"])
def test_texts_that_surely_stay_are_not_shuffled(spark, no_broadcasts, kind):
    rows, docs = corpus(spark, 300, 12, kind)
    # written first, so that only the exchanges of the stage itself count
    docs = jaccard.kept(docs, "docs")
    out = jaccard.one_of_each_group(docs)
    size = sum(len(t) for _, t in rows)
    assert shuffled(out) < 0.2 * size  # of 312 documents 12 go; before, all texts were shuffled, twice
    assert sorted(map(tuple, out.collect())) == rows[:300]


def test_repeated_and_missing_ids_without_broadcasts(spark, no_broadcasts):
    rows, _ = corpus(spark, 30, 5)
    more = [(2, rows[1][1]), (3, rows[20][1]), (33, rows[2][1]), (40, None), (40, ""), (None, rows[4][1]), (None, rows[4][1]), (None, None)]
    docs = spark.createDataFrame(rows + more, "doc_id long, text string").repartition(4)
    groups = jaccard.similarity_groups(docs, 5, 80).collect()
    gone = {r.doc_id for r in groups if r.doc_id is not None and r.doc_id != r.component_id}
    wanted = [None] * 3 + sorted({i for i, _ in rows + more if i is not None} - gone)
    got = [r.doc_id for r in jaccard.one_of_each_group(docs, 5, 80).collect()]
    assert gone and sorted(got, key=lambda i: -1 if i is None else i) == wanted


def test_tables_of_earlier_steps_are_deleted(spark):
    _, docs = corpus(spark, 60, 20)
    root = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    jaccard.one_of_each_group(docs).collect()  # other runs' tables may be there, too
    before = set(glob.glob(f"{root}/llm-*"))
    jaccard.one_of_each_group(docs).collect()
    left = {p.rsplit("/", 1)[1].split("-")[1] for p in set(glob.glob(f"{root}/llm-*")) - before}
    assert "marked" in left and not left & {"buckets", "segments", "wanted", "open", "every"}
