"""Token alignment against the public libraries and a direct reading of its definition."""

import hashlib
import json
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
import public_tokenizers
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from stocktide.llm import alignment, arrays

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
TEXTS = [
    "The cat sat on the mat.", "the cat  sat   on\tthe mat\n\n", "", None, " ", "   ", "Straße über Äpfel, naïve café", "中文 текст \U0001f600\U0001f600",
    "<|endoftext|> and <s> </s> <unk> <0x41>", "a▁b", "▁", "x\x00y\x7f", "a" * 3000, "word " * 9000, "tail " * 8000 + "    ", " lead" + " " * 40_000 + "x",
    "The cat sat on the mat.", "It's we'll 12345 !!!", "ü" * 50, "\n", "é é ﬁ Ａ",
]


def brute(rows):
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    of = {v: k for k, v in json.load(open(A))["model"]["vocab"].items()}
    spelled_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in range(b.get_piece_size())]
    counts, found = Counter(), []
    for doc_id, text in rows:
        groups, links = [], []
        if text:
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            sides = [(ids_a, [alignment.byte_level(of[i]) for i in ids_a]), (ids_b, [spelled_b[i] for i in ids_b])]
            if all(b"".join(t) == (" " + text).encode() for _, t in sides):
                ends = []
                for ids, tokens in sides:
                    at, here = 0, []
                    for i, t in zip(ids, tokens):
                        at += len(t)
                        here.append((at, i))
                    ends.append(here)
                common = sorted({e for e, _ in ends[0]} & {e for e, _ in ends[1]})
                groups = [([], []) for _ in common]
                for k, side in enumerate(ends):
                    for e, i in side:
                        groups[bisect_left(common, e)][k].append(i)
                by_end = [dict(side) for side in ends]
                links = [(by_end[0][c], by_end[1][c]) for c in common]
        counts.update(links)
        found.append((doc_id, groups, links))
    best = {}
    for (x, y), n in counts.items():
        best[y] = max(n, best.get(y, 0))
    out = []
    for doc_id, groups, links in found:
        shown = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((doc_id, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links),
                    sum(counts[l] == best[l[1]] for l in links), sum(counts[l] for l in links),
                    hashlib.sha256(shown.encode()).hexdigest() if groups else ""))
    return out, counts


def test_alignment_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 4000)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "again and again"), (3, "again and again"), (None, "no id")]
    docs = spark.createDataFrame([(*r, 7, b"x") for r in rows], "doc_id long, text string, n_a int, digest binary")
    got = alignment.align_documents(docs.repartition(3), A, B)
    wanted, counts = brute(rows)
    assert sorted(map(tuple, got.documents.collect()), key=repr) == sorted(wanted, key=repr)
    assert {(r.a, r.b): r.n for r in got.pairs.collect()} == counts


def test_alignment_of_the_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    wanted, _ = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert sorted(map(tuple, alignment.align_documents(docs, A, B).documents.collect())) == sorted(wanted)


def test_copies_are_tokenised_once_and_weigh_as_often_as_they_occur(spark):
    docs = spark.range(500).selectExpr("id doc_id", "case when id < 400 then 'the same words' else 'the other ' || id end text")
    texts = alignment.distinct_texts(docs)
    assert texts.count() == 101 and texts.where("copies = 400").count() == 1
    got = alignment.align_documents(docs, A, B)
    wanted, counts = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(map(tuple, got.documents.collect())) == sorted(wanted) and max(counts.values()) == 500


def test_groups_as_text(spark):
    texts = alignment.distinct_texts(spark.createDataFrame([("the cats",), ("a▁b",)], "text string"))
    rows = {r.text: r for r in alignment.align_texts(texts, A, B, groups=True).join(texts.select("digest", "text"), "digest").collect()}
    assert hashlib.sha256(rows["the cats"].groups.encode()).hexdigest() == rows["the cats"].groups_sha256
    assert rows["a▁b"].groups == "" and rows["a▁b"].n_a == 0


def test_empty_table(spark):
    got = alignment.align_documents(spark.createDataFrame([], "doc_id long, text string"), A, B)
    assert got.documents.count() == 0 and got.pairs.count() == 0


def test_texts_cut_in_parts_give_the_ids_of_the_whole():
    model, piece = SentencePieceProcessor(model_file=B), alignment.Piece(B)
    texts = ["word  and more " * 9000, "x" * 70_000, "a" + " " * 70_000 + "b", "tail " * 9000 + "      ", " " * 40_000]
    ids, bounds = piece.ids(texts)
    assert [ids[i:j].tolist() for i, j in zip(bounds, bounds[1:])] == [model.encode(t) for t in texts]
    assert len(piece.parts(texts[0])) > 3


def test_pretokens_of_one_hash_are_told_apart():
    word = "a"
    for _ in range(11):
        word += word.translate({97: "b", 98: "a"})
    other = word.translate({97: "b", 98: "a"})
    data, offsets = arrays.text_bytes(pa.array([word, other]))
    _, points, bounds = arrays.code_points(data, offsets)
    hashes = arrays.run_hashes(points, arrays.pretokens(points, bounds))
    assert hashes[0] == hashes[1]  # the hash can't tell them apart
    cache = arrays.PieceCache(lambda pieces: [list(p.encode()) for p in pieces])
    ids, bounds = cache.ids(data, offsets)
    assert bytes(ids[: bounds[1]].tolist()).decode() == word and bytes(ids[bounds[1] :].tolist()).decode() == other
