"""Pre-tokens, byte-level BPE and packing against the public libraries and by brute force."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from stocktide.llm import arrays, bpe, packing

TEXTS = [
    "", None, " ", "\n", "a", "'s", "it's we'll they're 'sat 'l ''s x 's \t'd I'D", "a  b   \n\n c \n", "tail   ", "  x  y",
    "Ärger, straße! 123 45six\tÈ 中文 ٢٣ \U0001f600\U0001f600 é", "<|endoftext|> x", "a" * 5000, "ab" * 3000 + " " * 50 + "z",
    "!!!'s??? --- ' ' '", "x\r\n\r\ny\x0b\x1cz", "\x00\x7f",
]


def odd_texts(n=400, seed=5):
    rng = random.Random(seed)
    signs = " \n\t'''sdtmrevlEa1é́中!. \U0001f600ß²"
    return ["".join(rng.choices(signs, k=rng.randint(0, 40))) for _ in range(n)]


def test_pretokens_are_those_of_the_pattern():
    import regex

    texts = [t for t in TEXTS if t is not None] + odd_texts()
    data, offsets = arrays.text_bytes(pa.array(texts))
    text, points, bounds = arrays.code_points(data, offsets)
    starts = arrays.pretokens(points, bounds)
    got = [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)])]
    assert got == [m for t in texts for m in regex.findall(public_tokenizers.PATTERN, t)]


@pytest.fixture(scope="module")
def reference():
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_public_library(spark, reference):
    texts = TEXTS + odd_texts()
    rows = [(i, t, 0) for i, t in enumerate(texts)] + [(3, "again", 0), (3, "again", 0), (None, "no id", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).collect()
    wanted = []
    for i, t, _ in rows:
        ids = reference.encode_ordinary(t or "")
        wanted.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(wanted, key=repr)


def test_bpe_of_long_pieces(reference):
    own = bpe.Bpe(bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    rng = random.Random(1)
    for alphabet in ("ab", "thenrs", "äöüß", "xyzzyplugh"):
        piece = "".join(rng.choices(alphabet, k=20_000))
        ids = own.encode_piece(piece.encode())
        assert ids == reference.encode_ordinary(piece)
        assert own.decode(ids) == piece.encode()


def test_bpe_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).count() == 0


def test_rank_queue_gives_lowest_rank_leftmost():
    rng, queue = random.Random(3), bpe.RankQueue(70_000)
    held = []
    for _ in range(3000):
        if held and rng.random() < 0.45:
            held.sort()
            assert queue.pop() == held.pop(0)
        else:
            held.append((rng.choice([0, 63, 64, 4095, 4096, rng.randrange(70_000)]), rng.randrange(10**6)))
            queue.push(*held[-1])
    assert [queue.pop() for _ in held] == sorted(held)
    assert queue.pop() is None


def check_pieces(rows, texts_by_id, width):
    """``rows``: pieces; ``texts_by_id``: (doc_id, text) of every document."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    pieces, windows = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    left = {}
    for i, t in texts_by_id:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        left.setdefault(i, []).append(ids)
    for i, many in left.items():
        of_doc = sorted((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in pieces.pop(i))
        if len(many) > 1:
            assert sum(x[1] for x in of_doc) == sum(map(len, many))
            continue
        reached = 0
        for start, length, crc, n in of_doc:
            assert start == reached and length > 0 and n == len(many[0])
            assert crc == zlib.crc32(many[0][start : start + length].tobytes())
            reached += length
        assert reached == len(many[0])
    assert not pieces
    for spans in windows.values():
        reached = 0
        for offset, length in sorted(spans):
            assert offset == reached
            reached += length
        assert reached <= width
    total = sum(r["length"] for r in rows)
    assert sorted(windows) == list(range(-(-total // width)))


def test_packing_is_gapless_full_and_mixed(spark):
    rng = random.Random(2)
    texts = [("hot", t) for t in TEXTS] + [(rng.choice(["hot", "hot", "a", "b", None]), t) for t in odd_texts(300)]
    rows = [(i, t, s, -1) for i, (s, t) in enumerate(texts)] + [(7, "twice", "a", 0), (None, "no id", None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, offset int").repartition(5)
    got = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), width=64).collect()
    check_pieces(got, [(r[0], r[1]) for r in rows], 64)
    total, by = sum(r["length"] for r in got), {}
    for r in got:
        by[r["source"]] = by.get(r["source"], 0) + r["length"]
    full = total // 64
    for s, n in by.items():
        for w in range(full):
            here = sum(r["length"] for r in got if r["sequence_id"] == w and r["source"] == s)
            assert abs(here - 64 * n / total) <= 8


def test_packing_with_targets_and_few_queues(spark):
    rows = [(i, "word " * (1 + i % 7), f"s{i % 5}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = packing.pack(docs, path, width=32, targets={"s0": 3.0, "s1": 1.0}).collect()
    check_pieces(got, [(r[0], r[1]) for r in rows], 32)
    first = [r for r in got if r["sequence_id"] == 0]
    assert sum(r["length"] for r in first if r["source"] == "s0") == 24
    check_pieces(packing.pack(docs, path, width=32, max_queues=2).collect(), [(r[0], r[1]) for r in rows], 32)


def test_packing_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")).count() == 0
