"""Pre-tokens encoded as one sequence: the same ids as each by itself."""

import random

import public_tokenizers
from tokenizers import Tokenizer, models, pre_tokenizers

from stocktide.llm import packing


def pieces():
    rng = random.Random(4)
    signs = "abcdefgh éßαβ東京🙂0123456789<|>'"
    return [" a", "<|endoftext|>", "🙂", "\n", " ", "東", "é" * 700, *{"".join(rng.choices(signs, k=rng.randrange(1, 9))) for _ in range(3000)}]


def check(tokenizer, encode, names):
    ids, ends = encode(names)
    got = [ids[a:b].tolist() for a, b in zip([0, *ends.tolist()], ends.tolist())]
    assert got == [e.ids for e in tokenizer.encode_batch_fast(names, add_special_tokens=False)]


def test_pieces_of_one_sequence():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    calls = []

    class Counted:
        def encode_batch_fast(self, batch, **options):
            calls.append(len(batch))
            return tokenizer.encode_batch_fast(batch, **options)

        def get_vocab(self):
            return tokenizer.get_vocab()

    names = pieces()
    encode = packing.piece_encoder(Counted())
    check(tokenizer, encode, names)
    assert calls == [1]  # one object each before
    assert [len(x) for x in encode([])] == [0, 0]


def test_a_vocabulary_that_lacks_bytes():
    tokenizer = Tokenizer(models.BPE({"a": 0, "b": 1, "ab": 2}, [("a", "b")]))
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    check(tokenizer, packing.piece_encoder(tokenizer), ["ab", "x", "aab", "é", "b", "xa"])


def test_tokens_given_by_the_queues_before():
    rounds = packing.Rounds([100, 37, 0, 911], [3.0, 1.0, 0.0, 0.0])
    for x in (0, 64, 640, 1048):
        assert rounds.ahead(x) == [sum(rounds.given(x)[:i]) for i in range(5)]
