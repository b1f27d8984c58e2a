"""Memory of one block of texts in a classifier."""

import tracemalloc

import numpy as np

from stocktide.llm import arrays, langid, substrings, toxicity


def peak(function, *given):
    function(*given)
    tracemalloc.start()
    try:
        function(*given)
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_a_block_takes_little_memory():
    rng = np.random.default_rng(3)
    data = rng.choice(np.frombuffer(b"abcdefghijklmnop  .", np.uint8), arrays.SMALL_CHUNK_BYTES)
    offsets = np.arange(0, len(data) + 1, 2048)
    languages = langid.Model(list("abcdefgh"), np.ones((1 << 16, 8), np.float32), np.zeros(8), 1.0, 0.0, 16)
    toxic = toxicity.Model(np.ones(1 << 16, np.float32), 0.0, 16)
    assert peak(languages.probabilities, data, offsets) < 80  # 4 times that with the blocks before
    assert peak(toxic.scores, data, offsets) < 80


def test_windows_of_many_texts_take_little_memory():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 123, 4 << 20).astype(np.uint8)
    assert peak(substrings.super_windows, data, np.arange(0, len(data) + 1, 2048), 50) < 80  # 148 before
