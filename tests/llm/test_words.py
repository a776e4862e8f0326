import tracemalloc

import numpy as np
import pyarrow as pa

from oreworks.llm import words
from oreworks.llm.substring_dedup import Units


def of(text):
    return words.hash_words(np.frombuffer(text.encode(), dtype=np.uint8))


def test_equal_words_have_equal_hashes_whatever_is_around_them():
    starts, ends, hashes = of("The cat\tthe  dog\nCAT étê")
    assert len(hashes) == 6
    assert hashes[0] == hashes[2] and hashes[1] == hashes[4]
    assert len(set(hashes.tolist())) == 4
    assert (starts[1], ends[1]) == (4, 7)


def test_long_data_is_cut_between_words(monkeypatch):
    monkeypatch.setattr(words, "STEP", 64)
    text = " ".join(f"w{k}" for k in range(200)) + " " + "x" * 500 + " w7"
    small = of(text)[2]
    monkeypatch.undo()
    assert np.array_equal(small, of(text)[2])


def test_texts_do_not_run_together():
    column = pa.array(["a b", None, "", "b", "c"])
    found = {k: h.tolist() for k, h in words.hashed_texts(column)}
    assert [len(found[k]) for k in range(5)] == [2, 0, 0, 1, 1]
    assert found[0][1] == found[3][0]


def test_few_words_are_one_shingle():
    hashes = of("a b")[2]
    assert len(words.shingle_hashes(hashes, 3)) == 1
    assert len(words.shingle_hashes(of("a b c d")[2], 3)) == 2
    assert len(words.shingle_hashes(hashes[:0], 3)) == 0


def test_a_step_takes_little_memory():
    text = b" ".join(b"word%d" % (k % 5000) for k in range(400_000))
    column = pa.array([text[k : k + 5000].decode() for k in range(0, len(text), 5000)])
    words._powers.cache_clear()
    tracemalloc.start()
    try:
        for _, bounds, data in words.batched(words.text_bytes(column)):
            Units(bounds, data).seeds()
        assert tracemalloc.get_traced_memory()[1] < 40 << 20
    finally:
        tracemalloc.stop()
