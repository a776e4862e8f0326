import math
import zlib
from collections import Counter

import numpy as np
import pytest

from oreworks.llm import lm_scoring


def brute(rows):
    counts = Counter()
    for i, text in rows:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2:
            counts.update((text or "").encode().lower().split())
            counts[None] += 1
    total, kinds = sum(counts.values()), len(counts)
    out = {}
    for i, text in rows:
        words = (text or "").encode().lower().split() + [None]
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in words)
        out[i] = (len(words), sum(counts[w] > 0 for w in words), total, base)
    return out


@pytest.mark.parametrize("chunk", [1 << 24, 50])
def test_base_scores(spark, make, monkeypatch, chunk):
    monkeypatch.setattr(lm_scoring, "CHUNK_BYTES", chunk)
    rows = [(k, f"The w{k % 7} É {'x' * (k % 5)}") for k in range(60)]
    rows += [(100, None), (101, ""), (102, " \n "), (None, "the the")]
    got = lm_scoring.score(make(rows)).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        n, known, total, base = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-12)
        assert r.score < 0


def test_scores_mix_pairs_with_words_alone(spark, make, monkeypatch):
    rows = [(k, f"a w{k % 7} b w{k * k % 5} c") for k in range(200)]
    rows += [(300, "c b a"), (301, "a w1 b w1 c"), (302, "c w1 b w1 a"), (303, "new a"), (304, "")]
    found, made = [], lm_scoring._scores
    monkeypatch.setattr(lm_scoring, "_scores", lambda *x: found.extend(x) or made(*x))
    monkeypatch.setattr(lm_scoring, "CHUNK_BYTES", 500)
    got = {r.doc_id: r for r in lm_scoring.score(make(rows)).collect()}
    weight, weights, tokens, kinds, unknown = found

    words = {i: (text or "").encode().split() + [None] for i, text in rows}
    crc = {i: zlib.crc32(str(i).encode()) for i in words}
    train = [i for i in words if crc[i] % 7 != 2]

    def counted(ids):
        alone, pairs = Counter(), Counter()
        for i in ids:
            alone.update(words[i])
            pairs.update(zip([None, *words[i]], words[i]))
        return alone, pairs

    left_out = [i for i in train if crc[i] // 7 % lm_scoring.DELETED == 0]
    grams = Counter(), Counter()
    for i in train:
        text = np.frombuffer(b" ".join(words[i][:-1]) + b" ", np.uint8)
        grams[i in left_out].update(lm_scoring.byte_events(text)[1].tolist())
        grams[i in left_out].update([0x20200A, 0x200A20])
    codes = np.array(sorted(grams[0] | grams[1]))
    kept_grams, left_grams = (np.array([g[c] for c in codes.tolist()]) for g in grams)
    spelling = lm_scoring.fit_spelling(codes, kept_grams, left_grams)

    def spelled(word):
        if word is None:
            return float(np.prod(spelling(np.array([0x20200A, 0x200A20]))))
        return float(np.prod(spelling(lm_scoring.byte_events(np.frombuffer(word + b" ", np.uint8))[1])))

    kept, kept_pairs = counted(set(train) - set(left_out))
    _, left_pairs = counted(left_out)
    events = Counter()
    for (v, w), n in left_pairs.items():
        alone = weight * kept[w] / sum(kept.values()) + (1 - weight) * spelled(w)
        ratio = kept_pairs[v, w] / kept[v] / alone if kept[v] else 0
        events[int(math.log2(kept[v])) + 1 if kept[v] else 0, ratio] += n
    want_weights = {}
    for bucket in {b for b, _ in events}:
        x, chosen = 0.5, [(r, n) for (b, r), n in events.items() if b == bucket]
        for _ in range(lm_scoring.ROUNDS):
            shares = sum(n * x * r / (x * r + 1 - x) for r, n in chosen)
            x = shares / (1 + sum(n for _, n in chosen))
        want_weights[bucket] = x
    assert len(want_weights) > 2
    for bucket, x in want_weights.items():
        assert weights[bucket] == pytest.approx(x, abs=0.05)

    alone, pairs = counted(train)
    assert (tokens, kinds) == (sum(alone.values()), len(alone))
    for i, row in words.items():
        want = 0.0
        for v, w in zip([None, *row], row):
            low = weight * alone[w] / tokens + (1 - weight) * spelled(w) if alone[w] else unknown
            x = weights[min(int(math.log2(alone[v])) + 1, len(weights) - 1)] if alone[v] else 0.0
            want += math.log10(max(1e-300, x * pairs[v, w] / max(alone[v], 1) + (1 - x) * low))
        assert got[i].score == pytest.approx(want, rel=1e-4)
    # The order of words counts.
    assert got[301].score > got[302].score


def test_spelling_is_a_distribution():
    data = np.frombuffer(b"abc abd ab\n the end ", dtype=np.uint8)
    _, codes = lm_scoring.byte_events(data)
    kinds, counts = np.unique(codes, return_counts=True)
    model = lm_scoring.fit_spelling(kinds, counts, np.maximum(counts // 2, 1))
    for context in (0x2020, 0x6162, 0x7A7A):
        assert model((context << 8) + np.arange(256)).sum() == pytest.approx(1)


def test_em_finds_the_better_estimate():
    high, low = np.array([0.5, 0.5]), np.array([0.1, 0.1])
    assert lm_scoring._em(np.zeros(2, dtype=int), np.array([5, 5]), high, low)[0] > 0.99


def test_empty_table(make):
    assert lm_scoring.score(make(["a"]).limit(0)).count() == 0
