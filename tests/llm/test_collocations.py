import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from oreworks.llm import collocations


def brute(rows, max_words=3, least=10, top=2000):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        raw = re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode())
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", raw):
            words = re.findall(rb"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            seen = counts.setdefault(lang, Counter())
            for k in range(1, max_words + 1):
                seen.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    longer[p[i : i + size]] = max(longer[p[i : i + size]], a)
        found = []
        for p, a in candidates.items():
            if 100 * longer[p] >= 50 * a:
                continue
            score, k = min(
                (10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))
            )
            found.append((-score, -a, b" ".join(p), f[p[:k]], f[p[k:]]))
        out += [
            (lang, rank, p.decode(), -a, left, right, totals[lang], -score)
            for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1)
        ]
    return sorted(out)


def table(spark, rows):
    schema = "doc_id long, text string, lang string, bucket int, n int, phrase string"
    return spark.createDataFrame(
        [(k, text, lang, 1, 2, "x") for k, (lang, text) in enumerate(rows)], schema
    ).repartition(3)


def hard_rows():
    rng = np.random.Generator(np.random.PCG64(3))
    names = np.array(["A", "b", "É", "ü", "x1", "the", "of", "New", "york", "-"])
    rows = [
        (lang, " ".join(rng.choice(names, 60)) + rng.choice([".", "\n", "! ", "\t", " "]) + "new  \tYork")
        for lang in ("en", "de", None, "und", "")
        for _ in range(12)
    ]
    return rows + [("en", None), (None, ""), ("fr", " .,\n"), ("en", "one two " * 30), *rows[:3]]


@pytest.mark.parametrize("chunk", [collocations.CHUNK_BYTES, 40])
def test_equals_brute_force(spark, monkeypatch, chunk):
    # Short chunks cut texts at ends of pieces, and merge many summaries.
    monkeypatch.setattr(collocations, "CHUNK_BYTES", chunk)
    rows = hard_rows()
    got = sorted(tuple(r) for r in collocations.mine(table(spark, rows)).collect())
    assert got == brute(rows) and len(got) > 100


@pytest.mark.parametrize("max_words,least,top", [(2, 3, 5), (4, 5, 50)])
def test_other_parameters(spark, max_words, least, top):
    rows = hard_rows()
    got = collocations.mine(table(spark, rows), max_words=max_words, min_count=least, top=top)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, max_words, least, top)


def test_summaries_keep_what_is_frequent():
    rng = np.random.Generator(np.random.PCG64(1))
    rare = rng.permutation(np.arange(1_000, 400_000, dtype=np.uint32))
    frequent = np.arange(50, dtype=np.uint32)
    mass = len(rare) + 10 * len(frequent)
    summary = collocations.Summary(mass, 10)
    for part in np.array_split(rare, 10):
        keys = np.concatenate([part, frequent])
        summary.add(keys, np.ones(len(keys), dtype=np.int64))
        summary._merge()
        assert len(summary.keys) <= summary.capacity == mass // 10 + 1
    assert 0 < summary.lost < 10
    assert set(frequent) <= set(summary.survivors())


def test_first_pass_lets_few_rare_runs_through(spark):
    """The bitmap holds what the summaries kept, not all runs."""
    rows = [("en", " ".join(f"w{k}_{j}" for j in range(200)) + " good thing") for k in range(100)]
    found = collocations.frequent_runs(table(spark, rows))
    assert {(r.phrase, r.n) for r in found.where("words > 0").collect()} == {
        ("good", 100), ("thing", 100), ("good thing", 100)
    }


def test_scores_are_exact_beyond_64_bits(spark):
    for a, left, right in [(10**15 - 1,) * 3, (333333333333331, 777777777777777, 499999999999999)]:
        score = collocations._exact_score(F.lit(a), F.lit(left), F.lit(right))
        assert spark.range(1).select(score).first()[0] == 10**6 * a * a // (left * right)


def test_empty_table_and_no_words(spark):
    assert collocations.mine(table(spark, hard_rows()).limit(0)).count() == 0
    assert collocations.mine(table(spark, [("en", None), (None, " ")])).count() == 0


def test_a_text_longer_than_a_chunk_without_ends(spark, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 1 << 10)
    rows = [("en", "a b c d " * 20_000), ("en", "e f. " * 2_000)]
    got = sorted(tuple(r) for r in collocations.mine(table(spark, rows)).collect())
    assert got == brute(rows)
