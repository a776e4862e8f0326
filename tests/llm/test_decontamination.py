import random

import numpy as np
import pytest

from oreworks.llm import decontamination as d
from oreworks.llm.words import ALPHANUMERIC, hash_words, shingle_hashes


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(["the", "of", f"w{rng.randint(0, 300)}"]) for _ in range(n))


def items(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def test_items_are_found_wherever_they_stand(spark, make):
    tests = [prose(k, 30) + "? " + prose(k + 100, 12) for k in range(20)] + [None, "", "one"]
    changed = tests[1].split()
    changed[3] = "new"
    texts = [
        prose(500, 700) + " " + tests[0] + " " + prose(501, 40),
        tests[0].upper().replace(" ", ", ") + "\n" + " ".join(changed),
        tests[2].split("?")[0] + " " + prose(502, 50),  # the answer is not there
        prose(503, 3000),
        None,
        "",
    ]
    found = d.find_items(make(texts), items(spark, tests)).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(0, 0), (1, 0), (1, 1)]
    assert all(0.8 <= r.question_overlap <= 1 and r.score > 0.6 for r in found)


def test_retrieval_is_that_of_scoring_every_piece():
    texts = [(k, prose(k, 10 + k % 50)) for k in range(300)]
    _, indexes = d.build_indexes(texts)
    rng = random.Random(1)
    for index in indexes:
        for _ in range(30):
            terms = sorted(rng.sample(range(len(index.terms)), min(40, len(index.terms))))
            scores = {}
            for t in terms:
                for piece, score in zip(index.postings[t].pieces, index.postings[t].scores):
                    scores[int(piece)] = scores.get(int(piece), 0) + float(score)
            for least in (0.05, 0.2):
                got = dict(d.retrieve(index, terms, least))
                want = {p: s for p, s in scores.items() if s >= least}
                assert got.keys() == want.keys()
                assert all(got[p] == pytest.approx(want[p]) for p in got)


def test_given_tables_match_plain_containment(given):
    docs, tests = given("documents"), given("benchmark")
    got = {(r.doc_id, r.item_id) for r in d.find_items(docs, tests).collect()}

    def runs(text):
        words = hash_words(np.frombuffer((text or "").encode(), np.uint8), ALPHANUMERIC)[2]
        return set(shingle_hashes(words, 5).tolist())

    sets = {r.doc_id: runs(r.text) for r in docs.collect()}
    want = set()
    for item in tests.collect():
        whole = d._item(item.item_id, item.text)
        for doc, own in sets.items():
            parts = [
                np.mean([x in own for x in p.tolist()]) if len(p) else 1.0
                for p in (whole.question, whole.answer)
            ]
            if min(parts) >= d.OVERLAP:
                want.add((doc, item.item_id))
    assert got == want


def test_parts_of_items_and_empty_tables(spark, make, monkeypatch):
    tests = items(spark, [prose(k, 30) for k in range(9)])
    docs = make([prose(4, 30), prose(7, 30), prose(7, 30)])
    monkeypatch.setattr(d, "INDEX_CHARS", 200)
    found = d.find_items(docs, tests).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(0, 4), (1, 7), (2, 7)]
    assert d.find_items(docs, tests.limit(0)).count() == 0
    assert d.find_items(docs.limit(0), tests).count() == 0
