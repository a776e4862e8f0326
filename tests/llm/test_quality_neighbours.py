import zlib

import numpy as np
import pyarrow as pa
import pytest

from oreworks.llm import quality_neighbours as near
from oreworks.llm import queries

GOOD = "The quick brown fox jumps over a lazy dog, and then it rests."
BAD = "BUY!! NOW!! ### $$$ CHEAP!! BUY!! NOW!!"


def labelled(spark, rows):
    schema = "doc_id long, text string, label int, score double, slot string, terms int"
    return spark.createDataFrame([(k, *r, 1.0, "x", 2) for k, r in enumerate(rows)], schema)


def sample(spark, n=60):
    rng = np.random.Generator(np.random.PCG64(4))
    rows = []
    for k in range(n):
        words = (GOOD if k % 3 else BAD).split()
        rows.append((" ".join(rng.choice(words, 30)), int(k % 3 > 0)))
    return labelled(spark, rows)


@pytest.fixture(scope="module")
def model(spark):
    return near.fit(sample(spark))


def scores(spark, model, texts):
    docs = labelled(spark, [(t, None) for t in texts])
    got = near.classify(docs, model, 0.3).orderBy("doc_id").collect()
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in got)
    return [r.score for r in got]


def test_votes_equal_brute_force(model):
    texts = [GOOD, BAD, "", "dog " * 20, "xyzzy 99", GOOD + BAD]
    got = next(model.scores(pa.array(texts), 7, 3.0))
    for text, score in zip(texts, got):
        _, rows, columns, counts = next(near.terms(pa.array([text])))
        value = near.weights(1, rows, columns, counts, model.idf)
        vector = (model.base[columns].astype(float) * value[:, None]).sum(axis=0)
        vector /= max(np.linalg.norm(vector), 1e-12)
        cosines = model.vectors.astype(float) @ vector
        best = np.argsort(-cosines)[:7]
        weight = np.maximum(cosines[best], 0) ** 3
        want = weight @ model.labels[best] / weight.sum() if weight.any() else model.prior
        assert score == pytest.approx(want, abs=1e-3)


def test_space_is_that_of_the_leading_singular_vectors(spark):
    docs = sample(spark)
    model = near.fit(docs, dimensions=8)
    texts = [r.text for r in docs.collect()]
    size, rows, columns, counts = next(near.terms(pa.array(texts)))
    whole = np.zeros((size, near.COLUMNS))
    whole[rows, columns] = near.weights(size, rows, columns, counts, model.idf)
    want = np.linalg.svd(whole, full_matrices=False)[1][:4]
    assert np.linalg.norm(whole @ model.base[:, :4], axis=0) == pytest.approx(want, rel=1e-2)


def test_style_decides(spark, model):
    good, bad, long, null, empty = scores(spark, model, [GOOD * 3, BAD * 3, BAD * 40_000, None, ""])
    assert good > 0.9 and bad < 0.1 and long < 0.3
    assert null == empty


def test_terms_do_not_depend_on_neighbouring_texts():
    texts = [GOOD, "", BAD, None, GOOD, "Dog", "dog dog"]
    together = {}
    for size, rows, columns, counts in near.terms(pa.array(texts)):
        assert size == len(texts)
        for k in range(size):
            together[k] = (columns[rows == k].tolist(), counts[rows == k].tolist())
    for k, text in enumerate(texts):
        _, _, columns, counts = next(near.terms(pa.array([text])))
        assert together[k] == (columns.tolist(), counts.tolist())


def test_ties_and_repeated_rows(spark, model):
    assert len(set(scores(spark, model, [GOOD] * 5))) == 1


def test_without_labels_or_rows(spark, model):
    for rows in ([], [("a", None), (GOOD, 7)]):
        empty = near.fit(labelled(spark, rows))
        assert scores(spark, empty, [GOOD, None]) == [near.UNLEARNED] * 2
    assert near.classify(labelled(spark, []), model, 0.3).count() == 0
    one = near.fit(labelled(spark, [(GOOD, 1), (None, 1)]))
    assert scores(spark, one, [BAD, None, GOOD]) == [1.0] * 3


def test_more_labelled_rows_than_the_bound(spark):
    few = near.fit(sample(spark, 3_000), most=600)
    assert 500 < len(few.labels) < 800
    assert scores(spark, few, [GOOD * 3])[0] > 0.9 > 0.1 > scores(spark, few, [BAD * 3])[0]


def test_query_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    found = {r.doc_id: r for r in queries.queries()["op12_quality_neighbours"](spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    assert len(found) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [r for r in labels if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(found[r.doc_id].held_out for r in held)
    assert np.mean([found[r.doc_id].predicted == r.quality for r in held]) > 0.95
