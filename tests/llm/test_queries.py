import pytest

import corpus_pipeline
from oreworks.llm import queries
from oreworks.llm.rows import once
from tests.compare import assert_same, duck
from tests.llm.test_jaccard_join import shingles

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, name):
    assert_same(queries.queries()[name](spark, SF), duck(SF), queries.oracle_sql()[name])


def test_every_operator_has_a_query():
    numbers = [int(name[2:].split("_")[0]) for name in queries.queries()]
    assert numbers == list(range(1, 14))


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        rows = {r.doc_id: r for r in docs.collect()}
        assert set(rows) <= set(before)
        if name == "jaccard_join":
            texts = [shingles(r.text) for r in rows.values()]
            for k, a in enumerate(texts):
                assert not any(
                    a and b and 100 * len(a & b) >= 90 * len(a | b) for b in texts[:k]
                )
        if name == "substring_dedup":
            for r in rows.values():
                assert r.n_chars == len(r.text) <= len(before[r.doc_id].text)
        elif name != "mixing":
            assert all(before[k] == r for k, r in rows.items())
        if name != "mixing":
            assert docs.columns == columns
        before = rows
    assert all(0 < r.taken <= 2 * r.size for r in before.values())


def test_run_is_the_stages(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_hard_tables_pass_every_stage(spark, make, tmp_path):
    hard = make([(None, "a b c"), (1, None), (2, ""), (3, "x y z"), (3, "x y z"), (4, "w " * 50_000)])
    hard = hard.selectExpr("*", "1 AS row", "2 AS found", "3 AS taken", "4 AS text_key")
    for docs in (hard, hard.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, SF).collect()


def test_once(make):
    docs = make([(1, "a"), (1, "a"), (1, "b"), (None, None), (None, None)])
    assert once(docs).count() == 3


def test_once_does_not_depend_on_partitions(spark):
    rows = [(1, "a", "en", f"s{k}", k) for k in range(40)] + [(None, None, None, "s", 1)] * 3
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    left = {tuple(sorted(map(str, once(docs.repartition(n)).collect()))) for n in (1, 3, 7)}
    assert len(left) == 1 and len(next(iter(left))) == 2


def five_word_runs(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(*(words[k:] for k in range(5))))


def test_near_copy_stage_keeps_one_document_of_each_group(spark, make):
    given = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    words = [f"w{k}" for k in range(60)]
    near = [words[:20] + ["new"] + words[21:], words[:40] + ["a", "b"] + words[40:]]
    rows = [(r.doc_id, r.text) for r in given]
    rows += [(10_000 + k, " ".join(x)) for k, x in enumerate([words, *near])]
    runs = [(i, five_word_runs(t)) for i, t in rows]
    least = {i: i for i, _ in runs}
    links = [
        (i, j)
        for k, (i, a) in enumerate(runs)
        for j, b in runs[:k]
        if a and b and 100 * len(a & b) >= 80 * len(a | b)
    ]
    for _ in runs:
        before = dict(least)
        for i, j in links:
            least[i] = least[j] = min(least[i], least[j])
        if least == before:
            break
    left = corpus_pipeline.join_near_copies(spark, make(rows), SF).collect()
    assert sorted(r.doc_id for r in left) == sorted(i for i in least if least[i] == i)
    assert 10_000 in {r.doc_id for r in left} and not {10_001, 10_002} & {r.doc_id for r in left}


def test_decontamination_drops_rows_not_ids(spark, make):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    rows = [(None, f"before {item} after"), (None, "clean"), (7, item), (7, "clean too"), (8, None)]
    left = corpus_pipeline.decontaminate(spark, make(rows + rows[:2]), SF).collect()
    want = [(7, "clean too"), (8, None), (None, "clean"), (None, "clean")]
    assert sorted(((r.doc_id, r.text) for r in left), key=str) == want
