import random

import pytest
from pyspark.sql import functions as F

from oreworks.llm import jaccard_join, linking
from oreworks.llm.components import components


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 3:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(words, words[1:], words[2:]))


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 90 * len(sets[a] | sets[b]):
                group[root(a)] = root(b)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(k)]
        ids = [x for x in ids if x is not None]
        out.append((i, len(sets[k]), min(ids) if ids else None))
    return out


def order(rows):
    return sorted(rows, key=str)


def cloud(seed):
    """Copies of a few texts with more and fewer changes, and texts that share a passage."""
    rng = random.Random(seed)
    rows = [(900, None), (901, ""), (902, " \n"), (903, "a b"), (904, "A  b"), (None, "c d"), (905, "b a")]
    k = 0
    shared = [f"s{x}" for x in range(40)]
    for base in range(4):
        words = [f"b{base}w{rng.randint(0, 400)}" for _ in range(rng.choice([60, 150, 400]))]
        for _ in range(25):
            copy = list(words)
            for _ in range(rng.randint(0, len(words) // 30 + 1)):
                copy[rng.randrange(len(copy))] = f"n{rng.randint(0, 10**6)}"
            rows.append((k, " ".join(copy)))
            k += 1
    for _ in range(20):
        own = [f"o{rng.randint(0, 10**6)}" for _ in range(rng.randint(2, 60))]
        rows.append((k, " ".join(shared + own)))
        k += 1
    rows.append((k, rows[-1][1].upper()))
    return rows


@pytest.mark.parametrize("seed,rounds", [(1, 3), (2, 0), (3, 1)])
def test_components_are_those_of_all_pairs(make, monkeypatch, seed, rounds):
    monkeypatch.setattr(linking, "STAR_ROUNDS", rounds)
    rows = cloud(seed)
    got = [tuple(r) for r in jaccard_join.link(make(rows)).collect()]
    assert order(got) == order(brute(rows))


@pytest.mark.parametrize("seed,rounds", [(1, 0), (4, 1)])
def test_crowded_buckets_lose_no_link(make, monkeypatch, seed, rounds):
    monkeypatch.setattr(linking, "STAR_ROUNDS", rounds)
    monkeypatch.setattr(linking, "FEW_PAIRS", 0)
    rows = cloud(seed)
    got = [tuple(r) for r in jaccard_join.link(make(rows)).collect()]
    assert order(got) == order(brute(rows))


def test_a_shared_template_makes_no_bucket_of_rare_items(spark):
    # All sets hold items 0 to 59 and 20 of their own, so none is linked with another.
    n = 400
    rows = [(k, 80, [*range(60), *range(1_000 + 20 * k, 1_020 + 20 * k)]) for k in range(n)]
    rows.append((n, 80, rows[0][2][:79] + [999]))
    sets = spark.createDataFrame(rows, "node long, size long, items array<long>")
    nodes = sets.select("node", "size")
    dealt = linking._by_rare_items(nodes, sets, lambda size: F.floor(size / 10))
    found = {}
    for r in dealt.collect():
        found.setdefault(r.key, set()).add(r.node)
    assert all(len(nodes) < 3 for nodes in found.values())
    assert {0, n} in found.values()


def test_given_documents(given):
    docs = given("documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = [tuple(r) for r in jaccard_join.link(docs).collect()]
    assert order(got) == order(brute(rows))


def test_repeated_rows_and_empty_table(make):
    docs = make([(1, "x y z"), (1, "x y z"), (None, "x y z")])
    assert [r.component_id for r in jaccard_join.link(docs).collect()] == [1, 1, 1]
    assert len(jaccard_join.superseded(docs).collect()) == 2
    assert jaccard_join.link(docs.limit(0)).count() == 0


def test_components_of_a_chain(spark):
    chain = [(k, k + 1) for k in range(50)] + [(100, 101), (102, 101), (7, 7)]
    edges = spark.createDataFrame(chain, "a long, b long")
    found = {r.node: r.root for r in components(edges).collect()}
    assert all(found[k] == 0 for k in range(51))
    assert {found[k] for k in (100, 101, 102)} == {100}
    assert components(edges.limit(0)).count() == 0


@pytest.mark.parametrize("similarity", [80, 90])
def test_short_prefixes_lose_no_linked_set(make, similarity):
    """Sets of all small sizes, each with one at the limit of what links, in any hash order."""
    rng = random.Random(similarity)
    rows, linked = [], set()
    for size in range(1, 90):
        base = rng.sample(range(-(2**61), 2**61), size)
        out = rng.randint(0, size * (100 - similarity) // 100)
        kept = base[out:]
        most = len(kept) * 100 // similarity - size  # elements that the other may have besides
        other = kept + rng.sample(range(-(2**61), 2**61), max(0, rng.randint(0, max(0, most))))
        pair = [sorted(x, key=lambda v: v % 2**64) for x in (base, other)]
        both = len(set(base) & set(other))
        for x in pair:
            prefix = x[: 2 * jaccard_join.most_different(len(x), similarity) + 2]
            rows.append((len(rows), len(x), prefix))
            if 100 * both >= similarity * len(set(base) | set(other)):
                linked.add(len(rows) - 1)
    spark = make([]).sparkSession
    nodes = spark.createDataFrame(rows, "row bigint, size bigint, prefix array<bigint>")
    left = {r["row"] for r in jaccard_join._likely(nodes, similarity).collect()}
    assert len(linked) > 100 and linked <= left
