import zlib
from hashlib import sha256

import numpy as np
import pytest

from oreworks.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, node string, parent int"


def rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(turns, key=lambda x: x[:2])] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = own.get(c - int(np.fmod(c, 5)), [])
        out[c] = tuple(base[:h] + turns[h:])
    return out


def brute(rows):
    members = {}
    talks = rebuilt(rows)
    for c, turns in talks.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node, ids in members.items():
        size = (len(ids) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += size
    out = []
    for node, ids in members.items():
        ends = sorted(c for c in ids if len(talks[c]) == len(node))
        out.append(
            (
                min(ids),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(ids),
                len(children.get(node, [])),
                leaves[node],
                saved[node],
                sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(5)


def found(spark, rows):
    got = prefix_trie.trie(table(spark, rows)).drop("node", "parent").collect()
    return sorted((tuple(r) for r in got), key=str)


def hard_rows(seed=1, convs=80):
    rng = np.random.Generator(np.random.PCG64(seed))
    rows = []
    for c in [*range(-12, convs), 10**15 + 3, 10**15]:
        words = rng.choice(["a", "é", "", None], rng.integers(1, 12))
        turns = [(c, k, ["user", "assistant"][k % 2], w) for k, w in enumerate(words)]
        rows += [(c, None if k == 2 else t, None if w == "é" else r, w) for k, (c, t, r, w) in enumerate(turns)]
    # Copies of one conversation, one that ends where others go on, and a long one.
    rows += [(c, k, "user", f"t{k}") for c in range(1000, 1400) for k in range(10)]
    rows += [(c, k, "user", f"t{k}") for c in range(2000, 2100, 5) for k in range(4)]
    rows += [(3000, k, "user", "x" * (k % 3)) for k in range(500)]
    return rows + [(None, 1, "user", "lost"), rows[5], rows[5]]


@pytest.mark.parametrize("turns,paths,last", [(1 << 16, 64, 1024), (100, 8, 40)])
def test_equals_brute_force(spark, monkeypatch, turns, paths, last):
    # Small shards take several rounds, in which their spines merge.
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", turns)
    monkeypatch.setattr(prefix_trie, "LEAST_PATHS", paths)
    monkeypatch.setattr(prefix_trie, "LAST_PATHS", last)
    rows = hard_rows()
    assert found(spark, rows) == brute(rows)


def test_turns_of_equal_rank_have_an_order_of_their_own(spark):
    rows = [(5, 1, "user", t) for t in "abcd"] + [(10, 1, "user", t) for t in "dcba"]
    got = found(spark, rows)
    assert len(got) == 5 and {r[3] for r in got} == {2}


def test_no_turns_left_is_a_member_of_the_root(spark):
    c = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    digest = sha256(str(c).encode()).hexdigest()
    assert found(spark, [(c, 0, "user", "a")]) == [(c, 0, None, 1, 0, 1, 0, digest)]


def test_empty_table(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 0, "user", "a")]) == []


def test_long_texts_count_in_bytes(spark):
    rows = [(c, 0, "user", "é" * 1_000_000) for c in (0, 5, 10)]
    assert {r[6] for r in found(spark, rows)} == {4_000_000}


def naive_close(bits, at):
    level = 0
    for k in range(at, len(bits)):
        level += 1 if bits[k] else -1
        if level == 0:
            return k


@pytest.mark.parametrize("shape", ["deep", "wide", "random"])
def test_findclose(shape):
    rng = np.random.Generator(np.random.PCG64(5))
    if shape == "deep":
        bits = [True] * 9_000 + [False] * 9_000
    elif shape == "wide":
        bits = [True] + [True, False] * 9_000 + [False]
    else:
        bits, level = [True], 1
        while len(bits) < 20_000:
            up = level == 1 or rng.random() < 0.5
            bits.append(up)
            level += 1 if up else -1
        bits += [False] * level
    bits = np.array(bits)
    tree = prefix_trie.Parentheses(bits)
    some = tree.opens[:: max(1, len(tree.opens) // 300)]
    assert tree.findclose(some).tolist() == [naive_close(bits, k) for k in some]


def test_range_minimum():
    values = np.random.Generator(np.random.PCG64(2)).integers(0, 1000, 777)
    low = np.arange(776)
    high = np.minimum(777, low + 1 + low % 97)
    got = prefix_trie.RangeMinimum(values)(low, high)
    assert got.tolist() == [values[a:b].min() for a, b in zip(low, high)]
