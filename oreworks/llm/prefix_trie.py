"""The trie of all conversations' first turns, and what sharing its prefixes saves.

A turn is known by a chained hash of its own and all turns before it, so a node of the trie is
one such hash, and a conversation is the path of its hashes. Equal conversations become one
path with a count. Paths in order are dealt by range over tasks, and every run of some thousand
paths is a shard: a trie of its own, kept as balanced parentheses, one pair a node in
depth-first order. Blocks of parentheses know their least and greatest excess (open minus
closed ones), in levels, so that findclose skips over blocks on its way to the end of a subtree;
how many `()` lie before a place gives leaves, and cumulative arrays give members and savings.

Only nodes on the first and last path of a shard, its spines, can go on in other shards. All
others are final. The spines, with what hangs from them, are the paths of the next and much
smaller round, until one shard holds them all: there spines that shards share have merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreworks.llm.lineage import cut
from oreworks.llm.rows import sized

#: Conversations of a block of so many ids take over less than so many turns of its first one.
BLOCK, BORROWED = 5, 9
#: Ids of one text are first put together in ranges of so many ids.
ID_RANGE = 4_096
#: A shard has at most so many turns, unless its least number of paths has more.
SHARD_TURNS, LEAST_PATHS = 1 << 16, 64
#: So many spines, or fewer, are merged in one shard.
LAST_PATHS = 1_024
#: Parentheses in a block, and blocks in a block of the next level.
WIDTH = 64

HASH = 16
ROOT = bytes(HASH)
NONE = np.iinfo(np.int64).max
EMPTY_DIGEST = sha256(b"").hexdigest()

#: What a path has for each of its nodes, the root first: the node, bytes of its text, and what
#: hangs from the node itself: conversations that end at it or are in subtrees that are final,
#: the leaves, savings and children of those, and their smallest conversation.
PATH = (
    "path binary, sizes binary, ends binary, leaves binary, saved binary, children binary,"
    " least binary, digests array<string>"
)
MEASURES = ("sizes", "ends", "leaves", "saved", "children", "least")
TRIE_NODE = (
    "node binary, parent binary, conv_id bigint, depth bigint, parent_conv_id bigint,"
    " n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
)


def borrowed_turns(id: Column) -> Column:
    """How many turns a conversation takes over: crc32 of its id as text, modulo 9."""
    return (F.crc32(id.cast("string")) % BORROWED).cast("int")


def _turns(talks: DataFrame) -> DataFrame:
    """The turns of a block together, its first conversation first, each one's in order."""
    turn = F.concat_ws(
        "", F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")
    )
    rows = talks.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).where(F.col("conv_id").isNotNull())
    rows = rows.select(
        (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("block"),
        "conv_id",
        "turn",
        F.unhex(F.substring(F.sha2(turn, 256), 1, 2 * HASH)).alias("key"),
        F.octet_length("text").cast("bigint").alias("size"),
        borrowed_turns(F.col("conv_id")).alias("borrowed"),
    )
    return rows.repartition("block").sortWithinPartitions(
        "block", F.col("conv_id") != F.col("block"), "conv_id", F.asc_nulls_first("turn"), "key"
    )


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """conv_id, node at its end, path and sizes of every rebuilt conversation."""
    block, conv = None, None
    head: list[tuple[bytes, int]] = []
    path: list[bytes] = []
    sizes: list[int] = []
    rows: list[tuple] = []
    own = waiting = 0

    def step(key: bytes, size: int) -> None:
        path.append(blake2b(path[-1] + key, digest_size=HASH).digest())
        sizes.append(size)

    def done() -> None:
        rows.append((conv, path[-1], b"".join(path), np.array(sizes, "<i8").tobytes()))

    def packed() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)],
            ["conv_id", "end", "path", "sizes"],
        )

    for batch in batches:
        names = ("block", "conv_id", "key", "size", "borrowed")
        for now, id, key, size, borrowed in zip(*[batch[name].to_pylist() for name in names]):
            if id != conv or conv is None:
                if conv is not None:
                    done()
                if now != block:
                    block, head = now, []
                conv, own, waiting = id, 0, borrowed
                path, sizes = [ROOT], [0]
                if id != block:
                    for turn in head[:borrowed]:
                        step(*turn)
            if id == block:
                if len(head) < BORROWED:
                    head.append((key, size))
                step(key, size)
            elif own >= waiting:
                step(key, size)
            own += 1
            if len(rows) >= 1_000:
                yield packed()
                rows = []
    if conv is not None:
        done()
    if rows:
        yield packed()


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each path, from rows in order of path and range of ids: its ids' digest."""
    end, state = None, None
    path = sizes = b""
    n, least = 0, NONE
    for batch in batches:
        rows: list[tuple] = []
        names = ("end", "path", "sizes", "n", "least", "ids")
        for row in zip(*[batch[name].to_pylist() for name in names]):
            if row[0] != end:
                if end is not None:
                    rows.append((path, sizes, n, least, state.hexdigest()))
                end, path, sizes, n, least, state = *row[:3], 0, row[4], sha256()
            else:
                state.update(b",")
            n += row[3]
            state.update(row[5].encode())
        if rows:
            yield _whole_paths(rows)
    if end is not None:
        yield _whole_paths([(path, sizes, n, least, state.hexdigest())])


def _at_end(nodes: int, value: int, before: int = 0) -> bytes:
    return np.array([before] * (nodes - 1) + [value], "<i8").tobytes()


def _whole_paths(rows: list[tuple]) -> pa.RecordBatch:
    """Paths on which only the last node has anything."""
    out: dict[str, list] = {name: [] for name in ("path", *MEASURES, "digests")}
    for path, sizes, n, least, digest in rows:
        nodes = len(path) // HASH
        none = bytes(8 * nodes)
        values = (
            path, sizes, _at_end(nodes, n), none, none, none, _at_end(nodes, least, NONE),
            [None] * (nodes - 1) + [digest],
        )
        for name, value in zip(out, values):
            out[name].append(value)
    return _path_batch(out)


def _path_batch(columns: dict[str, list]) -> pa.RecordBatch:
    kinds = [pa.binary()] * (1 + len(MEASURES)) + [pa.list_(pa.string())]
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(columns.values(), kinds)], list(columns)
    )


class Parentheses:
    """A tree as balanced parentheses: True opens a node, nodes are numbered as they open."""

    def __init__(self, bits: np.ndarray):
        self.opens = np.flatnonzero(bits)
        self.excess = np.cumsum(np.where(bits, 1, -1), dtype=np.int64)
        #: How many pairs `()` begin before each place.
        pairs = np.append(bits[:-1] & ~bits[1:], False)
        self.pairs = np.concatenate([[0], np.cumsum(pairs)])
        #: How many nodes open before each place.
        self.opened = np.concatenate([[0], np.cumsum(bits)])
        self.low, self.high = [self.excess], [self.excess]
        while len(self.low[-1]) > WIDTH:
            self.low.append(self._blocks(self.low[-1], np.minimum))
            self.high.append(self._blocks(self.high[-1], np.maximum))

    @staticmethod
    def _blocks(values: np.ndarray, best: np.ufunc) -> np.ndarray:
        return best.reduceat(values, np.arange(0, len(values), WIDTH))

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """Where each of the given nodes closes: the first later place with one excess less.

        All nodes are looked for at once. A node that does not close in its block looks for the
        next block that holds its excess, one level up; from there the way leads down again.
        """
        found = np.empty(len(opens), dtype=np.int64)
        for at in range(0, len(opens), 1 << 15):
            part = opens[at : at + (1 << 15)]
            found[at : at + len(part)] = self._findclose(part)
        return found

    def _findclose(self, opens: np.ndarray) -> np.ndarray:
        goal = self.excess[opens] - 1
        at, level = opens + 1, np.zeros(len(opens), dtype=np.int64)
        climbing = np.arange(len(opens))
        for k in range(len(self.low)):
            hit, place = self._next(k, at[climbing], goal[climbing])
            at[climbing] = np.where(hit, place, at[climbing] // WIDTH + 1)
            level[climbing] = k
            climbing = climbing[~hit]
        for k in range(len(self.low) - 1, 0, -1):
            down = np.flatnonzero(level == k)
            _, place = self._next(k - 1, at[down] * WIDTH, goal[down])
            at[down], level[down] = place, k - 1
        return at

    def _next(self, k: int, start: np.ndarray, goal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """In level k, from start to the end of its block: is the goal there, and where first?"""
        low, high = self.low[k], self.high[k]
        hit, place = np.zeros(len(start), dtype=bool), start.copy()
        end = np.minimum((start // WIDTH + 1) * WIDTH, len(low))
        open = np.arange(len(start))
        for step in range(WIDTH):
            open = open[start[open] + step < end[open]]
            spot = start[open] + step
            good = (low[spot] <= goal[open]) & (goal[open] <= high[spot])
            hit[open[good]], place[open[good]] = True, spot[good]
            open = open[~good]
        return hit, place


class RangeMinimum:
    """Least value between any two places, from the minima of all powers of two."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while 1 << len(self.rows) <= len(values):
            row, half = self.rows[-1], 1 << (len(self.rows) - 1)
            self.rows.append(np.minimum(row[:-half], row[half:]))

    def __call__(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        power = np.frexp(high - low)[1] - 1
        out = np.empty(len(low), dtype=np.int64)
        for k in np.unique(power):
            at = power == k
            row = self.rows[k]
            out[at] = np.minimum(row[low[at]], row[high[at] - (1 << int(k))])
        return out


def _encode(rows: list[tuple], last: bool) -> Iterator[pa.RecordBatch]:
    """The final nodes of one shard, and its spines as paths, none in the last round."""
    keys = [np.frombuffer(row[0], dtype="<u8").reshape(-1, HASH // 8) for row in rows]
    lengths = np.array([len(k) for k in keys])
    node_of: list[np.ndarray] = []
    shared = np.zeros(len(rows), dtype=np.int64)
    nodes, now, before = 0, np.zeros(0, dtype=np.int64), keys[0][:0]
    for k, key in enumerate(keys):
        both = min(len(before), len(key))
        other = np.flatnonzero((before[:both] != key[:both]).any(axis=1))
        shared[k] = other[0] if len(other) else both
        new = np.arange(nodes, nodes + len(key) - shared[k])
        now, before, nodes = np.concatenate([now[: shared[k]], new]), key, nodes + len(new)
        node_of.append(now)

    # For each path its new nodes open, after those of the path before it have closed.
    runs = np.empty(2 * len(rows), dtype=np.int64)
    runs[0::2] = lengths - shared
    runs[1:-1:2] = lengths[:-1] - shared[1:]
    runs[-1] = lengths[-1]
    tree = Parentheses(np.repeat(np.arange(2 * len(rows)) % 2 == 0, runs))

    flat = np.concatenate(node_of)
    place = np.concatenate([np.arange(n) for n in lengths])
    own = {}
    for k, name in enumerate(MEASURES, 1):
        values = np.concatenate([np.frombuffer(row[k], dtype="<i8") for row in rows])
        own[name] = np.full(nodes, NONE if name == "least" else 0, dtype=np.int64)
        (np.minimum if name in ("least",) else np.add).at(own[name], flat, values)
    depth = np.zeros(nodes, dtype=np.int64)
    depth[flat] = place
    # The bytes of a node's text are the same in all paths that have it.
    own["sizes"][flat] = np.concatenate([np.frombuffer(row[1], dtype="<i8") for row in rows])
    parent = np.full(nodes, -1, dtype=np.int64)
    inner = np.flatnonzero(place > 0)
    parent[flat[inner]] = flat[inner - 1]
    digests: list[str | None] = [None] * nodes
    for row, numbers in zip(rows, node_of):
        for number, digest in zip(numbers.tolist(), row[7]):
            if digest is not None:
                digests[number] = digest
    names = [b""] * nodes
    for row, numbers, low in zip(rows, node_of, shared.tolist()):
        for k in range(low, len(numbers)):
            names[numbers[k]] = row[0][k * HASH : (k + 1) * HASH]

    final = np.ones(nodes, dtype=bool)
    if not last:
        final[node_of[0]] = final[node_of[-1]] = False
    close = tree.findclose(tree.opens)
    low, high = np.arange(nodes), tree.opened[close]

    def below(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return total[high] - total[low]

    n_convs = below(own["ends"])
    n_children = own["children"] + np.bincount(parent[parent >= 0], minlength=nodes)
    # A pair `()` is no leaf if children that are final hang from it, nor is a spine's node.
    pair = close == tree.opens + 1
    leaf = pair & (own["children"] == 0) & final
    n_leaves = tree.pairs[close] - tree.pairs[tree.opens] - below(pair & ~leaf) + below(own["leaves"])
    n_saved = below(own["saved"] + np.where(final, (n_convs - 1) * own["sizes"], 0))
    least = RangeMinimum(own["least"])(low, high)

    out = np.flatnonzero(final)
    up = parent[out]
    known = (up >= 0) & final[up]
    yield pa.RecordBatch.from_pydict(
        {
            "node": pa.array([names[k] for k in out.tolist()], pa.binary()),
            "parent": pa.array([names[k] if k >= 0 else None for k in up.tolist()], pa.binary()),
            "conv_id": least[out],
            "depth": depth[out],
            "parent_conv_id": pa.array(least[up], mask=~known),
            "n_convs": n_convs[out],
            "n_children": n_children[out],
            "n_leaves": n_leaves[out],
            "saved_tokens": n_saved[out],
            "ends_sha256": pa.array([digests[k] or EMPTY_DIGEST for k in out.tolist()], pa.string()),
            **{f: pa.nulls(len(out), kind) for f, kind in _PATH_KINDS.items()},
        }
    )
    if last:
        return
    # What has become final hangs from the spines from now on.
    hung = out[~known & (up >= 0)]
    tops = parent[hung]
    for name, values in (("ends", n_convs), ("leaves", n_leaves), ("saved", n_saved)):
        np.add.at(own[name], tops, values[hung])
    np.add.at(own["children"], tops, 1)
    np.minimum.at(own["least"], tops, least[hung])
    spines = [(node_of[0], 0)]
    if len(rows) > 1:
        common = int(np.sum(np.isin(node_of[-1], node_of[0])))
        spines.append((node_of[-1], common))
    columns: dict[str, list] = {name: [] for name in _PATH_KINDS}
    for numbers, skip in spines:
        columns["path"].append(b"".join(names[k] for k in numbers.tolist()))
        for name in MEASURES:
            values = own[name][numbers]
            if name != "sizes":
                values[:skip] = NONE if name == "least" else 0
            columns[name].append(values.astype("<i8").tobytes())
        columns["digests"].append(
            [None if k < skip else digests[v] for k, v in enumerate(numbers.tolist())]
        )
    yield pa.RecordBatch.from_pydict(
        {f: pa.nulls(len(spines), kind) for f, kind in _NODE_KINDS.items()}
        | {f: pa.array(columns[f], kind) for f, kind in _PATH_KINDS.items()}
    )


_NODE_KINDS = {
    "node": pa.binary(),
    "parent": pa.binary(),
    **dict.fromkeys(
        ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"),
        pa.int64(),
    ),
    "ends_sha256": pa.string(),
}
_PATH_KINDS = {
    **dict.fromkeys(("path", *MEASURES), pa.binary()),
    "digests": pa.list_(pa.string()),
}


def _shards(last: bool):
    """Paths in order to nodes and spines, shard by shard."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        turns = 0
        for batch in batches:
            for row in zip(*[batch[name].to_pylist() for name in _PATH_KINDS]):
                rows.append(row)
                turns += len(row[0]) // HASH
                if not last and turns >= SHARD_TURNS and len(rows) >= LEAST_PATHS:
                    yield from _encode(rows, last)
                    rows, turns = [], 0
        if rows:
            yield from _encode(rows, last)

    return shards


def _paths(talks: DataFrame) -> DataFrame:
    """One row for each different path. Ids that end at one node meet in ranges first, so that
    a conversation with a third of all copies reaches its digest in few rows."""
    rebuilt = _turns(talks).mapInArrow(
        _rebuild, "conv_id bigint, end binary, path binary, sizes binary"
    )
    ranges = rebuilt.groupBy("end", F.floor(F.col("conv_id") / ID_RANGE).alias("range")).agg(
        F.first("path").alias("path"),
        F.first("sizes").alias("sizes"),
        F.count(F.lit(1)).alias("n"),
        F.min("conv_id").alias("least"),
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"),
    )
    return (
        ranges.repartition("end")
        .sortWithinPartitions("end", "range")
        .mapInArrow(_digest, PATH)
    )


def trie(talks: DataFrame) -> DataFrame:
    """node, parent, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256: the nodes of the trie of all rebuilt conversations.

    A conversation is the rows with one conv_id, by turn (null first), of equal turns by a hash
    of role and text; null role and text are empty. Conversation c is rebuilt as the first h
    turns of conversation c - c % 5 (fewer if it has fewer, none if there is none), h being
    crc32(c as text) % 9, and its own turns after its first h. Remainders have the sign of c.
    Each different sequence of first turns is a node, from the root with none, and rebuilt
    conversations that start with it are its members. conv_id is the smallest member, n_leaves
    counts nodes without children in its subtree, saved_tokens adds (members - 1) times the
    bytes of the last text over the subtree, and ends_sha256 is the digest of the ids, in
    order and with commas between, of the conversations that are no longer than the node.

    Rows without conv_id belong to no conversation. Repeated rows are turns of their own. Texts
    of any length weigh 24 bytes once they are hashed; a conversation is that many bytes a turn
    in one cell. An empty table has no node, not even the root. Other columns are not read.
    """
    paths = _paths(talks)
    schema = f"{TRIE_NODE}, {PATH}"
    nodes = [c.split()[0] for c in TRIE_NODE.split(", ")]
    found: list[DataFrame] = []
    part = paths.repartitionByRange("path").sortWithinPartitions("path")
    last = False
    while True:
        done = cut(part.mapInArrow(_shards(last), schema))
        found.append(done.where("path IS NULL").select(*nodes))
        if last:
            break
        spines = done.where("path IS NOT NULL").select(*_PATH_KINDS)
        many = spines.count()
        last = many <= LAST_PATHS
        if last:
            part = spines.coalesce(1).sortWithinPartitions("path")
        else:
            part = spines.repartitionByRange(-(-many // LAST_PATHS), "path").sortWithinPartitions("path")
    merged = found.pop()
    for rows in reversed(found):
        # Final nodes under a spine learn their parent's smallest member from a later round.
        tops = sized(merged.select(F.col("node").alias("top"), F.col("conv_id").alias("top_id")))
        joined = rows.join(tops, rows["parent"] == tops["top"], "left")
        fixed = joined.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "top_id"))
        merged = merged.unionByName(fixed.select(*nodes))
    return merged
