"""Prefix trie of conversations from ternary search trees of range shards.

Turns are encoded by a dictionary of the distinct ones, so that a conversation is a sequence of integers.
Sequences are range-partitioned in lexicographic order; a shard is a run of neighbouring sequences. Its distinct
sequences are inserted, medians first, in a ternary search tree, which is balanced by that order. An iterative
traversal sums members, leaves and savings of each node. Only nodes on the paths of a shard's first and last
sequence can go on in a neighbouring shard. These boundary nodes are merged in order, ``FAN`` shards at a time, in
as many rounds as it takes; a merged group again has one first and one last path that stay open.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeline.llm.common import word_count
from gradeline.llm.fitting import fold
from gradeline.sources.stage import stage

#: Turns of a shard; smaller inputs are still spread over the shuffle partitions, in shards of LEAST_TURNS.
SHARD_TURNS, LEAST_TURNS = 250_000, 2_000
#: Neighbouring shards whose boundary nodes one merge reads.
FAN = 64

_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
# What shards and merges write: a closed node (kind node), one on a boundary path (open), or the ids ended at an open node (ids).
_ROWS = f"kind string, shard long, side int, turn long, words long, key binary, parent_key binary, ids binary, {_NODE}"
_FIELDS = [f.split()[0] for f in _ROWS.split(", ")]
_TYPES = [{"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[f.split()[1]] for f in _ROWS.split(", ")]


# --- sequences -------------------------------------------------------------------------------------


def encode(conversations: DataFrame) -> DataFrame:
    """(conv_id, ids, words): each conversation's turns in order, as dictionary ids and word counts of their texts.

    A turn is known by the SHA-256 of its role and text, so that texts do not move. Turns are ordered by
    ``turn``, null first, and those with equal numbers by that digest. Null roles and texts are empty. Rows
    without a conv_id belong to no conversation and are left out; repeated rows are repeated turns. One
    conversation's ids and counts make one row.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.filter("conv_id is not null").select(
        "conv_id", "turn", F.unhex(F.sha2(F.concat_ws(":", F.char_length(role), role, text), 256)).alias("digest"), word_count(text).alias("words")
    )
    turns = stage(turns, "turns")
    dictionary = stage(turns.groupBy("digest").agg(F.first("words").alias("words")).withColumn("id", F.monotonically_increasing_id()), "dictionary")
    coded = turns.drop("words").join(dictionary, "digest")
    return coded.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "digest", "id", "words"))).alias("turns")).select(
        "conv_id", F.col("turns.id").alias("ids"), F.col("turns.words").alias("words")
    )


def rebuild(sequences: DataFrame, family: int = 20, folds: int = 4) -> DataFrame:
    """Conversations that begin with turns of the first one of their family (``family`` successive conv_ids).

    With h = crc32(conv_id) % ``folds``, the first h turns of that conversation (fewer or none, if it has no more)
    stand in place of the conversation's own first h turns.
    """
    sequences = stage(sequences, "sequences")
    h = fold(F.col("conv_id"), folds).cast("int")
    heads = sequences.filter(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("head"), *[F.slice(c, 1, folds).alias(f"head_{c}") for c in ("ids", "words")]
    )
    own = sequences.withColumns({"h": h, "family": F.col("conv_id") - F.col("conv_id") % family})
    none = F.array().cast("array<long>")

    def rebuilt(c: str):
        return F.concat(F.slice(F.coalesce(f"head_{c}", none), F.lit(1), F.col("h")), F.slice(c, F.col("h") + 1, F.size(c))).alias(c)

    return own.join(heads, F.col("family") == F.col("head"), "left").select("conv_id", rebuilt("ids"), rebuilt("words"))


# --- one shard -------------------------------------------------------------------------------------


class TernaryTree:
    """Sequences of integers in a ternary search tree held in lists; node 0 is the root of the trie."""

    def __init__(self) -> None:
        self.turn, self.lo, self.eq, self.hi = [-1], [-1], [-1], [-1]
        self.words, self.members, self.least, self.ended = [0], [0], [None], [-1]

    def _new(self, turn: int, words: int) -> int:
        for column, value in ((self.turn, turn), (self.lo, -1), (self.eq, -1), (self.hi, -1),
                              (self.words, words), (self.members, 0), (self.least, None), (self.ended, -1)):
            column.append(value)
        return len(self.turn) - 1

    def _count(self, node: int, members: int, least: int) -> None:
        self.members[node] += members
        if self.least[node] is None or least < self.least[node]:
            self.least[node] = least

    def insert(self, turns: list[int], words: list[int], members: int, least: int, number: int) -> None:
        node = 0
        self._count(0, members, least)
        for turn, n in zip(turns, words):
            links, at, below = self.eq, node, self.eq[node]
            while below >= 0 and self.turn[below] != turn:
                links, at = (self.lo, below) if turn < self.turn[below] else (self.hi, below)
                below = links[at]
            if below < 0:
                below = links[at] = self._new(turn, n)
            node = below
            self._count(node, members, least)
        self.ended[node] = number

    def find(self, turns: list[int]) -> list[int]:
        """The nodes along a sequence that is in the tree, the root first."""
        path = [0]
        for turn in turns:
            at = self.eq[path[-1]]
            while self.turn[at] != turn:
                at = self.lo[at] if turn < self.turn[at] else self.hi[at]
            path.append(at)
        return path

    def walk(self) -> tuple[list[int], list[int], list[int]]:
        """All nodes, parents before their children; parent and depth by node."""
        order, parent, depth = [0], [-1] * len(self.turn), [0] * len(self.turn)
        todo = [(self.eq[0], 0)] if self.eq[0] >= 0 else []
        while todo:
            node, above = todo.pop()
            order.append(node)
            parent[node], depth[node] = above, depth[above] + 1
            todo += [(n, p) for n, p in ((self.lo[node], above), (self.hi[node], above), (self.eq[node], node)) if n >= 0]
        return order, parent, depth


def medians_first(n: int) -> Iterator[int]:
    """0 to n - 1, the median of each range before those of its halves."""
    todo = [(0, n)]
    while todo:
        a, b = todo.pop()
        if a < b:
            middle = (a + b) // 2
            yield middle
            todo += [(middle + 1, b), (a, middle)]


def path_keys(turns: list[int]) -> list[bytes]:
    """128 bits of each prefix of a sequence, the empty one first."""
    digest = hashlib.blake2b(digest_size=16)
    keys = [digest.digest()]
    for turn in turns:
        digest.update(turn.to_bytes(8, "big"))
        keys.append(digest.digest())
    return keys


class _Writer:
    """Rows of the common schema, handed out in batches."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []

    def add(self, **values) -> None:
        self.rows.append(tuple(values.get(f) for f in _FIELDS))

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [()] * len(_FIELDS)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], names=_FIELDS)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[int], list[int]]]:
    """(turns, words, conv_ids) of each distinct sequence of sorted rows."""
    turns, words, convs = None, None, []
    for batch in batches:
        for conv, ids, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if ids != turns:
                if convs:
                    yield turns, words, convs
                turns, words, convs = ids, n, []
            convs.append(conv)
    if convs:
        yield turns, words, convs


def _shard(root: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The nodes of one shard: those off its first and last path are complete."""
        shard = TaskContext.get().partitionId()
        runs = [(t, w, len(c), c[0], ",".join(map(str, c)).encode()) for t, w, c in _runs(batches)]
        if not runs:
            return
        tree, out = TernaryTree(), _Writer()
        for i in medians_first(len(runs)):
            tree.insert(*runs[i][:4], i)
        order, parent, depth = tree.walk()
        first, last = runs[0][0], runs[-1][0]
        sides = {n: (0, k) for n, k in zip(tree.find(first), path_keys(first))}
        for n, k in zip(tree.find(last), path_keys(last)):
            sides.setdefault(n, (1, k))
        children, leaves, saved = ([0] * len(order) for _ in range(3))
        for node in reversed(order):
            if node in sides:
                continue
            above = parent[node]
            leaves[node] = leaves[node] or 1
            saved[node] += (tree.members[node] - 1) * tree.words[node]
            children[above] += 1
            leaves[above] += leaves[node]
            saved[above] += saved[node]
        for node in order:
            ids = runs[tree.ended[node]][4] if tree.ended[node] >= 0 else b""
            side, key = sides.get(node, (None, None))
            known = {"shard": shard, "depth": depth[node], "conv_id": tree.least[node], "n_convs": tree.members[node],
                     "n_children": children[node], "n_leaves": leaves[node], "saved_tokens": saved[node]}
            if key is None:
                above = parent[node]
                pending = above in sides and above
                out.add(kind="node", **known, ends_sha256=hashlib.sha256(ids).hexdigest(), parent_key=sides[above][1] if pending else None,
                        parent_conv_id=root if above == 0 else None if pending else tree.least[above])
            else:
                out.add(kind="open", **known, side=side, key=key, turn=tree.turn[node], words=tree.words[node])
                if ids:
                    out.add(kind="ids", shard=shard, key=key, ids=ids)
            if len(out.rows) >= 10_000:
                yield out.batch()
        yield out.batch()

    return nodes


# --- boundary nodes --------------------------------------------------------------------------------


def _open_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[dict], list[dict]]]:
    """(group, shard, first path, rest of the last path) of rows sorted by group, shard, side and depth."""
    at, paths = None, ([], [])
    for batch in batches:
        for row in batch.to_pylist():
            if (row["group"], row["shard"]) != at:
                if at:
                    yield *at, *paths
                at, paths = (row["group"], row["shard"]), ([], [])
            paths[row["side"]].append(row)
    if at:
        yield *at, *paths


def _merge(last_round: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Merge the paths of each group in order; in the last round no path stays open."""

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, stack, group = _Writer(), [], None

        def write(kind: str, node: dict, **more) -> None:
            out.add(**{f: node[f] for f in ("depth", "conv_id", "n_convs", "key", "n_children", "n_leaves", "saved_tokens", "turn", "words")}, kind=kind, **more)

        def pop() -> None:
            node = stack.pop()
            if node["left"]:
                write("open", node, shard=group, side=0)
                return
            node["n_leaves"] = node["n_leaves"] or 1
            node["saved_tokens"] += (node["n_convs"] - 1) * node["words"]
            write("node", node, parent_key=stack[-1]["key"] if stack else None)
            if stack:
                stack[-1]["n_children"] += 1
                stack[-1]["n_leaves"] += node["n_leaves"]
                stack[-1]["saved_tokens"] += node["saved_tokens"]

        def finish() -> None:
            if last_round:
                while stack:
                    pop()
            for node in stack:
                write("open", node, shard=group, side=0 if node["left"] else 1)
            stack.clear()

        for own, _, path, rest in _open_paths(batches):
            if own != group:
                finish()
                group = own
            begins = not stack
            same = 0
            while same < min(len(stack), len(path)) and stack[same]["turn"] == path[same]["turn"]:
                node, more = stack[same], path[same]
                for f in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                    node[f] += more[f]
                node["conv_id"] = min(node["conv_id"], more["conv_id"])
                same += 1
            while len(stack) > same:
                pop()
            stack += [node | {"left": begins and not last_round} for node in path[same:]]
            if rest:
                while len(stack) > rest[0]["depth"]:
                    pop()
                stack += [node | {"left": False} for node in rest]
            if len(out.rows) >= 10_000:
                yield out.batch()
        finish()
        yield out.batch()

    return merged


def _boundary(rows: DataFrame, shards: int, fan: int) -> DataFrame:
    """The merged nodes of all boundary paths."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    done, now = None, rows.filter("kind = 'open'")
    while True:
        groups = -(-shards // fan)
        dealt = now.withColumn("group", F.floor(F.col("shard") / fan)).repartition(min(parts, groups), "group")
        now = stage(dealt.sortWithinPartitions("group", "shard", "side", "depth").mapInArrow(_merge(groups == 1), _ROWS), "boundary")
        nodes = now.filter("kind = 'node'")
        done = nodes if done is None else done.union(nodes)
        if groups == 1:
            return done
        now, shards = now.filter("kind = 'open'"), groups


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids of each key, whose pieces come in order, one piece at a time."""
    key, digest = None, None
    keys, ends = [], []
    for batch in batches:
        for own, ids in zip(batch.column(0), batch.column(1)):
            own, ids = own.as_py(), ids.as_py()
            if own == key:
                digest.update(b"," + ids)
            else:
                if digest:
                    keys.append(key)
                    ends.append(digest.hexdigest())
                key, digest = own, hashlib.sha256(ids)
    if digest:
        keys.append(key)
        ends.append(digest.hexdigest())
    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ends, pa.string())], names=["k", "ends"])


def prefix_nodes(sequences: DataFrame, shard_turns: int = SHARD_TURNS, least_turns: int = LEAST_TURNS, fan: int = FAN) -> DataFrame:
    """Every distinct prefix of the sequences (conv_id, ids, words), the empty one included, as a node of their trie.

    Returns conv_id (the smallest of its members: the conversations that begin with it), depth, parent_conv_id
    (conv_id of the prefix that is one shorter; null for the root), n_convs (members), n_children, n_leaves
    (nodes without children at or below it), saved_tokens (over it and all below: words of the last turn times
    members less one) and ends_sha256 (of the members that end there: their conv_ids, ascending, joined by
    commas; of nothing where none does). An empty sequence is a member of the root. Each row is a member, so
    conv_ids should not repeat. Other columns play no part; no sequences give no nodes.

    The SHA-256 of one node's ids can only be taken in their order, so one task reads them, piece by piece.
    """
    spark = sequences.sparkSession
    sequences = stage(sequences.select("conv_id", "ids", "words"), "sequences")
    n, turns, root = sequences.agg(F.count(F.lit(1)), F.sum(F.size("ids") + 1), F.min("conv_id")).first()
    if not n:
        return spark.createDataFrame([], _NODE)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(-(-turns // shard_turns), min(parts, -(-turns // least_turns)))
    dealt = sequences.repartitionByRange(shards, "ids", "conv_id").sortWithinPartitions("ids", "conv_id")
    rows = stage(dealt.mapInArrow(_shard(root), _ROWS), "shards")
    # Whatever number of partitions the session makes of it, every shard's number is below this.
    shards = rows.agg(F.max("shard")).first()[0] + 1
    boundary = stage(_boundary(rows, shards, fan), "boundary")

    pieces = rows.filter("kind = 'ids'").repartition(parts, "key").sortWithinPartitions("key", "shard").select("key", "ids")
    ends = pieces.mapInArrow(_hash_ids, "k binary, ends string")
    nothing = hashlib.sha256(b"").hexdigest()
    merged = boundary.join(ends, F.col("key") == F.col("k"), "left").withColumn("ends_sha256", F.coalesce("ends", F.lit(nothing)))
    names = [f.split()[0] for f in _NODE.split(", ")]
    complete = rows.filter("kind = 'node' and parent_key is null").select(*names)
    pending = rows.filter("kind = 'node' and parent_key is not null").select("parent_key", *names).union(merged.select("parent_key", *names))
    parents = boundary.select(F.col("key").alias("k"), F.col("conv_id").alias("above"))
    found = pending.join(parents, F.col("parent_key") == F.col("k"), "left").withColumn("parent_conv_id", F.col("above"))
    return complete.union(found.select(*names))
