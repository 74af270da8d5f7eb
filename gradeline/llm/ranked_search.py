"""Ranked lexical search of documents for benchmark items over document FP-trees.

Documents are restricted to the terms of the items and each is written as its terms in order of document
frequency, the most frequent first. Sorted, such vectors form a trie: documents that share first terms stand side
by side. A task builds trees of a bounded number of documents. A node keeps, for each term, the largest tf below
it and the smallest m below it; their score is a bound for all documents below. For each item the tree is searched
depth first, the child with the largest bound first, and branches whose bound is under the item's 20th score so far
are left out. Leaves hold a few neighbouring documents, which are scored exactly.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeline.llm.words import _pieces
from gradeline.sources.stage import stage

TOP = 20
#: Bounds of one tree: documents and entries of their vectors (one document may have more).
TREE_DOCS, TREE_ENTRIES = 8192, 2_000_000
#: Documents of a leaf.
LEAF = 8
#: Characters of the items that are searched in one pass over the documents; they bound what is broadcast.
BLOCK_CHARS = 4_000_000
#: Groups that the best documents of the tasks pass before the last ranking of an item.
SALTS = 32

# A term is a run of ASCII letters and digits and of all characters beyond ASCII; A-Z are lower-cased.
_TERM = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()
_LAST = -(1 << 64)


def term_counts(text: str | None) -> tuple[Counter, int]:
    """Terms of a whole text with their counts, and the number of all."""
    counts: Counter = Counter()
    for piece in _pieces((text or "").encode().translate(_TERM)):
        counts.update(piece.split())
    return counts, counts.total()


# --- the tree --------------------------------------------------------------------------------------


@dataclass
class Tree:
    """Nodes in breadth-first order, so that the children of a node stand side by side."""

    first: list[int]  # first child; for a leaf its first document
    last: list[int]
    leaf: list[bool]
    node_at: np.ndarray  # entries of each node
    node_terms: np.ndarray
    node_values: np.ndarray
    doc_at: np.ndarray  # entries of each document, in the order of the trie
    doc_terms: np.ndarray
    doc_values: np.ndarray
    ids: list[int]


def _value(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a weight is multiplied by: grows with tf and falls with m."""
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def _children(lo: int, hi: int, shared: np.ndarray) -> list[tuple[int, int]]:
    """The branches of the documents lo:hi in the trie.

    A branch that holds more than half of them is opened in place, so that a document lies in few nested nodes.
    Small neighbouring branches are put together to one leaf.
    """
    out, todo, half = [], [(lo, hi)], (hi - lo) // 2
    while todo:
        a, b = todo.pop()
        inside = shared[a:b - 1]
        cuts = [a, *(np.flatnonzero(inside == inside.min()) + a + 1).tolist(), b]
        for at in range(len(cuts) - 1):
            x, y = cuts[at], cuts[at + 1]
            if y - x > max(half, LEAF):
                todo.append((x, y))
            else:
                out.append((x, y))
    out.sort()
    joined = [out[0]]
    for x, y in out[1:]:
        if y - joined[-1][0] <= LEAF:
            joined[-1] = (joined[-1][0], y)
        else:
            joined.append((x, y))
    return joined


def _largest(terms: np.ndarray, tfs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each distinct term with its largest tf."""
    order = np.argsort(terms, kind="stable")
    terms, tfs = terms[order], tfs[order]
    new = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]]))
    return terms[new], np.maximum.reduceat(tfs, new)


def build(ids: list[int], vectors: list[tuple[np.ndarray, np.ndarray]], m: list[int]) -> Tree:
    """The tree of documents with ranked terms (ascending) and tf, none of them empty."""
    order = sorted(range(len(ids)), key=lambda i: vectors[i][0].astype(">u4").tobytes())
    rows = [vectors[i] for i in order]
    ms = np.array([m[i] for i in order], np.int64)
    shared = np.zeros(len(rows), np.int64)
    for i in range(len(rows) - 1):
        a, b = rows[i][0], rows[i + 1][0]
        n = min(len(a), len(b))
        unequal = a[:n] != b[:n]
        shared[i] = int(unequal.argmax()) if unequal.any() else n
    span, first, last, leaf = [(0, len(rows))], [], [], []
    at = 0
    while at < len(span):
        lo, hi = span[at]
        if hi - lo <= LEAF:
            first.append(lo), last.append(hi), leaf.append(True)
        else:
            below = _children(lo, hi, shared)
            first.append(len(span)), last.append(len(span) + len(below)), leaf.append(False)
            span += below
        at += 1
    best: list[tuple[np.ndarray, np.ndarray]] = [None] * len(span)
    least = np.zeros(len(span), np.int64)
    for at in range(len(span) - 1, -1, -1):  # children come after their parent
        parts = rows[first[at]:last[at]] if leaf[at] else best[first[at]:last[at]]
        best[at] = _largest(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
        least[at] = ms[span[at][0]:span[at][1]].min()

    def flat(lists, mins):
        sizes = [len(t) for t, _ in lists]
        terms, tfs = (np.concatenate([x[k] for x in lists]) for k in (0, 1))
        return np.concatenate([[0], np.cumsum(sizes)]), terms.astype(np.int64), _value(tfs.astype(np.int64), np.repeat(mins, sizes))

    return Tree(first, last, leaf, *flat(best, least), *flat(rows, ms), [ids[i] for i in order])


def _sums(at: np.ndarray, terms: np.ndarray, values: np.ndarray, lo: int, hi: int, weights: np.ndarray) -> np.ndarray:
    p, q = at[lo], at[hi]
    return np.add.reduceat(weights[terms[p:q]] * values[p:q], at[lo:hi] - p)


def search(tree: Tree, weights: np.ndarray, heap: list[tuple[int, int]], top: int = TOP) -> int:
    """Bring the best documents of the tree for one item into ``heap`` of (score, -doc_id); returns the nodes opened."""
    todo, opened = [(1 << 62, 0)], 0
    while todo:
        bound, node = todo.pop()
        least = heap[0][0] if len(heap) == top else 1
        if bound < least:
            continue
        opened += 1
        lo, hi = tree.first[node], tree.last[node]
        if tree.leaf[node]:
            scores = _sums(tree.doc_at, tree.doc_terms, tree.doc_values, lo, hi, weights)
            for i in np.flatnonzero(scores >= least):
                found = (int(scores[i]), -tree.ids[lo + i])
                if len(heap) < top:
                    heapq.heappush(heap, found)
                elif found > heap[0]:
                    heapq.heapreplace(heap, found)
        else:
            bounds = _sums(tree.node_at, tree.node_terms, tree.node_values, lo, hi, weights)
            good = np.flatnonzero(bounds >= least)
            todo += [(int(bounds[i]), lo + int(i)) for i in good[np.argsort(bounds[good], kind="stable")]]
    return opened


# --- the passes ------------------------------------------------------------------------------------


@dataclass
class Items:
    """The items of one block: terms of each as (term ids, counts), and the numbers of all terms."""

    ids: list[int | None]
    terms: list[tuple[np.ndarray, np.ndarray]]
    vocabulary: dict[bytes, int]


def _blocks(items: DataFrame, block_chars: int) -> Iterator[Items]:
    """Items in blocks of bounded size; rows that share an item_id are in one block."""
    items = items.select("item_id", "text").filter("text is not null")
    n = max(1, math.ceil((items.agg(F.sum(F.char_length("text"))).first()[0] or 0) / block_chars))
    for block in range(n):
        own: dict[int | None, Counter] = {}
        for row in items.filter(F.pmod(F.xxhash64("item_id"), F.lit(n)) == block).toLocalIterator():
            own.setdefault(row.item_id, Counter()).update(term_counts(row.text)[0])
        vocabulary = {t: i for i, t in enumerate(sorted(set().union(*own.values())))}
        terms = [(np.array([vocabulary[t] for t in c], np.int64), np.array(list(c.values()), np.int64)) for c in own.values()]
        yield Items(list(own), terms, vocabulary)


def restrict(documents: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs) of each document with a term: all its terms counted, those of the items listed; staged."""
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts, n = term_counts(text.as_py())
                if n:
                    held = shared.value
                    own = [(held[t], k) for t, k in counts.items() if t in held]
                    rows.append((doc_id, n, np.array([t for t, _ in own], np.int32).tobytes(), np.array([k for _, k in own], np.int32).tobytes()))
            columns = [list(c) for c in zip(*rows)] or [[], [], [], []]
            types = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "n", "terms", "tfs"])

    vectors = documents.select("doc_id", "text").mapInArrow(read, "doc_id long, n long, terms binary, tfs binary")
    vectors = stage(vectors, "vectors")
    shared.destroy()
    return vectors


def document_frequencies(vectors: DataFrame, n_terms: int) -> np.ndarray:
    """Documents that hold each term; each task sends one count a term."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_terms, np.int64)
        for batch in batches:
            for terms in batch.column(0):
                df[np.frombuffer(terms.as_py(), np.int32)] += 1
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(df[held], pa.int64())], names=["term", "df"])

    out = np.zeros(n_terms, np.int64)
    counts = vectors.select("terms").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for row in counts.toLocalIterator():  # at most one row per term of the items
        out[row.term] = row.df
    return out


def _best(vectors: DataFrame, items: Items, rank: np.ndarray, weight: np.ndarray, n_docs: int, n_all: int, top: int) -> DataFrame:
    """(item_id, doc_id, score): the best documents of each task for each item, staged."""
    shared = vectors.sparkSession.sparkContext.broadcast((items.ids, items.terms, rank, weight))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, terms, ranks, weights = shared.value
        heaps: list[list[tuple[int, int]]] = [[] for _ in ids]
        asked = np.zeros(len(ranks), np.int64)
        held: list[tuple[int, tuple[np.ndarray, np.ndarray], int]] = []
        size = 0

        def look() -> None:
            tree = build(*map(list, zip(*held)))
            for (own, counts), heap in zip(terms, heaps):
                asked[ranks[own]] = counts * weights[own]
                search(tree, asked, heap, top)
                asked[ranks[own]] = 0

        for batch in batches:
            for doc_id, n, raw, tfs in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if raw:
                    places = ranks[np.frombuffer(raw, np.int32)]
                    order = np.argsort(places)
                    vector = places[order], np.frombuffer(tfs, np.int32)[order]
                    held.append((-_LAST if doc_id is None else doc_id, vector, 75 + 25 * n * n_docs // n_all))
                    size += len(order)
                    if len(held) == TREE_DOCS or size > TREE_ENTRIES:
                        look()
                        held, size = [], 0
        if held:
            look()
        rows = [(i, None if key == _LAST else -key, score) for i, heap in zip(ids, heaps) for score, key in heap]
        columns = [list(c) for c in zip(*rows)] or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item_id", "doc_id", "score"])

    best = stage(vectors.mapInArrow(find, "item_id long, doc_id long, score long"), "best")
    shared.destroy()
    return best


def rank_documents(documents: DataFrame, items: DataFrame, top: int = TOP, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The ``top`` documents with the highest score above 0 for each item: item_id, rank, doc_id, score.

    Equal scores are ordered by doc_id, a null one last. Null texts have no term; documents without a term
    are not counted. Document rows are judged one by one, also those that repeat a doc_id. Rows of ``items``
    that share an item_id, or have none, are one item with all their terms; items without a term, or whose
    terms no document holds, give no row. Whole texts are read. Other columns play no part. An empty table on
    either side gives no rows. Items are searched in blocks of ``block_chars`` characters, each in passes of
    its own.
    """
    found = None
    for block in _blocks(items, block_chars):
        vectors = restrict(documents, block.vocabulary)
        n_docs, n_all = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = document_frequencies(vectors, len(block.vocabulary))
        rank = np.empty(len(df), np.int64)
        rank[np.lexsort([np.arange(len(df)), -df])] = np.arange(len(df))
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        part = _best(vectors, block, rank, weight, n_docs, n_all, top)
        found = part if found is None else found.union(part)
    best = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "salt").orderBy(*best))).filter(F.col("rank") <= top)
    last = first.drop("rank").withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*best)))
    return last.filter(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
