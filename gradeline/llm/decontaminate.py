"""Benchmark decontamination by pigeonhole edit matching on words.

A test item of n words may appear with up to ``budget`` word edits. Cut into budget + 1 pieces, any such
appearance holds one piece unchanged. Windows of words are hashed for whole documents and looked up among
the pieces; round each hit, Myers' bit-parallel algorithm gives the exact edit distance of the best match.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from unicodedata import combining

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeline.llm.words import window_hashes, word_hashes

RATE = 0.15
WIDEST = 5
#: Text of items that is broadcast at once; a longer benchmark is searched in several passes.
BLOCK_CHARS = 4_000_000
#: ASCII letters and digits and the bytes of all other characters stay, everything else is a space.
_ASCII = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def plain(text: str | None) -> bytes:
    """Lower-case letters and digits, everything else a space (several may follow each other)."""
    text = (text or "").lower()
    if not text.isascii():
        for c in set(text):
            if c > "\x7f" and not c.isalnum() and not combining(c):
                text = text.replace(c, " ")
    return text.encode().translate(_ASCII)


def budget_of(n_words: int, rate: float = RATE) -> int:
    return int(n_words * rate)


@dataclass
class Index:
    """Items of one block and their pieces, sorted by hash for each window width."""

    ids: list
    words: list[np.ndarray]
    budgets: list[int]
    widths: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def build_index(items: list[tuple[int, str]], rate: float = RATE) -> Index:
    """Pieces of every item that has a word. A piece longer than ``WIDEST`` words is looked up by its first ones."""
    ids, words, budgets, pieces = [], [], [], {}
    for item_id, text in items:
        for _, own, _ in word_hashes([plain(text)]):
            if not len(own):
                continue
            budget = budget_of(len(own), rate)
            width = min(WIDEST, len(own) // (budget + 1))
            for k in range(budget + 1):
                offset = k * len(own) // (budget + 1)
                key = window_hashes(own[offset:offset + width], width)[0]
                pieces.setdefault(width, []).append((key, len(ids), offset))
            ids.append(item_id)
            words.append(own)
            budgets.append(budget)
    widths = {}
    for width, found in pieces.items():
        keys = np.array([f[0] for f in found], np.uint64)
        order = np.argsort(keys, kind="stable")
        maybe = np.zeros(1 << 20, bool)
        maybe[(keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        widths[width] = (keys[order], np.array([f[1] for f in found])[order], np.array([f[2] for f in found])[order], maybe)
    return Index(ids, words, budgets, widths)


def distance(item: np.ndarray, text: np.ndarray) -> int:
    """Smallest edit distance between ``item`` and any stretch of ``text`` (Myers, one bit per item word)."""
    m = len(item)
    match: dict[int, int] = {}
    for i, word in enumerate(item.tolist()):
        match[word] = match.get(word, 0) | 1 << i
    ones, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best = ones, 0, m, m
    for word in text.tolist():
        eq = match.get(word, 0)
        vertical = eq | minus
        horizontal = (((eq & plus) + plus) ^ plus) | eq
        up = minus | (ones & ~(horizontal | plus))
        down = plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = (up << 1) & ones, (down << 1) & ones
        plus = down | (ones & ~(vertical | up))
        minus = up & vertical
        best = min(best, score)
    return best


def leaks(texts: list[bytes], index: Index) -> Iterator[tuple[int, int, int]]:
    """(text number, item number, distance) of every item within its budget in a text."""
    first = 0
    for n, words, offsets in word_hashes(texts):
        regions: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for width, (keys, items, starts, maybe) in index.widths.items():
            windows = window_hashes(words, width)
            at = np.flatnonzero(maybe[(windows & np.uint64((1 << 20) - 1)).astype(np.int64)])
            lo, hi = np.searchsorted(keys, windows[at], "left"), np.searchsorted(keys, windows[at], "right")
            at, lo, hi = (x[hi > lo] for x in (at, lo, hi))
            docs = np.searchsorted(offsets, at, "right") - 1
            for pos, doc, a, b in zip(at.tolist(), docs.tolist(), lo.tolist(), hi.tolist()):
                if pos + width > offsets[doc + 1]:
                    continue
                for p in range(a, b):
                    item, start = int(items[p]), pos - int(starts[p])
                    spare = index.budgets[item]
                    span = (max(int(offsets[doc]), start - spare), min(int(offsets[doc + 1]), start + len(index.words[item]) + spare))
                    regions.setdefault((doc, item), []).append(span)
        for (doc, item), spans in regions.items():
            best, end = None, -1
            joined: list[list[int]] = []
            for a, b in sorted(spans):
                if joined and a <= end:
                    joined[-1][1] = end = max(end, b)
                else:
                    joined.append([a, b])
                    end = b
            for a, b in joined:
                found = distance(index.words[item], words[a:b])
                best = found if best is None else min(best, found)
            if best <= index.budgets[item]:
                yield first + doc, item, best
        first += n


def _blocks(benchmark: DataFrame, rate: float, block_chars: int) -> Iterator[Broadcast]:
    """The index of each block of items, broadcast; every item is in one block."""
    items = benchmark.select("item_id", "text").filter("item_id is not null and text is not null").distinct()
    chars = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    n = max(1, math.ceil(chars / block_chars))
    for block in range(n):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block).collect()
        yield benchmark.sparkSession.sparkContext.broadcast(build_index([(r.item_id, r.text) for r in own], rate))


def find_leaks(documents: DataFrame, benchmark: DataFrame, rate: float = RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Every document that holds a benchmark item within its budget of word edits.

    Returns doc_id, item_id, distance (word edits), budget (15 % of the item's words, rounded down) and
    item_words, one row per document row and item. Words are runs of letters and digits, lower-cased.
    Whole texts are searched. Null and empty texts hold nothing; items with a null id or without a word
    match nothing; an item id with several texts gives a row for each; repeated document rows give
    repeated rows. Other columns play no part. An empty table on either side gives no rows.
    """
    found = None
    for index in _blocks(benchmark, rate, block_chars):
        def search(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            held = index.value
            for batch in batches:
                hits = list(leaks([plain(t) for t in batch.column(1).to_pylist()], held))
                rows, items = [h[0] for h in hits], [h[1] for h in hits]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), pa.array([held.ids[i] for i in items], pa.int64()),
                     pa.array([h[2] for h in hits], pa.int32()), pa.array([held.budgets[i] for i in items], pa.int32()),
                     pa.array([len(held.words[i]) for i in items], pa.int32())],
                    names=["doc_id", "item_id", "distance", "budget", "item_words"],
                )

        part = documents.select("doc_id", "text").mapInArrow(
            search, "doc_id long, item_id long, distance int, budget int, item_words int"
        )
        found = part if found is None else found.union(part)
    return found


def drop_leaks(documents: DataFrame, benchmark: DataFrame, rate: float = RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns; nothing is shuffled."""
    place = documents.columns.index("text")
    kept = documents
    for index in _blocks(benchmark, rate, block_chars):
        def clean(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                mask = np.ones(batch.num_rows, bool)
                mask[[h[0] for h in leaks([plain(t) for t in batch.column(place).to_pylist()], index.value)]] = False
                yield batch.filter(pa.array(mask))

        kept = kept.mapInArrow(clean, documents.schema)
    return kept
