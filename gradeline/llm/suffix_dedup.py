"""Removal of repeated passages by groups of hashed word windows.

Not suffix trees: no suffix is ordered by its words, and the only depth that is found is ``window`` words. Of the
8-word grams in a window the one with the least hash, its anchor, is the same in every copy of the window, so a
window whose anchor occurs once in the corpus is unique and does not move. The others are dealt into groups by
their anchor, or for an anchor with too many occurrences by the hash of the whole window. In a group the 64-bit
hashes of the windows are sorted; equal ones are a repeat, and the first in the order of documents is the occurrence
that stays. Windows are compared by these hashes, not again by their words: with n windows in the corpus two
different ones are taken for equal with a probability of about n * n / 2**65. Neighbouring repeats join to longer ones.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeline.llm.words import mix, window_hashes, word_hashes
from gradeline.sources.stage import stage

WINDOW = 20
GRAM = 8
#: An anchor with more occurrences is split by its windows; a group of suffixes has about this many rows.
GROUP_ROWS = 100_000
MOST_HOT = 50_000
#: Words of 64 bits in the filter of repeated anchors: 16 MB at most. A fuller one passes more, never less.
MAX_FILTER = 1 << 21
_U = np.uint64
_NONE = np.iinfo(np.int64).min


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` neighbours."""
    if len(x) < width:
        return x[:0]
    span, out = 1, x
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def _windows(texts: list[bytes], window: int, gram: int) -> Iterator[tuple]:
    """By slab: (first text, texts, start in the words, text, place in the text, anchor) of all windows."""
    first = 0
    for n, words, offsets in word_hashes(texts):
        grams = mix(window_hashes(words, gram))
        anchors = mix(_sliding_least(grams, window - gram + 1) + _U(1))
        counts = np.maximum(np.diff(offsets) - window + 1, 0)
        doc = np.repeat(np.arange(n), counts)
        place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        start = offsets[:-1][doc] + place
        yield first, words, start, doc + first, place, anchors[start]
        first += n


def _bytes(column: pa.Array) -> list[bytes]:
    return [(t or "").encode() for t in column.to_pylist()]


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(_NONE).to_numpy(zero_copy_only=False).astype(np.int64)


def repeated_anchors(documents: DataFrame, window: int, gram: int) -> DataFrame:
    """(anchor, n) of the anchors with more than one occurrence; only hashes move, counted in each task first."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, words, offsets in word_hashes(_bytes(batch.column(0))):
                values, counts = np.unique(_anchor_places(words, offsets, window, gram), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts, pa.int64())], names=["anchor", "n"])

    found = documents.select("text").mapInArrow(find, "anchor long, n long")
    return stage(found.groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1"), "anchors")


def _anchor_places(words: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> np.ndarray:
    """The anchor once for each place where it is the least gram of some window of its text."""
    span, grams = window - gram + 1, mix(window_hashes(words, gram))
    least = _sliding_least(grams, span)
    if not len(least):
        return least
    ends = np.repeat(offsets[1:], np.diff(offsets))[:len(least)]
    least = np.where(np.arange(len(least)) + window <= ends, least, _U(0))
    # A gram is above no window's least that holds it, so it is an anchor if the largest of these equals it.
    padded = np.concatenate([np.zeros(span - 1, _U), least, np.zeros(span - 1, _U)])
    largest = ~_sliding_least(~padded, span)
    return mix(grams[(largest == grams) & (largest > 0)] + _U(1))


def _filter(anchors: DataFrame) -> tuple[np.ndarray, int]:
    """A Bloom filter of the anchors, three bits in one 64-bit word each; its size is bounded."""
    count = anchors.count()
    bits = max(1, min(int(math.log2(MAX_FILTER)), math.ceil(math.log2(max(1, count) * 12 / 64 + 1))))
    one = F.lit(1).cast("long")
    bit = lambda at: F.call_function("shiftleft", one, F.shiftrightunsigned("anchor", at).bitwiseAND(63).cast("int"))
    rows = (
        anchors.select(F.shiftrightunsigned("anchor", 64 - bits).alias("word"), bit(0).bitwiseOR(bit(6)).bitwiseOR(bit(12)).alias("mask"))
        .groupBy("word").agg(F.bit_or("mask").alias("mask")).toPandas()
    )
    table = np.zeros(1 << bits, _U)
    table[rows["word"].to_numpy(np.int64)] = rows["mask"].to_numpy(np.int64).view(_U)
    return table, bits


def _passes(anchor: np.ndarray, table: np.ndarray, bits: int) -> np.ndarray:
    one, low = _U(1), _U(63)
    mask = (one << (anchor & low)) | (one << ((anchor >> _U(6)) & low)) | (one << ((anchor >> _U(12)) & low))
    return (table[(anchor >> _U(64 - bits)).astype(np.int64)] & mask) == mask


_SUFFIXES = "key long, doc_id long, tag long, start long, windows array<long>, seen boolean"


def _rows(key, doc_id, tag, start, windows, seen: bool, breaks: np.ndarray) -> pa.RecordBatch:
    """One row for each stretch that begins where ``breaks`` is true."""
    at = np.flatnonzero(breaks)
    offsets = np.append(at, len(breaks)).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(windows.view(np.int64)))
    return pa.RecordBatch.from_arrays(
        [pa.array(key[at].view(np.int64)), pa.array(doc_id[at]), pa.array(tag[at].view(np.int64)), pa.array(start[at], pa.int64()),
         lists, pa.array(np.full(len(at), seen))],
        names=["key", "doc_id", "tag", "start", "windows", "seen"],
    )


def _stretches(doc_id, tag, start, *others) -> np.ndarray:
    breaks = np.ones(len(start), bool)
    same = (doc_id[1:] == doc_id[:-1]) & (tag[1:] == tag[:-1]) & (start[1:] == start[:-1] + 1)
    for x in others:
        same &= x[1:] == x[:-1]
    breaks[1:] = ~same
    return breaks


def _later(windows, doc_id, start) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of suffixes, and which of them in that order have an equal window before them."""
    order = np.lexsort((start, doc_id, windows))
    w, d, s = windows[order], doc_id[order], start[order]
    new = np.ones(len(w), bool)
    new[1:] = w[1:] != w[:-1]
    node = np.maximum.accumulate(np.where(new, np.arange(len(w)), 0))
    return order, (d != d[node]) | (s != s[node])


def suffixes(documents: DataFrame, table: Broadcast, bits: int, hot: Broadcast, window: int, gram: int) -> DataFrame:
    """Suffixes with a repeated anchor, one row per stretch of windows with the same key.

    Of equal windows in one batch only the first goes on; the later ones are known to be repeats at once
    (``seen``), so a passage that most documents share costs a row per batch.
    """
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled, crowded = table.value, hot.value
        for batch in batches:
            ids, parts = _ids(batch.column(0)), []
            for first, words, start, doc, place, anchor in _windows(_bytes(batch.column(1)), window, gram):
                whole = np.zeros(batch.num_rows, _U)
                some = np.flatnonzero(_passes(anchor, filled, bits))
                if len(some):
                    marks = window_hashes(words, window)[start[some]]
                    ends = np.unique(doc[some])
                    lo = np.searchsorted(doc, ends, "left")
                    hi = np.searchsorted(doc, ends, "right") - 1
                    all_marks = np.concatenate([[_U(0)], np.cumsum(mix(window_hashes(words, window)[start] ^ place.astype(_U)))])
                    whole[ends] = mix(all_marks[hi + 1] - all_marks[lo])
                    parts.append((marks, ids[doc[some]], whole[doc[some]], place[some], anchor[some]))
            if not parts:
                continue
            marks, doc_id, tag, place, anchor = (np.concatenate(x) for x in zip(*parts))
            order, later = _later(marks, doc_id, place)
            again = np.zeros(len(marks), bool)
            again[order] = later
            if again.any():
                d, t, p = doc_id[again], tag[again], place[again]
                yield _rows(mix(d.view(_U) ^ t), d, t, p, np.zeros(len(p), _U), True, _stretches(d, t, p))
            d, t, p, m, a = (x[~again] for x in (doc_id, tag, place, marks, anchor))
            key = np.where(np.isin(a, crowded), mix(m), a) if len(crowded) else a
            yield _rows(key, d, t, p, m, False, _stretches(d, t, p, key))

    return documents.select("doc_id", "text").mapInArrow(find, _SUFFIXES)


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeats of all groups of a partition: doc_id, tag, start, length (in windows)."""
    parts = []
    for batch in batches:
        seen = np.asarray(batch.column("seen").to_pylist(), bool)
        sizes = np.diff(batch.column("windows").offsets.to_numpy())
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "tag", "start")]
        if seen.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[seen]) for c in columns] + [pa.array(sizes[seen], pa.int64())], names=["doc_id", "tag", "start", "length"]
            )
        rows = np.repeat(np.arange(len(sizes)), sizes)
        inside = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        own = ~seen[rows]
        flat = batch.column("windows").flatten().to_numpy(zero_copy_only=False)
        parts.append([flat[own], columns[0][rows][own], columns[1][rows][own], (columns[2][rows] + inside)[own]])
    if not parts:
        return
    windows, doc_id, tag, start = (np.concatenate(x) for x in zip(*parts))
    order, later = _later(windows, doc_id, start)
    found = order[later]
    d, t, s = doc_id[found], tag[found], start[found]
    by = np.lexsort((s, t, d))
    d, t, s = d[by], t[by], s[by]
    at = np.flatnonzero(_stretches(d, t, s)) if len(s) else np.zeros(0, int)
    yield pa.RecordBatch.from_arrays(
        [pa.array(d[at]), pa.array(t[at]), pa.array(s[at]), pa.array(np.diff(np.append(at, len(s))), pa.int64())],
        names=["doc_id", "tag", "start", "length"],
    )


def repeats(documents: DataFrame, window: int = WINDOW, gram: int = GRAM, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Windows of each document that also start earlier: doc_id, tag, start, length (consecutive starts).

    Earlier means a smaller doc_id, or the same document and an earlier start. ``tag`` tells texts with
    one doc_id apart; it is a hash of the text's windows. A null doc_id comes as the smallest long.
    """
    spark = documents.sparkSession
    anchors = repeated_anchors(documents, window, gram)
    total = anchors.agg(F.sum("n")).first()[0] or 0
    limit = max(group_rows, total // MOST_HOT)
    hot = np.array([r.anchor for r in anchors.filter(F.col("n") > limit).select("anchor").collect()], np.int64).view(_U)
    table, bits = _filter(anchors)
    found = suffixes(documents, spark.sparkContext.broadcast(table), bits, spark.sparkContext.broadcast(hot), window, gram)
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / group_rows))
    return found.repartition(groups, "key").mapInArrow(_nodes, "doc_id long, tag long, start long, length long")


def _tags(texts: list[bytes], window: int, gram: int) -> np.ndarray:
    """The tag of each text, as ``suffixes`` makes it."""
    out = np.zeros(len(texts), _U)
    for _, words, start, doc, place, _ in _windows(texts, window, gram):
        if len(start):
            own, lo = np.unique(doc, return_index=True)
            sums = np.concatenate([[_U(0)], np.cumsum(mix(window_hashes(words, window)[start] ^ place.astype(_U)))])
            out[own] = mix(sums[np.append(lo[1:], len(doc))] - sums[lo])
    return out


def remove_repeats(documents: DataFrame, window: int = WINDOW, gram: int = GRAM, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Each document without the words that an earlier passage of ``window`` words or more repeats.

    Returns one row per input row: doc_id, n_words, n_removed and text (kept words joined by one space).
    Words are unchanged and split at space and \\t to \\r. All windows are judged on the input. Null and
    empty texts have no words; a text shorter than a window loses nothing. Rows that repeat a doc_id and
    its text count as one document and keep the same words; rows of one doc_id with different texts are
    documents of which neither is earlier, but equal windows of theirs at other starts count by the start.
    A null doc_id is below every other. Other columns play no part; an empty table has no rows.
    """
    spans = repeats(documents, window, gram, group_rows).groupBy("doc_id").agg(
        F.collect_list(F.struct("tag", "start", "length")).alias("spans")
    ).withColumnRenamed("doc_id", "owner")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts, spans = _bytes(part.column("text")), part.column("spans").to_pylist()
                marked = [i for i, s in enumerate(spans) if s]
                tags = dict(zip(marked, _tags([texts[i] for i in marked], window, gram).view(np.int64).tolist()))
                n, removed, kept = [], [], []
                for i, text in enumerate(texts):
                    words = text.split()
                    gone = np.zeros(len(words) + 1, np.int64)
                    for span in spans[i] or ():
                        if span["tag"] == tags[i]:
                            gone[span["start"]] += 1
                            gone[span["start"] + span["length"] + window - 1] -= 1
                    out = np.cumsum(gone[:-1]) > 0
                    n.append(len(words))
                    removed.append(int(out.sum()))
                    kept.append(b" ".join([w for w, o in zip(words, out.tolist()) if not o] if removed[-1] else words).decode())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                    names=["doc_id", "n_words", "n_removed", "text"],
                )

    owner = F.coalesce(F.col("doc_id"), F.lit(_NONE))
    joined = documents.select("doc_id", "text").join(spans, owner == F.col("owner"), "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(remove, "doc_id long, n_words long, n_removed long, text string")
