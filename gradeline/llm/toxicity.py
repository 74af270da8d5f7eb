"""Toxicity by a convolutional text classifier, trained in numpy.

Words and their prefixes are hashed to embeddings; filters of several widths slide over the whole text, each keeps its
largest value, and a linear layer turns these into a logit. The threshold is calibrated for each
language, which is guessed from function words of the text, never read from a column: the logit is
shifted so that the language's own threshold becomes a score of 0.3. The thresholds come from all usable
labelled rows that the weights were not fitted on, counted in Spark by language, label and cell of the logit.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeline.llm.decontaminate import plain
from gradeline.llm.fitting import class_counts, fold, sample_ids
from gradeline.llm.words import word_hashes
from gradeline.sources.stage import stage

#: Bounds of the sample that a model is fitted on: labelled rows of each class, and words of both, half for each class.
PER_CLASS = 2000
FIT_WORDS = 5_000_000
BUCKETS = 1 << 17
SIZE, FILTERS, WIDTHS = 12, 6, (1, 2, 3)
#: A word's vector is the sum of those of the word and of its first bytes, so that inflected forms share.
PREFIXES = (4, 5)
COLUMNS = 1 + len(PREFIXES)
#: A bucket that fewer documents of the sample hold has no embedding.
LEAST_DOCUMENTS = 4
EPOCHS, BATCH, RATE = 5, 32, 0.01
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2
#: One usable row of RESERVED is never fitted, so that small tables have rows to calibrate on.
RESERVED = 5
#: A language's cut is the mean of its own, weighted by the rows of its rarer class, and of the global one, weighted by this.
SHRINK = 25
#: Logits are counted in cells: so many in one unit, up to this bound on either side.
CELLS, BOUND = 64, 40

# Frequent function words by language.
FUNCTION_WORDS = {
    "en": "the and of to is that it in was for with as on be at by this from are",
    "de": "der die und das ist nicht ein eine zu den von mit auf sich dem des im auch",
    "fr": "le la les et des est une dans du pour que qui sur pas au avec ce il",
    "es": "el los las y del se una por con no su lo como para al es son",
}
LANGUAGES = ("other", *FUNCTION_WORDS)


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(BUCKETS - 1)).astype(np.int32)


def _language_table() -> tuple[np.ndarray, np.ndarray]:
    keys, owners = [], []
    for i, words in enumerate(FUNCTION_WORDS.values(), 1):
        _, hashes, _ = next(word_hashes([words.encode()]))
        keys += hashes.tolist()
        owners += [i] * len(hashes)
    order = np.argsort(np.array(keys, np.uint64), kind="stable")
    return np.array(keys, np.uint64)[order], np.array(owners)[order]


_KEYS, _OWNERS = _language_table()


def languages(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of the language with most function words in each text; 0 where there is none."""
    n = len(offsets) - 1
    counts = np.zeros((n, len(LANGUAGES)), np.int64)
    place = np.minimum(np.searchsorted(_KEYS, hashes), len(_KEYS) - 1)
    hit = np.flatnonzero(_KEYS[place] == hashes)
    np.add.at(counts, (np.searchsorted(offsets, hit, "right") - 1, _OWNERS[place[hit]]), 1)
    return counts.argmax(axis=1)


@dataclass
class Network:
    embeddings: np.ndarray  # last row: nothing
    filters: list[np.ndarray]  # by width: (width, SIZE, FILTERS)
    output: np.ndarray
    bias: float
    known: np.ndarray

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Rows of the embeddings for each word and its prefixes."""
        buckets = _bucket(hashes)
        return np.where(self.known[buckets], buckets, BUCKETS)

    def vectors(self, ids: np.ndarray) -> np.ndarray:
        return sum(self.embeddings[ids[:, c]] for c in range(ids.shape[1]))

    def logits(self, hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Logit of each text. A window that runs past the end of its text has nothing there."""
        n, some = len(offsets) - 1, np.diff(offsets) > 0
        pooled = np.zeros((n, FILTERS * len(WIDTHS)), np.float32)
        if len(hashes):
            products = self.vectors(self.ids(hashes)) @ np.concatenate([f[o] for f in self.filters for o in range(len(f))], axis=1)
            left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(hashes))
            column = 0
            for k, width in enumerate(WIDTHS):
                total = products[:, column:column + FILTERS].copy()
                for o in range(1, width):
                    part = products[o:, column + o * FILTERS:column + (o + 1) * FILTERS]
                    total[:len(part)] += part * (left[:len(part)] > o)[:, None]
                column += width * FILTERS
                pooled[some, k * FILTERS:(k + 1) * FILTERS] = np.maximum.reduceat(total, offsets[:-1][some], axis=0)
        return np.maximum(pooled, 0) @ self.output + self.bias


def _start(texts: list[np.ndarray], y: np.ndarray, rng: np.random.Generator) -> Network:
    """First weights: one embedding coordinate is the log-odds of the documents that hold the bucket."""
    held = np.zeros((2, BUCKETS))
    for words, label in zip(texts, y):
        held[label, np.unique(_bucket(words))] += 1
    odds = np.log((held[1] + 0.5) / (y.sum() + 1)) - np.log((held[0] + 0.5) / ((1 - y).sum() + 1))
    embeddings = rng.normal(0, 0.05, (BUCKETS + 1, SIZE)).astype(np.float32)
    embeddings[:-1, 0] = np.clip(odds, -4, 4) / 2
    embeddings[-1] = 0
    filters = [rng.normal(0, 0.1, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS]
    for f in filters:
        f[:, 0, :] += 1 / len(f)
    output = np.full(FILTERS * len(WIDTHS), 0.3, np.float32)
    return Network(embeddings, filters, output, -1.0, held.sum(axis=0) >= LEAST_DOCUMENTS)


def train_network(texts: list[np.ndarray], y: np.ndarray, seed: int = 11) -> Network:
    """Weights by stochastic gradients; the largest value of a filter passes its gradient to one window."""
    rng = np.random.default_rng(seed)
    net = _start(texts, y, rng)
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
    ids = [net.ids(t) for t in texts]
    squares_e = np.full(net.embeddings.shape, 1e-2, np.float32)
    squares_f = [np.full(f.shape, 1e-2, np.float32) for f in net.filters]
    squares_o = np.full(net.output.shape, 1e-2)
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for begin in range(0, len(order), BATCH):
            batch = order[begin:begin + BATCH]
            grad_e: dict[int, np.ndarray] = {}
            grad_f, grad_o, grad_b = [np.zeros_like(f) for f in net.filters], np.zeros_like(net.output), 0.0
            for d in batch:
                n = len(texts[d])
                if not n:
                    continue
                words = np.concatenate([ids[d], np.full((max(WIDTHS) - 1, ids[d].shape[1]), BUCKETS)])
                vectors, pooled, places = net.vectors(words), [], []
                for f in net.filters:
                    total = vectors[:n] @ f[0]
                    for o in range(1, len(f)):
                        total = total + vectors[o:o + n] @ f[o]
                    best = total.argmax(axis=0)
                    places.append(best)
                    pooled.append(total[best, np.arange(FILTERS)])
                pool = np.concatenate(pooled)
                active = np.maximum(pool, 0)
                p = 1 / (1 + math.exp(-max(-40, min(40, float(active @ net.output + net.bias)))))
                g = (p - y[d]) * weight[d] / len(batch)
                grad_o += g * active
                grad_b += g
                back = g * net.output * (pool > 0)
                for k, (f, best) in enumerate(zip(net.filters, places)):
                    for j, at in enumerate(best):
                        s = back[k * FILTERS + j]
                        if s:
                            for o in range(len(f)):
                                grad_f[k][o, :, j] += s * vectors[at + o]
                                for word in words[at + o]:
                                    if word < BUCKETS:
                                        grad_e[word] = grad_e.get(word, 0) + s * f[o, :, j]
            for word, g in grad_e.items():
                squares_e[word] += g * g
                net.embeddings[word] -= RATE * g / np.sqrt(squares_e[word])
            for f, g, s in zip(net.filters, grad_f, squares_f):
                g = g + 1e-4 * f
                s += g * g
                f -= RATE * g / np.sqrt(s)
            squares_o += grad_o * grad_o
            net.output -= (RATE * grad_o / np.sqrt(squares_o)).astype(np.float32)
            net.bias -= RATE * grad_b
    return net


def _best_cut(toxic: np.ndarray, rest: np.ndarray) -> float:
    """The cut between two logits with the largest F1, from the weight of each class in each cell, lowest cell first."""
    cells = np.flatnonzero(toxic + rest)[::-1]
    hits = np.cumsum(toxic[cells])
    f1 = 2 * hits / (hits + np.cumsum(rest[cells]) + toxic.sum())
    i = int(f1.argmax())
    below = cells[i + 1] if i + 1 < len(cells) else cells[i] - 2 * CELLS
    return float((cells[i] + below) / 2 / CELLS - BOUND)


def shifts_from(counts: np.ndarray, share: float) -> np.ndarray:
    """The cut of each language, from counts by (language, label, cell), weighted to the share of toxic rows.

    A language without rows of both classes has the global cut. Where no language has, nothing is shifted.
    """
    of_class = counts.sum(axis=(0, 2))
    if not of_class.all():
        return np.zeros(len(counts))
    weighted = counts * (np.array([1 - share, share]) / of_class)[None, :, None]
    common = _best_cut(weighted[:, 1].sum(axis=0), weighted[:, 0].sum(axis=0))
    shifts = np.full(len(counts), common)
    for i, n in enumerate(counts.sum(axis=2).min(axis=1)):
        if n:
            shifts[i] = (n * _best_cut(weighted[i, 1], weighted[i, 0]) + SHRINK * common) / (n + SHRINK)
    return shifts


def calibrate(raw: DataFrame, usable: DataFrame, fitted: list[int], share: float) -> np.ndarray:
    """The cut of each language from the logits of all usable labelled rows but the fitted ones."""
    # At most 2 * PER_CLASS ids.
    known = raw.sparkSession.createDataFrame([(i,) for i in fitted], "doc_id long")
    own = usable.filter(F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").cast("int").alias("y")).distinct()
    cell = F.round((F.least(F.greatest("logit", F.lit(-BOUND)), F.lit(BOUND)) + BOUND) * CELLS).cast("int")
    found = (
        own.join(F.broadcast(known), "doc_id", "left_anti").join(raw, "doc_id")
        .groupBy("language", "y", cell.alias("cell")).count().collect()
    )
    counts = np.zeros((len(LANGUAGES), 2, 2 * BOUND * CELLS + 1))
    for r in found:
        counts[r.language, r.y, r.cell] = r["count"]
    return shifts_from(counts, share)


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        start = 0
        for n, hashes, offsets in word_hashes([plain(t) for t in batch.column("text").to_pylist()], PREFIXES):
            part = batch.slice(start, n)
            packed = [hashes[offsets[i]:offsets[i + 1]].tobytes() for i in range(n)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("y"), pa.array(packed, pa.binary())], names=["doc_id", "y", "x"])
            start += n


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        start = 0
        for n, _, offsets in word_hashes([plain(t) for t in batch.column("text").to_pylist()]):
            part = batch.slice(start, n)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("y"), pa.array(np.diff(offsets), pa.int64())], names=["doc_id", "y", "words"]
            )
            start += n


def fitting_rows(candidates: DataFrame, fit_words: int) -> list[tuple[int, int]]:
    """(doc_id, y) of the rows of doc_id, text and y that are fitted, in digest order of the id.

    A row that takes its class over half of ``fit_words`` is left out, and later ones that fit are taken.
    Where no row of a class fits, its shortest is taken. Rows that repeat an id are taken together; a row
    without words counts as one word.
    """
    counted = candidates.mapInArrow(_count, "doc_id long, y int, words long").groupBy("doc_id", "y")
    sizes = counted.agg(F.sum(F.greatest("words", F.lit(1))).alias("words")).collect()
    chosen = []
    for y in (0, 1):
        own = sorted((r for r in sizes if r.y == y), key=lambda r: (hashlib.md5(str(r.doc_id).encode()).digest(), r.doc_id))
        taken, words = [], 0
        for r in own:
            if words + r.words <= fit_words // 2:
                taken.append((r.doc_id, y))
                words += r.words
        if own and not taken:
            taken = [(min(own, key=lambda r: r.words).doc_id, y)]
        chosen += taken
    return chosen


def _usable(labels: DataFrame) -> DataFrame:
    return labels.filter(fold(F.col("doc_id"), FOLDS) != HELD_OUT)


def train(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, fit_words: int = FIT_WORDS) -> tuple[Network | float, list[int], float]:
    """A network from labelled rows outside the held-out fold, or the constant score where a class is missing.

    Also the ids of the fitted rows and the share of toxic rows among the usable labels.
    """
    usable = _usable(labels)
    counts = class_counts(usable, "toxic")
    if counts.get(0, 0) == 0 or counts.get(1, 0) == 0:
        return 0.5 if not counts else float(max(counts)), [], 0.0
    fitting = usable.filter(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(RESERVED)) != 0)
    if len(class_counts(fitting, "toxic")) < 2:
        fitting = usable
    ids = sample_ids(fitting, "toxic", per_class)
    # At most 2 * per_class ids of 12 bytes: small at any size of the input.
    candidates = documents.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    chosen = fitting_rows(candidates, fit_words)
    known = documents.sparkSession.createDataFrame(chosen, "doc_id long, y int")
    hashed = documents.select("doc_id", "text").join(F.broadcast(known), "doc_id").mapInArrow(_hash, "doc_id long, y int, x binary")
    texts, y, fitted = [], [], []
    for r in hashed.orderBy(F.md5(F.col("doc_id").cast("string")), "y", "x").toLocalIterator():
        texts.append(np.frombuffer(bytes(r.x), np.uint64).reshape(-1, COLUMNS))
        y.append(r.y)
        fitted.append(r.doc_id)
    if len(set(y)) < 2:
        return 0.5, [], 0.0
    return train_network(texts, np.array(y)), sorted(set(fitted)), counts[1] / (counts[0] + counts[1])


def score(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, fit_words: int = FIT_WORDS) -> DataFrame:
    """doc_id, held_out, score and predicted for every document row; only the text enters a score.

    The fit uses at most ``per_class`` labelled rows of each class, with at most half of
    ``fit_words`` words (or one longer text), outside the fold crc32(doc_id) % 4 = 2; all other labelled rows outside the fold set the
    thresholds. Null and empty texts get the score of a text without words. A null doc_id is not held
    out. Null labels are ignored; where a class has no label, every score is the other class (0.5 without
    labels). Repeated rows score alike; other columns play no part.
    """
    net, fitted, share = train(documents, labels, per_class, fit_words)
    if isinstance(net, float):
        scored = documents.select("doc_id", F.lit(net).alias("score"))
    else:
        raw = stage(_logits(documents, net), "logits")
        shifts = calibrate(raw, _usable(labels), fitted, share)
        shift = F.element_at(F.array(*map(F.lit, shifts.tolist())), F.col("language") + 1)
        logit = F.col("logit") - shift + math.log(THRESHOLD / (1 - THRESHOLD))
        scored = raw.select("doc_id", (1 / (1 + F.exp(-F.least(F.greatest(logit, F.lit(-40.0)), F.lit(40.0))))).alias("score"))
    return scored.select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def _logits(documents: DataFrame, net: Network) -> DataFrame:
    """doc_id, language and logit of every document row."""
    model = documents.sparkSession.sparkContext.broadcast(net)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            for n, hashes, offsets in word_hashes([plain(t) for t in batch.column(1).to_pylist()], PREFIXES):
                spoken, found = languages(hashes[:, 0], offsets), model.value.logits(hashes, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, n), pa.array(spoken, pa.int32()), pa.array(found, pa.float64())],
                    names=["doc_id", "language", "logit"],
                )
                start += n

    return documents.select("doc_id", "text").mapInArrow(apply, "doc_id long, language int, logit double")
