"""Quality scores by Bradley-Terry pairwise ranking.

Labelled documents give preference pairs: every one of label 1 is preferred to every one of label 0. A
document's score is linear in features of its whole text, and the weights minimise the logistic loss on the
feature differences of all these pairs. The threshold is a score quantile: the share of label 0 among the labels.

No pair is built. The sum over the partners of a document depends on its own score and on the partners' scores
alone, which Spark counts in narrow cells; Newton steps then need sums over the labelled documents only.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeline.llm.fitting import class_counts, fold
from gradeline.llm.words import SLAB
from gradeline.sources.stage import stage

#: Newton steps at most, the largest gradient that ends them, and the weight of the squared weights in the loss.
STEPS, TOLERANCE, RIDGE = 40, 1e-4, 1e-3
#: Scores are whole numbers of points, so many in one unit.
POINTS = 10**9
#: Width in points of the cells that partners' scores are counted in, and at most so many cells enter a loss.
CELL, CELLS = POINTS // 16, 1024
#: Cells of the second derivative, which only steers the steps.
COARSE = 128
THRESHOLD = 0.3
FOLDS = 5

# Classes of bytes; pairs of neighbouring classes are the main features.
_GROUPS = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r\v\f", b".", b",",
           b"!?", b"|", b"*#%$&@^~=+", b"-_/\\", b"'\"`", b"()[]{}<>", b";:"]
_CLASS = np.full(256, len(_GROUPS), np.uint8)  # other control characters
_CLASS[128:] = 0  # bytes of letters beyond ASCII
for _i, _g in enumerate(_GROUPS):
    _CLASS[list(_g)] = _i
_N = len(_GROUPS) + 1
N_FEATURES = _N * _N + _N + 7


def _counts(data: bytes) -> np.ndarray:
    """Counts of class pairs of one text, in pieces of bounded size."""
    out = np.zeros(_N * _N)
    for at in range(0, len(data), SLAB):
        c = _CLASS[np.frombuffer(data[at:at + SLAB + 1], np.uint8)].astype(np.intp)
        out += np.bincount(c[:-1] * _N + c[1:], minlength=_N * _N)
    return out


def features(text: str | None) -> np.ndarray:
    """Features of a whole text; null and empty texts have zeros only."""
    data = (text or "").encode()
    if not data:
        return np.zeros(N_FEATURES, np.float32)
    pairs = _counts(data)
    single = pairs.reshape(_N, _N).sum(axis=1)
    single[_CLASS[data[-1]]] += 1
    words, lines = data.split(), [s for s in data.split(b"\n") if s.strip()]
    n, distinct = max(1, len(words)), len(set(words))
    extra = [
        math.log1p(len(data)), math.log1p(len(words)), sum(map(len, words)) / n / 10, distinct / n,
        len(set(lines)) / max(1, len(lines)), math.log1p(n / max(1, len(lines))), max(map(len, words), default=0) ** 0.5 / 10,
    ]
    return np.concatenate([np.sqrt(pairs / len(data)), np.sqrt(single / len(data)), extra]).astype(np.float32)


@dataclass
class Ranker:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: int = 0

    def inputs(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def points(self, x: np.ndarray) -> np.ndarray:
        return np.rint(self.inputs(x) @ self.weights * POINTS).astype(np.int64)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1; ``THRESHOLD`` is the score at the quantile."""
        raw = (self.points(x) - self.cut) / POINTS
        return 1 / (1 + np.exp(-np.clip(raw + math.log(THRESHOLD / (1 - THRESHOLD)), -40, 40)))


def _matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Labels and features of a batch of y and x."""
    x = np.frombuffer(b"".join(batch.column("x").to_pylist()), np.float32)
    return batch.column("y").to_numpy(), x.reshape(-1, N_FEATURES).astype(np.float64)


def _total(rows: DataFrame, sums: Callable[[np.ndarray, np.ndarray], np.ndarray], height: int) -> np.ndarray:
    """The sum of ``sums(y, x)`` over all rows, a matrix of ``height`` rows, one row per feature or cell; added up in a tree."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((height, N_FEATURES))
        for batch in batches:
            total += sums(*_matrix(batch))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    parts = rows.mapInArrow(partial, "total binary").rdd.map(lambda r: np.frombuffer(r.total).reshape(height, N_FEATURES))
    return parts.treeAggregate(np.zeros((height, N_FEATURES)), np.add, np.add)


def _moments(y: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.stack([np.full(N_FEATURES, (y == 0).sum()), np.full(N_FEATURES, (y == 1).sum()), x.sum(axis=0), (x * x).sum(axis=0)])


def _points(rows: DataFrame, model: Ranker) -> DataFrame:
    """y and the score in points of all rows."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, x = _matrix(batch)
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(model.points(x))], names=["y", "point"])

    return rows.mapInArrow(apply, "y int, point long")


def _cells(points: DataFrame, width: int) -> list[tuple[int, int, int, int]]:
    """(cell, y, rows, points of these above the cell's lower edge) of the cells that hold a row, lowest first."""
    cell = F.floor(F.col("point") / width)
    found = points.select("y", cell.alias("cell"), (F.col("point") - cell * width).alias("above"))
    return sorted((r.cell, r.y, r.n, r.above) for r in found.groupBy("cell", "y").agg(F.count("*").alias("n"), F.sum("above").alias("above")).collect())


def _sigmoid(a: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(a, -40, 40)))


def _masses(cells: list[tuple[int, int, int, int]], most: int) -> tuple[np.ndarray, np.ndarray]:
    """Middles of at most ``most`` even cells over all scores, in units, and the share of each class in each of them."""
    low, high = cells[0][0], cells[-1][0]
    joined = (high - low) // most + 1
    masses = np.zeros((2, (high - low) // joined + 1))
    for cell, y, n, _ in cells:
        masses[y, (cell - low) // joined] += n
    middles = (low + (np.arange(masses.shape[1]) + 0.5) * joined) * CELL / POINTS
    return middles, masses / masses.sum(axis=1, keepdims=True)


def _nodes(cells: list[tuple[int, int, int, int]], most: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of the cells, in units, and the share of each class at each: a row counts at both edges, by its nearness."""
    low, high = cells[0][0], cells[-1][0]
    joined = (high - low) // most + 1
    masses = np.zeros((2, (high - low) // joined + 2))
    for cell, y, n, above in cells:
        at, rest = divmod(cell - low, joined)
        upper = (rest * n + above / CELL) / joined
        masses[y, at] += n - upper
        masses[y, at + 1] += upper
    return (low + np.arange(masses.shape[1]) * joined) * CELL / POINTS, masses / masses.sum(axis=1, keepdims=True)


def _newton(rows: DataFrame, model: Ranker, n: np.ndarray, cells: list[tuple[int, int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and second derivative of the loss on all pairs."""
    nodes, masses = _nodes(cells, CELLS)
    lose = _sigmoid(nodes[:, None] - nodes)  # [c, d]: chance that a partner in c is preferred to one in d
    pull = np.stack([masses[1] @ lose.T, masses[0] @ lose])
    # One weight for all pairs of two cells keeps the second derivative positive definite.
    coarse, share = _masses(cells, COARSE)
    width = coarse[1] - coarse[0] if len(coarse) > 1 else 1.0
    chance = _sigmoid(coarse[:, None] - coarse)
    bend = chance * (1 - chance)
    bends = share[::-1] @ bend
    count = len(coarse)

    def sums(y: np.ndarray, x: np.ndarray) -> np.ndarray:
        z, raw = model.inputs(x), model.points(x) / POINTS
        cell = np.clip(np.floor((raw - coarse[0]) / width + 0.5), 0, count - 1).astype(np.intp)
        own = np.where(y == 1, np.interp(raw, nodes, pull[1]), -np.interp(raw, nodes, pull[0])) / n[y]
        held = np.zeros((len(y), 2 * count))
        held[np.arange(len(y)), y * count + cell] = 1 / n[y]
        return np.concatenate([-(own @ z)[None], (z * (bends[y, cell] / n[y])[:, None]).T @ z, held.T @ z])

    total = _total(rows, sums, 1 + N_FEATURES + 2 * count)
    gradient, square = total[0] + RIDGE * model.weights, total[1:1 + N_FEATURES]
    of_zero, of_one = total[1 + N_FEATURES:].reshape(2, count, N_FEATURES)
    cross = of_one.T @ bend @ of_zero
    return gradient, square - cross - cross.T + RIDGE * np.eye(N_FEATURES)


def _loss(model: Ranker, cells: list[tuple[int, int, int, int]]) -> float:
    nodes, masses = _nodes(cells, CELLS)
    return float(masses[1] @ np.logaddexp(0, nodes - nodes[:, None]) @ masses[0] + RIDGE / 2 * model.weights @ model.weights)


def quantile(points: DataFrame, share_of_zero: float) -> int:
    """The point halfway from the exact quantile to the next larger point; each class weighs its share, whatever its rows.

    Cells of the points are counted, then the narrower cells of that which holds the quantile, down to single points.
    """
    below, inside, weight = np.zeros(2), points, None
    for width in (1 << 24, 1 << 12, 1):
        cells = _cells(inside, width)
        if weight is None:
            weight = np.array([share_of_zero, 1 - share_of_zero]) / np.maximum(1, np.bincount([y for _, y, *_ in cells], [n for _, _, n, _ in cells], 2))
        found = {}
        for c, y, n, _ in cells:
            found.setdefault(c, np.zeros(2))[y] += n
        for cell, own in found.items():
            if (below + own) @ weight >= share_of_zero - 1e-12:
                break
            below = below + own
        inside = inside.filter((F.col("point") >= cell * width) & (F.col("point") < (cell + 1) * width))
    after = points.filter(F.col("point") > cell).agg(F.min("point")).first()[0]
    return cell if after is None else (cell + after + 1) // 2


def fit(rows: DataFrame, share_of_zero: float) -> Ranker | None:
    """A ranker from all rows of y and x, with the cut at the given quantile; None where a class has no row.

    Weights are rounded, so that sums in another order lead to the same ones.
    """
    total = _total(rows, _moments, 4)
    n = total[:2, 0]
    if not n.all():
        return None
    mean = total[2] / n.sum()
    deviation = np.sqrt(np.maximum(total[3] / n.sum() - mean * mean, 0))
    model = Ranker(mean.round(9), deviation.round(9) + 1e-3, np.zeros(N_FEATURES))
    before, least = model, math.inf
    for _ in range(STEPS):
        cells = _cells(_points(rows, model), CELL)
        loss = _loss(model, cells)
        if loss > least + TOLERANCE:  # too far
            model = replace(model, weights=((before.weights + model.weights) / 2).round(5))
            continue
        gradient, second = _newton(rows, model, n, cells)
        if np.abs(gradient).max() < TOLERANCE:
            break
        before, least = model, loss
        model = replace(model, weights=(model.weights - np.linalg.solve(second, gradient)).round(5))
    return replace(model, cut=quantile(stage(_points(rows, model), "points"), share_of_zero))


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(t).tobytes() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(rows, pa.binary())], names=["y", "x"])


def train(documents: DataFrame, labels: DataFrame) -> Ranker | float:
    """A ranker from all labelled rows outside the held-out fold, or the constant score where a class is missing."""
    usable = labels.filter(fold(F.col("doc_id"), FOLDS) != 0)
    counts = class_counts(usable, "quality")
    if counts.get(0, 0) == 0 or counts.get(1, 0) == 0:
        return 0.5 if not counts else float(max(counts))
    known = usable.filter(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int").alias("y")).distinct()
    # Labels grow with the documents: both sides are dealt by id at every size, and texts stream past the labels unsorted.
    own = documents.select("doc_id", "text").join(known.hint("shuffle_hash"), "doc_id").select("y", "text")
    rows = own.mapInArrow(_featurise, "y int, x binary")
    model = fit(stage(rows, "features"), counts[0] / (counts[0] + counts[1]))
    return 0.5 if model is None else model


def _scores(texts: list[str | None], model: Ranker | float) -> np.ndarray:
    if isinstance(model, float):
        return np.full(len(texts), model)
    out = [model.score(np.stack([features(t) for t in texts[i:i + 512]])) for i in range(0, len(texts), 512)]
    return np.concatenate(out) if out else np.zeros(0)


def score(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every document row; only the text enters a score.

    Weights and threshold come from all labelled rows outside the fold crc32(doc_id) % 5 = 0.
    Null and empty texts get the score of zero features. A null doc_id is not held out. Null labels are
    ignored; where a class has no label, every score is the other class (0.5 without labels). Repeated
    rows score alike; other columns play no part.
    """
    model = documents.sparkSession.sparkContext.broadcast(train(documents, labels))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(_scores(batch.column(1).to_pylist(), model.value), pa.float64())], names=["doc_id", "score"]
            )

    scored = documents.select("doc_id", "text").mapInArrow(apply, "doc_id long, score double")
    return scored.select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), FOLDS) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the ranker does not reject, with all their columns."""
    model = documents.sparkSession.sparkContext.broadcast(train(documents, labels))
    place = documents.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(batch.column(place).to_pylist(), model.value) >= THRESHOLD))

    return documents.mapInArrow(keep, documents.schema)
