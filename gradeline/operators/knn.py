"""Exact k nearest neighbours without comparing every pair of rows.

Splits at medians of a sample deal the training rows to cells. Each cell is
written once, in blocks of rows that lie close together, and the driver keeps
the box of every block. Query rows are dealt to batches by the same splits; a
batch reads the blocks one by one, the nearest box first, and leaves out those
whose box is farther from its rows than the k-th neighbour found so far. Inside
a block the same holds for groups of query rows and runs of training rows.

Where boxes exclude little (many dimensions), all blocks are read and matrix
products, with a bound on their rounding, exclude pairs; the distances of the
others are summed one dimension at a time. A task holds one batch, one block
and ``CHUNK_CELLS`` distances.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeline.sources.stage import new_dir

# Fixed value: number of neighbours that vote.
K = 5

#: Cells of training rows at most, and rows of the sample for each.
MAX_PIVOTS = 1024
CELL_SAMPLE = 16
BLOCK_ROWS = 20_000
QUERY_ROWS = 20_000
#: Training rows that are put in order at once, in MB.
SORTED_MB = 32
#: Query rows of a group, and training rows of a run.
GROUP_ROWS = 256
RUN_ROWS = 64
CHUNK_CELLS = 2_000_000  # distances held at once inside a task
#: Sets of training rows whose least distances bound the k-th one.
SETS = 128


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances, one dimension at a time: no cancellation between near rows."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        out += (a[:, j, None] - b[None, :, j]) ** 2
    return out


def _pair_distances(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``_distances`` of columns ``i`` of ``a`` and columns ``j`` of ``b``, to the bit: added up in the same order."""
    step = max(CHUNK_CELLS // len(a), 1)
    parts = [
        np.add.accumulate((a[:, i[s : s + step]] - b[:, j[s : s + step]]) ** 2)[-1] for s in range(0, len(i), step)
    ]
    return np.concatenate(parts) if parts else np.zeros(0)


def _gaps(lo: np.ndarray, hi: np.ndarray, box_lo: np.ndarray, box_hi: np.ndarray) -> np.ndarray:
    """Least squared distance that rows of one box can have to rows of another; rounded as ``_distances``, so never above one."""
    out = np.zeros((len(lo), len(box_lo)))
    for j in range(lo.shape[1]):
        gap = np.maximum(box_lo[None, :, j] - hi[:, j, None], lo[:, j, None] - box_hi[None, :, j])
        out += np.maximum(gap, 0.0) ** 2
    return out


def _vectors(column: pa.Array) -> np.ndarray:
    """Rows of a list column; all must be there and of one length."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(lists):
        return np.zeros((0, 0))
    lengths = pc.list_value_length(lists)
    if lists.null_count or pc.min(lengths) != pc.max(lengths):
        raise ValueError("all vectors must be present and of the same length")
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(lists), -1)


def _smallest(d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the k smallest entries per row; the first columns win ties."""
    if d.shape[1] <= k:
        rows, cols = np.indices(d.shape)
        return rows.ravel(), cols.ravel()
    limit = np.partition(d, k - 1, axis=1)[:, k - 1 : k]
    keep = d <= limit
    for i in np.nonzero(keep.sum(axis=1) > k)[0]:
        best = np.argsort(d[i], kind="stable")[:k]
        keep[i] = False
        keep[i, best] = True
    return np.nonzero(keep)


def _close_runs(x: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of the rows in which runs of at most ``size`` lie close together, and where the runs start."""
    order, starts, todo = np.arange(len(x)), [], [(0, len(x))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo <= size:
            starts.append(lo)
            continue
        rows, mid = order[lo:hi], (hi - lo) // 2
        part = x[rows]
        widest = np.ptp(part, axis=0).argmax()
        order[lo:hi] = rows[np.argpartition(part[:, widest], mid)]
        todo += [(lo + mid, hi), (lo, lo + mid)]
    return order, np.array(starts)


class _Splits:
    """Cells by a tree of splits, each at the median of a sample in its widest dimension."""

    def __init__(self, sample: np.ndarray, depth: int) -> None:
        self.depth, self.n_cells = depth, 2**depth
        self.dims, self.cuts = np.zeros(2**depth - 1, int), np.full(2**depth - 1, np.inf)
        share = {0: np.arange(len(sample))}
        for node in range(2**depth - 1):
            rows = share.pop(node)
            below = np.ones(len(rows), bool)
            if len(rows) > 1:
                self.dims[node] = np.ptp(sample[rows], axis=0).argmax()
                values = sample[rows, self.dims[node]]
                self.cuts[node] = np.partition(values, (len(rows) - 1) // 2)[(len(rows) - 1) // 2]
                below = values <= self.cuts[node]
            share |= {2 * node + 1: rows[below], 2 * node + 2: rows[~below]}
        #: Sampled rows of each cell.
        self.sampled = np.array([len(share[n]) for n in range(2**depth - 1, 2 ** (depth + 1) - 1)])

    def cells(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), int)
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[np.arange(len(x)), self.dims[node]] > self.cuts[node])
        return node - (self.n_cells - 1)


def _without_copies(x: np.ndarray, k: int) -> np.ndarray:
    """Row numbers without those that come after ``k`` equal rows: these are among no row's k nearest."""
    weights = np.random.default_rng(0).integers(1, 2**63, x.shape[1], dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    order = np.argsort((np.ascontiguousarray(x).view(np.uint64) * weights).sum(axis=1), kind="stable")
    first = np.ones(len(x), bool)
    first[1:] = (x[order[1:]] != x[order[:-1]]).any(axis=1)
    place = np.arange(len(x))
    return np.sort(order[place - np.maximum.accumulate(np.where(first, place, 0)) < k])


def _block_rows(rows: pa.Table, k: int, block_rows: int) -> Iterator[pa.Table]:
    """Blocks of rows that lie close together; ``place`` is the order of the ids, ``run`` numbers the runs.

    Rows with a NaN have no distance to any row and are left out.
    """
    rows = rows.take(pc.sort_indices(rows["_train"], null_placement="at_start"))
    x = _vectors(rows["_there"])
    kept = np.flatnonzero(~np.isnan(x).any(axis=1))
    kept = kept[_without_copies(x[kept], k)]
    run_rows = min(RUN_ROWS, block_rows)
    order, starts = _close_runs(x[kept], run_rows)
    ends = np.append(starts[1:], len(kept))
    first = 0
    while first < len(starts):
        last = max(int(np.searchsorted(ends, starts[first] + block_rows, side="right")), first + 1)
        part = order[starts[first] : ends[last - 1]]
        ids = np.sort(part)
        own = rows.select(["_train", "_label"]).take(pa.array(kept[ids]))
        vectors = x[kept[part]]
        run = np.repeat(np.arange(last - first, dtype=np.int32), (ends - starts)[first:last])
        if len(part):
            yield pa.table({
                "train": own["_train"], "label": own["_label"],
                "place": pa.array(np.searchsorted(ids, part).astype(np.int32)), "run": pa.array(run),
                "vector": pa.FixedSizeListArray.from_arrays(pa.array(vectors.ravel()), x.shape[1]),
            })
        first = last


class _Block:
    """A block as it is searched: rows by run, with what the matrix product needs."""

    def __init__(self, rows: pa.Table) -> None:
        rows = rows.combine_chunks()
        self.train, self.label = rows["train"], rows["label"]
        self.place = rows["place"].to_numpy()
        vectors = rows["vector"].chunk(0)
        self.x = vectors.flatten().to_numpy().reshape(len(vectors), -1)
        self.by_dim = np.ascontiguousarray(self.x.T)
        self.starts = np.flatnonzero(np.diff(rows["run"].to_numpy(), prepend=-1))
        self.ends = np.append(self.starts[1:], len(self.x))
        self.lo, self.hi = np.minimum.reduceat(self.x, self.starts), np.maximum.reduceat(self.x, self.starts)
        self.middle = self.x.mean(axis=0)
        away = self.x - self.middle
        norms = (away**2).sum(axis=1)
        self.farthest = norms.max()
        self.plain = bool(self.farthest < 1e300)
        # Above the rounding of the products, of the norms and of the distances themselves, as a share of what is added up.
        self.slack = (self.x.shape[1] + 8) * 2.0**-50
        self.factors = np.column_stack([-2.0 * away, (1 - self.slack) * norms, np.ones(len(away))])

    def near(self, q: np.ndarray, q_by_dim: np.ndarray, limits: np.ndarray, k: int, rows: slice | np.ndarray):
        """Numbers of query and training rows, and squared distances, that can be among the k nearest within the limits."""
        n = rows.stop - rows.start if isinstance(rows, slice) else len(rows)
        away = q - self.middle
        norms = (away**2).sum(axis=1)
        if self.plain and norms.max() < 1e300:
            known = np.isfinite(limits)
            within = np.where(known, limits, 0.0)
            own = np.column_stack([away, np.ones(len(q)), (1 - self.slack) * norms - (1 + self.slack) * within])
            low = own @ self.factors[rows].T
            # The k-th of the least values of distinct sets of columns: as many pairs are not farther.
            sets = min(n, max(SETS, 4 * k))
            least = low[:, : n - n % sets].reshape(len(q), -1, sets).min(axis=1)
            kth = np.partition(least, k - 1, axis=1)[:, k - 1] if k <= sets else np.inf
            most = np.minimum(kth + 4 * self.slack * (norms + self.farthest + within), np.where(known, 0.0, np.inf))
            at = np.flatnonzero(low <= most[:, None] + 1e-300)
            i, j = np.divmod(at, n)
            j = j + rows.start if isinstance(rows, slice) else rows[j]
            d = _pair_distances(q_by_dim, i, self.by_dim, j)
        else:
            # In the order of the ids, the first of which win ties.
            rows = np.arange(len(self.x))[rows]
            rows = rows[np.argsort(self.place[rows])]
            all_d = _distances(q, self.x[rows])
            i, j = _smallest(np.where(np.isnan(all_d), np.inf, all_d), k)
            d, j = all_d[i, j], rows[j]
        keep = d <= limits[i]
        return i[keep], j[keep], d[keep]


def _first_of_each(i: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Place of each entry among equal ones of the sorted ``i``, and whether it is below k."""
    place = np.arange(len(i)) - np.searchsorted(i, i)
    return place, place < k


def _nearest(
    x: np.ndarray, box_lo: np.ndarray, box_hi: np.ndarray, load: Callable[[int], _Block], k: int
) -> Iterator[tuple[np.ndarray, pa.Array, pa.Array, np.ndarray]]:
    """Query row numbers, training ids, labels and squared distances, with all rows that tie for the k-th place."""
    order, starts = _close_runs(x, GROUP_ROWS)
    x = x[order]
    by_dim, ends = np.ascontiguousarray(x.T), np.append(starts[1:], len(x))
    lo, hi = np.minimum.reduceat(x, starts), np.maximum.reduceat(x, starts)
    best = np.full((len(x), k), np.inf)
    gaps = _gaps(lo, hi, box_lo, box_hi)
    centre = np.median(x, axis=0)
    off = np.abs((box_lo + box_hi) / 2 - centre).sum(axis=1)
    found = []
    for b in np.lexsort((off, gaps.min(axis=0))):
        groups = np.flatnonzero(gaps[:, b] <= np.maximum.reduceat(best[:, -1], starts))
        if not len(groups):
            continue
        block, hits = load(b), []
        run_gaps = _gaps(lo[groups], hi[groups], block.lo, block.hi)
        for g, run_gap in zip(groups, run_gaps):
            here = slice(starts[g], ends[g])
            for rows in _chunks(block, run_gap, lambda: best[here, -1].max(), ends[g] - starts[g]):
                i, j, d = block.near(x[here], by_dim[:, here], best[here, -1], k, rows)
                if not len(i):
                    continue
                by = np.lexsort((block.place[j], d, i))
                i, j, d = i[by], j[by], d[by]
                place, first = _first_of_each(i, k)
                i, j, d, place = i[first], j[first], d[first], place[first]
                changed, row = np.unique(i, return_inverse=True)
                more = np.full((len(changed), k), np.inf)
                more[row, place] = d
                changed = changed + starts[g]
                best[changed] = np.sort(np.hstack([best[changed], more]), axis=1)[:, :k]
                hits.append((i + starts[g], block.place[j], d))
        if hits:
            i, place, d = (np.concatenate(p) for p in zip(*hits))
            keep = d <= best[i, -1]
            at = pa.array(place[keep])
            found.append((i[keep], block.train.take(at), block.label.take(at), d[keep]))
    for i, train, label, d in found:
        keep = d <= best[i, -1]
        yield order[i[keep]], train.filter(pa.array(keep)), label.filter(pa.array(keep)), d[keep]


def _chunks(block: _Block, gaps: np.ndarray, worst: Callable[[], float], n: int) -> Iterator[slice | np.ndarray]:
    """Rows of the runs that ``n`` query rows need, as the worst k-th distance falls: the nearest run first.

    Without a k-th distance to begin with, each step takes twice as many runs as the one before, so that
    many rows are compared only when the distances are small.
    """
    most, limit = max(CHUNK_CELLS // n // RUN_ROWS, 1), worst()
    step = most if math.isfinite(limit) else 1
    by, done = np.argsort(gaps, kind="stable"), 0
    if gaps[by[int(0.7 * len(by))]] <= limit < np.inf:
        # Most of them: all, in their own order, without a copy.
        for r in range(0, len(by), most):
            yield slice(block.starts[r], block.ends[min(r + most, len(by)) - 1])
        return
    gaps = gaps[by]
    while done < len(by) and gaps[done] <= limit:
        end = min(done + step, int(np.searchsorted(gaps, limit, side="right")))
        yield np.concatenate([np.arange(block.starts[r], block.ends[r]) for r in by[done:end]])
        done, step, limit = end, min(2 * step, most), worst()


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def _write_blocks(rows: DataFrame, groups: int, k: int, block_rows: int) -> list:
    """Write the blocks of each group of rows: path, and the least and the largest value of each dimension.

    Each attempt of a task writes files of its own, and only those that are named here count.
    """
    folder = new_dir(rows.sparkSession, "neighbours")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        system, root = _open(folder)
        system.create_dir(root, recursive=True)
        for block in _block_rows(pa.Table.from_batches(held), k, block_rows):
            name = f"{uuid.uuid4().hex}.arrow"
            with system.open_output_stream(f"{root}/{name}") as out, pa.ipc.new_file(out, block.schema) as file:
                file.write_table(block)
            x = block["vector"].combine_chunks().flatten().to_numpy().reshape(block.num_rows, -1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([f"{folder}/{name}"]), pa.array([x.min(axis=0)]), pa.array([x.max(axis=0)])],
                names=["path", "lo", "hi"],
            )

    dealt = rows.repartitionById(groups, F.col("_group"))
    return dealt.mapInArrow(write, "path string, lo array<double>, hi array<double>").collect()


def _grouped(df: DataFrame, id_col: str, vector_col: str, group: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """Add ``_group``, of the vector and of a hash of the id."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                of = group(_vectors(batch.column(vector_col)), batch.column("_hash").to_numpy())
                yield batch.append_column("_group", pa.array(of.astype(np.int32)))

    hashed = df.withColumn("_hash", F.xxhash64(id_col))
    return hashed.mapInArrow(add, T.StructType([*hashed.schema.fields, T.StructField("_group", T.IntegerType())])).drop("_hash")


def nearest_neighbours(
    queries: DataFrame,
    train: DataFrame,
    query_id: str,
    train_id: str,
    label_col: str,
    vector_col: str = "features",
    k: int = K,
    max_pivots: int = MAX_PIVOTS,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """The k nearest training rows of each query row: (query id, train id, label, squared distance).

    Both frames have unique ids and ``vector_col`` as array<double>; the order
    among equal distances is the train id. Training rows become at most
    ``max_pivots`` cells. On the driver: ``CELL_SAMPLE`` vectors and two counts
    a cell, and the box of each block of up to ``block_rows`` rows. Vectors
    with a NaN have no neighbours and are none.
    """
    spark = queries.sparkSession
    # Fresh column names, as both frames may come from one table.
    train = train.select(
        F.col(train_id).alias("_train"), F.col(label_col).alias("_label"),
        F.col(vector_col).alias("_there"),
    )
    queries = queries.select(F.col(query_id).alias("_query"), F.col(vector_col).alias("_here"))
    n_train = train.count()
    if n_train == 0:
        raise ValueError("no training rows")
    depth = min(math.ceil(math.log2(max(n_train / block_rows, 1))), int(math.log2(max_pivots)))
    share = min(CELL_SAMPLE * 2**depth / n_train, 1.0) if depth else 0.0
    sample = _vectors(train.sample(share, seed=0).select("_there").toArrow()["_there"]) if depth else np.zeros((0, 0))
    splits = _Splits(sample[~np.isnan(sample).any(axis=1)], depth)

    # Large cells, as the sample has them, are cut by a hash of the id.
    width = max(len(train.select("_there").first()[0] or ()), 1) if not sample.size else sample.shape[1]
    sorted_rows = max(SORTED_MB * 2**20 // (8 * width), block_rows)
    parts = np.maximum(np.ceil(splits.sampled * (n_train / max(splits.sampled.sum(), 1)) / sorted_rows), 1).astype(int)
    if not depth:
        parts[0] = max(math.ceil(n_train / sorted_rows), 1)
    offsets = np.cumsum(parts) - parts

    def cell_part(x: np.ndarray, h: np.ndarray) -> np.ndarray:
        cell = splits.cells(x)
        return offsets[cell] + h % parts[cell]

    blocks = _write_blocks(_grouped(train, "_train", "_there", cell_part), int(parts.sum()), k, block_rows)
    blocks.sort(key=lambda r: (r["lo"], r["hi"]))
    paths = [r["path"] for r in blocks]
    box_lo, box_hi = (np.array([r[c] for r in blocks], dtype=np.float64).reshape(len(blocks), -1) for c in ("lo", "hi"))

    # Batches of near-by query rows: ranges of the cells in order, cut by a hash of the id.
    counted = _grouped(queries, "_query", "_here", lambda x, h: splits.cells(x)).groupBy("_group").count().collect()
    n_cell = np.zeros(splits.n_cells, int)
    for r in counted:
        n_cell[r["_group"]] = r["count"]
    before, n_queries = np.cumsum(n_cell) - n_cell, int(n_cell.sum())
    even = math.ceil(n_queries / (4 * spark.sparkContext.defaultParallelism))
    batch_rows = min(max(even, GROUP_ROWS), query_rows)

    def batch_of(x: np.ndarray, h: np.ndarray) -> np.ndarray:
        cell = splits.cells(x)
        return (before[cell] + h % n_cell[cell]) // batch_rows

    out = T.StructType([
        T.StructField(query_id, queries.schema["_query"].dataType),
        T.StructField(train_id, train.schema["_train"].dataType),
        T.StructField("label", train.schema["_label"].dataType),
        T.StructField("distance", T.DoubleType()),
    ])

    def load(b: int) -> _Block:
        system, path = _open(paths[b])
        with system.open_input_file(path) as file:
            return _Block(pa.ipc.open_file(file).read_all())

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held or not paths:
            return
        rows = pa.Table.from_batches(held)
        for s in range(0, rows.num_rows, 2 * query_rows):
            part = rows.slice(s, 2 * query_rows).combine_chunks()
            x = _vectors(part["_here"])
            real = np.flatnonzero(~np.isnan(x).any(axis=1))
            if not len(real):
                continue
            for i, near, label, d in _nearest(x[real], box_lo, box_hi, load, k):
                found = pa.table([part["_query"].take(pa.array(real[i])), near, label, pa.array(d)], names=out.names)
                yield from found.combine_chunks().to_batches()

    batches = max(math.ceil(n_queries / batch_rows), 1)
    dealt = _grouped(queries, "_query", "_here", batch_of).repartitionById(batches, F.col("_group"))
    candidates = dealt.select("_query", "_here").mapInArrow(search, out)
    order = Window.partitionBy(query_id).orderBy("distance", train_id)
    return (
        candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    )


def knn_classify(
    queries: DataFrame, train: DataFrame, query_id: str, train_id: str, label_col: str, **options
) -> DataFrame:
    """Label of the majority among the nearest training rows; the smaller label wins a tie."""
    near = nearest_neighbours(queries, train, query_id, train_id, label_col, **options)
    votes = near.groupBy(query_id, "label").agg(
        F.count("*").alias("n"), F.min("distance").alias("distance")
    )
    return votes.groupBy(query_id).agg(
        F.max_by("label", F.struct("n", -F.col("label"))).alias("prediction"),
        F.sqrt(F.min("distance")).alias("nearest"),
    )
