"""MinHash near-deduplication by a multi-index Hamming join.

A signature has 60 symbols of b = 16 bits, each from one MinHash of the document's 5-word shingles. It is
cut into chunks, whose number follows from the similarity asked for: 12 chunks of 5 symbols at 0.85, 15
of 4 at 0.80. Two signatures that differ in less than twice as many symbols as there are chunks have, by
the pigeonhole principle, a chunk with at most one wrong symbol; the allowed errors are enumerated by
leaving out each symbol of each chunk in turn, so such a pair surely shares one of 60 keys. Documents with
Jaccard similarity 0.85 differ in 9 symbols on average and in more than 23 with probability 2e-6; those
with 0.80 differ in 12 on average and in more than 29 with probability 2e-7. Pairs under the distance
threshold are then checked on their full shingle sets.

Documents with equal sets are one class from the start. In a bucket (the classes with one key) every
class meets the smallest first, not each other. Where a bucket still holds several components, their signatures
are compared in blocks; those under the distance are compared by their texts, again in blocks of bounded size, and
only confirmed links leave the block. A pair inside one component can add nothing.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeline.llm.components import connected, stars
from gradeline.llm.url_filter import possible_hits
from gradeline.llm.words import mix, seeds, shingle_hashes, word_hashes
from gradeline.sources.stage import stage

WIDTH = 5
PERCENT = 85
SYMBOLS = 60
#: Symbols of a chunk, the longest first: longer chunks have fewer chance matches, more chunks allow more errors.
PER_CHUNK = (5, 4, 3)
#: The largest probability that a pair at the similarity asked for is beyond the distance threshold.
MISSED = 1e-5
#: Bounds of a block: rows and characters (one text may be longer).
BLOCK, BLOCK_CHARS = 512, 16_000_000
#: Rows of a block where only signatures are compared.
SIGN_BLOCK = 4096
#: Members of a pivot that are compared with one copy of its text.
PIVOT_ROWS = 1024
#: Groups of up to so many rows are compared many at a time.
SMALL_GROUP = 24
_U = np.uint64


@dataclass(frozen=True)
class Plan:
    """What follows from the least similarity, in percent."""

    percent: int
    per_chunk: int

    @property
    def chunks(self) -> int:
        return SYMBOLS // self.per_chunk

    @property
    def distance(self) -> int:
        """The largest distance at which one chunk surely has at most one error."""
        return 2 * self.chunks - 1

    @property
    def missed(self) -> float:
        """Probability that a pair of just this similarity is beyond the distance."""
        p = self.percent / 100
        return sum(math.comb(SYMBOLS, k) * (1 - p) ** k * p ** (SYMBOLS - k) for k in range(self.distance + 1, SYMBOLS + 1))

    def similar(self, both: np.ndarray | int, either: np.ndarray | int) -> np.ndarray | bool:
        return 100 * both >= self.percent * either


def plan_for(percent: int) -> Plan:
    """The plan with the longest chunks that misses a pair with a probability of at most ``MISSED``."""
    for per_chunk in PER_CHUNK:
        plan = Plan(percent, per_chunk)
        if percent <= 100 and plan.missed <= MISSED:
            return plan
    raise ValueError(f"signatures of {SYMBOLS} symbols do not find pairs of {percent} % similarity")


def _texts(column: pa.Array) -> Iterator[bytes]:
    """One text at a time, so that a batch is not held a second time as Python strings."""
    return ((t.as_py() or "").encode().lower() for t in column)


def _sets(texts: Iterable[bytes]) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; bytes.lower() lower-cases A-Z only."""
    for n, words, offsets in word_hashes(texts):
        hashes, at = shingle_hashes(words, offsets, WIDTH)
        for i in range(n):
            yield np.unique(hashes[at[i]:at[i + 1]])


def _signatures(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row of 16-bit symbols per text; texts without shingles get zeros."""
    n = len(at) - 1
    filled = np.flatnonzero(np.diff(at) > 0)
    out = np.zeros((n, SYMBOLS), np.uint16)
    if len(filled):
        odd, add = seeds(SYMBOLS, 1) | _U(1), seeds(SYMBOLS, 5000)
        for k in range(SYMBOLS):
            low = np.minimum.reduceat((hashes ^ add[k]) * odd[k], at[:-1][filled])
            out[filled, k] = (mix(low) >> _U(48)).astype(np.uint16)
    return out


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    for batch in batches:
        ids, start = batch.column(0), 0
        for n, words, offsets in word_hashes(_texts(batch.column(1))):
            hashes, at = shingle_hashes(words, offsets, WIDTH)
            sizes, prints = [], []
            for i in range(n):
                own = np.unique(hashes[at[i]:at[i + 1]])
                sizes.append(len(own))
                prints.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
            signs = _signatures(hashes, at)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(start, n), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()),
                 pa.array([s.tobytes() for s in signs], pa.binary())],
                names=["doc_id", "n_shingles", "set_print", "signature"],
            )
            start += n


def signatures(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles (distinct), set_print (128 bits of the whole set) and signature."""
    return documents.select("doc_id", "text").mapInArrow(
        _sign, "doc_id long, n_shingles long, set_print binary, signature binary"
    )


def _enumerate(plan: Plan) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt, per = seeds(SYMBOLS, 9000), plan.per_chunk
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16).reshape(-1, plan.chunks, per)
            keys = np.zeros((len(raw), plan.chunks, per), _U)
            for drop in range(per):
                packed = np.zeros(raw.shape[:2], _U)
                for s in range(per):
                    if s != drop:
                        packed = packed << _U(16) | raw[:, :, s]
                keys[:, :, drop] = mix(packed ^ salt[drop::per][None, :])
            flat = pa.array(keys.reshape(len(raw), -1).view(np.int64).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(raw) + 1, dtype=np.int32) * SYMBOLS), flat)
            yield pa.RecordBatch.from_arrays([batch.column("rep"), lists], names=["rep", "keys"])

    return keys_of


def bucket_keys(classes: DataFrame, plan: Plan) -> DataFrame:
    """(key, rep): the 60 keys of each class."""
    return classes.select("rep", "signature").mapInArrow(_enumerate(plan), "rep long, keys array<long>").select(
        F.explode("keys").alias("key"), "rep"
    )


@F.pandas_udf(T.IntegerType())
def _distance(a: pd.Series, b: pd.Series) -> pd.Series:
    if not len(a):
        return pd.Series([], dtype="int32")
    x, y = (np.frombuffer(b"".join(s), np.uint16).reshape(-1, SYMBOLS) for s in (a, b))
    return pd.Series((x != y).sum(axis=1).astype("int32"))


def _near(pairs: DataFrame, classes: DataFrame, plan: Plan) -> DataFrame:
    """The pairs (a, b) whose signatures are under the distance threshold."""
    left = classes.select(F.col("rep").alias("a"), F.col("signature").alias("sa"))
    right = classes.select(F.col("rep").alias("b"), F.col("signature").alias("sb"))
    return pairs.join(left, "a").join(right, "b").filter(_distance("sa", "sb") <= plan.distance).select("a", "b")


def _overlap(plan: Plan) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The links of rows (a, part, b, text) sorted by these: a pivot's own rows, without b, come before its members.

    Only the sets of the pivot at hand are held; copies of its row add nothing.
    """

    def confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, sets = None, []
        for batch in batches:
            left, right = [], []
            names = zip(*(batch.column(c).to_pylist() for c in ("a", "part", "b")))
            for (a, part, b), own in zip(names, _sets(_texts(batch.column("text")))):
                if (a, part) != pivot:
                    pivot, sets = (a, part), []
                if b is None:
                    if not any(np.array_equal(own, x) for x in sets):
                        sets.append(own)
                    continue
                for x in sets:
                    both = len(np.intersect1d(x, own, assume_unique=True))
                    if both and plan.similar(both, len(x) + len(own) - both):
                        left.append(a)
                        right.append(b)
                        break
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return confirmed


def _texts_of(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` rows with the text of their doc_id. A filter of bounded size keeps most other texts from moving."""
    key = F.col("doc_id").cast("string")
    possible = possible_hits(documents.select("doc_id", "text"), key, wanted.select(key.alias("key")).distinct())
    return possible.join(wanted, "doc_id")


def _linked(pairs: DataFrame, documents: DataFrame, plan: Plan) -> DataFrame:
    """The pairs that hold on the full shingle sets; only texts of documents in a pair are moved.

    A member's text goes to its pivot's; the pivot's is there once for every ``PIVOT_ROWS`` members.
    """
    pairs = stage(pairs, "pairs")
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PIVOT_ROWS).cast("int").alias("n"))
    members = pairs.join(size, "a").select(F.col("b").alias("doc_id"), "a", F.pmod(F.xxhash64("b"), F.col("n")).cast("int").alias("part"), "b")
    pivots = size.select(F.col("a").alias("doc_id"), "a", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("part"), F.lit(None).cast("long").alias("b"))
    rows = _texts_of(documents, stage(members.union(pivots), "wanted")).select("a", "part", "b", "text")
    sorted_ = rows.repartition(parts, "a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    return sorted_.mapInArrow(_overlap(plan), "a long, b long").distinct()


def _links_between(one: pd.DataFrame, other: pd.DataFrame, same: bool, plan: Plan) -> tuple[list[int], list[int]]:
    """Labels of different components that a link between rows of two blocks joins, confirmed on full sets.

    Each link joins its components at once, so that a later pair inside one adds nothing.
    """
    x, y = (np.frombuffer(b"".join(f.signature), np.uint16).reshape(-1, SYMBOLS) for f in (one, other))
    own, sets = list(_sets(_texts(pa.array(one.text)))), list(_sets(_texts(pa.array(other.text))))
    at = np.cumsum([0] + [len(s) for s in sets])
    flat, sizes = np.concatenate(sets), np.diff(at)
    names, values = np.unique(np.concatenate([one.label, other.label]), return_inverse=True)
    mine, theirs = values[:len(one)], values[len(one):]
    parent = np.arange(len(names))
    left, right = [], []
    for i in range(len(one)):
        near = (parent[theirs] != parent[mine[i]]) & ((y != x[i]).sum(axis=1) <= plan.distance)
        if same:
            near[:i + 1] = False
        if not near.any():
            continue
        place = np.minimum(np.searchsorted(own[i], flat), len(own[i]) - 1)
        both = np.add.reduceat((own[i][place] == flat).astype(np.int64), at[:-1])
        for j in np.flatnonzero(near & plan.similar(both, sizes + len(own[i]) - both)):
            p, q = parent[mine[i]], parent[theirs[j]]
            if p != q:
                parent[parent == q] = p
                left.append(int(one.label.iloc[i]))
                right.append(int(other.label.iloc[j]))
    return left, right


def _compare(plan: Plan) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Links of each (cluster, i, j), of rows sorted by these; one group is held at a time."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pd.DataFrame] = []

        def links(frame: pd.DataFrame) -> Iterator[pa.RecordBatch]:
            for (_, i, j), g in frame.groupby(["cluster", "i", "j"], sort=False):
                one, other = g[g.block == i], g[g.block == j]
                if len(one) and len(other):
                    left, right = _links_between(one, other, i == j, plan)
                    yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                frame = pd.concat([*held, batch.slice(at, 1000).to_pandas()])
                last = frame.iloc[-1]
                open_ = (frame.cluster == last.cluster) & (frame.i == last.i) & (frame.j == last.j)
                held = [frame[open_]]
                yield from links(frame[~open_])
        if held:
            yield from links(pd.concat(held))

    return compared


def _near_in(g: pd.DataFrame, plan: Plan) -> list[tuple[int, int]]:
    """A spanning forest of the near pairs of one large group, row by row."""
    signs = np.frombuffer(b"".join(g.signature), np.uint16).reshape(-1, SYMBOLS)
    labels, block, rep = g.label.to_numpy(), g.block.to_numpy(), g.rep.to_numpy()
    i, j = int(g.i.iloc[0]), int(g.j.iloc[0])
    parent, found = np.arange(len(g)), []
    for x in np.flatnonzero(block == i):
        others = (block == j) & (labels != labels[x])
        if i == j:
            others[:x + 1] = False
        others = np.flatnonzero(others)
        for y in others[(signs[others] != signs[x]).sum(axis=1) <= plan.distance]:
            if parent[x] != parent[y]:
                parent[parent == parent[y]] = parent[x]
                found.append((int(rep[x]), int(rep[y])))
    return found


def _near_in_small(frame: pd.DataFrame, groups: np.ndarray, longest: int, plan: Plan) -> list[tuple[int, int]]:
    """Near pairs of many small groups at once: each row with the next, the one after it and so on."""
    signs = np.frombuffer(b"".join(frame.signature), np.uint16).reshape(-1, SYMBOLS)
    labels, rep = frame.label.to_numpy(), frame.rep.to_numpy()
    found: list[tuple[int, int]] = []
    for step in range(1, longest):
        at = np.flatnonzero((groups[step:] == groups[:-step]) & (labels[step:] != labels[:-step]))
        near = at[(signs[at] != signs[at + step]).sum(axis=1) <= plan.distance]
        found += zip(rep[near].tolist(), rep[near + step].tolist())
    return stars(found)


def _near_pairs(plan: Plan) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pairs (a, b) of different components that are joined by pairs under the distance, of rows sorted by (key, i, j)."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pd.DataFrame] = []

        def out(frame: pd.DataFrame) -> pa.RecordBatch:
            keys = frame[["key", "i", "j"]].to_numpy()
            groups = np.concatenate([[0], np.cumsum((keys[1:] != keys[:-1]).any(axis=1))])
            sizes = np.bincount(groups)
            small = sizes[groups] <= SMALL_GROUP
            found = _near_in_small(frame[small], groups[small], SMALL_GROUP, plan) if small.any() else []
            for n in np.flatnonzero(sizes > SMALL_GROUP):
                found += _near_in(frame[groups == n], plan)
            a, b = zip(*found) if found else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            frame = pd.concat([*held, batch.to_pandas()], ignore_index=True)
            last = frame.iloc[-1] if len(frame) else None
            open_ = (frame.key == last.key) & (frame.i == last.i) & (frame.j == last.j) if last is not None else []
            held = [frame[open_]]
            if len(frame) > len(held[0]):
                yield out(frame[~open_])
        if held and len(held[0]):
            yield out(held[0])

    return pairs


def _deal(rows: DataFrame) -> DataFrame:
    """Rows (key, rep, label, signature) of mixed buckets as (key, i, j): the pairs of blocks that must meet.

    Rows of a bucket's largest component meet only the others, so they are dealt once for each block of others,
    which is one as a rule. Their blocks have negative numbers.
    """
    per = rows.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    sizes = per.groupBy("key").agg(F.sum("n").alias("n"), F.max(F.struct("n", "label")).alias("top")).select(
        F.col("key").alias("k"), F.col("top.label").alias("top"),
        F.ceil((F.col("n") - F.col("top.n")) / SIGN_BLOCK).cast("int").alias("few"), F.ceil(F.col("top.n") / SIGN_BLOCK).cast("int").alias("many"),
    )
    placed = rows.join(sizes, F.col("key") == F.col("k"))
    large = F.col("label") == F.col("top")
    block = F.when(large, -1 - F.pmod(F.xxhash64("rep"), F.col("many"))).otherwise(F.pmod(F.xxhash64("rep"), F.col("few"))).cast("int")
    meets = F.when(large, F.sequence(F.lit(0), F.col("few") - 1)).otherwise(F.sequence(-F.col("many"), F.col("few") - 1))
    return placed.withColumn("block", block).withColumn("other", F.explode(meets)).select(
        "key", "rep", "label", "signature", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    )


def _across(buckets: DataFrame, classes: DataFrame, labels: DataFrame, documents: DataFrame, plan: Plan) -> DataFrame | None:
    """(a, b): labels of different components that a link joins, or None where no signatures of such are near.

    In the buckets that hold several components signatures are compared first; texts move only for the classes
    that are near one of another component. These are joined to clusters, and a cluster is compared in pairs of
    blocks, each of bounded rows and characters; only confirmed links leave a block.
    """
    spark = documents.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Nodes without an edge are their own label.
    named = buckets.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    mixed = named.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("key")
    rows = stage(named.join(mixed, "key").join(classes.select("rep", "signature"), "rep"), "mixed")
    order = ["key", "i", "j"]
    near = _deal(rows).repartition(parts, *order).sortWithinPartitions(*order).mapInArrow(_near_pairs(plan), "a long, b long")
    near = stage(near.distinct(), "near")
    if near.isEmpty():
        return None
    clusters = connected(near).withColumnsRenamed({"node": "rep", "label": "cluster"})
    members = rows.select("rep", "label", "signature").dropDuplicates(["rep"]).join(clusters, "rep")
    texts = _texts_of(documents, clusters.select(F.col("rep").alias("doc_id"))).withColumnRenamed("doc_id", "rep")
    members = stage(members.join(texts, "rep"), "members")
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum(F.char_length("text")).alias("chars")).select(
        "cluster", F.ceil(F.greatest(F.col("n") / BLOCK, F.col("chars") / BLOCK_CHARS)).cast("int").alias("blocks")
    )
    dealt = (
        members.join(sizes, "cluster")
        .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("cluster", "rep", "label", "signature", "text", "block",
                F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    )
    dealt = dealt.repartition(parts, "cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
    # Written before components are joined: two Python steps in one task would hold two workers.
    return stage(dealt.mapInArrow(_compare(plan), "a long, b long"), "more")


def near_groups(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Components of documents whose shingle sets have a Jaccard similarity of ``percent`` / 100 or more.

    Returns one row per input row: doc_id, n_shingles, component_id (the smallest doc_id reachable over
    links, itself included) and kept (doc_id = component_id). Null and empty texts have no shingles and
    link to nothing; texts of one to four words have one shingle, their whole sequence. Rows that repeat
    a doc_id are kept or dropped together; rows with one doc_id and different texts are one node. A row
    with a null doc_id cannot be named by a link: it stays, with a null component_id. Other columns play
    no part. Links that both texts' signatures put beyond the plan's distance are missed (see above).
    """
    plan = plan_for(percent)
    signed = stage(signatures(documents), "signatures")
    classes = stage(
        signed.filter("n_shingles > 0 and doc_id is not null").groupBy("set_print")
        .agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature")),
        "classes",
    )
    keys = bucket_keys(classes, plan)
    pivots = keys.groupBy("key").agg(F.min("rep").alias("pivot"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    buckets = stage(keys.join(pivots.select("key", "pivot"), "key"), "buckets")

    star = buckets.filter("rep > pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
    links = stage(_linked(_near(star, classes, plan), documents, plan), "links")
    labels = stage(connected(links), "labels")
    more = _across(buckets.select("key", "rep"), classes, labels, documents, plan)
    rep = classes.select(F.col("set_print").alias("p"), "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "p", F.coalesce("label", "rep").alias("component")
    )
    if more is not None:
        joined = connected(more).select(F.col("node").alias("component"), F.col("label").alias("whole"))
        rep = rep.join(joined, "component", "left").select("p", F.coalesce("whole", "component").alias("component"))

    members = signed.filter("doc_id is not null").select("doc_id", "n_shingles", "set_print")
    found = members.join(rep, (F.col("set_print") == F.col("p")) & (F.col("n_shingles") > 0), "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )
    unnamed = signed.filter("doc_id is null").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"))
    return found.union(unnamed).select(
        "*", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def drop_near_copies(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents that ``near_groups`` keeps, with all their columns."""
    dropped = near_groups(documents, percent).filter(~F.col("kept")).select("doc_id").distinct()
    return documents.join(dropped, "doc_id", "left_anti").select(*documents.columns)
