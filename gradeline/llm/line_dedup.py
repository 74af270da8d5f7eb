"""Line deduplication with two Bloom filters, for hashes seen once and seen twice.

One scan marks the hashes of all long lines in two blocked filters: a hash that the once-seen filter already
holds goes to the twice-seen filter too. The filters of the tasks are merged slice by slice; what two tasks
have both seen once is seen twice. A second scan sends on only the lines that the twice-seen filter passes.
These are counted and compared by their texts, so false suspicions change nothing. A document moves only if it
may lose a line.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeline.llm.url_filter import LANES, MAX_BLOCKS, _block, _mask, bloom_filter
from gradeline.llm.words import mix
from gradeline.sources.stage import stage

LEAST_CHARS = 40
LEAST_DOCUMENTS = 5
#: Bits of each filter: one for every 20 bytes of text, within these bounds. The larger is 32 MB, which fits to
#: broadcast; where lines outgrow it more of them are suspected, and the exact step counts those as well.
MIN_BITS, MAX_BITS = 1 << 16, 1 << 28
#: Words of a slice, which is what one row carries and one merge holds.
SLICE = 1 << 14
# The white space that is taken off both ends of a line.
SPACES = b" \t\n\v\f\r"
_U = np.uint64


def keys_of(text: str | None) -> list[bytes]:
    """The key of each line, in order; bytes.lower() lower-cases A-Z only."""
    return [line.strip(SPACES) for line in (text or "").encode().lower().split(b"\n")]


def _long(key: bytes, least: int) -> bool:
    """Whether the key has enough code points: bytes that do not continue one."""
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode()) >= least)


def _own_keys(text: str | None, least: int) -> set[bytes]:
    return {k for k in keys_of(text) if _long(k, least)}


def _places(hashes: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Filter word of each hash and its mask of up to three bits in that word."""
    more = mix(hashes)
    masks = np.zeros(len(hashes), _U)
    for shift in (0, 6, 12):
        masks |= _U(1) << (more >> _U(shift) & _U(63))
    return (hashes % _U(words)).astype(np.int64), masks


class SeenFilters:
    """Once-seen and twice-seen filters of what one task has read."""

    def __init__(self, bits: int):
        self.once, self.twice = np.zeros(bits // 64, _U), np.zeros(bits // 64, _U)

    def add(self, hashes: np.ndarray) -> None:
        """Each document brings a hash once; documents may repeat each other's."""
        hashes, counts = np.unique(hashes, return_counts=True)
        at, masks = _places(hashes, len(self.once))
        again = (counts > 1) | (self.once[at] & masks == masks)
        np.bitwise_or.at(self.twice, at[again], masks[again])
        np.bitwise_or.at(self.once, at, masks)


def _merge(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Two pairs (once, twice) as one; what both have seen once has been seen twice."""
    return np.stack([one[0] | other[0], one[1] | other[1] | (one[0] & other[0])])


def suspect_filter(documents: DataFrame, bits: int, least: int) -> np.ndarray:
    """The twice-seen filter of the keys of all documents. Each task sends its filled slices, compressed."""
    width = min(SLICE, bits // 64)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held, size = SeenFilters(bits), [], 0
        for batch in batches:
            for text in batch.column(0):
                own = [xxhash.xxh3_64_intdigest(k) for k in _own_keys(text.as_py(), least)]
                held.append(np.array(own, _U))
                size += len(own)
                if size > 100_000:
                    seen.add(np.concatenate(held))
                    held, size = [], 0
        if held:
            seen.add(np.concatenate(held))
        for at in range(0, bits // 64, width):
            if seen.once[at:at + width].any():
                pair = np.stack([seen.once[at:at + width], seen.twice[at:at + width]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at // width], pa.int64()), pa.array([pa.compress(pair.tobytes(), "zstd", asbytes=True)], pa.binary())],
                    names=["slice", "seen"],
                )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows of a partition come sorted by slice, so that one slice is held."""
        now, pair = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([pair[1].tobytes()], pa.binary())], names=["slice", "seen"])

        for batch in batches:
            for key, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = pa.decompress(data.as_py(), 16 * width, "zstd", asbytes=True)
                own = np.frombuffer(raw, _U).reshape(2, width)
                if key == now:
                    pair = _merge(pair, own)
                else:
                    if now is not None:
                        yield done()
                    now, pair = key, own
        if now is not None:
            yield done()

    sent = documents.filter("doc_id is not null").select("text").mapInArrow(mark, "slice long, seen binary")
    parts = min(bits // 64 // width, int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    merged = sent.repartition(parts, "slice").sortWithinPartitions("slice").mapInArrow(merge, "slice long, seen binary")
    twice = np.zeros(bits // 64, _U)
    for row in merged.toLocalIterator():  # at most MAX_BITS in all
        twice[row.slice * width:(row.slice + 1) * width] = np.frombuffer(row.seen, _U)
    return twice


def suspects(documents: DataFrame, twice: np.ndarray, least: int) -> DataFrame:
    """(doc_id, key): the distinct keys of each document that the filter passes, staged."""
    shared = documents.sparkSession.sparkContext.broadcast(twice)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = list(_own_keys(text.as_py(), least))
                if own:
                    hashes = np.array([xxhash.xxh3_64_intdigest(k) for k in own], _U)
                    at, masks = _places(hashes, len(shared.value))
                    passed = np.flatnonzero(shared.value[at] & masks == masks)
                    ids += [doc_id] * len(passed)
                    keys += [own[i].decode() for i in passed]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.string())], names=["doc_id", "key"])

    found = documents.filter("doc_id is not null").select("doc_id", "text").mapInArrow(find, "doc_id long, key string")
    found = stage(found, "suspects")
    shared.destroy()
    return found


def _drop_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_lines, n_dropped, kept = [], [], []
        for text, gone in zip(batch.column(1), batch.column(2)):
            text, gone = text.as_py() or "", {k.encode() for k in gone.as_py() or ()}
            lines = text.split("\n")
            left = [line for line, key in zip(lines, keys_of(text)) if key not in gone] if gone else lines
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(left))
            kept.append("\n".join(left))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())],
            names=["doc_id", "n_lines", "n_dropped", "text"],
        )


def drop_repeated_lines(
    documents: DataFrame, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS, max_bits: int = MAX_BITS
) -> DataFrame:
    """Every document without the lines that ``least_documents`` documents or more hold.

    A line's key is the line without white space at both ends, A-Z lower-cased. Lines of a key of at least
    ``least_chars`` code points go, except in the largest doc_id that holds the key, where all of them stay.
    Returns doc_id, n_lines (before), n_dropped and text (what is left, joined by newlines), one row per input
    row. Null and empty texts are one empty line. Documents are counted by doc_id, so rows that repeat one
    count once and are treated alike. A row with a null doc_id counts for nothing and keeps all its lines.
    Other columns play no part; an empty table gives no rows.
    """
    documents = documents.select("doc_id", "text")
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(max_bits, 1 << max(MIN_BITS.bit_length() - 1, (size // 20).bit_length()))
    doubtful = suspects(documents, suspect_filter(documents, bits, least_chars), least_chars)
    repeated = doubtful.groupBy("key").agg(F.count_distinct("doc_id").alias("n"), F.max("doc_id").alias("keep")).filter(
        F.col("n") >= least_documents
    )
    # Staged, so that both sides of the join are dealt anew and Spark can split a key that very many documents hold.
    repeated = stage(repeated.select(F.col("key").alias("k"), "keep"), "repeated")
    lost = doubtful.join(repeated, (F.col("key") == F.col("k")) & (F.col("doc_id") != F.col("keep")))
    gone = stage(lost.groupBy("doc_id").agg(F.collect_set("key").alias("keys")).select(F.col("doc_id").alias("owner"), "keys"), "gone")

    # Documents that the filter of owners holds back lose nothing; they do not move.
    name = F.col("doc_id").cast("string")
    owners, blocks = bloom_filter(gone.select(F.col("owner").cast("string").alias("key")), MAX_BLOCKS)
    owners = F.broadcast(stage(owners, "owners"))
    hit = owners["block"] == _block(name, blocks)
    for i in range(LANES):
        hit &= owners[f"w{i}"].bitwiseAND(_mask(name, i)) != 0
    whole = documents.join(owners, hit, "left_anti").select(
        "doc_id", F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long").alias("n_lines"),
        F.lit(0).cast("long").alias("n_dropped"), F.coalesce("text", F.lit("")).alias("text"),
    )
    cut = documents.join(owners, hit, "left_semi").join(gone, F.col("doc_id") == F.col("owner"), "left").select("doc_id", "text", "keys")
    return whole.union(cut.mapInArrow(_drop_lines, "doc_id long, n_lines long, n_dropped long, text string"))
