"""Token counts from flat token files without an index.

A flat file is a run of little-endian 16-bit token ids in which an end-of-document id closes each
document. Files are read in blocks by byte range; in a block the separators are found in one vectorised
search. What a document has in earlier blocks follows from a prefix scan: the running number of
separators gives its place in the file, and the running maximum of their positions its start.
"""

from __future__ import annotations

import base64
import functools
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeline.sources.stage import new_dir, stage

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# How the byte-level vocabularies split a text, and the id that they leave free.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END = 50256
BLOCK_BYTES = 8 << 20
LONG = 100_000
#: A cut here is always between two pre-tokens: a single space that a letter or digit follows.
_CUT = re.compile(r"(?<=\S) (?=[^\W_])")


@functools.lru_cache(1)
def encoder(vocabulary: str):
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("flat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(text: str | None, vocabulary: str) -> np.ndarray:
    """Token ids of a text; a long one is encoded in parts that give the same ids as the whole."""
    parts, at, text = [], 0, text or ""
    while len(text) - at > LONG and (cut := _CUT.search(text, at + LONG)):
        parts.append(text[at:cut.start()])
        at = cut.start()
    parts.append(text[at:])
    return np.concatenate([np.array(encoder(vocabulary).encode_ordinary(p), "<u2") for p in parts])


def write_flat(documents: DataFrame, vocabulary: str = VOCABULARY, end: int = END, path: str | None = None) -> DataFrame:
    """Write flat files of all documents and return what stands where: file, ordinal, doc_id.

    Each attempt of a task writes a file of its own, and only those that the listing names count, so a
    lost executor leaves at most a file that nobody reads. The vocabulary is at the same path everywhere.
    """
    path = path or new_dir(documents.sparkSession, "tokens")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(path)
        system.create_dir(root, recursive=True)
        name, count, out = f"{root}/{uuid.uuid4().hex}.bin", 0, None
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                out = out or system.open_output_stream(name)
                for text in part.column(1).to_pylist():
                    out.write(encode(text, vocabulary).tobytes() + np.array([end], "<u2").tobytes())
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * n, pa.string()), pa.array(range(count, count + n), pa.int64()), part.column(0)],
                    names=["file", "ordinal", "doc_id"],
                )
                count += n
        if out:
            out.close()

    return stage(documents.select("doc_id", "text").mapInArrow(write, "file string, ordinal long, doc_id long"), "flat")


def scan(files: DataFrame, system_uri: str, end: int = END, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Documents in flat files: file, ordinal, n_tokens. ``files`` has one path per row in column file.

    ``system_uri`` is any path of the file system that holds them. A separator at once after another
    closes an empty document; tokens after the last separator are a document that is not closed.
    """
    block_bytes -= block_bytes % 2

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(system_uri)
        for batch in batches:
            found = system.get_file_info(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f.size for f in found], pa.int64())], names=["file", "size"]
            )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(system_uri)
        for batch in batches:
            for file, size, block in zip(*[c.to_pylist() for c in batch.columns]):
                with system.open_input_file(file) as stream:
                    ids = np.frombuffer(stream.read_at(min(block_bytes, size - block * block_bytes), block * block_bytes), "<u2")
                at = np.flatnonzero(ids == end) + block * (block_bytes // 2)
                some = len(at) > 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file]), pa.array([size // 2], pa.int64()), pa.array([block], pa.int64()), pa.array([len(at)], pa.int64()),
                     pa.array([int(at[0]) if some else None], pa.int64()), pa.array([int(at[-1]) if some else None], pa.int64()),
                     pa.array([np.diff(at) - 1], pa.list_(pa.int64()))],
                    names=["file", "n_ids", "block", "separators", "first", "last", "inner"],
                )

    spark = files.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = (
        files.select("file").mapInArrow(sizes, "file string, size long").filter("size > 0")
        .select("file", "size", F.explode(F.sequence(F.lit(0), F.floor((F.col("size") - 1) / block_bytes))).alias("block"))
        .repartition(tasks, "file", "block")
    )
    found = stage(
        blocks.mapInArrow(
            search, "file string, n_ids long, block long, separators long, first long, last long, inner array<long>"
        ), "blocks",
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    stitched = (
        found.select("file", "block", "separators", "first", "last")
        .withColumn("base", F.coalesce(F.sum("separators").over(earlier), F.lit(0)))
        .withColumn("before", F.coalesce(F.max("last").over(earlier), F.lit(-1)))
    )
    heads = stitched.filter("separators > 0").select("file", F.col("base").alias("ordinal"), (F.col("first") - F.col("before") - 1).alias("n_tokens"))
    inner = (
        found.select("file", "block", F.posexplode("inner").alias("i", "n_tokens"))
        .join(stitched.select("file", "block", "base"), ["file", "block"])
        .select("file", (F.col("base") + F.col("i") + 1).alias("ordinal"), "n_tokens")
    )
    tails = (
        found.groupBy("file").agg(F.sum("separators").alias("ordinal"), F.max("n_ids").alias("n"), F.max("last").alias("last"))
        .select("file", "ordinal", (F.col("n") - 1 - F.coalesce("last", F.lit(-1))).alias("n_tokens")).filter("n_tokens > 0")
    )
    return heads.union(inner).union(tails)


def token_counts(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id and n_tokens of every document row, by a scan of flat files that hold all documents.

    Null and empty texts have 0 tokens. The end-of-document mark inside a text is ordinary text. Repeated
    rows and null ids are counted like any other; other columns play no part; an empty table has no rows.
    """
    path = new_dir(documents.sparkSession, "tokens")
    listing = write_flat(documents, vocabulary, path=path)
    counts = scan(listing.select("file").distinct(), path)
    return listing.join(counts, ["file", "ordinal"]).select("doc_id", "n_tokens")
