"""Exact deduplication by content-defined chunk recipes, in DataFrame functions only.

A text is cut where a short window of its own characters fits a pattern, so that the cuts move with the
content. Each chunk gets an identifier, and the dictionary of distinct chunks proves that an identifier
stands for one chunk text only. Two documents are equal when their ordered identifier lists are equal.
Every distinct chunk moves once; after that only the short lists move.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeline.llm.common import ascii_lower
from gradeline.sources.stage import stage

MIN_CHUNK, MAX_CHUNK = 512, 8192
_IN, _OUT = "[acegikmoqsuwy02468 ]", "[^acegikmoqsuwy02468 ]"
#: A cut follows this window of nine characters, about one place in 512.
CUT_AFTER = "".join(_IN if c == "1" else _OUT for c in "100101101")


def chunks(text: Column, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> Column:
    """The chunks of a text in order, none lost; an empty text has none."""
    pattern = rf"(?s).{{{least},{most}}}?(?:(?<={CUT_AFTER})|\z)|.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _two_hashes(chunk: Column) -> Column:
    return F.struct(F.xxhash64(chunk).alias("a"), F.xxhash64(F.lit(1), chunk).alias("b"))


#: Identifiers to try, short ones first.
FINGERPRINTS: tuple[Callable[[Column], Column], ...] = (_two_hashes, lambda chunk: F.sha2(chunk, 256))


def verified_fingerprint(
    texts: DataFrame, fingerprints: Sequence[Callable[[Column], Column]] = FINGERPRINTS
) -> Callable[[Column], Column]:
    """The first fingerprint under which no two different chunks of column ``text`` share an identifier.

    Distinct chunks are combined in each task before they move, so a chunk that most documents share
    costs one row per task.
    """
    each = texts.select(F.explode(chunks(F.col("text"))).alias("chunk"))
    for fingerprint in fingerprints:
        dictionary = each.select(fingerprint(F.col("chunk")).alias("id"), "chunk").distinct()
        shared = dictionary.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        if shared.isEmpty():
            return fingerprint
    raise ValueError("two different chunks share an identifier under every fingerprint")


def exact_groups(
    documents: DataFrame, fingerprints: Sequence[Callable[[Column], Column]] = FINGERPRINTS
) -> DataFrame:
    """Group documents whose texts are equal after lower-casing A-Z.

    Returns one row per input row: doc_id, keep_id (the largest doc_id of the group), group_size, kept,
    text_sha256 (of the lower-cased text). A null text counts as empty, and all empty texts are equal.
    Rows that repeat a doc_id and its text are kept or dropped together. A null doc_id is below every
    other: it is kept only in a group that has no other id (keep_id is then null). Other columns play
    no part, and an empty table gives an empty result.
    """
    texts = documents.select("doc_id", ascii_lower(F.coalesce("text", F.lit(""))).alias("text"))
    fingerprint = verified_fingerprint(texts, fingerprints)
    recipes = stage(
        texts.select(
            "doc_id",
            F.sha2("text", 256).alias("text_sha256"),
            F.transform(chunks(F.col("text")), fingerprint).alias("recipe"),
        ),
        "recipes",
    )
    groups = recipes.groupBy("recipe").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    # The length is a second join key, so that both sides are dealt anew and Spark can split a hot recipe.
    groups = groups.select("keep_id", "group_size", F.col("recipe").alias("r"), F.size("recipe").alias("n"))
    same = (F.col("recipe") == F.col("r")) & (F.size("recipe") == F.col("n"))
    return recipes.join(groups, same).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def drop_copies(documents: DataFrame) -> DataFrame:
    """The documents that ``exact_groups`` keeps, with all their columns."""
    groups = exact_groups(documents)
    dropped = groups.filter(~F.col("kept")).select("doc_id", "text_sha256").distinct()
    digest = F.sha2(ascii_lower(F.coalesce(documents["text"], F.lit(""))), 256)
    same = documents["doc_id"].eqNullSafe(dropped["doc_id"]) & (digest == dropped["text_sha256"])
    return documents.join(dropped, same, "left_anti")
