"""URL rules by a blocked Bloom filter and an exact join.

A rule names a host (with its subdomains) and a path prefix. Each URL is expanded to the canonical
prefixes that a rule could name; the filter passes the possible hits, and the exact join on the listed
text removes the false ones. The filter has one row per block of four 64-bit words.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeline.llm.common import UPPER
from gradeline.sources.stage import stage

LANES = 4
MAX_BLOCKS = 1 << 18
DEFAULT = "allow"


def canonical(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty for null or without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(text, pattern, 1), UPPER, UPPER.lower()), F.regexp_extract(text, pattern, 2)


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _mask(key: Column, lane: int) -> Column:
    bit = F.pmod(F.xxhash64(F.lit(lane), key), F.lit(64)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), bit)


def bloom_filter(listed: DataFrame, max_blocks: int = MAX_BLOCKS) -> tuple[DataFrame, int]:
    """Blocks with a set bit of the distinct texts in column ``key``, and the number of blocks.

    About 32 bits per text, but never more than ``max_blocks`` blocks of 40 bytes (10 MB), which is
    what makes it fit to broadcast: a longer list gives more false hits, which the exact join removes.
    """
    keys = listed.select("key").distinct()
    blocks = min(max_blocks, 1 << max(0, math.ceil(math.log2(max(1, keys.count()) / 8))))
    bits = keys.select(_block(F.col("key"), blocks).alias("block"), *[_mask(F.col("key"), i).alias(f"b{i}") for i in range(LANES)])
    return bits.groupBy("block").agg(*[F.bit_or(f"b{i}").alias(f"w{i}") for i in range(LANES)]), blocks


def possible_hits(rows: DataFrame, key: Column, listed: DataFrame, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """The rows whose ``key`` (text) the filter of ``listed`` passes: all listed ones and a few others."""
    filtered, blocks = bloom_filter(listed, max_blocks)
    marked = rows.select("*", _block(key, blocks).alias("_block"), *[_mask(key, i).alias(f"_b{i}") for i in range(LANES)])
    hit = marked["_block"] == filtered["block"]
    for i in range(LANES):
        hit &= filtered[f"w{i}"].bitwiseAND(marked[f"_b{i}"]) != 0
    return marked.join(F.broadcast(filtered), hit, "left_semi").select(*rows.columns)


def apply_rules(urls: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """Judge every row of ``urls`` (column url) by ``rules`` (host, path, verdict).

    Adds host, path, rule (host and path of the longest fitting rule, else null) and verdict (the
    rule's, or ``default``: a URL that no rule lists). Of rules with the same host and path ``block``
    wins. Rules with a null host or path are ignored. Null and malformed URLs have empty host and path.
    Repeated rows are judged alike; other columns are passed on, but columns of ``urls`` named like an
    added one are replaced. No rules: every URL gets the default.
    """
    listed = stage(
        rules.filter("host is not null and path is not null")
        .groupBy("host", "path").agg(F.max("verdict").alias("rule_verdict"))  # 'block' is above 'allow'
        .select(F.concat("host", "path").alias("key"), F.char_length("path").alias("prefix"), "rule_verdict"),
        "rules",
    )
    # Distinct prefix lengths are bounded by the length of a URL, not by the length of the list.
    lengths = sorted(r.prefix for r in listed.select("prefix").distinct().collect())
    host, path = canonical(F.col("url"))
    pages = urls.withColumns({"host": host, "path": path})

    parts = F.split("host", r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    starts = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.char_length("path"))
    keys = F.flatten(F.transform(hosts, lambda h: F.transform(starts, lambda n: F.concat(h, F.substring(F.col("path"), F.lit(1), n)))))
    candidates = pages.select("host", "path", F.explode(keys).alias("key"))
    possible = possible_hits(candidates, F.col("key"), listed).distinct()
    best = (
        possible.join(listed, "key")
        .groupBy("host", "path")
        .agg(F.max_by(F.struct("key", "rule_verdict"), F.char_length("key")).alias("best"))
        .select(F.col("host").alias("h"), F.col("path").alias("p"), "best", F.char_length("path").alias("n"))
    )
    # The path length is a third key, so that both sides are dealt anew and Spark can split a hot URL.
    same = (pages["host"] == best["h"]) & (pages["path"] == best["p"]) & (F.char_length(pages["path"]) == best["n"])
    return pages.join(best, same, "left").select(
        *[pages[c] for c in pages.columns if c not in ("rule", "verdict")],
        best["best"]["key"].alias("rule"), F.coalesce(best["best"]["rule_verdict"], F.lit(default)).alias("verdict"),
    )
