"""Mix sources to target weights with a multivariate-hypergeometric splitting tree.

Documents of a source are dealt into blocks by a digest of their id, and the blocks of a source stand in
a permuted order. A source needs some of its blocks, in that order and starting again at the front for
repeats, to reach its target: its block quota. The quotas of all sources are split between two halves of
the output shards by drawing blocks without replacement, and again in each half, so each shard ends with
an exact quota of every source. A shard then takes the next disjoint stretch of the permuted blocks and
shuffles its documents locally. All of it is DataFrame functions; digests make reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeline.llm.common import word_count
from gradeline.sources.stage import stage

BLOCKS = 256
LEVELS = 4
CYCLE = (3, 1, 2)
SHARE = 1.5
REPEATS = 2


def digest(*parts: Column | str) -> Column:
    """52 bits of an MD5, as a long: the same in every engine."""
    text = F.concat_ws("/", *[p if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def targets(sizes: DataFrame, cycle=CYCLE, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """Words each source is to give; ``sizes`` has one row per source: source, source_size.

    Weights follow the code-point order of the sources, null last. Each source gets the smaller of
    ``repeats`` times its size and a level times its weight, with the level at which all targets sum to
    ``share`` of all sizes: what resharing the excess by weight comes to. One row per source is sorted
    in one task; documents are not.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weights = F.array(*[F.lit(float(w)) for w in cycle])
    ranked = sizes.withColumn("rank", F.row_number().over(order)).withColumn(
        "weight", F.element_at(weights, (F.pmod(F.col("rank") - 1, F.lit(len(cycle))) + 1).cast("int"))
    )
    cap = (F.col("source_size") * repeats).cast("double")
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wanted = F.sum("source_size").over(everything) * F.lit(share)
    level = (wanted - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    # Full sources come first in this order; the first that is not full gives the level for the rest.
    opened = ranked.withColumn("cap", cap).withColumn("level", level)
    first = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("position", "level"))).over(everything)
    placed = opened.withColumn("position", F.row_number().over(fill)).withColumn("first", first)
    return placed.select(
        "source", "source_size", "weight",
        F.when(F.col("position") < F.coalesce(F.col("first.position"), F.lit(1 << 30)), F.col("cap"))
        .otherwise(F.col("first.level") * F.col("weight")).alias("target"),
    )


def split_quotas(quotas: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Exact quotas of the 2**levels shards: source_key, shard, quota.

    At each node the blocks of all sources are drawn without replacement into two halves of equal size
    (the left one gets an odd block), which is one multivariate-hypergeometric draw. ``quotas`` has
    source_key and quota; the tree handles block counts, never documents.
    """
    nodes = quotas.filter("quota > 0").select("source_key", "quota", F.lit(0).alias("shard"))
    for level in range(levels):
        urn = nodes.select("source_key", "shard", F.explode(F.sequence(F.lit(1), F.col("quota").cast("int"))).alias("i"))
        draw = Window.partitionBy("shard").orderBy(
            digest("draw", F.lit(level), F.col("shard"), F.col("source_key"), F.col("i")), "source_key", "i"
        )
        whole = Window.partitionBy("shard")
        right = (F.row_number().over(draw) * 2 > F.count(F.lit(1)).over(whole) + 1).cast("int")
        nodes = (
            urn.select("source_key", (F.col("shard") * 2 + right).alias("shard"))
            .groupBy("source_key", "shard").agg(F.count(F.lit(1)).alias("quota"))
        )
    return nodes


def mix(
    documents: DataFrame, *, cycle=CYCLE, share: float = SHARE, repeats: int = REPEATS,
    blocks: int = BLOCKS, levels: int = LEVELS,
) -> tuple[DataFrame, DataFrame]:
    """Mix all documents; returns (documents with sizes and targets, draws).

    Draws have one row per document and time it is taken: doc_id, source, size, turn (0 for the first
    time), shard, position (order in the shard) and words. Words equal the size, but for the last
    document of a source's draw, which gives its leading words only as far as the target needs, so a
    source's words sum to its rounded target. A null text has size 0; documents of size 0 are drawn with
    their block and give 0 words. A null source is a source of its own. Rows that repeat a doc_id are
    separate documents of one block; where their sizes are equal too, either may come first. A null doc_id
    counts as the text ``null``. An empty table gives two empty results.
    """
    sized = stage(documents.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit("null"))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    sized = sized.select(
        "*", key.alias("source_key"), F.pmod(digest("block", name), F.lit(blocks)).cast("int").alias("block"),
        digest("document", name).alias("place"),
    )
    by_block = sized.groupBy("source", "source_key", "block").agg(F.sum("size").alias("words"))
    by_block = stage(by_block, "blocks")
    aims = targets(by_block.groupBy("source").agg(F.sum("words").alias("source_size")), cycle, share, repeats)
    aims = stage(aims.select(key.alias("source_key"), "source_size", "target", F.round("target").cast("long").alias("goal")), "targets")

    # Each block stands once per turn in the order of its source; those that start before the goal are drawn.
    order = Window.partitionBy("source_key").orderBy("turn", digest("order", F.col("source_key"), F.col("block")), "block")
    units = (
        by_block.select("source_key", "block", "words", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("turn"))
        .withColumn("unit", F.row_number().over(order))
        .withColumn("start", F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("words"))
        .join(aims.select("source_key", "goal"), "source_key")
        .filter("start < goal and words > 0")
        .withColumn("unit", F.row_number().over(Window.partitionBy("source_key").orderBy("unit")))
    )
    units = stage(units, "units")
    quotas = split_quotas(units.groupBy("source_key").agg(F.count(F.lit(1)).alias("quota")), levels)
    upto = Window.partitionBy("source_key").orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stretches = quotas.withColumn("last", F.sum("quota").over(upto)).select(
        F.col("source_key").alias("k"), "shard", (F.col("last") - F.col("quota") + 1).alias("begin"), "last"
    )
    drawn = stage(
        units.join(
            stretches,
            (F.col("source_key") == F.col("k")) & (F.col("unit") >= F.col("begin")) & (F.col("unit") <= F.col("last")),
        ).select("source_key", "block", "turn", "shard", "start", "words", "goal"),
        "drawn",
    )
    taken = sized.join(drawn, ["source_key", "block"]).withColumn("left", F.col("goal") - F.col("start"))
    whole = taken.filter("words <= left").select("doc_id", "source", "size", "turn", "shard", "place", F.col("size").alias("words"))
    inside = Window.partitionBy("source_key").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (
        taken.filter("words > left")
        .withColumn("before", F.sum("size").over(inside) - F.col("size"))
        .filter("before < left")
        .select("doc_id", "source", "size", "turn", "shard", "place", F.least("size", F.col("left") - F.col("before")).alias("words"))
    )
    draws = whole.union(cut).withColumn("position", digest("shuffle", F.col("shard"), F.col("turn"), F.col("place"))).drop("place")
    return sized.join(aims, "source_key").select("doc_id", "source", "size", "source_size", "target"), draws


def taken_words(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words, repeats counted)."""
    sized, draws = mix(documents)
    sums = draws.groupBy("doc_id", "source", "size").agg(F.sum("words").alias("words"))
    rows = sized.groupBy("doc_id", "source", "size").agg(
        F.count(F.lit(1)).alias("rows"), F.first("source_size").alias("source_size"), F.first("target").alias("target")
    )
    # Repeated rows share what they take: the first ones get the remainder.
    same = (
        rows["doc_id"].eqNullSafe(sums["doc_id"]) & rows["source"].eqNullSafe(sums["source"]) & (rows["size"] == sums["size"])
    )
    joined = rows.join(sums, same, "left").select(rows["*"], F.coalesce("words", F.lit(0)).alias("words"))
    return joined.select("*", F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("i")).select(
        "doc_id", "size", "source_size", "target",
        (F.floor(F.col("words") / F.col("rows")) + (F.col("i") <= F.col("words") % F.col("rows")).cast("long")).cast("long").alias("taken"),
    )
