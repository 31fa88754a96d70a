"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Targets. Every source has a weight; together they share the size of the whole corpus, a source never
   more than `REPEATS` times its own size, the excess going to the others by weight.
2. Blocks. The documents of a source are laid end to end in the order of a hash, and cut into blocks of
   `BLOCK` words; a document belongs to the block in which it starts. A source's quota is the exact list of
   blocks that reach its target: all blocks of every full pass, and the first ones of the last pass.
3. Tree. The root holds the quotas of all sources. Each node gives an equal number of its blocks to each of
   its `FAN` children by a random order of its own: what a child gets of each source follows the
   multivariate hypergeometric law, and the children's counts add up to the node's exactly.
4. Draw. A leaf is an output shard. Its blocks are disjoint from those of all others; within it, the
   documents stand in an order of their own (`position`).

Random orders come from hashes of ids, so that reruns agree. Nothing is counted or ranked in one task:
places in a source come from sums per slice of the hash range, and a node's order from a range sort whose
partitions are numbered by their counts. Words of a document that the last block cuts are not taken.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendspark.llm.common import WORD, cut, split_row

WEIGHTS = (5, 2, 1)
REPEATS = 3
BLOCK = 4096
SLICE_DIGITS = 3  # hexadecimal digits of the hash that name a slice: 4,096 slices a source
FAN_BITS = 3
LEVELS = 2
SHARDS = 1 << (FAN_BITS * LEVELS)


def in_order(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Number all rows from 0 in the given order, each partition of a range sort counting its own."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = cut(ranged.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")))
    counts = numbered.groupBy("_part").agg(F.count("*").alias("n"), F.min("_at").alias("low")).orderBy("_part").collect()
    if not counts:
        return numbered.select(*df.columns, F.lit(0).cast("long").alias(name))
    # One number per partition: where it starts, less the number of its own first row.
    shifts = [(r["_part"], r["low"], start) for r, start in zip(counts, accumulate([0, *(r["n"] for r in counts)]))]
    starts = df.sparkSession.createDataFrame(shifts, "_part int, low long, start long")
    return numbered.join(F.broadcast(starts), "_part").select(
        *df.columns, (F.col("_at") - F.col("low") + F.col("start")).alias(name)
    )


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, source_size): weights by code point, a null source last.

    Only sums over all sources reach the driver; the rounds end when no source is above its limit.
    """
    placed = in_order(sizes.withColumn("nameless", F.col("source").isNull()), ["nameless", "source"], "place")
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("place") % len(WEIGHTS) + 1).cast("int"))
    limit = (F.col("source_size") * REPEATS).alias("limit")
    weighed = cut(placed.select("source", "source_size", weight.cast("long").alias("weight"), limit, F.lit(False).alias("full")))
    whole = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).head()[0]
    full = F.lit(False)
    while True:
        free = weighed.select(full.alias("full"), "weight", "limit")
        given, shares = free.agg(
            F.coalesce(F.sum(F.when(F.col("full"), F.col("limit"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))), F.lit(0)),
        ).head()
        part = (F.lit(whole - given) * F.col("weight")).cast("double") / F.lit(max(shares, 1)).cast("double")
        above = ~full & (part > F.col("limit"))
        if weighed.where(above).isEmpty():
            break
        # A source once at its limit stays there, as the others' parts only grow.
        full = full | above
    return weighed.select("source", "source_size", F.when(full, F.col("limit").cast("double")).otherwise(part).alias("target"))


def _in_source(rows: DataFrame) -> DataFrame:
    """Add `start`: the words of a source's documents that stand before this one in the order of `order`."""
    slices = rows.groupBy("source", F.substring("order", 1, SLICE_DIGITS).alias("slice")).agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.select("source", "slice", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("slice_start"))
    within = Window.partitionBy("source", "slice").orderBy("order", "row").rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("slice", F.substring("order", 1, SLICE_DIGITS)).withColumn(
        "local", F.coalesce(F.sum("size").over(within), F.lit(0))
    )
    same = local.source.eqNullSafe(starts.source) & (local.slice == starts.slice)
    return local.join(starts, same).select(local["*"], (F.col("local") + F.col("slice_start")).alias("start")).drop("local", "slice")


def split_tree(draws: DataFrame) -> DataFrame:
    """Give every drawn block of `draws` (any columns, with a unique `draw`) its output `shard`."""
    nodes = draws.withColumn("shard", F.lit(0))
    for level in range(LEVELS):
        key = F.md5(F.concat_ws(":", F.lit(f"split {level}"), "draw"))
        ranked = in_order(nodes.withColumn("chance", key), ["shard", "chance", "draw"], "rank")
        # The blocks of a node stand together in the order; a node's own count and first rank cut it evenly.
        spans = ranked.groupBy("shard").agg(F.min("rank").alias("first"), F.count("*").alias("held"))
        child = F.floor((F.col("rank") - F.col("first")) * (1 << FAN_BITS) / F.col("held")).cast("int")
        # At most SHARDS nodes: a few hundred bytes.
        nodes = ranked.join(F.broadcast(spans), "shard").select(
            *draws.columns, (F.shiftleft("shard", FAN_BITS) + child).alias("shard")
        )
    return nodes


def draw(rows: DataFrame) -> DataFrame:
    """The mix of (row, id, source, size): those columns and source_size, target, taken, draws.

    `taken` counts the words taken over all passes; `draws` lists (pass, shard, position) of each copy.
    """
    order = F.md5(F.concat_ws(":", F.lit("mix"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("size").cast("string")))
    placed = cut(_in_source(rows.withColumn("order", order)).withColumn("block", F.floor(F.col("start") / BLOCK)))
    goals = cut(targets(placed.groupBy("source").agg(F.sum("size").alias("source_size"))))
    blocks = placed.groupBy("source", "block").agg(F.min(F.when(F.col("size") > 0, F.col("start"))).alias("first"))
    filled = blocks.where(F.col("first").isNotNull())  # a block of empty documents adds nothing
    goal = F.round("target").cast("long")
    passes = F.floor(goal / F.col("source_size"))
    drawn = (
        filled.join(goals.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
        .where("source_size > 0")
        .select("source", "block", F.explode(F.sequence(F.lit(0), passes)).alias("pass"), "first", goal.alias("goal"), "source_size")
        .where(F.col("pass") * F.col("source_size") + F.col("first") < F.col("goal"))
        .select("source", "block", "pass", F.concat_ws(":", F.col("source").isNull(), "source", "block", "pass").alias("draw"))
    )
    by_block = (
        split_tree(drawn)
        .groupBy("source", "block")
        .agg(F.sort_array(F.collect_list(F.struct("pass", "shard"))).alias("draws"))
        .select(F.col("source").alias("_source"), F.col("block").alias("_block"), "draws")
    )
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block"))
    joined = placed.join(by_block, same, "left").drop("_source", "_block")
    joined = joined.join(goals.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")), "left")
    left = F.round("target").cast("long") - F.col("start")

    def words(taken_pass: Column) -> Column:
        return F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), left - taken_pass * F.col("source_size")))

    here = F.filter(F.coalesce("draws", F.array().cast("array<struct<pass:bigint,shard:int>>")), lambda d: words(d["pass"]) > 0)
    taken = F.aggregate(here, F.lit(0).cast("long"), lambda total, d: total + words(d["pass"]))
    position = F.transform(
        here, lambda d: F.struct(d["pass"], d["shard"], F.md5(F.concat_ws(":", F.lit("shuffle"), "order", d["pass"])).alias("position"))
    )
    return joined.select("row", "id", "source", "size", "source_size", "target", taken.alias("taken"), position.alias("draws"))


def _size(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size")


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, size, source_size, target, taken, draws) for every row of `df`, those not drawn too.

    Size counts words; a null, empty or blank text has none and is never taken. A null source is a source,
    the last one. Null ids are drawn like others; rows that repeat an id and a size are told apart by their
    order of arrival only. Other columns are not read. An empty table gives no rows.
    """
    row = F.monotonically_increasing_id().alias("row")
    rows = cut(df.select(row, F.col(id_col).cast("long").alias("id"), F.col(source_col).alias("source"), _size(text_col)))
    return draw(rows).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "draws")


def mixed_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of `df` as the mix repeats them, with all their columns; cases as in `mix`.

    A document comes as often as the mix takes its words, to the nearest whole number: the one document
    that a source's last block cuts is in if half of it is. Copies lie in the order of their output shard and of their position in
    it, so that those of one document stand apart and every stretch of the output is mixed.
    """
    whole = split_row(df, [id_col, text_col, source_col])
    rows = cut(whole.select(F.col("_row").alias("row"), F.col("_0").cast("long").alias("id"), F.col("_2").alias("source"), _size("_1")))
    times = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")  # the passes that take all of it come first
    taken = draw(rows).where("size > 0").select(F.col("row").alias("_row"), F.explode(F.slice("draws", F.lit(1), times)).alias("_copy"))
    copies = whole.join(taken, "_row").select("_doc", "_copy.shard", "_copy.position")
    return copies.repartitionByRange("shard", "position").sortWithinPartitions("shard", "position").select("_doc.*")
