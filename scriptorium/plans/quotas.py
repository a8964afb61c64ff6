"""Quotas, apportionment, numbering and shards for planned datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import saved
from .numbering import numbered_within

#: Rows of a split whose sizes are summed up in one go.
BLOCK = 4096


def equal_quotas(categories: DataFrame, name: str, total: int) -> DataFrame:
    """total over the categories, the first ones by name getting one more. The list of categories is small by nature."""
    n = F.count("*").over(Window.partitionBy(F.lit(1)))
    place = F.row_number().over(Window.orderBy(name))
    return categories.select(name).distinct().select(name, (F.floor(F.lit(total) / n) + F.when(place <= F.lit(total) % n, 1).otherwise(0)).cast("long").alias("quota"))


def split_targets(rows: DataFrame, count: str, train: float = 0.8, val: float = 0.1) -> DataFrame:
    a, b = F.floor(F.col(count) * train), F.floor(F.col(count) * val)
    return rows.select("*", a.alias("train"), b.alias("val"), (F.col(count) - a - b).alias("test"))


def largest_remainder(weights: DataFrame, name: str, weight: str, total: int) -> DataFrame:
    """Whole shares of total by weight: floors first, then one more by falling remainder, weight, and name. Weight 0 gets 0."""
    all_ = F.sum(weight).over(Window.partitionBy(F.lit(1)))
    exact = F.lit(total) * F.col(weight) / F.nullif(all_, F.lit(0))
    rows = weights.filter(F.col(weight) > 0).select(name, F.col(weight).alias("w"), F.floor(exact).alias("whole"), (exact - F.floor(exact)).alias("part"))
    place = F.row_number().over(Window.orderBy(F.desc("part"), F.desc("w"), name))
    left = F.lit(total) - F.sum("whole").over(Window.partitionBy(F.lit(1)))
    shares = rows.select(name, (F.col("whole") + F.when(place <= left, 1).otherwise(0)).alias("share"))
    return weights.select(name).join(shares, name, "left").select(name, F.coalesce("share", F.lit(0)).alias("share"))


def renumber(rows: DataFrame, group: str, order: list, size: int = 1000) -> DataFrame:
    """Adds image_id: consecutive in each group's order; each group begins on a new volume of size numbers.

    Groups are the few scripts or languages of a plan; their counts meet in one place. order is total within a group.
    """
    counts = rows.groupBy(group).agg((F.ceil(F.count("*") / size) * size).alias("room"))
    before = Window.orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(group, F.coalesce(F.sum("room").over(before), F.lit(0)).alias("offset"))
    placed = numbered_within(rows, [group], order)
    return placed.join(F.broadcast(offsets), group).withColumn("image_id", F.col("offset") + F.col("place")).drop("offset", "place")


def seeded_order(rows: DataFrame, split: str, key: str, seed: int) -> DataFrame:
    """Adds place, from 1: a permutation of each split by a digest of seed, split and key (unique), the same in every run. A null or empty split is data.

    Rows are range-partitioned by split and digest and numbered by counts of the ranges, so no split is one task's.
    """
    named = rows.withColumn(split, F.coalesce(F.nullif(F.col(split), F.lit("")), F.lit("data")))
    mixed = named.withColumn("_mix", F.sha1(F.concat_ws(":", F.lit(str(seed)), split, F.col(key).cast("string"))))
    return numbered_within(mixed, [split], ["_mix", key]).drop("_mix")


def next_fit_shards(rows: DataFrame, split: str, size: str, order: list[str], cap: int) -> DataFrame:
    """Adds shard, from 0: a split's rows in order fill a shard until the next would take it beyond cap; a larger row has one of its own.

    Where a shard begins depends on where the one before began, but no fold is needed. From running sums alone each row knows at which row a shard
    that began with it would end. From a split's first row on, that leads from shard to shard; a jump over two shards is two jumps over one, and so on, so that
    the beginnings are all known after as many joins as the logarithm of the most shards of a split. Only rows that a jump reaches are kept for longer jumps, and these soon
    are few. Rows are range-partitioned by split and order; no split is one task's. order is total within a split; null sizes are 0; a null split is one.
    """
    sized = rows.withColumn("_size", F.coalesce(F.col(size), F.lit(0)).cast("long"))
    placed = saved(_running(numbered_within(sized, [split], order, "_place"), split))
    jump = saved(_ends(placed, split, cap))
    starts, step = saved(placed.filter("_place = 1").select(split, "_place", F.lit(0).cast("long").alias("_nth"))), 1
    same = lambda left, right: F.col(f"a.{split}").eqNullSafe(F.col(f"b.{split}")) & (F.col(left) == F.col(right))
    while True:
        # jump leads step shards on, and the first step beginnings are known
        more = starts.alias("a").join(jump.alias("b"), same("a._place", "b._place")).select(F.col(f"a.{split}").alias(split), F.col("b.next").alias("_place"), (F.col("a._nth") + step).alias("_nth"))
        starts = saved(starts.unionByName(more))
        if starts.filter(F.col("_nth") >= step).isEmpty():
            break
        reached = jump.select(split, F.col("next").alias("_place")).distinct().unionByName(starts.select(split, "_place"))
        jump = jump.alias("a").join(reached.alias("b"), same("a._place", "b._place"), "left_semi")
        jump = saved(jump.alias("a").join(jump.alias("b"), same("a.next", "b._place")).select(F.col(f"a.{split}").alias(split), F.col("a._place").alias("_place"), F.col("b.next").alias("next")))
        step *= 2
    # a row's shard is one less than the beginnings up to its own place
    marks = starts.select(split, "_place", F.lit(0).alias("_kind"))
    both = placed.withColumn("_kind", F.lit(1)).unionByName(marks, allowMissingColumns=True).withColumnRenamed("_place", "_own")
    found = numbered_within(both, [split], ["_own", "_kind"], "_all").filter("_kind = 1")
    return found.select(*rows.columns, (F.col("_all") - F.col("_own") - 1).alias("shard"))


def _running(placed: DataFrame, split: str) -> DataFrame:
    """Adds _upto: the sizes of a split's rows up to and with this one, by sums within blocks of places and of the blocks before."""
    told = placed.withColumn("_block", F.floor((F.col("_place") - 1) / BLOCK).cast("long"))
    sums = told.groupBy(F.col(split).alias("_s"), F.col("_block").alias("_b")).agg(F.sum("_size").alias("_of"))
    before = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_s", "_b", F.coalesce(F.sum("_of").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy(split, "_block").orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = told.withColumn("_in", F.sum("_size").over(within)).join(sums, F.col(split).eqNullSafe(F.col("_s")) & (F.col("_block") == F.col("_b")))
    return found.select(*placed.columns, (F.col("_in") + F.col("_before")).alias("_upto"))


def _ends(placed: DataFrame, split: str, cap: int) -> DataFrame:
    """split, _place, next: the place of the first row that no longer fits into a shard that begins at place; rows whose shard takes all the rest are left out.

    That row is the first one, behind place, whose sum is more than cap beyond the sum before place. Sums and those limits are put in one order by value, range by
    range; limits grow with place, so what stands before a limit are place limits (itself counted) and the sums that don't exceed it.
    """
    sums = placed.select(split, F.col("_upto").alias("value"), F.lit(0).alias("kind"), F.col("_place").alias("own"))
    limits = placed.select(split, (F.col("_upto") - F.col("_size") + cap).alias("value"), F.lit(1).alias("kind"), F.col("_place").alias("own"))
    found = numbered_within(sums.unionByName(limits), [split], ["value", "kind", "own"], "_all").filter("kind = 1")
    following = F.greatest(F.col("own") + 1, F.col("_all") - F.col("own") + 1)
    many = placed.groupBy(F.col(split).alias("_s")).agg(F.max("_place").alias("_many"))
    found = found.select(split, F.col("own").alias("_place"), following.alias("next")).join(many, F.col(split).eqNullSafe(F.col("_s")))
    return found.filter("next <= _many").select(split, "_place", "next")
