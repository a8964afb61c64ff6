"""Consecutive numbers without a global sort, and names that don't collide."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import saved

BUCKETS = 1024


def numbered(rows: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """Distinct keys with number, 0 to their count less one, in a seeded order that reruns repeat.

    Keys are numbered within hash buckets; only the buckets' counts meet in one place.
    """
    keys = rows.select(key).distinct().withColumn("hash", F.xxhash64(F.lit(seed), key)).withColumn("bucket", F.pmod("hash", F.lit(BUCKETS)))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = keys.groupBy("bucket").agg(F.count("*").alias("n"))
    offsets = counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("hash", key)) - 1
    # at most BUCKETS rows are broadcast
    return keys.withColumn("place", place).join(F.broadcast(offsets), "bucket").select(key, (F.col("offset") + F.col("place")).alias("number"))


def numbered_by_digest(rows: DataFrame, within: str, digest: Column, kept: list[str]) -> DataFrame:
    """The kept columns and number, from 0 in each group, in the order of a hexadecimal digest that is unique within it.

    The first three digits name a bucket, so a group of any size is cut into 4,096 even parts; only their counts meet. within has few values and is not null. Rows are made
    and shuffled once, without their digests, and saved with their place in the bucket; at most 4,096 counts for each value of within are broadcast.
    """
    told = rows.withColumn("_bucket", F.substring(digest, 1, 3)).repartition(within, "_bucket").withColumn("_digest", digest)
    place = F.row_number().over(Window.partitionBy(within, "_bucket").orderBy("_digest")) - 1
    placed = saved(told.withColumn("_place", place).select(*dict.fromkeys([within, *kept]), "_bucket", "_place"))
    before = Window.partitionBy(within).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(within, "_bucket").agg(F.count("*").alias("_n"))
    offsets = saved(counts.select(within, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")))
    found = placed.join(F.broadcast(offsets), [within, "_bucket"])
    return found.select(*kept, (F.col("_offset") + F.col("_place")).cast("long").alias("number"))


def numbered_within(rows: DataFrame, by: list[str], order: list, name: str = "place") -> DataFrame:
    """Adds place (or name), from 1, in each group's order (which is total). Hot groups are cut into ranges of the order, so none is one task's sort.

    Rows are range-partitioned by group and order and sorted; a row's place is its number in its partition, less that of the group's first row there, and what the group has in the
    partitions before. Only counts by (partition, group) meet, at most one row each.
    """
    laid = rows.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order).withColumn("_id", F.monotonically_increasing_id())
    laid = saved(laid.withColumn("_part", F.shiftright("_id", 33)))
    counts = laid.groupBy(*by, "_part").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("_part").alias("_p"), "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    same = F.col("_part") == F.col("_p")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    found = laid.join(offsets, same)
    return found.select(*rows.columns, (F.col("_offset") + F.col("_id") - F.col("_first") + 1).cast("long").alias(name))


def unique_names(rows: DataFrame, within: list[str], name: str, order: list[str], suffix: Column | None = None, max_rounds: int = 50) -> DataFrame:
    """Adds unique_name: the first row of a name (in order) keeps it, later ones get _1, _2 and so on, or _ and their suffix.

    A made name that another row bears already is passed over: such rows take their next number, round by round, until no two are
    equal. A row that bears a name by nature goes before those that are made it.
    """
    made = lambda n: F.when(F.col("_first"), F.col(name)).otherwise(F.concat_ws("_", F.col(name), n.cast("string") if suffix is None else suffix))
    now = numbered_within(rows, [*within, name], order, "_n").withColumn("_n", F.col("_n") - 1)
    now = now.withColumn("_first", F.col("_n") == 0).withColumn("unique_name", made(F.col("_n")))
    if suffix is not None:
        return now.drop("_n", "_first")
    # rows that bear one name are few here, however many share the plain one
    taken = Window.partitionBy(*within, "unique_name").orderBy(F.desc("_first"), "_n", name, *order)
    for _ in range(max_rounds):
        now = saved(now)
        late = now.withColumn("_late", F.row_number().over(taken) > 1).filter("_late")
        late = saved(late.groupBy(*[F.col(c).alias(f"_by_{i}") for i, c in enumerate([*within, name])]).agg(F.min("_n").alias("_from")))
        if late.isEmpty():
            return now.drop("_n", "_first")
        # a late row and those behind it in its name move on by one
        same = F.lit(True)
        for i, c in enumerate([*within, name]):
            same = same & F.col(c).eqNullSafe(F.col(f"_by_{i}"))
        behind = F.coalesce(F.col("_n") >= F.col("_from"), F.lit(False)).cast("long")
        now = now.join(late, same, "left").withColumn("_n", F.col("_n") + behind).withColumn("unique_name", made(F.col("_n"))).select(*now.columns)
    raise RuntimeError("names did not settle")
