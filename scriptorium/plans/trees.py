"""Trees of directories renamed from the root down, with names that don't collide."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import folded_slug, short_hash
from ..sources.shared import saved


def safe_file_name(name: Column) -> Column:
    """The slug of the stem, and the extension in lower case."""
    ending = F.regexp_extract(name, "[^.](\\.[^.]*)$", 1)
    return F.concat(folded_slug(F.substring(name, F.lit(1), F.length(name) - F.length(ending))), F.lower(ending))


def _claimed(rows: DataFrame, parent: list[str], safe: str, order: str, other: Column) -> DataFrame:
    """Adds name: the first row (by order, unique) of a parent that comes to a name takes it; a later one takes the name other, whoever else has that.

    A name is taken by those that have it by nature and by those that it was made for, so a row whose own name was made for an earlier one takes another too: rounds until
    no such row is left, mostly one. Only the first row of a name counts, so a name that very many bear is combined before it is shuffled.
    """
    now = rows.withColumn("_other", other).withColumn("_made", F.lit(False))
    while True:
        now = now.withColumn("name", F.when(F.col("_made"), F.col("_other")).otherwise(F.col(safe)))
        first = now.groupBy(*parent, "name").agg(F.min(order).alias("_first"))
        first = first.select(*[F.col(c).alias(f"_p_{c}") for c in parent], F.col("name").alias("_taken"), "_first")
        same = F.col(safe) == F.col("_taken")
        for c in parent:
            same = same & (F.col(c) == F.col(f"_p_{c}"))
        now = saved(now.drop("name").join(first, same, "left").withColumn("_late", ~F.col("_made") & (F.col("_first") < F.col(order))).select(*rows.columns, "_other", (F.col("_made") | F.col("_late")).alias("_made"), "_late"))
        if now.filter("_late").isEmpty():
            return now.select(*rows.columns, F.when(F.col("_made"), F.col("_other")).otherwise(F.col(safe)).alias("name"))
        now = now.drop("_late")


def renamed_tree(files: DataFrame, path: str = "path") -> DataFrame:
    """path, normalized_dir, normalized_name of each file: directories and names in ASCII, those that would collide with a digest.

    Directories are told apart by their whole path and come in the order of their first file. Each is walked from the root: a component that is free below
    the names chosen so far keeps its slug; if another directory has it already, even one that shares the component itself, the slug gets
    _ and 8 digits of the sha1 of the parent and the component as it was. So all but the first directory below a parent live below the parent's second name. Files
    then get their names likewise, with the sha1 of their path. One round of joins for each depth of the tree; no directory is one task's. Paths are
    relative, unique and not empty; null ones are left out.
    """
    split = F.regexp_extract(path, "^(.*)/[^/]*$", 1)
    rows = files.filter(F.col(path).isNotNull()).select(F.col(path).alias("path"), split.alias("dir"), F.regexp_extract(path, "[^/]*$", 0).alias("file"))
    rows = saved(rows)
    dirs = rows.groupBy("dir").agg(F.min("path").alias("first"))
    parts = F.filter(F.split("dir", "/"), lambda x: x != "")
    dirs = saved(dirs.select("dir", "first", parts.alias("parts"), F.lit("").alias("to")))
    deepest = dirs.agg(F.max(F.size("parts"))).first()[0] or 0
    for depth in range(deepest):
        part = F.get("parts", F.lit(depth))
        deep = dirs.filter(F.size("parts") > depth).withColumn("part", part)
        deep = _claimed(deep.withColumn("safe", folded_slug(F.col("part"))), ["to"], "safe", "first", F.concat("safe", F.lit("_"), short_hash(F.concat("to", F.lit("/"), "part"))))
        deep = deep.select("dir", "first", "parts", F.concat_ws("/", F.nullif("to", F.lit("")), "name").alias("to"))
        dirs = saved(deep.unionByName(dirs.filter(F.size("parts") <= depth)))
    told = rows.join(dirs.select("dir", "to"), "dir").withColumn("safe", safe_file_name(F.col("file")))
    ending = F.regexp_extract("safe", "(\\.[^.]*)$", 1)
    stem = F.substring("safe", F.lit(1), F.length("safe") - F.length(ending))
    named = _claimed(told, ["to"], "safe", "path", F.concat(stem, F.lit("_"), short_hash(F.col("path")), ending))
    return named.select("path", F.col("to").alias("normalized_dir"), F.col("name").alias("normalized_name"))
